"""Language of texts by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a window forwards and backwards; two gated recurrent layers
give each position a state from either side, and a linear layer on both labels every position
with a probability for each language. A document's probabilities are the mean of those of all
its positions. A window is a word (a run of anything but ASCII white space, A-Z in lower
case); words beyond ``SPAN`` bytes are several windows in a row. States start anew with each
window, so the labels of a word are the same wherever it stands: a word that comes again in a
batch is read once and counted as often as it stands, and no text is cut short.

The network is trained in numpy by backpropagation through time with Adam steps on batches
of windows of one length. Learning rows are sampled to about ``FIT_DOCS`` a language by a hash
of id and text (all of them if there are fewer); Spark counts the windows of the sample by
language, and at most ``FIT_WINDOWS`` windows a language, drawn with their counts as weights
by a hashed race, reach the driver. So the fit is bounded, and the same rows give the same
network. All rows are scored as they are read, from nothing but their text.

Rows: each row is scored by itself. Null texts and texts without a letter get ``und`` and
score 0, as does every text if no learning row has a language. Null ids: their fold is that of
the empty text. Repeated rows count as often as they stand; ties between languages go to the
smaller name. A null language teaches nothing. Empty table: no rows. A very long text is read
whole, its words in blocks, so it needs memory for its words but not for their states. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm import text as tx
from cartwise.llm.ship import ship

#: Most bytes of a window.
SPAN = 32
HIDDEN = 16
FIT_DOCS = 2000
FIT_WINDOWS = 6000
EPOCHS = 10
BATCH = 256
RATE = 0.02
#: Windows whose states are kept at a time when texts are scored, and bytes of texts a piece.
BLOCK = 4096
PIECE = 1 << 25

Params = dict[str, np.ndarray]


class Network(NamedTuple):
    """Weights and the languages of the outputs, in the order of their names."""

    params: Params
    languages: list[str]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def new_params(languages: int, hidden: int = HIDDEN, seed: int = 12, dtype=np.float32) -> Params:
    """Seeded weights; 'bytes' rows are the input weights of each byte for the three gates."""
    draw = np.random.default_rng(seed)
    out: Params = {"out": draw.normal(0, 0.1, (2 * hidden, languages)), "bias": np.zeros(languages)}
    for way in ("forth", "back"):
        out[f"bytes_{way}"] = draw.normal(0, 0.3, (256, 3 * hidden))
        out[f"state_{way}"] = draw.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
    return {name: value.astype(dtype) for name, value in out.items()}


def _run(params: Params, x: np.ndarray, way: str) -> tuple[np.ndarray, list[tuple]]:
    """States (length, windows, hidden) of one direction, and what each step needs again."""
    table, weights = params[f"bytes_{way}"], params[f"state_{way}"]
    h = len(weights)
    length = x.shape[1]
    state = np.zeros((len(x), h), weights.dtype)
    states, kept = np.empty((length, len(x), h), weights.dtype), []
    for t in range(length) if way == "forth" else range(length - 1, -1, -1):
        given, own = table[x[:, t]], state @ weights
        gates = _sigmoid(given[:, : 2 * h] + own[:, : 2 * h])
        update, reset = gates[:, :h], gates[:, h:]
        new = np.tanh(given[:, 2 * h :] + reset * own[:, 2 * h :])
        kept.append((t, state, update, reset, new, own[:, 2 * h :]))
        state = new + update * (state - new)
        states[t] = state
    return states, kept


def _states(params: Params, x: np.ndarray, way: str) -> np.ndarray:
    """As ``_run``, without keeping the steps: gates are worked out in place."""
    table, weights = params[f"bytes_{way}"].copy(), params[f"state_{way}"].copy()
    h = len(weights)
    # tanh(x / 2) gives the gates; halving their weights once saves it in every step.
    table[:, : 2 * h] *= 0.5
    weights[:, : 2 * h] *= 0.5
    length = x.shape[1]
    states = np.empty((length, len(x), h), weights.dtype)
    state = None
    for t in range(length) if way == "forth" else range(length - 1, -1, -1):
        given = table[x[:, t]]
        if state is None:
            own = np.zeros((len(x), h), weights.dtype)
            gates = given[:, : 2 * h]
        else:
            through = state @ weights
            own = through[:, 2 * h :]
            gates = given[:, : 2 * h] + through[:, : 2 * h]
        np.tanh(gates, out=gates)
        gates += 1
        gates *= 0.5
        new = own * gates[:, h:]
        new += given[:, 2 * h :]
        np.tanh(new, out=new)
        kept = -new if state is None else state - new
        kept *= gates[:, :h]
        new += kept
        states[t] = state = new
    return states


def label(params: Params, x: np.ndarray) -> np.ndarray:
    """Probabilities (length, windows, languages) of every position of windows of one length."""
    h = len(params["state_forth"])
    logits = _states(params, x, "forth") @ params["out"][:h]
    logits += _states(params, x, "back") @ params["out"][h:]
    logits += params["bias"]
    logits -= logits.max(2, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(2, keepdims=True)
    return logits


def loss_and_gradients(params: Params, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, Params]:
    """Weighted cross entropy of all positions, and its gradients through time."""
    hidden = len(params["state_forth"])
    runs = {way: _run(params, x, way) for way in ("forth", "back")}
    both = np.concatenate([runs["forth"][0], runs["back"][0]], axis=2)
    logits = both @ params["out"] + params["bias"]
    logits -= logits.max(2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(2, keepdims=True)
    rows = np.arange(len(x))
    share = (weight / (weight.sum() * x.shape[1])).astype(p.dtype)
    loss = float(-(np.log(p[:, rows, y] + 1e-30) * share).sum())
    error = p
    error[:, rows, y] -= 1
    error *= share[:, None]
    grads = {name: np.zeros_like(value) for name, value in params.items()}
    grads["out"] = both.reshape(-1, 2 * hidden).T @ error.reshape(-1, error.shape[2])
    grads["bias"] = error.sum((0, 1))
    into = error @ params["out"].T
    for way, part in (("forth", into[:, :, :hidden]), ("back", into[:, :, hidden:])):
        weights = params[f"state_{way}"]
        passed = np.zeros((len(x), hidden), p.dtype)
        given = np.empty((x.shape[1], len(x), 3 * hidden), p.dtype)
        for t, state, update, reset, new, own in reversed(runs[way][1]):
            total = passed + part[t]
            d_new = total * (1 - update) * (1 - new * new)
            d_update = total * (state - new) * update * (1 - update)
            d_reset = d_new * own * reset * (1 - reset)
            given[t] = np.concatenate([d_update, d_reset, d_new], axis=1)
            through = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
            grads[f"state_{way}"] += state.T @ through
            passed = total * update + through @ weights.T
        np.add.at(grads[f"bytes_{way}"], x.T.reshape(-1), given.reshape(-1, 3 * hidden))
    return loss, grads


def fit(
    windows: list[bytes], y: np.ndarray, weight: np.ndarray, languages: int, epochs: int = EPOCHS, seed: int = 12
) -> Params:
    """Network trained on windows with language numbers ``y``."""
    params = new_params(languages, seed=seed)
    first = {name: np.zeros_like(value) for name, value in params.items()}
    second = {name: np.zeros_like(value) for name, value in params.items()}
    draw = np.random.default_rng(seed)
    lengths = np.array([len(w) for w in windows])
    by_length = {
        n: (np.array([list(windows[i]) for i in np.flatnonzero(lengths == n)], np.uint8), np.flatnonzero(lengths == n))
        for n in np.unique(lengths).tolist()
    }
    per_epoch = sum(-(-len(at) // BATCH) for _, at in by_length.values())
    step, steps = 0, max(1, epochs * per_epoch)
    for _ in range(epochs):
        batches = []
        for n, (x, at) in by_length.items():
            order = draw.permutation(len(at))
            batches += [(x[part], at[part]) for part in np.split(order, range(BATCH, len(order), BATCH))]
        for b in draw.permutation(len(batches)).tolist():
            x, at = batches[b]
            step += 1
            _, grads = loss_and_gradients(params, x, y[at], weight[at].astype(np.float32))
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            rate = RATE * (1 - 0.95 * step / steps)
            for name, g in grads.items():
                g *= min(1.0, 1.0 / max(norm, 1e-12))
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.01 * (g * g - second[name])
                up = first[name] / (1 - 0.9**step)
                params[name] -= (rate * up / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return params


def _windows(text: bytes) -> list[bytes]:
    """Windows of a lower-cased text: its words, long ones cut every ``SPAN`` bytes."""
    out = text.split()
    if out and max(map(len, out)) > SPAN:
        return [w[i : i + SPAN] for w in out for i in range(0, len(w), SPAN)]
    return out


def _lowered(text: str | None) -> bytes:
    # bytes.lower changes A-Z alone, bytes.split cuts at ASCII white space.
    return (text or "").encode().lower()


def _count_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of each batch by language, with their numbers."""
    for batch in batches:
        counts: dict[tuple[str, bytes], int] = {}
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            for window in _windows(_lowered(text)):
                counts[lang, window] = counts.get((lang, window), 0) + 1
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([k[0] for k in counts], pa.string()),
                "window": pa.array([k[1] for k in counts], pa.binary()),
                "n": pa.array(list(counts.values()), pa.int64()),
            }
        )


def train(docs: DataFrame, learns: Column, fit_docs: int = FIT_DOCS, fit_windows: int = FIT_WINDOWS) -> Network:
    """Network from the rows (doc_id, text, lang) that ``learns`` selects."""
    ship(docs.sparkSession)
    rows = docs.where(learns & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Network({}, [])
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, fit_docs / sizes[k]))) for k in languages])
    coin = F.pmod(F.xxhash64(F.lit(12), F.col("doc_id").cast("string"), "text"), F.lit(1 << 30)) / float(1 << 30)
    counted = (
        rows.where(coin < share)
        .select("lang", "text")
        .mapInArrow(_count_windows, "lang string, window binary, n bigint")
        .groupBy("lang", "window")
        .agg(F.sum("n").alias("n"))
    )
    # The first of an exponential race with rates n is a draw with weights n.
    luck = (F.pmod(F.xxhash64(F.lit(12), "lang", "window"), F.lit(1 << 30)) + 1) / float((1 << 30) + 1)
    raced = counted.withColumn("race", -F.log(luck) / F.col("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("race", "window"))
    drawn = raced.withColumn("place", place).where(F.col("place") <= fit_windows).select("lang", "window", "n").toArrow()
    drawn = drawn.sort_by([("lang", "ascending"), ("window", "ascending")])
    number = {k: i for i, k in enumerate(languages)}
    y = np.array([number[k] for k in drawn["lang"].to_pylist()], np.int64)
    weight = np.log1p(drawn["n"].to_numpy().astype(float))
    if not len(y):
        return Network(new_params(len(languages)), languages)
    # Every language weighs the same, whatever its share of the rows.
    total = np.bincount(y, weight, len(languages))
    return Network(fit(drawn["window"].to_pylist(), y, weight / total[y] * len(y), len(languages)), languages)


def window_sums(params: Params, windows: list[bytes]) -> np.ndarray:
    """Sum of the probabilities of all positions of each window."""
    out = np.zeros((len(windows), len(params["bias"])), np.float64)
    lengths = np.fromiter(map(len, windows), np.int64, len(windows))
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        for part in np.split(at, range(BLOCK, len(at), BLOCK)):
            x = np.frombuffer(b"".join([windows[i] for i in part.tolist()]), np.uint8).reshape(-1, n)
            out[part] = label(params, x).sum(0)
    return out


def document_means(params: Params, texts: list[str | None]) -> np.ndarray:
    """Mean probability of all positions of each text; zeros for texts without a word."""
    seen: dict[bytes, int] = {}
    numbers, sizes = [], []
    for text in texts:
        mine = [seen.setdefault(w, len(seen)) for w in _windows(_lowered(text))]
        numbers.append(np.array(mine, np.int64))
        sizes.append(len(mine))
    every = list(seen)
    sums = window_sums(params, every)
    lengths = np.fromiter(map(len, every), np.int64, len(every))
    out = np.zeros((len(texts), len(params["bias"])))
    for row, mine in enumerate(numbers):
        if len(mine):
            out[row] = sums[mine].sum(0) / lengths[mine].sum()
    return out


def _scorer(network: Network):
    """Batch function: language and score in place of the text; pieces of about ``PIECE`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(network.languages, object)
        for batch in batches:
            found, scores = [], []
            for first, end, _, _ in tx.pieces(batch["text"], PIECE):
                means = document_means(network.params, batch["text"].slice(first, end - first).to_pylist())
                best = means.argmax(1)
                found.append(names[best])
                scores.append(means[np.arange(len(means)), best])
            lettered = batch["lettered"].to_numpy(zero_copy_only=False).astype(bool)
            lang = np.where(lettered, np.concatenate(found), "und") if found else np.zeros(0, object)
            score = np.where(lettered, np.clip(np.concatenate(scores), 0, 1), 0.0) if found else np.zeros(0)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "held_out": batch["held_out"],
                    "lang_pred": pa.array(lang.tolist(), pa.string()),
                    "score": pa.array(score, pa.float64()),
                }
            )

    return run


def predict(docs: DataFrame, learns: Column, network: Network) -> DataFrame:
    """doc_id, held_out, lang_pred and score (its pooled probability) of every row."""
    ship(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select("doc_id", (~learns).alias("held_out"), lettered.alias("lettered"), "text")
    if not network.languages:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    return rows.mapInArrow(_scorer(network), f"doc_id {id_type}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, learns: Column) -> DataFrame:
    """Train on the rows that ``learns`` selects, then predict every row of ``docs``."""
    return predict(docs, learns, train(docs, learns))
