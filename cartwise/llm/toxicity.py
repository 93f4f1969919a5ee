"""Toxicity classifier with a counterfactual penalty on identity terms.

Features are words and their first four and five bytes (A-Z in lower case, marks at the end
cut off). One pass over all labelled learning texts counts, for each feature, the toxic and
the clean documents that hold it; all features with at least ``LEAST_DOCS`` documents whose
association is significant (``LEAST_CHI``, the same test at every size), and all identity
terms, make the model's vocabulary as far as a row of the fit holds them. Vectors are sparse.

Counterfactuals: each mention of an identity term in a labelled sentence is swapped for the
other terms of its group, and for a neutral word. The rest of the sentence stays, and a first
mention changes the score in proportion to the difference of the two terms' weights (features are
log1p of counts, so repeated mentions change it less); the squared differences, weighed by the mentions counted
over all labelled texts, are added to the logistic loss with weight ``PENALTY``. So terms of
a group end with nearly the same weight, and mentioning a group at all changes little.

The weights are fitted on at most about ``FIT_ROWS`` labelled rows, chosen by a hash of the
id (documented bound); counts, mentions and scores cover all rows.

Very long texts are read whole, in pieces of rows; a row's features are distinct codes.

Rows: each row is scored by itself; repeated rows are alike. Null text: empty text. Null id:
never labelled; its fold is that of the empty text. A document with several labels counts
as toxic if one of them is 1. Only one class, or no labels: the score of all rows is the
share of toxic labels (0 without any). Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm import text as tx
from cartwise.llm.ship import ship
from cartwise.session import broadcast_if_small, materialize, temporary_tables

#: Least root of chi-square of a feature: 5 % error at one degree of freedom.
LEAST_CHI = 1.96
FIT_ROWS = 20_000
PENALTY = 10.0
RIDGE = 1e-5
STEPS = 40
#: Steps of conjugate gradients in a step of Newton's method.
INNER = 60
#: Fewest documents that hold a feature.
LEAST_DOCS = 3
# Groups of identity terms that can stand for each other.
IDENTITY = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("disabled", "deaf", "blind", "elderly", "young"),
)
_TAIL = np.isin(np.arange(256), np.frombuffer(b".,;:!?\"')", np.uint8))


def _codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Three hashes for each word (a row of the result each): word, first 4, first 5 bytes."""
    for _ in range(3):
        cut = (ends - starts > 1) & _TAIL[data[ends - 1]] if len(ends) else np.zeros(0, bool)
        ends = ends - cut
    return np.stack(
        [
            tx.word_hashes(data, starts, ends),
            tx.word_hashes(data, starts, np.minimum(ends, starts + 4)),
            tx.word_hashes(data, starts, np.minimum(ends, starts + 5)),
        ]
    )


def code_of(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(tx.word_hashes(data, np.array([0]), np.array([len(data)]))[0])


def codes_of(word: str) -> list[int]:
    """The codes of all three features of a word."""
    body = word.encode()
    return [code_of(body[:n].decode("utf-8", "ignore")) for n in (len(body), 4, 5)]


def _pieces(texts: pa.Array):
    for first, end, data, at in tx.pieces(texts):
        data = tx.LOWER[data]
        starts, ends, before = tx.words_at(data, at, tx.SPACED)
        yield first, end, _codes(data, starts, ends), before


def _count_batches(identity: frozenset):
    terms = np.array(sorted(identity), np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch["toxic"].to_numpy(zero_copy_only=False).astype(bool)
            for first, end, codes, before in _pieces(batch["text"]):
                found, flags = [], []
                for i in range(end - first):
                    own = np.unique(codes[:, before[i] : before[i + 1]])
                    found.append(own)
                    flags.append(np.full(len(own), toxic[first + i]))
                code, inverse = np.unique(np.concatenate(found), return_inverse=True)
                bad = np.bincount(inverse, np.concatenate(flags), len(code)).astype(np.int64)
                docs = np.bincount(inverse, minlength=len(code))
                mention = codes[0][np.isin(codes[0], terms)]
                n = np.zeros(len(code), np.int64)
                if len(mention):
                    np.add.at(n, np.searchsorted(code, mention), 1)
                yield pa.RecordBatch.from_pydict(
                    {
                        "code": pa.array(code.view(np.int64)),
                        "toxic": pa.array(bad),
                        "clean": pa.array(docs - bad),
                        "mentions": pa.array(n),
                    }
                )

    return run


def _code_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, codes, _ in _pieces(batch["text"]):
            yield pa.RecordBatch.from_pydict({"code": pa.array(np.unique(codes).view(np.int64))})


@dataclass
class Model:
    """Sorted feature codes with their weights, and the intercept."""

    codes: np.ndarray
    weights: np.ndarray
    bias: float

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, place, number) of the features in each text, sorted by row and place."""
        found = [np.zeros(0, np.int64)]
        if len(self.codes):
            door = np.zeros(1 << 16, bool)
            door[self.codes & np.uint64(0xFFFF)] = True
            for first, end, codes, before in _pieces(texts):
                row = np.repeat(np.arange(first, end), np.diff(before))
                for line in codes:
                    near = np.flatnonzero(door[line & np.uint64(0xFFFF)])
                    place = np.searchsorted(self.codes, line[near])
                    place = np.minimum(place, len(self.codes) - 1)
                    hit = self.codes[place] == line[near]
                    found.append(row[near[hit]] * len(self.codes) + place[hit])
        key, n = np.unique(np.concatenate(found), return_counts=True)
        row, place = np.divmod(key, max(1, len(self.codes)))
        return row, place, n

    def score(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts))
        # A few thousand rows at a time: the features found stay few.
        for low in range(0, len(texts), 2048):
            size = min(2048, len(texts) - low)
            row, place, n = self.counts(texts.slice(low, size))
            z = np.bincount(row, np.log1p(n) * self.weights[place], size) + self.bias
            out[low : low + size] = 1 / (1 + np.exp(-z))
        return out


def swaps(codes: np.ndarray, mentions: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(differences, weights) over sorted ``codes``: one row for each swap of a mentioned term."""
    place = {int(c): i for i, c in enumerate(codes)}
    rows, weights = [], []
    for group in IDENTITY:
        for a in group:
            # None stands for a neutral word, which has no features.
            for b in (*group, None):
                if a != b and mentions.get(code_of(a)):
                    row = np.zeros(len(codes))
                    np.add.at(row, [place[c] for c in codes_of(a)], 1)
                    np.add.at(row, [place[c] for c in (codes_of(b) if b else ())] or np.zeros(0, int), -1)
                    rows.append(row)
                    weights.append(mentions[code_of(a)] / len(group))
    if not rows:
        return np.zeros((0, len(codes))), np.zeros(0)
    weights = np.array(weights)
    return np.array(rows), weights / weights.sum()


def fit_weights(
    vectors: tuple[np.ndarray, np.ndarray, np.ndarray],
    y: np.ndarray,
    width: int,
    own: np.ndarray,
    difference: np.ndarray,
    weight: np.ndarray,
    penalty: float = PENALTY,
) -> tuple[np.ndarray, float]:
    """Newton's method on mean logistic loss + penalty * mean squared swap change + ridge.

    ``vectors``: (row, place, value) of ``width`` features. ``own``: places of the columns
    of ``difference``. Each step is solved by conjugate gradients.
    """
    row, place, value = vectors
    pull = 2 * penalty * (difference * weight[:, None]).T @ difference
    ridge = np.r_[np.full(width, RIDGE), 1e-9]

    def ahead(w: np.ndarray) -> np.ndarray:
        return np.bincount(row, value * w[place], len(y)) + w[-1]

    def back(v: np.ndarray) -> np.ndarray:
        return np.r_[np.bincount(place, value * v[row], width), v.sum()] / len(y)

    def held(w: np.ndarray) -> np.ndarray:
        out = ridge * w
        out[own] += pull @ w[own]
        return out

    w = np.zeros(width + 1)
    for _ in range(STEPS):
        s = 1 / (1 + np.exp(-np.clip(ahead(w), -30, 30)))
        curve = s * (1 - s)
        grad = back(s - y) + held(w)
        scale = np.r_[np.bincount(place, value**2 * curve[row], width), curve.sum()] / len(y) + ridge
        scale[own] += np.diag(pull)
        move, left = np.zeros(width + 1), grad.copy()
        eased = left / scale
        way, size = eased, left @ eased
        goal = 1e-10 * size
        for _ in range(INNER):
            if size <= goal:
                break
            bent = back(curve * ahead(way)) + held(way)
            step = size / (way @ bent)
            move, left = move + step * way, left - step * bent
            eased = left / scale
            before, size = size, left @ eased
            way = eased + size / before * way
        w = w - move * min(1.0, 4.0 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-4:
            break
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, learns: Column, fit_rows: int = FIT_ROWS) -> Model:
    """Model from the labelled rows of ``docs`` (doc_id, text) that ``learns`` selects."""
    ship(docs.sparkSession)
    with temporary_tables(docs.sparkSession):
        return _trained(docs, labels, learns, fit_rows)


def _trained(docs: DataFrame, labels: DataFrame, learns: Column, fit_rows: int) -> Model:
    marks = (
        labels.where("toxic is not null and doc_id is not null")
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.max("toxic").alias("toxic"))
    )
    # Narrow labels go to the texts up to a counted bound, so that texts need no shuffle.
    marks = broadcast_if_small(materialize(marks, "marks"), 32)
    rows = docs.where(learns).select("doc_id", "text")
    labelled = rows.join(marks, rows["doc_id"] == marks["labelled"]).select("doc_id", "text", "toxic")
    identity = {code_of(t) for group in IDENTITY for t in group}
    counts = materialize(
        labelled.select("text", "toxic")
        .mapInArrow(_count_batches(frozenset(identity)), "code long, toxic long, clean long, mentions long")
        .groupBy("code")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.sum("mentions").alias("mentions")),
        "toxic-counts",
    )
    sizes = rows.select("doc_id").join(marks, rows["doc_id"] == marks["labelled"]).agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")
    ).first()
    n, bad = sizes["n"], sizes["toxic"] or 0
    if not n or bad in (0, n):
        share = bad / n if n else 0.0
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    # Signed root of the chi-square statistic of the two-by-two table of a feature.
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    held = a + b
    chi = (a * (n - bad - b) - b * (bad - a)) * F.sqrt(F.lit(float(n))) / F.sqrt(held * (n - held + 1) * bad * (n - bad))
    share = min(1.0, fit_rows / n)
    picked = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))
    # A feature that no row of the fit holds would get weight 0: what reaches the driver is
    # bounded by the sample, not by the vocabulary.
    seen = picked.select("text").mapInArrow(_code_batches, "code long").distinct()
    significant = counts.where((held >= LEAST_DOCS) & (F.abs(chi) >= LEAST_CHI))
    best = significant.join(seen, "code", "left_semi").select("code").toArrow()
    terms = np.array(sorted({c for group in IDENTITY for t in group for c in codes_of(t)}), np.uint64)
    codes = np.union1d(best["code"].to_numpy().view(np.uint64), terms)
    signed = [int(np.uint64(c).astype(np.int64)) for c in sorted(identity)]
    mentions = {
        r["code"] & 0xFFFFFFFFFFFFFFFF: r["mentions"]
        for r in counts.where(F.col("code").isin(signed) & (F.col("mentions") > 0)).collect()
    }
    model = Model(codes, np.zeros(len(codes)), 0.0)
    vector = F.arrow_udf(_vector_body(model), "binary")
    sample = picked.select("toxic", vector("text").alias("x")).toArrow()
    y = sample["toxic"].to_numpy().astype(float)
    bodies = sample["x"].to_pylist()
    row = np.repeat(np.arange(len(y)), [len(b) // 8 for b in bodies])
    place, n = np.frombuffer(b"".join(bodies), np.uint32).reshape(-1, 2).astype(np.int64).T
    vectors = row, place, np.log1p(n)
    model.weights, model.bias = fit_weights(
        vectors, y, len(codes), np.searchsorted(codes, terms), *swaps(terms, mentions)
    )
    return model


def _vector_body(model: Model):
    def body(texts: pa.Array) -> pa.Array:
        out = []
        for low in range(0, len(texts), 2048):
            part = texts.slice(low, 2048)
            row, place, n = model.counts(part)
            pairs = np.stack([place, n], axis=1).astype(np.uint32)
            out += [p.tobytes() for p in np.split(pairs, np.searchsorted(row, np.arange(1, len(part))))]
        return pa.array(out, pa.binary())

    return body


def toxic_score(model: Model) -> Column:
    """Column function: probability that a text is toxic."""

    def body(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(texts))

    return F.arrow_udf(body, "double")


def classify(docs: DataFrame, labels: DataFrame, learns: Column) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= 0.7) of every row of ``docs``."""
    model = train(docs, labels, learns)
    score = toxic_score(model)
    return docs.select("doc_id", (~learns).alias("held_out"), score("text").alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.7).cast("int")
    )
