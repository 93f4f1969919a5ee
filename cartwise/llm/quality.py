"""Quality classifier by positive-unlabelled learning with a non-negative unbiased risk.

Trusted positives are the labelled documents of quality 1; every document of the learning
rows, labelled or not, is unlabelled web text (label 0 is not used as a negative). The class
prior is estimated from a first classifier of positives against unlabelled text: the least
ratio, over score thresholds, of the unlabelled to the positive share above the threshold,
plus one standard error of the positive share (few positives make the least ratio too low).

With logistic loss the unbiased risk of a linear score g is
prior * mean_P(-g) + mean_U(log(1 + exp(g))). Its part for negatives, mean_U(log(1 + exp(g)))
- prior * mean_P(log(1 + exp(g))), can't be negative for a true classifier; a step that would
make it so is undone along that part instead (non-negative correction). Each Newton step is
one pass over a table of a few dozen figures a document, summed in the tasks, so all
positives and all unlabelled documents count at any size.

Rows: each row is scored by itself; repeated rows are alike. Null text: empty text (all
figures zero). Null id: never labelled; its fold is that of the empty text. A document with
several labels counts as positive if one of them is 1. No positives or no learning rows:
every score is the prior 0.5. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm import text as tx
from cartwise.llm.ship import ship
from cartwise.session import materialize

STEPS = 8
RIDGE = 1e-3
#: Least share of the positives above a threshold for the prior's ratio.
TAIL = 0.3

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_SYMBOL = np.isin(_BYTES, np.frombuffer(b"#*$%&|<>@~^_={}[]\\/", np.uint8))
_MARK = np.isin(_BYTES, np.frombuffer(b"!?", np.uint8))
_STOP = np.isin(_BYTES, np.frombuffer(b".,;:", np.uint8))
_HIGH = _BYTES >= 128


def _per_row(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(values, dtype=np.int64)]
    return (total[at[1:]] - total[at[:-1]]).astype(float)


def features(texts: pa.Array) -> np.ndarray:
    """Figures of whole texts: one row each, the same for equal texts."""
    out = []
    for first, end, data, at in tx.pieces(texts):
        starts, ends, before = tx.words_at(data, at, tx.SPACED)
        size = np.maximum(1.0, np.diff(at))
        count = np.diff(before).astype(float)
        words = np.maximum(1.0, count)
        hashes = tx.word_hashes(tx.LOWER[data], starts, ends)
        lengths = ends - starts
        codes, runs = tx.shingles(hashes, before, 3)
        row = np.repeat(np.arange(end - first), np.diff(before))
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
        kinds = np.array([len(np.unique(hashes[a:b])) for a, b in zip(before[:-1], before[1:])], float)
        windows = np.array([len(np.unique(codes[a:b])) for a, b in zip(runs[:-1], runs[1:])], float)
        lines = _per_row(data == 10, at) + 1
        repeated = np.array(
            [1 - len(set(x)) / len(x) for x in (bytes(data[a:b]).split(b"\n") for a, b in zip(at[:-1], at[1:]))]
        )
        last = data[ends - 1] if len(ends) else data[:0]
        shares = [
            _per_row(table[data], at) / size for table in (_UPPER, _DIGIT, _SYMBOL, _MARK, _STOP, _HIGH)
        ] + [
            _per_row(again, before) / words,
            _per_row(lengths <= 3, before) / words,
            _per_row(lengths > 20, before) / words,
            _per_row(_SYMBOL[last] | _MARK[last], before) / words,
            _per_row(_STOP[last], before) / words,
            _per_row((lengths == 1) & _SYMBOL[data[starts]] if len(starts) else lengths, before) / words,
            np.where(count > 0, 1 - kinds / words, 0),
            np.where(count > 0, 1 - windows / np.maximum(1.0, np.diff(runs)), 0),
            np.where(count > 0, repeated, 0),
        ]
        plain = np.stack(shares, axis=1)
        scale = np.stack(
            [np.log1p(count), np.log1p(lines), np.log1p(_per_row(lengths, before) / words), np.log1p(count) ** 2 / 10], axis=1
        )
        out.append(np.concatenate([plain, np.log1p(30 * plain), scale], axis=1))
    return np.concatenate(out).astype(np.float32) if out else np.zeros((0, 34), np.float32)


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = features(batch["text"])
        offsets = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
        columns = {name: batch[name] for name in batch.schema.names if name != "text"}
        yield pa.RecordBatch.from_pydict(columns | {"x": pa.ListArray.from_arrays(offsets, pa.array(x.reshape(-1)))})


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1).astype(float)


def _total(table: DataFrame, body) -> np.ndarray:
    """Sum of ``body(x, positive)`` (a flat vector) over all rows, added up in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                part = body(_matrix(batch["x"]), batch["positive"].to_numpy(zero_copy_only=False))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(len(total)), pa.int32()), "v": pa.array(total)})

    rows = table.select("x", "positive").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(len(rows))
    out[rows["i"].to_numpy()] = rows["v"].to_numpy()
    return out


def _bodies():
    """The sums of a pass; local, so that tasks get them with the values they close over."""

    def moments(x, positive):
        return np.r_[len(x), positive.sum(), x.sum(0), (x * x).sum(0)]

    def step(center, scale, w, prior, n, n_positive):
        def body(x, positive):
            z = np.c_[(x - center) / scale, np.ones(len(x))]
            g = z @ w
            s = 1 / (1 + np.exp(-g))
            loss = np.logaddexp(0, g)
            p = positive.astype(bool)
            grad_u = z.T @ s / n
            grad_p = z[p].sum(0) / n_positive
            grad_pn = z[p].T @ s[p] / n_positive
            hess = (z * (s * (1 - s) / n)[:, None]).T @ z
            return np.r_[loss.sum() / n, loss[p].sum() / n_positive, g[p].sum() / n_positive, grad_u, grad_p, grad_pn, hess.reshape(-1)]

        return body

    def histogram(center, scale, w):
        def body(x, positive):
            g = np.c_[(x - center) / scale, np.ones(len(x))] @ w
            bins = np.clip(((1 / (1 + np.exp(-g))) * 1000).astype(int), 0, 999)
            p = positive.astype(bool)
            return np.r_[np.bincount(bins, minlength=1000), np.bincount(bins[p], minlength=1000)].astype(float)

        return body

    return moments, step, histogram


def fit(table: DataFrame, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(center, scale, weights, prior) from rows (x, positive), all of them unlabelled text."""
    moments, step, histogram = _bodies()
    sums = _total(table, moments)
    d = (len(sums) - 2) // 2
    if len(sums) < 2 or sums[0] == 0 or sums[1] == 0:
        return np.zeros(34), np.ones(34), np.zeros(35), 0.5
    n, n_positive = sums[0], sums[1]
    center = sums[2 : 2 + d] / n
    scale = np.sqrt(np.maximum(1e-12, sums[2 + d :] / n - center**2))
    scale = np.where(scale < 1e-5, 1.0, scale)

    def solve(prior: float) -> np.ndarray:
        w = np.zeros(d + 1)
        ridge = np.r_[np.full(d, RIDGE + 3 / n), 1e-9]
        for _ in range(steps):
            out = _total(table, step(center, scale, w, prior, n, n_positive))
            loss_u, loss_p, _ = out[:3]
            grad_u, grad_p, grad_pn = out[3 : 3 + 3 * (d + 1)].reshape(3, -1)
            hess = out[3 + 3 * (d + 1) :].reshape(d + 1, d + 1)
            if loss_u - prior * loss_p < 0:
                # Non-negative correction: climb back along the negatives' part alone.
                w = w + 0.5 * np.linalg.solve(hess + np.diag(ridge), grad_u - prior * grad_pn)
                continue
            move = np.linalg.solve(hess + np.diag(ridge), grad_u - prior * grad_p + ridge * w)
            longest = np.abs(move).max()
            w = w - move * min(1.0, 3.0 / max(longest, 1e-12))
            if longest < 1e-3:
                break
        return w

    # Positives against unlabelled text, weighed alike, only to rank the documents.
    first = solve(0.5)
    counts = _total(table, histogram(center, scale, first))
    every, own = counts[:1000][::-1].cumsum() / n, counts[1000:][::-1].cumsum() / n_positive
    ratio = (every / np.maximum(own, 1e-12) + 1 / np.sqrt(np.maximum(1.0, own * n_positive)))[own >= TAIL]
    prior = float(np.clip(ratio.min(), 0.05, 0.98))
    return center, scale, solve(prior), prior


def classify(docs: DataFrame, labels: DataFrame, learns) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text); ``learns`` selects the learning rows.

    ``labels`` has doc_id and quality. Returns doc_id, held_out, score (probability of
    quality 1), predicted (score >= 0.7) and the class prior.
    """
    spark = docs.sparkSession
    ship(spark)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    trusted = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("labelled")).distinct()
    rows = docs.select("doc_id", "text", (~learns).alias("held_out"))
    table = materialize(
        rows.mapInArrow(_feature_batches, f"doc_id {id_type}, held_out boolean, x array<float>"), "features"
    )
    marked = table.join(trusted, table["doc_id"] == trusted["labelled"], "left")
    learning = materialize(
        marked.where("not held_out").select("x", F.col("labelled").isNotNull().alias("positive")), "learning"
    )
    center, scale, w, prior = fit(learning)

    def scored(column: pa.Array) -> pa.Array:
        x = _matrix(column)
        return pa.array(1 / (1 + np.exp(-(((x - center) / scale) @ w[:-1] + w[-1]))) if len(x) else np.zeros(0))

    score = F.arrow_udf(scored, "double")
    return table.withColumn("score", score("x")).select(
        "doc_id",
        "held_out",
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.lit(prior).alias("prior"),
    )
