"""Ranking metrics over scored candidate rows.

Inside a group rows are ordered by score descending, then item_id, then line_key;
the same order decides every metric, so ties never depend on the partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.functions.hashing import MASK_32, MIX_MULTIPLIER, mix32
from cartwise.operators.ordering import HOT_ROWS, exact_quantiles, running_totals
from cartwise.session import BROADCAST_BYTES, materialize

K_VALUES = (5, 10, 20)
# Draws made one by one are turned into row numbers by 32 bits, so there are fewer rows than that.
MAX_ROWS = 1 << 31
# Most distinct values that go to every task, and the draws that a task makes at a time.
SENT_VALUES = 1 << 18
DRAWS_AT_ONCE = 1 << 18
# Most blocks of values in a split resample, and the least values of one.
BLOCKS = 1 << 16
LEAST_BLOCK = 1 << 11
# Bytes of a numbered value in a broadcast table.
VALUE_BYTES = 32


def rank_order(score: str = "score", ties: Sequence[str] = ("item_id", "line_key")) -> list[Column]:
    return [F.col(score).desc(), *[F.col(t) for t in ties]]


def top_per_group(
    scored: DataFrame,
    k: int = 10,
    group: str | Sequence[str] = "order_id",
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Adds ``rank`` and keeps the first ``k`` rows of each group.

    The optimizer turns the rank filter into a per-task limit before the shuffle,
    so a group of any size sends at most ``k`` rows per task.
    """
    window = Window.partitionBy(*_keys(group)).orderBy(*(order or rank_order()))
    return scored.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def _keys(group: str | Sequence[str]) -> list[str]:
    return [group] if isinstance(group, str) else list(group)


def _ideal_gains(k: int) -> str:
    """SQL array of the ideal DCG for 0..k relevant rows."""
    sums, total = [0.0], 0.0
    for position in range(1, k + 1):
        total += 1 / log2(position + 1)
        sums.append(total)
    return f"array({', '.join(f'{x!r}D' for x in sums)})"


def group_metrics(
    scored: DataFrame,
    k_values: Sequence[int] = K_VALUES,
    group: str | Sequence[str] = "order_id",
    label: str = "added_to_cart",
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Precision, recall and both NDCG variants of each group at each k.

    ``ndcg_k`` compares with the best order of the same top k rows,
    ``ndcg_full_k`` with the best order of the whole group. Groups without
    relevant rows score 0 and stay in. Labels are 0 or 1.
    """
    keys = _keys(group)
    totals = scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("group_size"),
        F.sum(F.col(label).cast("long")).alias("n_relevant"),
    )
    slim = top_per_group(scored, max(k_values), group, order).where(F.col(label) == 1)
    hits = slim.groupBy(*keys).agg(
        *[F.expr(f"count_if(rank <= {k}) AS hits_{k}") for k in k_values],
        *[
            F.expr(f"sum(if(rank <= {k}, 1 / log2(rank + 1), 0D)) AS dcg_{k}")
            for k in k_values
        ],
    )
    joined = totals.join(hits, keys, "left").fillna(
        0, [c for c in hits.columns if c not in keys]
    )
    columns = []
    for k in k_values:
        ideal = _ideal_gains(k)
        columns += [
            f"hits_{k} / least({k}, group_size) AS precision_{k}",
            f"if(n_relevant > 0, hits_{k} / n_relevant, 0D) AS recall_{k}",
            f"if(hits_{k} > 0, dcg_{k} / get({ideal}, int(hits_{k})), 0D) AS ndcg_{k}",
            f"if(n_relevant > 0, dcg_{k} / get({ideal}, int(least({k}, n_relevant))), 0D) "
            f"AS ndcg_full_{k}",
        ]
    return joined.selectExpr(*keys, "group_size", "n_relevant", *columns)


def graded_ndcg(
    scored: DataFrame,
    k: int,
    group: str | Sequence[str] = "order_id",
    label: str = "added_to_cart",
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Both NDCG variants of each group for labels of any grade, gain 2^label - 1."""
    keys = _keys(group)
    dcg = lambda place: F.sum((F.pow(F.lit(2.0), label) - 1) / F.log2(F.col(place) + 1))
    best_first = [F.col(label).desc()]
    top = top_per_group(scored, k, group, order).withColumn(
        "best", F.row_number().over(Window.partitionBy(*keys).orderBy(*best_first))
    )
    kept = top.groupBy(*keys).agg(dcg("rank").alias("dcg"), dcg("best").alias("ideal"))
    whole = (
        top_per_group(scored, k, group, best_first)
        .groupBy(*keys)
        .agg(dcg("rank").alias("ideal_full"))
    )
    share = lambda ideal: F.when(F.col(ideal) > 0, F.col("dcg") / F.col(ideal)).otherwise(0.0)
    return kept.join(whole, keys).select(
        *keys, share("ideal").alias(f"ndcg_{k}"), share("ideal_full").alias(f"ndcg_full_{k}")
    )


def mean_metrics(per_group: DataFrame) -> DataFrame:
    """One row: the mean of every per-group metric over all groups."""
    names = [
        c for c in per_group.columns if c.startswith(("precision_", "recall_", "ndcg_"))
    ]
    return per_group.agg(*[F.avg(c).alias(c) for c in names])


def score_totals(
    scored: DataFrame,
    score: str = "score",
    label: str = "added_to_cart",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Positives and negatives at each distinct score and at all higher ones."""
    histogram = scored.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"),
        F.count(F.when(F.col(label) != 1, 1)).alias("neg"),
    )
    return running_totals(
        histogram,
        [F.col("score").desc()],
        {"pos_above": F.col("pos"), "neg_above": F.col("neg")},
        hot_rows,
    )


def auc_and_precision(
    scored: DataFrame,
    score: str = "score",
    label: str = "added_to_cart",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row: exact ROC AUC (ties count half) and step-wise average precision.

    Both are 0 when only one class is present.
    """
    totals = score_totals(scored, score, label, hot_rows)
    seen_pos = F.col("pos_above") + F.col("pos")
    seen = seen_pos + F.col("neg_above") + F.col("neg")
    sums = totals.agg(
        F.sum("pos").alias("p"),
        F.sum("neg").alias("n"),
        F.sum(F.col("pos") * (F.col("neg_above") + F.col("neg") / 2)).alias("lost"),
        F.sum(F.col("pos") * (seen_pos / seen)).alias("gained"),
    )
    both = (F.col("p") > 0) & (F.col("n") > 0)
    pairs = F.col("p").cast("double") * F.col("n")
    return sums.select(
        F.when(both, 1 - F.col("lost") / pairs).otherwise(0.0).alias("auc"),
        F.when(both, F.col("gained") / F.col("p")).otherwise(0.0).alias("average_precision"),
    )


def ranking_metrics(
    scored: DataFrame,
    k_values: Sequence[int] = K_VALUES,
    group: str = "order_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row with AUC, average precision and all means at all k."""
    overall = auc_and_precision(scored, hot_rows=hot_rows).first()
    return mean_metrics(group_metrics(scored, k_values, group)).select(
        F.lit(overall.auc).alias("auc"),
        F.lit(overall.average_precision).alias("average_precision"),
        "*",
    )


def long_report(row: DataFrame, section: str) -> DataFrame:
    """A one-row metric frame as (section, metric, value) rows."""
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
            for c in row.columns
        ]
    )
    return row.select(F.lit(section).alias("section"), F.inline(entries))


def ranking_report(scored: DataFrame, **options) -> DataFrame:
    return long_report(ranking_metrics(scored, **options), "ranking")


def compare_to_baseline(metrics: DataFrame, baseline_auc: float = 0.725) -> DataFrame:
    """Relative AUC improvement in percent over a fixed baseline."""
    return metrics.select(
        "auc",
        F.lit(baseline_auc).alias("baseline_auc"),
        ((F.col("auc") - baseline_auc) / baseline_auc * 100).alias("improvement_pct"),
    )


def _replicate_means_by_draw(
    values: DataFrame, column: str, rows: int, replicates: int, seed: str, hot_rows: int
) -> DataFrame:
    histogram = values.groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    placed = running_totals(histogram, [F.col("v")], {"before": F.col("n")}, hot_rows)
    distinct = placed.limit(SENT_VALUES + 1).count()
    if distinct <= SENT_VALUES:
        return _means_by_sent_values(placed, rows, replicates, int(seed))
    indexed = placed.select(
        "v", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("n") - 1)).alias("idx")
    )
    spark = values.sparkSession
    draws = spark.range(0, rows * replicates).selectExpr(
        f"id % {replicates} AS replicate", f"id ^ {int(seed)} AS counter"
    ).selectExpr("replicate", f"{mix32('counter')} * {rows} div {2**32} AS idx")
    # With a small table of values broadcast, the draws add up without being shuffled.
    if rows * VALUE_BYTES <= BROADCAST_BYTES:
        indexed = F.broadcast(indexed)
    return draws.join(indexed, "idx").groupBy("replicate").agg(F.avg("v").alias("mean"))


def _means_by_sent_values(placed: DataFrame, rows: int, replicates: int, seed: int) -> DataFrame:
    """The same draws where the distinct values are few enough to go to every task.

    A draw looks its value up, and a task counts how often each replicate drew each value, so
    neither the rows nor the draws are joined or shuffled.
    """
    known = placed.select("v", "before").orderBy("before").collect()
    values, before = np.array([float(r[0]) for r in known]), np.array([r[1] for r in known], np.int64)
    first, second = MIX_MULTIPLIER
    mask, draws = MASK_32, rows * replicates
    # Whole rounds of the replicates, some 2^18 draws at a time.
    block = replicates * max(1, DRAWS_AT_ONCE // replicates)

    def totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(replicates)
        for batch in batches:
            for start in batch["id"].to_numpy() * block:
                ids = np.arange(start, min(start + block, draws), dtype=np.int64)
                x = ids ^ seed
                x = ((x ^ (x >> 15)) & mask) * first & mask
                x = (x ^ (x >> 12)) * second & mask
                index = (x ^ (x >> 15)) * rows >> 32
                found = values[np.searchsorted(before, index, "right") - 1]
                sums += found.reshape(-1, replicates).sum(0)
        yield pd.DataFrame({"replicate": np.arange(replicates), "s": sums})

    blocks = placed.sparkSession.range(0, -(-draws // block))
    means = blocks.mapInPandas(totals, "replicate BIGINT, s DOUBLE").groupBy("replicate")
    return means.agg((F.sum("s") / F.lit(float(rows))).alias("mean"))


def _replicate_means_by_weight(
    values: DataFrame, column: str, replicates: int, seed: str
) -> DataFrame:
    histogram = values.groupBy(F.col(column).cast("double").alias("v")).agg(
        F.count(F.lit(1)).alias("n")
    )
    base = int(seed)

    def partial_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, weight = np.zeros(replicates), np.zeros(replicates)
        for batch in batches:
            for v, n in zip(batch["v"].to_numpy(), batch["n"].to_numpy()):
                bits = int(np.float64(v).view(np.uint64))
                times = np.random.Generator(np.random.Philox(key=[base, bits])).poisson(
                    n, replicates
                )
                total += times * v
                weight += times
        yield pd.DataFrame({"replicate": np.arange(replicates), "s": total, "w": weight})

    return (
        histogram.mapInPandas(partial_sums, "replicate BIGINT, s DOUBLE, w DOUBLE")
        .groupBy("replicate")
        .agg((F.sum("s") / F.sum("w")).alias("mean"))
    )


def _replicate_means_by_split(
    values: DataFrame, column: str, rows: int, replicates: int, seed: str, hot_rows: int
) -> DataFrame:
    """Means of multinomial resamples, drawn by splitting counts down a tree of the values.

    The sorted distinct values are the leaves. All ``rows`` draws of a replicate stand at the
    root; at each node they go left with the share of rows that lies there, a binomial draw
    that depends on the seed and the node only. So counts follow the multinomial law exactly
    at any size, whatever the partitioning. Leaves are dealt in at most ``BLOCKS`` blocks; a
    task draws the path to its block again, then the block's own nodes.
    """
    histogram = values.groupBy(F.col(column).cast("double").alias("v")).agg(
        F.count(F.lit(1)).alias("n")
    )
    order = [F.col("v")]
    sums = {"place": F.lit(1).cast("long"), "before": F.col("n")}
    placed = materialize(running_totals(histogram, order, sums, hot_rows), "leaves")
    leaves = placed.count()
    size = 1 << max(LEAST_BLOCK, -(-leaves // BLOCKS)).bit_length()
    blocked = placed.withColumn("block", F.floor(F.col("place") / size).cast("long"))
    starts = {r[0]: r[1] for r in blocked.groupBy("block").agg(F.min("before")).collect()}
    edges = [starts[b] for b in range(len(starts))] + [rows]
    base = int(seed)

    def totals(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("v")
        v, n = frame["v"].to_numpy(), frame["n"].to_numpy()
        block, upto = int(frame["block"].iloc[0]), np.concatenate([[0], np.cumsum(n)])

        def left_share(at: np.ndarray, below: int, level: int, node: int, part: float) -> np.ndarray:
            draw = np.random.Generator(np.random.Philox(key=[base, (level << 56) | node], counter=below))
            return draw.binomial(at, part)

        # Down to this block: nodes are ranges of blocks.
        counts = np.full(replicates, rows, np.int64)
        low, high, level, node = 0, len(edges) - 1, 0, 0
        while high - low > 1:
            middle = (low + high) // 2
            share = (edges[middle] - edges[low]) / (edges[high] - edges[low])
            left = left_share(counts, 0, level, node, share)
            go_left = block < middle
            counts = left if go_left else counts - left
            low, high = (low, middle) if go_left else (middle, high)
            level, node = level + 1, 2 * node + (not go_left)
        # Inside it: ranges of values, the block's number keeps its nodes apart from others'.
        sums = np.zeros(replicates)
        todo = [(0, len(v), counts, 0, 0)]
        while todo:
            low, high, counts, level, node = todo.pop()
            if high - low == 1:
                sums += counts * v[low]
                continue
            middle = (low + high) // 2
            share = (upto[middle] - upto[low]) / (upto[high] - upto[low])
            left = left_share(counts, block + 1, level, node, share)
            todo.append((low, middle, left, level + 1, 2 * node))
            todo.append((middle, high, counts - left, level + 1, 2 * node + 1))
        return pd.DataFrame({"replicate": np.arange(replicates), "s": sums})

    return (
        blocked.select("block", "v", "n")
        .groupBy("block")
        .applyInPandas(totals, "replicate BIGINT, s DOUBLE")
        .groupBy("replicate")
        .agg((F.sum("s") / F.lit(float(rows))).alias("mean"))
    )


def bootstrap_ci(
    values: DataFrame,
    column: str,
    replicates: int = 1000,
    confidence: float = 0.95,
    seed: str = "42",
    method: str = "split",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row: percentile interval of the mean over resampled replicates.

    ``method`` is the caller's choice at every size. "split" resamples exactly, at a cost of
    distinct values times replicates. "draw" draws rows one by one, the same law again, and
    refuses more rows than 31 bits number. "weight" gives every distinct value a Poisson
    weight per replicate, another estimator, drawn once for all its copies.
    """
    if method not in ("split", "draw", "weight"):
        raise ValueError(f"unknown method {method!r}")
    spark = values.sparkSession
    known = values.where(F.col(column).isNotNull())
    rows = known.count()
    if rows == 0:
        return spark.range(1).select(
            F.lit(None).cast("double").alias("lower"), F.lit(None).cast("double").alias("upper")
        )
    if method == "draw":
        if rows >= MAX_ROWS:
            raise ValueError('too many rows to number; choose method="split"')
        means = _replicate_means_by_draw(known, column, rows, replicates, seed, hot_rows)
    elif method == "split":
        means = _replicate_means_by_split(known, column, rows, replicates, seed, hot_rows)
    else:
        means = _replicate_means_by_weight(known, column, replicates, seed)
    alpha = (1 - confidence) / 2
    low, high = exact_quantiles(means, "mean", [alpha, 1 - alpha], hot_rows)
    return spark.range(1).select(F.lit(low).alias("lower"), F.lit(high).alias("upper"))
