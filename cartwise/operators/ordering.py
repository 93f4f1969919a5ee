"""Ordered computations that stay exact and distributed for groups of any size.

A window partition is one task, so a group holding a large part of the table
must not become one. Groups up to ``hot_rows`` rows go through a plain window.
Larger ones are range-partitioned by (group, order); each range is numbered by
itself and shifted by the totals of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.session import materialize

HOT_ROWS = 1_000_000


def hot_groups(df: DataFrame, group: Sequence[str], hot_rows: int) -> DataFrame | None:
    """Keys of groups with more than ``hot_rows`` rows, or None if there are none.

    The count combines map-side, so the check itself has no hot task. At most
    total / hot_rows keys come back.
    """
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    return None if sizes.isEmpty() else materialize(sizes, "hot")


def _ranged_totals(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    sums: dict[str, Column],
    ranges: int,
) -> DataFrame:
    ranged = materialize(
        df.repartitionByRange(ranges, *[F.col(g) for g in group], *order).withColumn(
            "_range", F.spark_partition_id()
        ),
        "ranged",
    )
    keys = [*group, "_range"]
    per_range = ranged.groupBy(*keys).agg(
        *[F.sum(expr).alias(f"_{name}_total") for name, expr in sums.items()]
    )
    # One row per (group, range): at most `ranges` rows in any window partition.
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = per_range.select(
        *keys,
        *[
            F.coalesce(F.sum(f"_{name}_total").over(before), F.lit(0)).alias(f"_{name}_offset")
            for name in sums
        ],
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.withColumns(
            {name: F.coalesce(F.sum(expr).over(inside), F.lit(0)) for name, expr in sums.items()}
        )
        .join(offsets, keys)
        .withColumns({name: F.col(name) + F.col(f"_{name}_offset") for name in sums})
        .drop("_range", *[f"_{name}_offset" for name in sums])
    )


def numbered(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    name: str = "rn",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the 1-based row number inside each group. ``order`` must be total."""
    window = Window.partitionBy(*group).orderBy(*order)
    hot = hot_groups(df, group, hot_rows)
    if hot is None:
        return df.withColumn(name, F.row_number().over(window).cast("long"))
    small = df.join(hot, list(group), "left_anti").withColumn(
        name, F.row_number().over(window).cast("long")
    )
    rows = hot.agg(F.sum("_n")).first()[0]
    large = _ranged_totals(
        df.join(hot, list(group), "left_semi"),
        group,
        order,
        {name: F.lit(1)},
        ceil(rows / hot_rows) + 1,
    ).withColumn(name, (F.col(name) + 1).cast("long"))
    return small.unionByName(large)


def consecutive(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    column: str,
    next_column: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Pairs (column, value of the next row) inside each group."""

    def by_window(rows: DataFrame) -> DataFrame:
        following = F.lead(F.struct(F.col(column).alias("v"))).over(
            Window.partitionBy(*group).orderBy(*order)
        )
        return (
            rows.withColumn("_next", following)
            .where(F.col("_next").isNotNull())
            .select(*group, column, F.col("_next.v").alias(next_column))
        )

    hot = hot_groups(df, group, hot_rows)
    if hot is None:
        return by_window(df)
    small = by_window(df.join(hot, list(group), "left_anti"))
    rows = hot.agg(F.sum("_n")).first()[0]
    ranked = _ranged_totals(
        df.join(hot, list(group), "left_semi"),
        group,
        order,
        {"_rn": F.lit(1)},
        ceil(rows / hot_rows) + 1,
    ).select(*group, "_rn", column)
    # Neighbours meet on (group, row number): the key spreads a hot group evenly.
    successor = ranked.select(
        *group, (F.col("_rn") - 1).alias("_rn"), F.col(column).alias(next_column)
    )
    large = ranked.join(successor, [*group, "_rn"]).select(*group, column, next_column)
    return small.unionByName(large)


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    sums: dict[str, Column],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add, over the whole frame, the sums of all rows before each row.

    The frame is written once. Up to ``hot_rows`` rows are summed by one window;
    more go through ranges.
    """
    stable = materialize(df, "totals")
    rows = stable.count()
    if rows > hot_rows:
        return _ranged_totals(stable, [], order, sums, ceil(rows / hot_rows) + 1)
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return stable.withColumns(
        {name: F.coalesce(F.sum(expr).over(before), F.lit(0)) for name, expr in sums.items()}
    )


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], hot_rows: int = HOT_ROWS
) -> list[float | None]:
    """Quantiles with linear interpolation, from a distributed value histogram."""
    histogram = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    placed = running_totals(histogram, [F.col("v")], {"before": F.col("n")}, hot_rows)
    total = placed.agg(F.sum("n")).first()[0]
    if not total:
        return [None for _ in probabilities]
    positions = [(total - 1) * p for p in probabilities]
    ranks = sorted({r for h in positions for r in (floor(h), ceil(h))})

    def value_at(rank: int) -> Column:
        inside = (F.col("before") <= rank) & (F.col("before") + F.col("n") > rank)
        return F.max(F.when(inside, F.col("v")))

    found = placed.agg(*[value_at(r).alias(f"r{r}") for r in ranks]).first()
    return [
        found[f"r{floor(h)}"] + (found[f"r{ceil(h)}"] - found[f"r{floor(h)}"]) * (h - floor(h))
        for h in positions
    ]
