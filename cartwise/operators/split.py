"""Row filters and the temporal split."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def positives(df: DataFrame) -> DataFrame:
    return df.where(F.col("added_to_cart") == 1)


def split_bounds(
    split_date: str, test_days: int = 7, val_days: int | None = None
) -> tuple[Column, Column]:
    """Start of validation and start of test.

    Validation is as long as ``test_days`` unless ``val_days`` is given.
    """
    test_start = datetime.fromisoformat(split_date)
    val_start = test_start - timedelta(days=test_days if val_days is None else val_days)
    as_ntz = lambda t: F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")
    return as_ntz(val_start), as_ntz(test_start)


def temporal_split(df: DataFrame, timestamp: str = "timestamp", **bounds) -> DataFrame:
    """Label rows train, val or test; the test period is open-ended."""
    val_start, test_start = split_bounds(**bounds)
    return df.withColumn(
        "split",
        F.when(F.col(timestamp) >= test_start, "test")
        .when(F.col(timestamp) >= val_start, "val")
        .when(F.col(timestamp) < val_start, "train"),
    )


def split_frames(
    df: DataFrame, timestamp: str = "timestamp", **bounds
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test as plain range filters, which scans can push down."""
    val_start, test_start = split_bounds(**bounds)
    time = F.col(timestamp)
    return (
        df.where(time < val_start),
        df.where((time >= val_start) & (time < test_start)),
        df.where(time >= test_start),
    )
