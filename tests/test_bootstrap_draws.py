"""Draws one by one: the same numbers at any size, however the values are looked up."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartwise.functions.hashing import MASK_32, MIX_MULTIPLIER, mix32
from cartwise.operators import metrics


def plain_mix(x):
    x = (x ^ x >> 15) * MIX_MULTIPLIER[0] & MASK_32
    x = (x ^ x >> 12) * MIX_MULTIPLIER[1] & MASK_32
    return x ^ x >> 15


def test_counters_beyond_32_bits_do_not_overflow(spark):
    ids = [0, 5, 2**32 - 1, 2**32, 2**33 + 12_345, 2**36 + 7, 2**45 + 1]
    frame = spark.createDataFrame([(i,) for i in ids], "id long")
    assert sorted(rows(frame.selectExpr("id", f"{mix32('id')} AS x"))) == [(i, plain_mix(i)) for i in ids]


def test_more_draws_than_32_bits_count_are_not_refused(spark, monkeypatch):
    asked = []

    def means(values, column, n, replicates, *rest):
        asked.append(n * replicates)
        return spark.range(3).select(F.col("id").cast("double").alias("mean"))

    monkeypatch.setattr(metrics, "_replicate_means_by_draw", means)
    values = spark.range(5).select(F.col("id").cast("double").alias("x"))
    assert metrics.bootstrap_ci(values, "x", replicates=10**9, method="draw").first().lower == pytest.approx(0.05)
    assert asked == [5 * 10**9]


@pytest.mark.parametrize("draws", [1, 1000, 1 << 18])
def test_draws_by_lookup_equal_draws_by_join(spark, monkeypatch, draws):
    values = spark.range(700).select((F.col("id") % 13 / 4).alias("x")).unionAll(spark.range(1).select(F.lit(None).cast("double")))
    known = values.where("x IS NOT NULL")
    monkeypatch.setattr(metrics, "DRAWS_AT_ONCE", draws)
    looked_up = rows(metrics._replicate_means_by_draw(known, "x", 700, 90, "42", 10**6))
    monkeypatch.setattr(metrics, "SENT_VALUES", 3)
    assert rows(metrics._replicate_means_by_draw(known, "x", 700, 90, "42", 10**6)) == looked_up
    sorted_values = sorted(i % 13 / 4 for i in range(700))
    first = sum(sorted_values[plain_mix((90 * j) ^ 42) * 700 >> 32] for j in range(700)) / 700
    assert dict(looked_up)[0] == pytest.approx(first, abs=1e-6)
