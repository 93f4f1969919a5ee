"""Skip-gram vectors fitted in parts: groups of items that are bought together, edges, repeats."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwise.operators import embeddings

SCHEMA = "order_id BIGINT, item_id BIGINT, timestamp TIMESTAMP_NTZ, position_in_cart INT, line_key STRING"


@pytest.fixture(scope="module")
def orders(spark):
    """Orders of four items of one of 12 groups of five."""
    rows = spark.range(3000).select(F.col("id").alias("order_id"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("n"))
    group = F.pmod(F.xxhash64("order_id", F.lit(1)), F.lit(12))
    return rows.select(
        "order_id",
        (group * 5 + F.pmod(F.xxhash64("order_id", "n"), F.lit(5))).alias("item_id"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("timestamp"),
        F.col("n").alias("position_in_cart"),
        F.concat_ws("-", "order_id", "n").alias("line_key"),
    )


def fitted(lines, **settings):
    state = embeddings.fit_item_vectors(lines, dim=16, partitions=2, **settings)
    # No task and no driver holds the whole vocabulary: the vectors lie in parts.
    assert {r["part"] for r in state.select("part").distinct().collect()} <= {0, 1}
    return {r["item_id"]: r["vec"] for r in embeddings.vectors_of(state).collect()}


def test_items_bought_together_are_near(orders):
    vectors = fitted(orders)
    assert set(vectors) == set(range(60)) and all(len(v) == 16 for v in vectors.values())
    table = np.array([vectors[i] for i in range(60)])
    table /= np.linalg.norm(table, axis=1, keepdims=True)
    score = table @ table.T - 9 * np.eye(60)
    near = np.argsort(-score, axis=1)[:, :4]
    assert np.mean(near // 5 == np.arange(60)[:, None] // 5) > 0.9


def test_rare_items_single_lines_and_no_lines(spark, orders):
    extra = spark.sql("SELECT 900000L, 777L, TIMESTAMP_NTZ'2024-01-01', 1, 'a'").toDF(*orders.columns)
    alone = spark.sql(
        "SELECT * FROM VALUES (1L, 5L, TIMESTAMP_NTZ'2024-01-01', 1, 'a'), (2L, 5L, TIMESTAMP_NTZ'2024-01-01', 1, 'b')"
    ).toDF(*orders.columns)
    some = orders.where("order_id < 200")
    first = fitted(some.unionByName(extra), epochs=2)
    assert 777 not in first and first
    # The vectors do not depend on how the rows are dealt.
    assert fitted(some.repartition(7), epochs=2) == fitted(some, epochs=2) == first
    assert set(fitted(alone, epochs=2)) == {5}
    assert fitted(spark.createDataFrame([], SCHEMA), epochs=2) == {}
