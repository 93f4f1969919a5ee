"""The add-on tables as views over the star-schema parquet folder.

customer -> users, part -> items and restaurants, orders -> orders,
lineitem -> order lines, embeddings -> item vectors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.session import spread
from cartwise.sources.readers import interactions_of, join_order_header

# How the star schema maps onto the add-on tables.
SEGMENTS = {"BUILDING": "budget", "AUTOMOBILE": "premium"}
CATEGORIES = {
    "STANDARD": "main",
    "SMALL": "snack",
    "MEDIUM": "drink",
    "LARGE": "starter",
    "ECONOMY": "beverage",
    "PROMO": "dessert",
}
MENU_SIZE = 20
VECTOR_DIM = 64
SPLIT_DATE = "2000-01-01"
TEST_DAYS = 180


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _restaurant(item: str) -> Column:
    return F.floor(F.col(item) / F.lit(MENU_SIZE)).cast("long")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.lit("regular")
    for source, target in SEGMENTS.items():
        segment = F.when(F.col("c_mktsegment") == source, target).otherwise(segment)
    veg = F.array(F.lit("veg"), F.lit("non-veg"), F.lit("both"))
    return _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        segment.alias("user_segment"),
        F.get(veg, (F.col("c_custkey") % 3).cast("int")).alias("veg_preference"),
        F.when(F.col("c_acctbal") < 2500, "low")
        .when(F.col("c_acctbal") < 6200, "medium")
        .otherwise("high")
        .alias("order_frequency"),
        F.col("c_nationkey").cast("string").alias("preferred_cuisine"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    category = F.lit(None).cast("string")
    for source, target in CATEGORIES.items():
        category = F.when(F.col("p_type") == source, target).otherwise(category)
    return _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        _restaurant("p_partkey").alias("restaurant_id"),
        category.alias("category"),
        (F.col("p_size") % 2).cast("int").alias("veg_flag"),
        (F.col("p_size") * 8).cast("double").alias("price"),
        (F.col("p_retailprice") / 1000).alias("popularity_score"),
    )


def restaurants(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("restaurant_id")
    named = lambda kind: F.concat(F.lit(f"{kind} "), (key % 5).cast("string"))
    return (
        items(spark, sf_dir)
        .select("restaurant_id")
        .distinct()
        .select(
            "restaurant_id",
            named("cuisine").alias("cuisine_type"),
            named("city").alias("city"),
            (key % 4 + 1).cast("int").alias("price_range"),
            (F.lit(2.0) + key % 31 / F.lit(10.0)).alias("rating"),
            (F.lit(2.0) + key % 29 / F.lit(10.0)).alias("delivery_rating"),
            (F.lit(15.0) + key % 46).alias("avg_prep_time"),
            (F.lit(400) + key % 200).cast("int").alias("order_volume_30d"),
            F.when(key % 10 < 3, 1).otherwise(0).alias("chain_flag"),
        )
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        (
            F.col("o_orderdate")
            + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
        ).alias("opened_at"),
        F.col("o_totalprice").alias("price"),
    )


def _raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line columns that the add-on tables are made of, as narrow as they can travel."""
    return spread(_table(spark, sf_dir, "lineitem")).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_linenumber").alias("position_in_cart"),
        "l_suppkey",
        "l_shipdate",
        (F.col("l_returnflag") == "R").cast("int").alias("is_recommended"),
        (F.col("l_linestatus") == "O").cast("int").alias("added_after_recommendation"),
    )


def _lines_of(raw: DataFrame, *extra: str) -> DataFrame:
    """Order lines of raw ones; what is derived from them is made here, after any join."""
    return raw.select(
        "order_id",
        "item_id",
        _restaurant("item_id").alias("restaurant_id"),
        "position_in_cart",
        F.concat_ws(
            "-",
            "order_id",
            "position_in_cart",
            "item_id",
            "l_suppkey",
            F.date_format("l_shipdate", "yyyyMMdd"),
        ).alias("line_key"),
        "is_recommended",
        "added_after_recommendation",
        *extra,
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines_of(_raw_lines(spark, sf_dir))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = orders(spark, sf_dir).select("order_id", "user_id", "opened_at")
    return _lines_of(join_order_header(_raw_lines(spark, sf_dir), headers), "user_id", "opened_at")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    line_time = F.col("opened_at") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.col("position_in_cart")
    )
    return interactions_of(order_lines(spark, sf_dir), line_time)


def cart_rows(lines: DataFrame) -> DataFrame:
    """Carts in long form: all lines of every session."""
    return lines.select(
        "session_id", "item_id", "timestamp", "position_in_cart", "line_key"
    )


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("item_id"), F.col("embedding").cast("array<double>").alias("vec")
    )
