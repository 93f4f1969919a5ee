"""Business metrics over recommended rows with simulated acceptance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.functions.hashing import uniform
from cartwise.functions.scalars import ratio, safe_divide
from cartwise.operators.stats import distinct_count

# The acceptance model and its defaults.
BASE_RATE = 0.15
SEGMENT_MULTIPLIERS = {"budget": 0.7, "regular": 1.0, "premium": 1.3}
PRICE_SENSITIVITY = 0.01
DEFAULT_SEGMENT = "regular"
DEFAULT_PRICE = 100.0
DEFAULT_AOV = 300.0


def join_segment_price(
    recommendations: DataFrame, users: DataFrame, items: DataFrame
) -> DataFrame:
    """Segment of the user and price of the item, replacing columns of those names.

    A table without the column gives the default for all rows.
    """
    df = recommendations.drop("user_segment", "price")
    if "user_segment" in users.columns:
        df = df.join(users.select("user_id", "user_segment"), "user_id", "left")
    else:
        df = df.withColumn("user_segment", F.lit(DEFAULT_SEGMENT))
    if "price" in items.columns:
        return df.join(items.select("item_id", "price"), "item_id", "left")
    return df.withColumn("price", F.lit(DEFAULT_PRICE))


def minmax_scale(df: DataFrame, column: str, name: str) -> DataFrame:
    """Scale to [0, 1] over the whole frame; 0.5 when the column is constant."""
    bounds = df.agg(
        F.struct(F.min(column).alias("low"), F.max(column).alias("high"))
    ).scalar()
    span = bounds["high"] - bounds["low"]
    return df.withColumn(
        name, F.when(span > 0, (F.col(column) - bounds["low"]) / span).otherwise(0.5)
    )


def acceptance_prob(
    df: DataFrame,
    base_rate: float = BASE_RATE,
    multipliers: dict[str, float] | None = None,
    price_sensitivity: float = PRICE_SENSITIVITY,
    scaled: str | None = None,
) -> DataFrame:
    """Adds acceptance_prob from segment, price and, if present, scaled score.

    ``scaled`` names a column that holds the scaled score already.
    """
    factor = F.lit(1.0)
    for segment, value in (multipliers or SEGMENT_MULTIPLIERS).items():
        factor = F.when(F.col("user_segment") == segment, value).otherwise(factor)
    prob = F.lit(base_rate) * factor * F.exp(F.lit(-price_sensitivity) * F.col("price"))
    if scaled is None and "score" in df.columns:
        scaled = "score_normalized"
        df = minmax_scale(df, "score", scaled)
    if scaled is not None:
        prob = prob * (1 + F.col(scaled))
    clipped = F.when(prob.isNotNull(), F.least(F.greatest(prob, F.lit(0.0)), F.lit(1.0)))
    return df.withColumn("acceptance_prob", clipped)


def acceptance_draw(
    df: DataFrame, keys: tuple[str, ...] = ("line_key", "item_id"), seed: str = "42"
) -> DataFrame:
    """Adds accepted 0/1, a repeatable draw per row; an unknown probability never accepts."""
    hit = uniform(*keys, F.lit("accept"), seed=seed) < F.col("acceptance_prob")
    return df.withColumn("accepted", F.coalesce(hit.cast("int"), F.lit(0)))


def simulate_acceptance(
    recommendations: DataFrame,
    users: DataFrame,
    items: DataFrame,
    keys: tuple[str, ...] = ("line_key", "item_id"),
    seed: str = "42",
) -> DataFrame:
    scaled = None
    if "score" in recommendations.columns:
        # Before the joins, which would run again for the bounds.
        scaled = "score_normalized"
        recommendations = minmax_scale(recommendations, "score", scaled)
    joined = join_segment_price(recommendations, users, items)
    return acceptance_draw(acceptance_prob(joined, scaled=scaled), keys, seed)


def accepted_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("accepted") == 1)


def business_metrics(
    accepted: DataFrame,
    items: DataFrame,
    orders: DataFrame | None = None,
    group: str = "order_id",
) -> DataFrame:
    """One row of business metrics from rows with ``accepted`` and ``price``.

    The baseline order value is the mean price of ``orders`` when it has one.
    """
    catalogue = distinct_count(items, "item_id").scalar()
    if orders is not None and "price" in orders.columns:
        aov = orders.agg(F.avg("price")).scalar()
    else:
        aov = F.lit(DEFAULT_AOV)
    yes = F.col("accepted") == 1
    # One row an order first; rows without an order count, but not as an order.
    per_group = accepted.groupBy(group).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(yes, 1)).alias("hits"),
        F.sum(F.when(yes, F.col("price"))).alias("paid"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    sums = per_group.agg(
        F.count(group).alias("n_orders"),
        F.count(F.when(F.col("hits") > 0, F.col(group))).alias("n_accepted_orders"),
        total("rows").alias("n_rows"),
        total("hits").alias("n_accepted"),
        total("paid").alias("revenue"),
    )
    per_order = lambda c: ratio(F.col(c), F.col("n_orders"))
    return sums.select(
        per_order("n_accepted_orders").alias("attach_rate"),
        ratio(per_order("revenue"), aov).alias("aov_lift"),
        ratio(distinct_count(accepted, "item_id").scalar(), catalogue).alias("coverage"),
        per_order("n_accepted_orders").alias("csao_order_share"),
        per_order("n_rows").alias("avg_recommendations_per_order"),
        per_order("n_accepted").alias("avg_accepted_per_order"),
    )


def aov_lift(baseline: Column, treatment: Column) -> Column:
    """Relative change of the order value, 0 for a zero baseline."""
    return safe_divide(treatment - baseline, baseline)


def attach_rate(n_accepted: Column, n_shown: Column) -> Column:
    """Accepted per shown recommendation."""
    return safe_divide(n_accepted, n_shown)


def c2o_ratio(n_orders: Column, n_carts: Column) -> Column:
    """Orders per cart."""
    return safe_divide(n_orders, n_carts)
