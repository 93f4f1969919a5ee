"""Table schemas and the plan-time column check."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

# Table layouts of the input files.
USERS = (
    "user_id BIGINT, user_segment STRING, veg_preference STRING, "
    "order_frequency STRING, preferred_cuisine STRING"
)
RESTAURANTS = (
    "restaurant_id BIGINT, cuisine_type STRING, city STRING, price_range INT, "
    "rating DOUBLE, delivery_rating DOUBLE, avg_prep_time DOUBLE, "
    "order_volume_30d INT, chain_flag INT"
)
ITEMS = (
    "item_id BIGINT, restaurant_id BIGINT, category STRING, veg_flag INT, "
    "price DOUBLE, popularity_score DOUBLE, margin_proxy DOUBLE, historical_attach_rate DOUBLE"
)
ORDERS = "order_id BIGINT, user_id BIGINT, restaurant_id BIGINT, price DOUBLE"
ORDER_ITEMS = (
    "order_id BIGINT, item_id BIGINT, added_timestamp TIMESTAMP_NTZ, is_recommended INT, "
    "added_after_recommendation INT, position_in_cart INT"
)
CARTS = (
    "session_id STRING, user_id BIGINT, restaurant_id BIGINT, cart_item_count INT, "
    "cart_total DOUBLE, veg_ratio DOUBLE, dominant_category STRING, cart_items STRING"
)
INTERACTIONS = (
    "order_id BIGINT, session_id STRING, line_key STRING, user_id BIGINT, item_id BIGINT, "
    "restaurant_id BIGINT, timestamp TIMESTAMP_NTZ, position_in_cart INT, added_to_cart INT, "
    "recommended_flag INT, clicked INT, ordered INT"
)


def require_columns(df: DataFrame, required: Iterable[str], name: str = "DataFrame") -> DataFrame:
    """Return ``df`` unchanged, or raise before any job runs."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{name} lacks columns: {', '.join(missing)}")
    return df
