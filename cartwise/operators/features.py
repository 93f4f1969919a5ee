"""Feature columns for candidate rows.

Everything that depends only on the user, the item or the cart is computed once
per user, item or session and then joined, so a candidate frame many times larger
than those tables meets each of them in a single narrow join. Join strategies are
left to the optimizer, which knows the real sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.functions.scalars import clip, flag, one_hot
from cartwise.operators.ordering import HOT_ROWS, exact_quantiles, hot_groups
from cartwise.operators.stats import SPLIT_ITEMS, pair_counts
from cartwise.session import broadcast_if_small, dealt, materialize

# Feature names, categories and thresholds.
USER_FLAGS = {
    "segment_budget": ("user_segment", "budget"),
    "segment_regular": ("user_segment", "regular"),
    "segment_premium": ("user_segment", "premium"),
    "veg_preference_veg": ("veg_preference", "veg"),
    "veg_preference_nonveg": ("veg_preference", "non-veg"),
    "veg_preference_both": ("veg_preference", "both"),
    "order_freq_low": ("order_frequency", "low"),
    "order_freq_medium": ("order_frequency", "medium"),
    "order_freq_high": ("order_frequency", "high"),
}
CATEGORIES = ("main", "drink", "dessert", "snack", "starter", "beverage")
BUDGET_PRICE_BELOW = 150
PREMIUM_PRICE_ABOVE = 200
EMPTY_CART_VEG_RATIO = 0.5
NOT_FEATURES = {
    "order_id", "session_id", "user_id", "item_id", "restaurant_id",
    "added_to_cart", "timestamp", "added_timestamp",
    "user_segment", "veg_preference", "order_frequency", "preferred_cuisine",
    "category", "dominant_category", "city", "cuisine_type",
    "is_recommended", "added_after_recommendation", "recommended_flag",
    "clicked", "ordered", "position_in_cart",
}
FEATURE_TYPES = {"bigint", "int", "tinyint", "double", "float", "boolean"}

USER_ATTRIBUTES = ("user_segment", "veg_preference", "order_frequency", "preferred_cuisine")
ITEM_ATTRIBUTES = ("price", "category", "veg_flag", "popularity_score")
CART_DEFAULTS = {
    "cart_total_price": 0.0,
    "cart_avg_price": 0.0,
    "cart_has_main": 0,
    "cart_has_drink": 0,
    "cart_has_dessert": 0,
    "cart_veg_ratio": EMPTY_CART_VEG_RATIO,
}


def join_user_attrs(df: DataFrame, users: DataFrame) -> DataFrame:
    return df.join(users.select("user_id", *USER_ATTRIBUTES), "user_id", "left")


def join_item_attrs(df: DataFrame, items: DataFrame) -> DataFrame:
    return df.join(items.select("item_id", *ITEM_ATTRIBUTES), "item_id", "left")


def join_user_stats(df: DataFrame, user_stats: DataFrame) -> DataFrame:
    """Adds user_order_count, 0 for users without history."""
    counts = user_stats.select("user_id", F.col("order_count").alias("user_order_count"))
    return df.join(counts, "user_id", "left").fillna(0, ["user_order_count"])


def join_item_stats(df: DataFrame, item_stats: DataFrame) -> DataFrame:
    """Adds item_unique_users, item_order_count and item_popularity, 0 for unseen items."""
    stats = item_stats.select(
        "item_id",
        F.col("unique_users").alias("item_unique_users"),
        F.col("order_count").alias("item_order_count"),
        F.col("popularity_score").alias("item_popularity"),
    )
    return df.join(stats, "item_id", "left").fillna(
        0, ["item_unique_users", "item_order_count", "item_popularity"]
    )


def user_attributes(users: DataFrame, user_stats: DataFrame | None) -> DataFrame:
    """One row per user with the columns that the user features are made of."""
    table = users.select("user_id", *USER_ATTRIBUTES)
    if user_stats is not None:
        # Users with history but no profile still carry their order count.
        table = table.join(user_stats.select("user_id", "order_count"), "user_id", "full")
        table = table.withColumnRenamed("order_count", "user_order_count")
    return table


def make_user_features(df: DataFrame) -> DataFrame:
    """User features of rows that hold the user's attributes; 0 for unknown users."""
    df = df.withColumns({name: one_hot(*spec) for name, spec in USER_FLAGS.items()})
    return df.fillna(0, [*USER_FLAGS, *(["user_order_count"] if "user_order_count" in df.columns else [])])


def add_user_features(df: DataFrame, users: DataFrame, user_stats: DataFrame | None) -> DataFrame:
    return make_user_features(df.join(user_attributes(users, user_stats), "user_id", "left"))


def item_attributes(items: DataFrame, item_stats: DataFrame | None) -> DataFrame:
    """One row per item with the columns that the item features are made of."""
    table = items.select("item_id", *ITEM_ATTRIBUTES)
    if item_stats is not None:
        stats = item_stats.select(
            "item_id",
            F.col("unique_users").alias("item_unique_users"),
            F.col("order_count").alias("item_order_count"),
            F.col("popularity_score").alias("item_popularity"),
        )
        table = table.join(stats, "item_id", "full")
    return table


def make_item_features(df: DataFrame) -> DataFrame:
    """Item features of rows that hold the item's attributes."""
    return df.withColumns(
        {
            "log_price": F.log1p("price"),
            "price_squared": F.col("price") * F.col("price"),
            **{f"category_{c}": one_hot("category", c) for c in CATEGORIES},
            "is_veg": F.coalesce(F.col("veg_flag").cast("int"), F.lit(0)),
        }
    )


def item_features(items: DataFrame, item_stats: DataFrame | None) -> DataFrame:
    """One row per item with all its feature columns."""
    return make_item_features(item_attributes(items, item_stats))


def join_item_features(df: DataFrame, table: DataFrame) -> DataFrame:
    """Join a table of :func:`item_features`; flags and counts of unknown items are 0."""
    return fill_item_features(df.join(table, "item_id", "left"))


def fill_item_features(df: DataFrame) -> DataFrame:
    """Zeros for the flags and counts of unknown items."""
    counts = ("item_unique_users", "item_order_count", "item_popularity")
    filled = [f"category_{c}" for c in CATEGORIES] + ["is_veg"]
    return df.fillna(0, filled + [c for c in counts if c in df.columns])


def add_item_features(df: DataFrame, items: DataFrame, item_stats: DataFrame | None) -> DataFrame:
    return join_item_features(df, item_features(items, item_stats))


def cart_sizes(carts: DataFrame) -> DataFrame:
    return carts.groupBy("session_id").agg(F.count(F.lit(1)).alias("cart_size"))


def join_cart(df: DataFrame, carts: DataFrame) -> DataFrame:
    """Adds cart_size, repeats included; 0 for sessions without a cart."""
    return df.join(cart_sizes(carts), "session_id", "left").fillna(0, ["cart_size"])


def item_in_cart(df: DataFrame, carts: DataFrame) -> DataFrame:
    """Candidate rows whose item already lies in the session's cart."""
    lines = carts.select("session_id", "item_id").distinct()
    return df.join(lines, ["session_id", "item_id"], "left_semi")


def cart_stats(carts: DataFrame, items: DataFrame) -> DataFrame:
    """Per session: size with repeats, price and category facts over distinct known items."""
    lines = carts.groupBy("session_id", "item_id").agg(F.count(F.lit(1)).alias("n"))
    known = lines.join(
        items.select("item_id", "price", "category", "veg_flag", F.lit(True).alias("known")),
        "item_id",
        "left",
    )
    has = lambda c: F.max(flag(F.col("category") == c))
    return known.groupBy("session_id").agg(
        F.sum("n").alias("cart_size"),
        F.coalesce(F.sum("price"), F.lit(0.0)).alias("cart_total_price"),
        F.avg("price").alias("cart_avg_price"),
        has("main").alias("cart_has_main"),
        has("drink").alias("cart_has_drink"),
        has("dessert").alias("cart_has_dessert"),
        F.avg("veg_flag").alias("cart_veg_ratio"),
    )


def add_cart_features(df: DataFrame, carts: DataFrame, items: DataFrame) -> DataFrame:
    """Cart columns; only sessions without a cart take the defaults."""
    joined = df.join(cart_stats(carts, items), "session_id", "left")
    empty = F.col("cart_size").isNull()
    return joined.withColumns(
        {
            **{
                name: F.when(empty, F.lit(value)).otherwise(F.col(name))
                for name, value in CART_DEFAULTS.items()
            },
            "cart_size": F.coalesce("cart_size", F.lit(0).cast("long")),
        }
    )


def cart_pairs(
    df: DataFrame, carts: DataFrame, split_items: int = SPLIT_ITEMS
) -> DataFrame:
    """(session_id, item_id, cart_item, n, cart_size): distinct candidates with distinct cart items.

    ``n`` is the lines of the cart item and ``cart_size`` all lines of the cart. Sessions with
    more than ``split_items`` rows are spread by candidate.
    """
    lines = carts.select("session_id", F.col("item_id").alias("cart_item"))
    candidates = df.select("session_id", "item_id")
    # Rows bound distinct items from above and are cheaper to count.
    both = candidates.select("session_id").unionAll(lines.select("session_id"))
    hot = hot_groups(both, ["session_id"], split_items)
    if hot is None:
        # One shuffle a side, by session, serves the distinct rows, the sizes and the join.
        wanted = dealt(candidates, "session_id").distinct()
        size = F.sum("n").over(Window.partitionBy("session_id"))
        cart = (
            dealt(lines, "session_id")
            .groupBy("session_id", "cart_item")
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("cart_size", size)
        )
        return wanted.join(cart, "session_id")
    cart = lines.groupBy("session_id", "cart_item").agg(F.count(F.lit(1)).alias("n")).join(
        cart_sizes(carts), "session_id"
    )
    blocks = hot.select(
        "session_id", F.ceil(F.col("_n") / split_items).cast("long").alias("_blocks")
    )
    share = lambda rows: rows.join(blocks, "session_id", "left").withColumn(
        "_blocks", F.coalesce("_blocks", F.lit(1).cast("long"))
    )
    wanted = share(candidates.distinct()).withColumn(
        "_block", F.pmod(F.xxhash64("item_id"), F.col("_blocks"))
    )
    cart = share(cart).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))
    )
    return wanted.drop("_blocks").join(cart.drop("_blocks"), ["session_id", "_block"]).drop("_block")


def _mean_cooccurrence(df: DataFrame, weighted: DataFrame) -> DataFrame:
    """Join the mean of ``total`` over the cart's lines; candidates without pairs get 0."""
    scores = weighted.groupBy("session_id", "item_id").agg(
        (F.sum("total") / F.max("cart_size")).alias("cart_cooccurrence")
    )
    return df.join(scores, ["session_id", "item_id"], "left").fillna(0.0, ["cart_cooccurrence"])


def cart_cooccurrence(
    df: DataFrame, carts: DataFrame, edges: DataFrame, split_items: int = SPLIT_ITEMS
) -> DataFrame:
    """Adds cart_cooccurrence: mean co-occurrence of the candidate with the cart's lines.

    ``edges`` is a finished symmetric table. Scores are computed once per distinct
    (session, candidate) and distinct cart item, then joined back.
    """
    weighted = cart_pairs(df, carts, split_items).join(
        edges.select(F.col("item_a").alias("item_id"), F.col("item_b").alias("cart_item"), "cooc"),
        ["item_id", "cart_item"],
    )
    return _mean_cooccurrence(df, weighted.withColumn("total", F.col("cooc") * F.col("n")))


def cart_cooccurrence_in(
    df: DataFrame, carts: DataFrame, interactions: DataFrame, split_items: int = SPLIT_ITEMS
) -> DataFrame:
    """:func:`cart_cooccurrence` straight from ``interactions``, without a symmetric table.

    Items that are neither candidates nor in a cart leave the baskets before any pairing, and
    wanted pairs meet the summed unordered pairs once, in their order, where those already lie.
    """
    items = materialize(
        df.select("item_id").distinct().unionAll(carts.select("item_id").distinct()).distinct(),
        "wanted",
    )
    half = pair_counts(
        interactions, split_items=split_items, only=broadcast_if_small(items, 16)
    )
    wanted = cart_pairs(df, carts, split_items).withColumns(
        {"item_a": F.least("item_id", "cart_item"), "item_b": F.greatest("item_id", "cart_item")}
    )
    # An item pairs with itself in both directions.
    times = F.when(F.col("item_a") == F.col("item_b"), 2).otherwise(1)
    weighted = wanted.join(half, ["item_a", "item_b"]).withColumn(
        "total", F.col("pairs") * times * F.col("n")
    )
    return _mean_cooccurrence(df, weighted)


def add_interaction_features(df: DataFrame) -> DataFrame:
    price = F.col("price")
    return df.withColumns(
        {
            "user_item_veg_match": flag(
                (F.col("veg_preference_veg") == 1) & (F.col("is_veg") == 1)
            ),
            "user_item_price_match": flag(
                ((F.col("segment_budget") == 1) & (price < BUDGET_PRICE_BELOW))
                | ((F.col("segment_premium") == 1) & (price > PREMIUM_PRICE_ABOVE))
            ),
        }
    )


def add_context_features(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    hour, day = F.hour(timestamp), F.weekday(timestamp)
    return df.withColumns(
        {
            "hour": hour,
            "day_of_week": day,
            "is_weekend": flag(day >= 5),
            "is_breakfast": flag((hour >= 6) & (hour < 10)),
            "is_lunch": flag((hour >= 11) & (hour < 15)),
            "is_dinner": flag((hour >= 18) & (hour < 22)),
            "is_late_night": flag((hour >= 22) | (hour < 6)),
        }
    )


def add_price_progression(df: DataFrame) -> DataFrame:
    """Candidate price against the cart's mean price, when cart features exist."""
    if "cart_avg_price" not in df.columns:
        return df
    return df.withColumns(
        {
            "price_vs_cart_avg": F.col("price") - F.col("cart_avg_price"),
            "price_ratio_to_cart": F.col("price") / (F.col("cart_avg_price") + 1),
        }
    )


def add_category_transition(
    df: DataFrame, carts: DataFrame, items: DataFrame, transitions: DataFrame
) -> DataFrame:
    """Adds the fitted probability of (last cart category -> candidate category), 0 if unseen."""
    last = (
        carts.groupBy("session_id")
        .agg(
            F.max(F.struct("timestamp", "position_in_cart", "item_id", "line_key")).alias("last")
        )
        .select("session_id", F.col("last.item_id").alias("item_id"))
        .join(items.select("item_id", F.col("category").alias("category_from")), "item_id", "left")
        .select("session_id", "category_from")
    )
    steps = transitions.select(
        "category_from",
        F.col("category_to").alias("category"),
        F.col("prob").alias("category_transition_prob"),
    )
    return (
        df.join(last, "session_id", "left")
        .join(steps, ["category_from", "category"], "left")
        .drop("category_from")
        .fillna(0.0, ["category_transition_prob"])
    )


def engineer_features(
    df: DataFrame,
    users: DataFrame,
    items: DataFrame,
    user_stats: DataFrame | None = None,
    item_stats: DataFrame | None = None,
    carts: DataFrame | None = None,
) -> DataFrame:
    """User, item, cart (if given), interaction, context and price features.

    Attributes join first and features are made of them after the last join, so that no shuffle
    moves what can be computed. Lines of a session mostly stand together, and still do after the
    joins by session and by user; the join by item scatters them and comes last.
    """
    user_table, item_table = user_attributes(users, user_stats), item_attributes(items, item_stats)
    columns = ["item_id", "user_id", *[c for c in df.columns if c not in ("item_id", "user_id")]]
    of_user = [*user_table.drop("user_id").columns, *USER_FLAGS]
    of_item = make_item_features(item_table).drop("item_id").columns
    of_cart = []
    if carts is not None:
        columns = ["session_id", *[c for c in columns if c != "session_id"]]
        of_cart = ["cart_size", *CART_DEFAULTS]
        df = add_cart_features(df, carts, items)
    df = df.join(user_table, "user_id", "left").join(item_table, "item_id", "left")
    df = fill_item_features(make_item_features(make_user_features(df)))
    df = df.select(*columns, *of_user, *of_item, *of_cart)
    df = add_interaction_features(df)
    df = add_context_features(df)
    return add_price_progression(df)


def feature_names(df: DataFrame) -> list[str]:
    """Numeric and boolean columns that are neither ids, nor the target, nor leaky."""
    return [
        name for name, kind in df.dtypes if name not in NOT_FEATURES and kind in FEATURE_TYPES
    ]


def clip_outliers(
    df: DataFrame,
    column: str,
    lower: float = 1,
    upper: float = 99,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Clip a column to two exact percentiles; nulls stay null."""
    low, high = exact_quantiles(df, column, [lower / 100, upper / 100], hot_rows)
    if low is None:
        return df
    return df.withColumn(column, clip(F.col(column), F.lit(low), F.lit(high)))
