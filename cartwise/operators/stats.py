"""Fitted statistics: per user, per item, per item pair, per category pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.operators.ordering import HOT_ROWS, consecutive, hot_groups, numbered
from cartwise.session import ROWS_PER_TASK, dealt, materialize

# A session with more distinct items than this is split over several tasks.
SPLIT_ITEMS = 4096


def session_order() -> list[Column]:
    """Total order of lines inside a session or a user history."""
    return [F.col(c) for c in ("timestamp", "position_in_cart", "item_id", "line_key")]


def user_stats(train: DataFrame, users: DataFrame) -> DataFrame:
    """Order count, first and last order of each user, with demographics."""
    per_user = train.groupBy("user_id").agg(
        F.count("item_id").alias("order_count"),
        F.min("timestamp").alias("first_order"),
        F.max("timestamp").alias("last_order"),
    )
    profile = users.select("user_id", "user_segment", "veg_preference", "preferred_cuisine")
    return per_user.join(profile, "user_id", "left")


def item_stats(train: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct buyers, order count and order share of each item, with its attributes."""
    per_item = train.groupBy("item_id").agg(
        F.count_distinct("user_id").alias("unique_users"),
        F.count("session_id").alias("order_count"),
    )
    total = train.where(F.col("item_id").isNotNull()).agg(F.count("session_id")).scalar()
    return per_item.withColumn("popularity_score", F.col("order_count") / total).join(
        items.select("item_id", "price", "category", "veg_flag"), "item_id", "left"
    )


def item_popularity(interactions: DataFrame) -> DataFrame:
    """Rows per item and their share of all rows."""
    total = interactions.where(F.col("item_id").isNotNull()).agg(F.count(F.lit(1))).scalar()
    return (
        interactions.where(F.col("item_id").isNotNull())
        .groupBy("item_id")
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("prob", F.col("count") / total)
    )


def pair_counts(
    interactions: DataFrame,
    session: str = "session_id",
    split_items: int = SPLIT_ITEMS,
    only: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Unordered line pairs of the same session, summed per item pair (item_a <= item_b).

    With n_a and n_b lines of two items, a session holds n_a * n_b pairs of them
    and n_a * (n_a - 1) / 2 pairs of an item with itself. So repeated lines are
    counted before any pairing and copies never multiply. Sessions with very many
    distinct items are cut into blocks by item, as many as their own size asks for, and
    every two blocks are paired apart from the others. ``only`` (item_id, distinct) leaves
    out all other items before any pairing. A task pairs the sessions of about
    ``rows_per_task`` lines, however large the table is.
    """
    if only is not None:
        interactions = interactions.join(only, "item_id", "left_semi")
    # Lines bound distinct items from above and are cheaper to count.
    hot = hot_groups(interactions, [session], split_items)
    if hot is None:
        # One shuffle, by session, serves the counts and both sides of the pairing.
        interactions = dealt(interactions.select(session, "item_id"), session, rows_per_task=rows_per_task)
    baskets = interactions.groupBy(session, "item_id").agg(F.count(F.lit(1)).alias("n"))
    repeated = (
        baskets.where("n > 1")
        .groupBy(F.col("item_id").alias("item_a"))
        .agg(F.sum(F.expr("n * (n - 1) div 2")).alias("pairs"))
        .select("item_a", F.col("item_a").alias("item_b"), "pairs")
    )

    def paired(rows: DataFrame, keys: list[str], once: str = "true") -> DataFrame:
        side = lambda s: rows.select(
            *keys, *[F.col(c).alias(f"{c}_{s}") for c in rows.columns if c not in keys]
        )
        return side("a").join(side("b"), keys).where(f"item_a < item_b AND {once}").select(
            "item_a", "item_b", (F.col("n_a") * F.col("n_b")).alias("c")
        )

    slim = baskets.select(session, F.col("item_id").alias("item"), "n")

    if hot is None:
        emitted = paired(slim, [session])
    else:
        small = slim.join(hot, session, "left_anti")
        blocks = hot.select(session, F.ceil(F.col("_n") / split_items).cast("long").alias("_blocks"))
        large = slim.join(blocks, session).select(
            session,
            "item",
            "n",
            F.pmod(F.xxhash64("item"), F.col("_blocks")).alias("own"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("_other"),
        )
        large = large.withColumns(
            {"_i": F.least("own", "_other"), "_j": F.greatest("own", "_other")}
        ).drop("_other")
        # Two items of one block meet where the block is paired with itself.
        emitted = paired(small, [session]).unionByName(
            paired(large, [session, "_i", "_j"], "(_i = _j OR own_a <> own_b)")
        )
    half = emitted.groupBy("item_a", "item_b").agg(F.sum("c").alias("pairs"))
    return half.unionByName(repeated)


def item_cooccurrence(
    interactions: DataFrame, session: str = "session_id", split_items: int = SPLIT_ITEMS
) -> DataFrame:
    """Symmetric pair counts; a pair of the same item counts twice at (x, x).

    Both directions come from the summed unordered pairs, after their shuffle.
    """
    return pair_counts(interactions, session, split_items).select(
        F.explode(
            F.expr(
                "if(item_a = item_b, array(struct(item_a, item_b, 2 * pairs AS cooc)), "
                "array(struct(item_a, item_b, pairs AS cooc), "
                "struct(item_b AS item_a, item_a AS item_b, pairs AS cooc)))"
            )
        ).alias("e")
    ).select("e.*")


def category_pairs(
    interactions: DataFrame, items: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Categories of neighbouring lines of each session, in session order."""
    lines = interactions.select(
        "session_id", "item_id", "timestamp", "position_in_cart", "line_key"
    )
    # Items first, so that the check for large sessions reads no joined rows.
    steps = consecutive(
        lines, ["session_id"], session_order(), "item_id", "next_item", hot_rows
    )
    named = lambda item, category: items.select(
        F.col("item_id").alias(item), F.col("category").alias(category)
    )
    return (
        steps.join(named("item_id", "category_from"), "item_id", "left")
        .join(named("next_item", "category_to"), "next_item", "left")
        .select("session_id", "category_from", "category_to")
    )


def category_transitions(
    interactions: DataFrame, items: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Count and joint probability of each ordered category pair."""
    counts = (
        category_pairs(interactions, items, hot_rows)
        .groupBy("category_from", "category_to")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # The table has one row per category pair; its total is a scalar.
    return counts.withColumn("prob", F.col("n") / counts.agg(F.sum("n")).scalar())


def session_sequences(
    interactions: DataFrame,
    group: str = "order_id",
    max_length: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Items of each order in time order, as one array an order.

    A caller who gives ``max_length`` gets longer orders continued in further parts.
    """
    lines = interactions.select(
        group, "item_id", "timestamp", "position_in_cart", "line_key"
    )
    ranked = numbered(lines, [group], session_order(), "rn", hot_rows)
    part = F.floor((F.col("rn") - 1) / max_length) if max_length else F.lit(0)
    return (
        ranked.withColumn("part", part.cast("long"))
        .groupBy(group, "part")
        .agg(F.array_sort(F.collect_list(F.struct("rn", "item_id"))).alias("seq"))
        .select(group, "part", F.transform("seq", lambda s: s["item_id"]).alias("items"))
    )


def group_sizes(df: DataFrame, group: str = "order_id") -> DataFrame:
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("group_size"))


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """One row: the number of distinct values that are not null."""
    return df.select(column).distinct().agg(F.count(column).alias("n"))


def order_counts(recommendations: DataFrame, group: str = "order_id") -> DataFrame:
    """One row: distinct orders, distinct orders with an acceptance, distinct items."""
    orders = recommendations.groupBy(group).agg(
        F.max((F.col("accepted") == 1).cast("int")).alias("hit")
    )
    return orders.agg(
        F.count(group).alias("n_orders"),
        F.count(F.when(F.col("hit") == 1, F.col(group))).alias("n_accepted_orders"),
    ).withColumn("n_items", distinct_count(recommendations, "item_id").scalar())


def candidate_set_check(
    samples: DataFrame, session: str = "session_id", few: int = 5, strict: bool = False
) -> DataFrame:
    """One row: sessions lacking positives or negatives, and the spread of negatives.

    ``strict`` raises when a session has no positive or no negative row.
    """
    per_session = samples.groupBy(session).agg(
        F.sum(F.col("added_to_cart").cast("long")).alias("n_pos"),
        F.count(F.lit(1)).alias("total"),
    ).withColumn("n_neg", F.col("total") - F.col("n_pos"))
    count_if = lambda c: F.count(F.when(c, 1))
    report = per_session.agg(
        F.count(F.lit(1)).alias("sessions"),
        count_if(F.col("n_pos") == 0).alias("without_positives"),
        count_if(F.col("n_neg") == 0).alias("without_negatives"),
        count_if(F.col("n_neg") < few).alias("few_negatives"),
        F.avg("n_pos").alias("avg_positives"),
        F.avg("n_neg").alias("avg_negatives"),
        F.min("n_neg").alias("min_negatives"),
        F.max("n_neg").alias("max_negatives"),
    )
    if strict:
        # Written, so that the samples are drawn once.
        report = materialize(report, "candidate_sets")
        found = report.first()
        if found.without_positives or found.without_negatives:
            raise ValueError(
                f"invalid candidate set: {found.without_positives} sessions have no positives, "
                f"{found.without_negatives} have no negatives"
            )
    return report
