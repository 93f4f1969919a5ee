"""Every operator as a named query over the star-schema folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.functions.scalars import cyclical, safe_divide
from cartwise.operators import business, embeddings, features, metrics, ranker, sampling, split, stats
from cartwise.plans import flow
from cartwise.session import materialize, new_path
from cartwise.sources import readers, retail, schemas, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SPLIT = {"split_date": retail.SPLIT_DATE, "test_days": retail.TEST_DAYS}

_memo: dict[tuple, object] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """Share written tables and fitted models between the queries of one session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _memo:
        _memo[key] = make()
    return _memo[key]


def forget(keep: tuple[str, ...] = ()) -> None:
    """Drop the shared tables and models, so the next query builds its own."""
    for key in [k for k in _memo if k[2] not in keep]:
        del _memo[key]


def interactions(spark: SparkSession, d: str) -> DataFrame:
    """The loaded interactions: the first stage's table, which every later stage reads."""
    return _once(
        spark, d, "interactions", lambda: materialize(retail.interactions(spark, d), "interactions")
    )


def carts(spark: SparkSession, d: str) -> DataFrame:
    return retail.cart_rows(interactions(spark, d))


def r6(column: Column | str) -> Column:
    return F.round(column, 6)


def rounded(df: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """All double columns to six digits, for comparison across engines."""
    return df.select(
        *[r6(c).alias(c) if t == "double" and c not in skip else c for c, t in df.dtypes]
    )


def _splits(spark: SparkSession, d: str):
    return split.split_frames(interactions(spark, d), **SPLIT)


def _scored(spark: SparkSession, d: str) -> DataFrame:
    """Test samples scored by train popularity, written once per session."""

    def make() -> DataFrame:
        train, _, test = _splits(spark, d)
        scored = flow.popularity_scored(train, test, retail.items(spark, d))
        return materialize(flow.slim_scores(scored), "scored")

    return _once(spark, d, "scored", make)


def _lines(spark: SparkSession, d: str, *extra: str) -> DataFrame:
    """All order lines as candidate rows."""
    return interactions(spark, d).select(
        "line_key", "session_id", "user_id", "item_id", "timestamp", *extra
    )


def _as_csv(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = new_path(spark, name)
    df.write.option("header", True).csv(path)
    return path


# --- sources and sinks ---------------------------------------------------------


@query
def src_users(spark: SparkSession, d: str) -> DataFrame:
    return readers.load_users(spark, _as_csv(spark, retail.users(spark, d), "users"))


@query
def src_restaurants(spark: SparkSession, d: str) -> DataFrame:
    return readers.load_restaurants(
        spark, _as_csv(spark, retail.restaurants(spark, d), "restaurants")
    )


@query
def src_items(spark: SparkSession, d: str) -> DataFrame:
    return readers.load_items(spark, _as_csv(spark, retail.items(spark, d), "items"))


@query
def src_carts(spark: SparkSession, d: str) -> DataFrame:
    """Carts as comma lists, written as CSV, read back and unfolded."""
    parts = stats.session_sequences(carts(spark, d), "session_id")
    empty = {
        name: F.lit(None).cast(kind)
        for name, kind in (column.split() for column in schemas.CARTS.split(", "))
    }
    filled = {
        "session_id": F.col("session_id"),
        "cart_item_count": F.size("items"),
        "cart_items": F.array_join(F.col("items").cast("array<string>"), ","),
    }
    wide = parts.select(*[filled.get(n, c).alias(n) for n, c in empty.items()])
    lines = readers.cart_lines(readers.load_carts(spark, _as_csv(spark, wide, "carts")))
    return lines.groupBy("session_id", "item_id").agg(F.count(F.lit(1)).alias("n_lines"))


@query
def src_interactions(spark: SparkSession, d: str) -> DataFrame:
    return retail.interactions(spark, d)


@query
def src_interactions_csv(spark: SparkSession, d: str) -> DataFrame:
    path = _as_csv(spark, retail.interactions(spark, d), "interactions")
    return readers.load_interactions_file(spark, path).select(
        "order_id", "line_key", "user_id", "item_id", "timestamp", "clicked"
    )


@query
def null_profile(spark: SparkSession, d: str) -> DataFrame:
    return readers.null_profile(retail.order_lines(spark, d))


@query
def sink_embeddings(spark: SparkSession, d: str) -> DataFrame:
    path = sinks.save_vectors(retail.item_vectors(spark, d), new_path(spark, "vectors"))
    return sinks.load_vectors(spark, path).select(
        "item_id", F.size("vec").alias("dim"), r6(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x)).alias("total")
    )


@query
def sink_model(spark: SparkSession, d: str) -> DataFrame:
    """Validation rows, and whether the saved and reloaded model scores them as the fitted one."""
    fitted, importance, history = _production(spark, d)
    tables = {"importance": importance, "history": history}
    path = ranker.save_ranker(fitted, tables, new_path(spark, "ranker"))
    again, _ = ranker.load_ranker(spark, path)
    before = ranker.predict(fitted, _frames(spark, d).val).withColumnRenamed("score", "before")
    both = ranker.predict(again, before).select("line_key", "item_id", "before", "score")
    return both.select("line_key", "item_id", F.col("score").eqNullSafe(F.col("before")).alias("same"))


@query
def sink_report(spark: SparkSession, d: str) -> DataFrame:
    report = rounded(metrics.ranking_report(_scored(spark, d)))
    path = sinks.save_report(report, new_path(spark, "report"))
    return spark.read.schema("section STRING, metric STRING, value DOUBLE").json(path)


# --- filters and splits --------------------------------------------------------


@query
def filter_positives(spark: SparkSession, d: str) -> DataFrame:
    samples = sampling.sample_random(interactions(spark, d), retail.items(spark, d))
    return split.positives(samples).select("line_key", "item_id", "added_to_cart")


@query
def temporal_split(spark: SparkSession, d: str) -> DataFrame:
    return split.temporal_split(interactions(spark, d), **SPLIT).select(
        "line_key", "timestamp", "split"
    )


@query
def feature_select(spark: SparkSession, d: str) -> DataFrame:
    """The selected feature columns of all lines with the whole feature set."""
    full = _engineered(spark, d)
    return rounded(full.select("line_key", *features.feature_names(full)))


@query
def accepted_filter(spark: SparkSession, d: str) -> DataFrame:
    return business.accepted_rows(_accepted(spark, d)).select("order_id", "line_key", "item_id")


@query
def item_in_cart(spark: SparkSession, d: str) -> DataFrame:
    """Positives and sampled candidates that already lie in the session's cart."""
    samples = sampling.sample_uniform(interactions(spark, d), retail.items(spark, d), 5)
    return features.item_in_cart(samples, carts(spark, d)).select(
        "line_key", "session_id", "item_id", "added_to_cart"
    )


@query
def exclude_self(spark: SparkSession, d: str) -> DataFrame:
    """How many other items each positive can be contrasted with."""
    return sampling.join_menu(interactions(spark, d), retail.items(spark, d)).select(
        "line_key", "others", F.least(F.lit(40).cast("long"), "others").alias("n_negatives")
    )


# --- joins -------------------------------------------------------------------


@query
def join_order_header(spark: SparkSession, d: str) -> DataFrame:
    return retail.order_lines(spark, d).select(
        "line_key", "order_id", "item_id", "user_id", "opened_at"
    )


@query
def join_user_attrs(spark: SparkSession, d: str) -> DataFrame:
    return features.join_user_attrs(_lines(spark, d), retail.users(spark, d)).select(
        "line_key", "user_id", *features.USER_ATTRIBUTES
    )


@query
def join_item_attrs(spark: SparkSession, d: str) -> DataFrame:
    joined = features.join_item_attrs(_lines(spark, d), retail.items(spark, d))
    return rounded(joined.select("line_key", "item_id", *features.ITEM_ATTRIBUTES))


@query
def join_user_stats(spark: SparkSession, d: str) -> DataFrame:
    train, _, _ = _splits(spark, d)
    fitted = stats.user_stats(train, retail.users(spark, d))
    return features.join_user_stats(_lines(spark, d), fitted).select(
        "line_key", "user_id", "user_order_count"
    )


@query
def join_item_stats(spark: SparkSession, d: str) -> DataFrame:
    train, _, _ = _splits(spark, d)
    fitted = stats.item_stats(train, retail.items(spark, d))
    joined = features.join_item_stats(_lines(spark, d), fitted)
    return joined.select(
        "line_key", "item_unique_users", "item_order_count",
        F.round("item_popularity", 9).alias("item_popularity"),
    )


@query
def join_cart(spark: SparkSession, d: str) -> DataFrame:
    return features.join_cart(_lines(spark, d), carts(spark, d)).select(
        "line_key", "session_id", "cart_size"
    )


@query
def join_segment_price(spark: SparkSession, d: str) -> DataFrame:
    joined = business.join_segment_price(
        _lines(spark, d), retail.users(spark, d), retail.items(spark, d)
    )
    return joined.select("line_key", "user_segment", "price")


@query
def join_session_order(spark: SparkSession, d: str) -> DataFrame:
    """Sampled rows per order and session: negatives carry their order along."""
    samples = sampling.sample_random(interactions(spark, d), retail.items(spark, d))
    return samples.groupBy("session_id", "order_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("added_to_cart") == 0).alias("n_negatives"),
    )


@query
def join_menu(spark: SparkSession, d: str) -> DataFrame:
    return sampling.join_menu(interactions(spark, d), retail.items(spark, d)).select(
        "line_key", "restaurant_id", "item_id", "menu_size"
    )


@query
def pair_self_join(spark: SparkSession, d: str) -> DataFrame:
    return stats.pair_counts(interactions(spark, d))


# --- statistics ----------------------------------------------------------------


@query
def user_stats(spark: SparkSession, d: str) -> DataFrame:
    train, _, _ = _splits(spark, d)
    return stats.user_stats(train, retail.users(spark, d))


@query
def item_stats(spark: SparkSession, d: str) -> DataFrame:
    train, _, _ = _splits(spark, d)
    fitted = stats.item_stats(train, retail.items(spark, d))
    return fitted.withColumn("popularity_score", F.round("popularity_score", 9))


@query
def item_popularity(spark: SparkSession, d: str) -> DataFrame:
    return stats.item_popularity(interactions(spark, d)).withColumn(
        "prob", F.round("prob", 9)
    )


@query
def menu(spark: SparkSession, d: str) -> DataFrame:
    """Menus unfolded: place of each item, its page and the size of the menu."""
    return sampling.menu(retail.items(spark, d)).select(
        "restaurant_id", "page", "menu_size", F.posexplode("items").alias("slot", "item_id")
    )


@query
def item_cooccurrence(spark: SparkSession, d: str) -> DataFrame:
    return stats.item_cooccurrence(interactions(spark, d))


@query
def category_transitions(spark: SparkSession, d: str) -> DataFrame:
    return rounded(
        stats.category_transitions(interactions(spark, d), retail.items(spark, d))
    )


@query
def session_sequences(spark: SparkSession, d: str) -> DataFrame:
    return stats.session_sequences(interactions(spark, d)).select(
        "order_id", "part", F.array_join(F.col("items").cast("array<string>"), ",").alias("items")
    )


@query
def group_sizes(spark: SparkSession, d: str) -> DataFrame:
    return stats.group_sizes(_scored(spark, d))


@query
def candidate_set_check(spark: SparkSession, d: str) -> DataFrame:
    samples = sampling.sample_random(interactions(spark, d), retail.items(spark, d))
    return rounded(stats.candidate_set_check(samples, strict=True))


@query
def nunique_orders(spark: SparkSession, d: str) -> DataFrame:
    return stats.order_counts(_accepted(spark, d))


# --- negative sampling ---------------------------------------------------------


@query
def neg_uniform(spark: SparkSession, d: str) -> DataFrame:
    samples = sampling.sample_uniform(interactions(spark, d), retail.items(spark, d), 40)
    return samples.select("line_key", "item_id", "added_to_cart")


@query
def neg_random(spark: SparkSession, d: str) -> DataFrame:
    samples = sampling.sample_random(interactions(spark, d), retail.items(spark, d))
    return samples.select("line_key", "item_id", "added_to_cart")


@query
def neg_popular(spark: SparkSession, d: str) -> DataFrame:
    samples = sampling.sample_popular(interactions(spark, d), retail.items(spark, d))
    return samples.select("line_key", "item_id", "added_to_cart")


@query
def neg_mixed(spark: SparkSession, d: str) -> DataFrame:
    samples = sampling.sample_mixed(interactions(spark, d), retail.items(spark, d))
    return samples.select("line_key", "item_id", "added_to_cart")


@query
def neg_excluding_session(spark: SparkSession, d: str) -> DataFrame:
    """Five negatives each from the menu without anything the session bought."""
    samples = sampling.sample_uniform(
        interactions(spark, d), retail.items(spark, d), 5, exclude_session_positives=True
    )
    return samples.select("line_key", "item_id", "added_to_cart")


@query
def neg_union(spark: SparkSession, d: str) -> DataFrame:
    """Positives and five uniform negatives each, with the full sample columns."""
    samples = sampling.sample_uniform(interactions(spark, d), retail.items(spark, d), 5)
    return samples.select(
        "order_id", "session_id", "user_id", "item_id", "restaurant_id", "added_to_cart",
        "timestamp",
    )


# --- features ------------------------------------------------------------------


def _fitted(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    train, _, _ = _splits(spark, d)
    return (
        stats.user_stats(train, retail.users(spark, d)),
        stats.item_stats(train, retail.items(spark, d)),
    )


def _engineered(spark: SparkSession, d: str) -> DataFrame:
    user_table, item_table = _fitted(spark, d)
    return features.engineer_features(
        _lines(spark, d),
        retail.users(spark, d),
        retail.items(spark, d),
        user_table,
        item_table,
        carts(spark, d),
    )


@query
def feat_user(spark: SparkSession, d: str) -> DataFrame:
    user_table, _ = _fitted(spark, d)
    df = features.add_user_features(_lines(spark, d), retail.users(spark, d), user_table)
    return df.select("line_key", *features.USER_FLAGS, "user_order_count")


@query
def feat_item(spark: SparkSession, d: str) -> DataFrame:
    _, item_table = _fitted(spark, d)
    df = features.add_item_features(_lines(spark, d), retail.items(spark, d), item_table)
    return rounded(
        df.select(
            "line_key", "price", "popularity_score", "veg_flag", "log_price", "price_squared",
            *[f"category_{c}" for c in features.CATEGORIES], "is_veg",
            "item_unique_users", "item_order_count", "item_popularity",
        )
    )


@query
def feat_cart(spark: SparkSession, d: str) -> DataFrame:
    df = features.add_cart_features(
        _lines(spark, d), carts(spark, d), retail.items(spark, d)
    )
    return rounded(df.select("line_key", "cart_size", *features.CART_DEFAULTS))


@query
def feat_cart_cooccurrence(spark: SparkSession, d: str) -> DataFrame:
    train, _, _ = _splits(spark, d)
    df = features.cart_cooccurrence_in(_lines(spark, d), carts(spark, d), train)
    return rounded(df.select("line_key", "cart_cooccurrence"))


@query
def feat_interaction(spark: SparkSession, d: str) -> DataFrame:
    df = features.add_user_features(_lines(spark, d), retail.users(spark, d), None)
    df = features.add_item_features(df, retail.items(spark, d), None)
    return features.add_interaction_features(df).select(
        "line_key", "user_item_veg_match", "user_item_price_match"
    )


@query
def feat_context(spark: SparkSession, d: str) -> DataFrame:
    return features.add_context_features(_lines(spark, d)).drop(
        "session_id", "user_id", "item_id", "timestamp"
    )


@query
def feat_price_progression(spark: SparkSession, d: str) -> DataFrame:
    items = retail.items(spark, d)
    df = features.add_cart_features(_lines(spark, d), carts(spark, d), items)
    df = features.add_price_progression(df.join(items.select("item_id", "price"), "item_id", "left"))
    return rounded(df.select("line_key", "price_vs_cart_avg", "price_ratio_to_cart"))


@query
def feat_category_transition(spark: SparkSession, d: str) -> DataFrame:
    train, _, _ = _splits(spark, d)
    items = retail.items(spark, d)
    df = _lines(spark, d).join(items.select("item_id", "category"), "item_id", "left")
    df = features.add_category_transition(
        df, carts(spark, d), items, stats.category_transitions(train, items)
    )
    return rounded(df.select("line_key", "category", "category_transition_prob"))


@query
def engineer_features(spark: SparkSession, d: str) -> DataFrame:
    full = _engineered(spark, d)
    return rounded(
        full.select("line_key", "user_segment", "category", *features.feature_names(full))
    )


@query
def cyclical_time(spark: SparkSession, d: str) -> DataFrame:
    sine, cosine = cyclical(F.hour("timestamp"), 24)
    return _lines(spark, d).select(
        "line_key", r6(sine).alias("hour_sin"), r6(cosine).alias("hour_cos")
    )


@query
def safe_divide_cart(spark: SparkSession, d: str) -> DataFrame:
    """Distinct items by lines of an order's cart; orders without lines get 0."""
    by_item = interactions(spark, d).groupBy("order_id", "item_id").agg(F.count(F.lit(1)).alias("n"))
    lines = by_item.groupBy("order_id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("c"))
    both = retail.orders(spark, d).join(lines, "order_id", "left").fillna(0, ["n", "c"])
    return both.select("order_id", r6(safe_divide(F.col("c"), F.col("n"))).alias("share"))


@query
def clip_outliers(spark: SparkSession, d: str) -> DataFrame:
    return rounded(
        features.clip_outliers(retail.orders(spark, d).select("order_id", "price"), "price")
    )


# --- vectors ---------------------------------------------------------------------


@query
def item2vec_fit(spark: SparkSession, d: str) -> DataFrame:
    train, _, _ = _splits(spark, d)
    vectors = embeddings.vectors_of(embeddings.fit_item_vectors(train))
    return vectors.select("item_id", F.size("vec").alias("dim"))


@query
def item_vector_lookup(spark: SparkSession, d: str) -> DataFrame:
    found = embeddings.lookup_vectors(
        retail.items(spark, d).select("item_id"), retail.item_vectors(spark, d)
    )
    return rounded(found.select("item_id", F.posexplode("vec").alias("pos", "x")))


@query
def user_embedding(spark: SparkSession, d: str) -> DataFrame:
    vecs = embeddings.user_vectors(interactions(spark, d), retail.item_vectors(spark, d))
    return rounded(vecs.select("user_id", F.posexplode("vec").alias("pos", "x")))


def _similarities(spark: SparkSession, d: str) -> DataFrame:
    train, _, _ = _splits(spark, d)
    vectors = retail.item_vectors(spark, d)
    return embeddings.add_embedding_features(
        _lines(spark, d), vectors, embeddings.user_vectors(train, vectors)
    )


@query
def user_item_similarity(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_similarities(spark, d).select("line_key", "user_item_similarity"))


@query
def embedding_norms(spark: SparkSession, d: str) -> DataFrame:
    return rounded(
        _similarities(spark, d).select("line_key", "item_embedding_norm", "user_embedding_norm")
    )


@query
def cart_item_similarity(spark: SparkSession, d: str) -> DataFrame:
    df = embeddings.add_cart_similarity(
        _lines(spark, d), carts(spark, d), retail.item_vectors(spark, d)
    )
    return rounded(df.select("line_key", "cart_item_similarity"))


@query
def similar_items(spark: SparkSession, d: str) -> DataFrame:
    return embeddings.similar_items(retail.item_vectors(spark, d))


@query
def embedding_neighbors(spark: SparkSession, d: str) -> DataFrame:
    return embeddings.embedding_neighbors(retail.item_vectors(spark, d))


@query
def embedding_tables(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of the fitted item table and of the user table built from it."""
    train, _, _ = _splits(spark, d)
    items, users = embeddings.embedding_tables(train)
    count = lambda df, kind: df.groupBy(F.lit(kind).alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim")
    )
    return count(items, "item").unionByName(count(users, "user"))


# --- ranking ---------------------------------------------------------------------


@query
def topk_per_group(spark: SparkSession, d: str) -> DataFrame:
    return metrics.top_per_group(_scored(spark, d), 10).select(
        "order_id", "item_id", "line_key", "rank"
    )


@query
def predict_top_n(spark: SparkSession, d: str) -> DataFrame:
    """Top three per order of all lines by a score computed in the plan."""
    scored = features.join_item_attrs(_lines(spark, d, "order_id"), retail.items(spark, d))
    scored = scored.withColumn("score", F.col("popularity_score") * F.col("price"))
    return metrics.top_per_group(scored, 3).select("order_id", "item_id", "line_key", "rank")


@query
def consecutive_pairs(spark: SparkSession, d: str) -> DataFrame:
    pairs = stats.category_pairs(interactions(spark, d), retail.items(spark, d))
    return pairs.groupBy("session_id", "category_from", "category_to").agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def recency_rank(spark: SparkSession, d: str) -> DataFrame:
    return embeddings.recency_rank(interactions(spark, d)).select(
        "user_id", "line_key", "age"
    )


@query
def minmax_scale(spark: SparkSession, d: str) -> DataFrame:
    df = business.minmax_scale(retail.orders(spark, d).select("order_id", "price"), "price", "scaled")
    return rounded(df)


@query
def auc(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.auc_and_precision(_scored(spark, d)).select("auc"))


@query
def average_precision(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.auc_and_precision(_scored(spark, d)).select("average_precision"))


def _mean_of(spark: SparkSession, d: str, prefix: str) -> DataFrame:
    means = metrics.mean_metrics(metrics.group_metrics(_scored(spark, d)))
    return rounded(means.select(*[f"{prefix}_{k}" for k in metrics.K_VALUES]))


@query
def precision_at_k(spark: SparkSession, d: str) -> DataFrame:
    return _mean_of(spark, d, "precision")


@query
def recall_at_k(spark: SparkSession, d: str) -> DataFrame:
    return _mean_of(spark, d, "recall")


@query
def ndcg_at_k(spark: SparkSession, d: str) -> DataFrame:
    return _mean_of(spark, d, "ndcg")


@query
def ndcg_at_k_full(spark: SparkSession, d: str) -> DataFrame:
    return _mean_of(spark, d, "ndcg_full")


@query
def precision_at_k_util(spark: SparkSession, d: str) -> DataFrame:
    return rounded(
        metrics.group_metrics(_scored(spark, d), (10,)).select(
            "order_id", "group_size", "precision_10"
        )
    )


@query
def recall_at_k_util(spark: SparkSession, d: str) -> DataFrame:
    return rounded(
        metrics.group_metrics(_scored(spark, d), (10,)).select(
            "order_id", "n_relevant", "recall_10"
        )
    )


@query
def ranking_report(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.ranking_report(_scored(spark, d)))


@query
def compare_to_baseline(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.compare_to_baseline(metrics.auc_and_precision(_scored(spark, d))))


@query
def bootstrap_ci(spark: SparkSession, d: str) -> DataFrame:
    per_order = metrics.group_metrics(_scored(spark, d), (10,))
    return rounded(metrics.bootstrap_ci(per_order, "precision_10", method="draw"))


# --- business ------------------------------------------------------------------------


def _accepted(spark: SparkSession, d: str) -> DataFrame:
    """The ten best rows of every test order with simulated acceptance."""

    def make() -> DataFrame:
        top = metrics.top_per_group(_scored(spark, d), 10)
        drawn = business.simulate_acceptance(top, retail.users(spark, d), retail.items(spark, d))
        return materialize(drawn, "accepted")

    return _once(spark, d, "accepted", make)


@query
def acceptance_prob(spark: SparkSession, d: str) -> DataFrame:
    return rounded(
        _accepted(spark, d).select(
            "line_key", "item_id", "user_segment", "price", "score_normalized", "acceptance_prob"
        )
    )


@query
def acceptance_draw(spark: SparkSession, d: str) -> DataFrame:
    return _accepted(spark, d).select("line_key", "item_id", "accepted")


@query
def business_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(
        business.business_metrics(
            _accepted(spark, d), retail.items(spark, d), retail.orders(spark, d)
        )
    )


@query
def aov_lift_util(spark: SparkSession, d: str) -> DataFrame:
    """Order value of orders holding a recommended line against all others."""
    seen = retail.order_items(spark, d).groupBy("order_id").agg(
        F.max("is_recommended").alias("treated")
    )
    value = retail.orders(spark, d).join(seen, "order_id", "left").fillna(0, ["treated"])
    mean = value.agg(
        F.avg(F.when(F.col("treated") == 0, F.col("price"))).alias("baseline"),
        F.avg(F.when(F.col("treated") == 1, F.col("price"))).alias("treatment"),
    )
    return mean.select(
        r6(business.aov_lift(F.col("baseline"), F.col("treatment"))).alias("aov_lift")
    )


@query
def attach_rate_util(spark: SparkSession, d: str) -> DataFrame:
    """Accepted per shown, by segment."""
    return _accepted(spark, d).groupBy("user_segment").agg(
        r6(business.attach_rate(F.sum("accepted"), F.count(F.lit(1)))).alias("attach_rate")
    )


@query
def c2o_ratio(spark: SparkSession, d: str) -> DataFrame:
    n_orders = retail.orders(spark, d).agg(F.count_distinct("order_id")).scalar()
    return carts(spark, d).agg(F.count_distinct("session_id").alias("n_carts")).select(
        r6(business.c2o_ratio(n_orders, F.col("n_carts"))).alias("c2o_ratio")
    )


@query
def evaluate(spark: SparkSession, d: str) -> DataFrame:
    return rounded(
        flow.evaluate(
            _scored(spark, d),
            retail.users(spark, d),
            retail.items(spark, d),
            retail.orders(spark, d),
            written=True,
        )
    )


# --- learning to rank ------------------------------------------------------------------


def _frames(spark: SparkSession, d: str) -> flow.Frames:
    return _once(
        spark,
        d,
        "frames",
        lambda: flow.featured_frames(
            interactions(spark, d),
            retail.users(spark, d),
            retail.items(spark, d),
            retail.item_vectors(spark, d),
            written=True,
            **SPLIT,
        ),
    )


def _production(spark: SparkSession, d: str):
    return _once(spark, d, "production", lambda: flow.train_production(_frames(spark, d)))


def _finite(column: str) -> Column:
    value = F.col(column)
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


@query
def ranker_fit(spark: SparkSession, d: str) -> DataFrame:
    """Features of the pairwise ranker, each with a finite weight."""
    frames = _frames(spark, d)
    fitted = ranker.fit_pairwise(frames.train, frames.features)
    weights = fitted.model.stages[-1].coefficients.toArray().tolist()
    table = spark.createDataFrame(
        list(zip(fitted.features, weights)), "feature STRING, weight DOUBLE"
    )
    return table.select("feature", _finite("weight").alias("finite"))


@query
def ranker_predict(spark: SparkSession, d: str) -> DataFrame:
    """Every test candidate with a score."""
    fitted, _, _ = _production(spark, d)
    scored = ranker.predict(fitted, _frames(spark, d).test)
    return scored.select("line_key", "item_id", "added_to_cart", _finite("score").alias("scored"))


@query
def ranker_cv(spark: SparkSession, d: str) -> DataFrame:
    """One row a fold, with a score between 0 and 1."""
    frames = _frames(spark, d)
    _, scores = flow.cross_validate(frames, 3)
    return scores.select("fold", F.col("ndcg_10").between(0, 1).alias("in_bounds"))


@query
def group_kfold(spark: SparkSession, d: str) -> DataFrame:
    return ranker.group_kfold(interactions(spark, d), 3)


@query
def feature_importance(spark: SparkSession, d: str) -> DataFrame:
    """Every feature with an importance; all together make 1."""
    importance = _production(spark, d)[1]
    total = importance.agg(F.round(F.sum("importance"), 6).alias("total"))
    return importance.select("feature", F.col("importance").between(0, 1).alias("in_bounds")).join(
        F.broadcast(total)
    )


@query
def top_features(spark: SparkSession, d: str) -> DataFrame:
    """Places of the ten strongest features: different ones, by falling importance."""
    importance = _production(spark, d)[1]
    top = ranker.top_features(importance, 10).collect()
    falling = [i == 0 or top[i - 1].importance >= r.importance for i, r in enumerate(top)]
    fresh = [r.feature not in {q.feature for q in top[:i]} for i, r in enumerate(top)]
    return spark.createDataFrame(
        [(i + 1, a and b) for i, (a, b) in enumerate(zip(falling, fresh))], "place INT, holds BOOLEAN"
    )


@query
def training_history(spark: SparkSession, d: str) -> DataFrame:
    """Rounds of each data set: without gaps, as many as patience asks for, scores in bounds."""
    fitted, _, history = _production(spark, d)
    patience, most = fitted.params["patience"], fitted.params["trees"]
    waited = F.col("rounds") == F.least(F.lit(most), F.lit(fitted.params["best_iteration"] + patience))
    return (
        history.groupBy("data")
        .agg(
            F.count_distinct("iteration").alias("rounds"),
            F.min("iteration").alias("first"),
            F.max("iteration").alias("last"),
            F.bool_and(F.col("ndcg_5").between(0, 1) & F.col("ndcg_10").between(0, 1)).alias("in_bounds"),
        )
        .select(
            "data",
            "first",
            (F.col("rounds") == F.col("last")).alias("no_gaps"),
            waited.alias("waited"),
            "in_bounds",
        )
    )


@query
def model_info(spark: SparkSession, d: str) -> DataFrame:
    """The fitted model's description: its trees are those up to the best round."""
    fitted, _, history = _production(spark, d)
    info = ranker.model_info(fitted, spark, history)
    return info.select(
        "status",
        "n_features",
        (F.col("n_trees") == F.col("best_iteration")).alias("cut_at_best"),
        F.col("best_ndcg_10").between(0, 1).alias("in_bounds"),
        F.size(F.split("top_features", ",")).alias("n_top_features"),
    )


@query
def train_production(spark: SparkSession, d: str) -> DataFrame:
    """Metrics reported for the fitted ranker on the test samples, each a finite number."""
    fitted, _, _ = _production(spark, d)
    report = flow.evaluate_model(
        fitted, _frames(spark, d).test, retail.users(spark, d), retail.items(spark, d)
    )
    return report.select("section", "metric", _finite("value").alias("finite"))
