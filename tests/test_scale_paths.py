"""The paths for large groups give the rows of the plain paths."""

import re
from datetime import datetime

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from cartwise.operators import embeddings, features, metrics, ordering, ranker, sampling, stats
from cartwise.plans import flow
from cartwise.plans.catalog import QUERIES
from cartwise.sources import retail


@pytest.fixture(scope="module")
def inter(spark, sf):
    return retail.interactions(spark, sf).cache()


@pytest.fixture(scope="module")
def skewed(inter):
    """A third of all lines in one session and of one user."""
    hot = F.pmod(F.xxhash64("line_key"), F.lit(3)) == 0
    return inter.withColumns(
        {
            "session_id": F.when(hot, "sess_hot").otherwise(F.col("session_id")),
            "order_id": F.when(hot, -1).otherwise(F.col("order_id")),
            "user_id": F.when(hot, -1).otherwise(F.col("user_id")),
        }
    ).cache()


def test_numbering_of_hot_groups(skewed):
    plain = embeddings.recency_rank(skewed)
    ranged = embeddings.recency_rank(skewed, hot_rows=100)
    columns = ("user_id", "line_key", "age")
    assert rows(plain, *columns) == rows(ranged, *columns)


def test_transitions_of_hot_sessions(spark, sf, skewed):
    items = retail.items(spark, sf)
    assert rows(stats.category_transitions(skewed, items)) == rows(
        stats.category_transitions(skewed, items, hot_rows=100)
    )


def test_sequences_of_hot_orders(skewed):
    plain = stats.session_sequences(skewed, max_length=50)
    ranged = stats.session_sequences(skewed, max_length=50, hot_rows=100)
    text = lambda df: rows(
        df, "order_id", "part", F.array_join(F.col("items").cast("array<string>"), ",")
    )
    assert text(plain) == text(ranged)
    assert ranged.agg(F.max(F.size("items"))).first()[0] == 50


def test_pairs_of_hot_sessions(skewed):
    assert rows(stats.item_cooccurrence(skewed)) == rows(
        stats.item_cooccurrence(skewed, split_items=16)
    )


def test_pairs_against_brute_force(skewed):
    data = skewed.select("session_id", "item_id").collect()
    by_session = {}
    for r in data:
        by_session.setdefault(r.session_id, []).append(r.item_id)
    expected = {}
    for basket in by_session.values():
        for i, a in enumerate(basket):
            for b in basket[i + 1:]:
                expected[a, b] = expected.get((a, b), 0) + 1
                expected[b, a] = expected.get((b, a), 0) + 1
    got = {(r.item_a, r.item_b): r.cooc for r in stats.item_cooccurrence(skewed).collect()}
    assert got == expected


def test_running_totals_over_ranges(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), F.lit(2).alias("n"))
    got = ordering.running_totals(df, [F.col("v")], {"before": F.col("n")}, hot_rows=90)
    assert rows(got, "v", "before") == [(v, 2 * v) for v in range(1000)]


@pytest.mark.parametrize("name", ["uniform", "random", "popular", "mixed"])
def test_paged_menus(spark, sf, inter, name):
    sample = getattr(sampling, f"sample_{name}")
    items = retail.items(spark, sf)
    columns = ("line_key", "item_id", "added_to_cart")
    whole = rows(sample(inter, items, 5), *columns) if name != "popular" else rows(
        sample(inter, items), *columns
    )
    paged = rows(sample(inter, items, 5, page=4), *columns) if name != "popular" else rows(
        sample(inter, items, page=4), *columns
    )
    assert whole == paged


def test_uniform_draws_cover_menus_evenly(spark, sf, inter):
    samples = sampling.sample_uniform(inter, retail.items(spark, sf), 5)
    negatives = samples.where("added_to_cart = 0")
    per_line = negatives.groupBy("line_key").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("item_id").alias("d")
    )
    assert per_line.where("n <> 5 OR d <> 5").isEmpty()
    own = inter.select("line_key", F.col("item_id"))
    assert negatives.join(own, ["line_key", "item_id"]).isEmpty()
    counts = [r[1] for r in negatives.groupBy("item_id").count().collect()]
    assert len(counts) == 200 and max(counts) < 2 * min(counts)


def test_excluding_session_positives(spark, sf, inter):
    samples = sampling.sample_uniform(
        inter, retail.items(spark, sf), 40, exclude_session_positives=True
    )
    bought = inter.select("session_id", "item_id").distinct()
    assert samples.where("added_to_cart = 0").join(bought, ["session_id", "item_id"]).isEmpty()
    assert samples.where("added_to_cart = 1").count() == inter.count()


@pytest.mark.parametrize("page", [sampling.PAGE, 2])
def test_negatives_outside_the_session_wherever_they_exist(spark, page):
    """A menu of six, three of them bought in one session: three are left for each row."""
    schema = "order_id long, session_id long, line_key string, user_id long, item_id long, restaurant_id long, "
    bought = [(1, 1, f"l{i}", 1, i, 7, None, i, 1) for i in (0, 2, 5)] + [(2, None, "l9", 1, 3, 7, None, 0, 1)]
    inter = spark.createDataFrame(bought, schema + "timestamp timestamp, position_in_cart int, added_to_cart int")
    items = spark.createDataFrame([(i, 7) for i in range(6)], "item_id long, restaurant_id long")
    samples = sampling.sample_uniform(inter, items, 3, exclude_session_positives=True, page=page)
    found = {}
    for r in samples.where("added_to_cart = 0").collect():
        found.setdefault(r.line_key, set()).add(r.item_id)
    assert {k: found[k] for k in ("l0", "l2", "l5")} == dict.fromkeys(("l0", "l2", "l5"), {1, 3, 4})
    assert len(found["l9"]) == 3 and 3 not in found["l9"]


def test_draw_numbers_tell_rows_apart(spark, sf, inter):
    for page in (sampling.PAGE, 4):
        samples = sampling.sample_mixed(inter, retail.items(spark, sf), page=page)
        keys = samples.groupBy("line_key", "draw").agg(F.count(F.lit(1)).alias("n"), F.max("added_to_cart").alias("own"))
        assert keys.where("n > 1 OR (draw = 0) <> (own = 1) OR draw > 4").isEmpty()


def test_weighted_draws_follow_their_weights(spark):
    """Two of three items by weight: the law of drawing one after the other."""
    inter = spark.range(6000).select(
        F.col("id").alias("order_id"), F.col("id").alias("session_id"), F.col("id").cast("string").alias("line_key"),
        F.lit(1).alias("user_id"), F.lit(0).cast("long").alias("item_id"), F.lit(7).cast("long").alias("restaurant_id"),
        F.lit(None).cast("timestamp").alias("timestamp"), F.lit(0).alias("position_in_cart"), F.lit(1).alias("added_to_cart"),
    )
    items = spark.createDataFrame([(i, 7) for i in range(3)], "item_id long, restaurant_id long")
    weights = spark.createDataFrame([(0, 6), (1, 3), (2, 1)], "item_id long, count long")
    drawn = sampling.sample_popular(inter, items, weights, ratio=2).where("added_to_cart = 0")
    share = {r.item_id: r["count"] / 6000 for r in drawn.groupBy("item_id").count().collect()}
    w = {0: 0.6, 1: 0.3, 2: 0.1}
    for i, p in w.items():
        expected = p + sum(q * p / (1 - q) for j, q in w.items() if j != i)
        assert abs(share[i] - expected) < 0.02


def test_mixed_with_popular_half(spark, sf, inter):
    samples = sampling.sample_mixed(inter, retail.items(spark, sf), second_half="popular")
    assert samples.where("added_to_cart = 0").count() == 4 * inter.count()


def test_nearest_items_in_blocks(spark, sf):
    vectors = retail.item_vectors(spark, sf)
    one, many = embeddings.similar_items(vectors), embeddings.similar_items(vectors, block=100)
    assert rows(one) == rows(many)
    few = vectors.where("item_id < 3").select("item_id")
    assert embeddings.similar_items(vectors, queries=few).count() == 30


@pytest.mark.parametrize("cosine", [True, False])
def test_cells_skip_what_cannot_be_near(spark, cosine):
    """Clustered vectors against brute force, with equal vectors, a zero and a hot cluster."""
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(12, 8)) * 3
    of = np.where(draw.random(900) < 0.3, 0, draw.integers(0, 12, 900))
    points = centres[of] + draw.normal(size=(900, 8)) * 0.05
    points[10:40] = points[10]
    points[50] = 0.0
    vectors = spark.createDataFrame(
        [(int(i), v.tolist()) for i, v in enumerate(points)], "item_id BIGINT, vec ARRAY<DOUBLE>"
    )
    seen = Observation()
    found = embeddings.nearest_items(vectors, 5, cosine, block=60, observation=seen)
    unit = points / np.maximum(np.linalg.norm(points, axis=1), 1e-300)[:, None] if cosine else points
    scores = unit @ unit.T
    np.fill_diagonal(scores, -np.inf)
    got = {}
    for r in found.collect():
        got.setdefault(r.item_id, {})[r["rank"]] = r.similarity
    for i, row in enumerate(scores):
        assert [got[i][k] for k in range(1, 6)] == pytest.approx(np.sort(row)[::-1][:5], abs=1e-8)
    equal = found.where("item_id = 12 AND rank <= 5").orderBy("rank").collect()
    if cosine:
        assert [r.other_id for r in equal] == [10, 11, 13, 14, 15]
    assert seen.get["pairs"] % 900 == 0
    assert seen.get["compared"] < 0.5 * seen.get["pairs"]
    few = spark.createDataFrame([(3,), (50,), (-1,)], "item_id BIGINT")
    some = embeddings.nearest_items(vectors, 5, cosine, queries=few, block=60)
    assert rows(some) == rows(found.where("item_id IN (3, 50)"))


@pytest.mark.parametrize("split_items", [stats.SPLIT_ITEMS, 2])
def test_cooccurrence_without_symmetric_table(spark, sf, inter, split_items):
    train = inter.where("item_id % 3 <> 0")
    carts = inter.select("session_id", "item_id")
    slim = inter.select("line_key", "session_id", "item_id")
    one = features.cart_cooccurrence(slim, carts, stats.item_cooccurrence(train), split_items)
    other = features.cart_cooccurrence_in(slim, carts, train, split_items)
    assert rows(one) == rows(other.select(*one.columns))
    if split_items > 2:
        other.collect()
        plan = other._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
        assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 8
    none = features.cart_cooccurrence_in(slim.limit(0), carts, train)
    assert none.count() == 0


@pytest.mark.parametrize("block", [metrics.LEAST_BLOCK, 1])
def test_split_resamples_follow_the_law(spark, monkeypatch, block):
    """Means of 10 distinct values: the variance of a mean is that of a value over n."""
    monkeypatch.setattr(metrics, "LEAST_BLOCK", block)
    values = spark.range(500).select((F.col("id") % 10).cast("double").alias("x"))
    means = [metrics._replicate_means_by_split(v, "x", 500, 2000, "42", 10**6).toPandas().sort_values("replicate")["mean"]
             for v in (values, values.repartition(7, "x"))]
    assert means[0].tolist() == pytest.approx(means[1].tolist(), abs=1e-12)
    assert abs(means[0].mean() - 4.5) < 0.01 and abs(means[0].var() / (8.25 / 500) - 1) < 0.1
    whole = spark.range(500).select(F.lit(3.0).alias("x"))
    assert metrics.bootstrap_ci(whole, "x", replicates=50).first() == (3.0, 3.0)
    low, high = metrics.bootstrap_ci(values, "x", replicates=400).first()
    assert 4.1 < low < 4.4 < 4.6 < high < 4.9


def test_bootstrap_by_weight(spark):
    values = spark.range(500).select((F.col("id") % 10).cast("double").alias("x"))
    low, high = metrics.bootstrap_ci(values, "x", replicates=200, method="weight").first()
    assert 3.9 < low < 4.5 < high < 5.1


def test_results_do_not_depend_on_partitioning(spark, sf, inter):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    items = retail.items(spark, sf)
    results = []
    for partitions, parts in ((1, 1), (13, 7)):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        shuffled = inter.repartition(parts, "line_key")
        results.append(
            (
                rows(sampling.sample_random(shuffled, items), "line_key", "item_id"),
                rows(stats.category_transitions(shuffled, items)),
                rows(ranker.group_kfold(shuffled)),
            )
        )
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def test_flagship_values(spark, sf):
    got = {r.metric: r.value for r in QUERIES["ranking_report"](spark, sf).collect()}
    expected = {
        "precision_10": 0.053495, "recall_10": 0.176637, "ndcg_10": 0.215846,
        "ndcg_full_10": 0.10742, "auc": 0.497071, "average_precision": 0.049813,
    }
    assert {k: got[k] for k in expected} == expected


@pytest.mark.parametrize("page", [4, 256])
def test_attributes_travel_with_the_menus(spark, sf, inter, page):
    items = retail.items(spark, sf)
    # Every third line's item is not on its restaurant's menu, some items have no attributes.
    away = inter.withColumn(
        "restaurant_id", F.when(F.col("item_id") % 3 == 0, 1).otherwise(F.col("restaurant_id"))
    )
    facts = items.where("item_id % 5 > 0").select("item_id", "price", F.array("price").alias("_iv"))
    plain = sampling.sample_uniform(away, items, 7, page=page).join(facts, "item_id", "left")
    carried = sampling.sample_uniform(away, items, 7, page=page, attributes=facts, cluster="order_id")
    columns = ("line_key", "item_id", "added_to_cart", F.coalesce("price", F.lit(-1.0)), F.size("_iv"))
    assert rows(plain, *columns) == rows(carried, *columns)


def test_scored_rows_meet_no_join(spark, sf, inter):
    """Shares join the lines and the menus; the fanned-out rows are neither joined nor moved."""
    scored = flow.popularity_scored(inter, inter, retail.items(spark, sf), 5)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in plan
    assert "Join" not in plan[: plan.index("Generate")] and "Repartition" not in plan[: plan.index("Generate")]


def test_sessions_are_excluded_before_the_menus(spark, sf, inter):
    drawn = sampling.sample_uniform(inter, retail.items(spark, sf), 5, exclude_session_positives=True)
    plan = drawn._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    # The last join, nearest to the fan-out, is that with the menus.
    assert "session_id" not in joins[0] and any("session_id" in line for line in joins[1:])


def test_pairing_tasks_do_not_grow_with_the_table(inter):
    plain = stats.pair_counts(inter)
    small = stats.pair_counts(inter, rows_per_task=100)
    assert rows(small) == rows(plain)
    plan = small._jdf.queryExecution().optimizedPlan().toString()
    tasks = max(int(n) for n in re.findall(r"RepartitionByExpression \[session_id#\d+\], (\d+)", plan))
    assert tasks == -(-inter.count() // 100)


def test_small_vectors_and_menus_go_to_the_lines(spark, sf):
    """Lines stay where they are: vectors and menus are sent to them whatever the session's threshold."""
    inter, items = retail.interactions(spark, sf), retail.items(spark, sf)
    vectors = retail.item_vectors(spark, sf)
    users = embeddings.user_vectors(inter, vectors)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = embeddings.add_embedding_features(inter, vectors, users)
        sampled = sampling.sample_random(inter, items)
        popular = sampling.sample_popular(inter, items, stats.item_popularity(inter))
        plans = [f._jdf.queryExecution().optimizedPlan().toString() for f in (joined, sampled, popular)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [plan.count("rightHint=(strategy=broadcast)") for plan in plans] == [2, 1, 2]


def test_lines_that_tie_up_to_the_key_hold_one_item(spark):
    """The user's vector needs no line key: repeats of a line share their item."""
    rows_ = [(1, i, datetime(2024, 1, 1), 0, f"k{n}") for n, i in enumerate([3, 3, 4, 5, 5, 5])]
    lines = spark.createDataFrame(
        rows_, "user_id BIGINT, item_id BIGINT, timestamp TIMESTAMP_NTZ, position_in_cart INT, line_key STRING"
    )
    vectors = spark.createDataFrame([(3, [1.0, 0.0]), (5, [0.0, 1.0])], "item_id BIGINT, vec ARRAY<DOUBLE>")
    weights = [2.718281828459045 ** (-0.1 * age) for age in (0, 1, 2, 4, 5)]
    share = sum(weights[:3]) / sum(weights)
    found = embeddings.user_vectors(lines, vectors).first()["vec"]
    assert found == pytest.approx([1 - share, share])
    slim = embeddings.user_vectors(lines.drop("line_key"), vectors).first()["vec"]
    assert slim == pytest.approx(found)


def test_features_are_made_after_the_last_join(spark):
    """No join moves a column that can be computed; unknown users, items and carts as in single steps."""
    users = spark.createDataFrame(
        [(1, "budget", "veg", "low", "a"), (2, None, "both", "high", "b")],
        "user_id long, user_segment string, veg_preference string, order_frequency string, preferred_cuisine string",
    )
    items = spark.createDataFrame(
        [(7, 10.0, "main", 1, 0.5), (8, 300.0, None, 0, 0.1)],
        "item_id long, price double, category string, veg_flag int, popularity_score double",
    )
    user_stats = spark.createDataFrame([(1, 4), (3, 2)], "user_id long, order_count long")
    item_stats = spark.createDataFrame(
        [(8, 2, 3, 0.25), (9, 1, 1, 0.5)], "item_id long, unique_users long, order_count long, popularity_score double"
    )
    lines = spark.createDataFrame(
        [("a", "s", 1, 7), ("b", "s", 2, 8), ("c", "t", 3, 9), ("d", None, None, None), ("e", "u", 5, 7)],
        "line_key string, session_id string, user_id long, item_id long",
    ).withColumn("timestamp", F.lit("2024-01-01 08:00:00").cast("timestamp"))
    carts = lines.where("session_id <> 'u'").select("session_id", "item_id")
    got = features.engineer_features(lines, users, items, user_stats, item_stats, carts)
    want = features.add_user_features(lines, users, user_stats)
    want = features.add_item_features(want, items, item_stats)
    want = features.add_interaction_features(features.add_cart_features(want, carts, items))
    want = features.add_price_progression(features.add_context_features(want))
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    shown = spark.conf.get("spark.sql.debug.maxToStringFields", "25")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = got._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", shown)
    top, below = plan.split("Join LeftOuter", 1)
    for name in ("segment_budget", "log_price", "category_main", "is_veg"):
        assert f"AS {name}#" in top and f"AS {name}#" not in below
