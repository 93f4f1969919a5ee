"""Hand-computed results on small fixtures."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartwise.functions.scalars import cyclical, safe_divide
from cartwise.operators import business, embeddings, features, metrics, sampling, split, stats
from cartwise.sources import readers, schemas, sinks
from cartwise.sources.schemas import require_columns


def lines(spark, data):
    """Interactions from (session, item) pairs, in order."""
    table = [
        (s, s, f"{s}-{n}", 1, i, 0, datetime(2024, 1, 1, 0, n), n, 1)
        for n, (s, i) in enumerate(data)
    ]
    return spark.createDataFrame(
        table,
        "order_id STRING, session_id STRING, line_key STRING, user_id BIGINT, item_id BIGINT, "
        "restaurant_id BIGINT, timestamp TIMESTAMP_NTZ, position_in_cart INT, added_to_cart INT",
    )


@pytest.fixture(scope="module")
def scored(spark):
    groups = {
        "A": ([1, 0, 0, 1, 0, 1], [0.9, 0.8, 0.7, 0.6, 0.5, 0.4]),
        "B": ([0, 1, 0], [0.3, 0.2, 0.1]),
        "C": ([0, 0], [0.25, 0.15]),
    }
    data = [
        (g, i, f"{g}{i}", label, score)
        for g, (labels, scores) in groups.items()
        for i, (label, score) in enumerate(zip(labels, scores))
    ]
    return spark.createDataFrame(
        data, "order_id STRING, item_id INT, line_key STRING, added_to_cart INT, score DOUBLE"
    )


def test_ranking_metrics_per_group(scored):
    got = rows(
        metrics.group_metrics(scored, (2, 5)),
        "order_id", "precision_2", "recall_2", "ndcg_2", "ndcg_full_2",
        "precision_5", "recall_5", "ndcg_5", "ndcg_full_5",
    )
    assert got == [
        ("A", 0.5, 0.333333, 1.0, 0.613147, 0.4, 0.666667, 0.877215, 0.671386),
        ("B", 0.5, 1.0, 0.63093, 0.63093, 0.333333, 1.0, 0.63093, 0.63093),
        ("C", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0),
    ]


def test_graded_ndcg(spark, scored):
    for k in (2, 5):
        names = ("order_id", f"ndcg_{k}", f"ndcg_full_{k}")
        assert rows(metrics.graded_ndcg(scored, k), *names) == rows(
            metrics.group_metrics(scored, (k,)), *names
        )
    graded = spark.createDataFrame(
        [("g", 0, "x", 1, 0.9), ("g", 1, "y", 2, 0.8), ("g", 2, "z", 3, 0.1)],
        scored.schema,
    )
    # Gains 1 and 3 at ranks 1 and 2; the best order of all rows starts 7, 3.
    assert rows(metrics.graded_ndcg(graded, 2)) == [("g", 0.796708, 0.325296)]


def test_ranking_means(scored):
    means = metrics.mean_metrics(metrics.group_metrics(scored, (2, 5))).first().asDict()
    expected = {
        "precision_2": 0.333333, "recall_2": 0.444444, "ndcg_2": 0.543643, "ndcg_full_2": 0.414692,
        "precision_5": 0.244444, "recall_5": 0.555556, "ndcg_5": 0.502715, "ndcg_full_5": 0.434105,
    }
    assert {k: round(v, 6) for k, v in means.items()} == expected


@pytest.mark.parametrize("hot_rows", [1_000_000, 3])
def test_auc_and_average_precision(scored, hot_rows):
    assert rows(metrics.auc_and_precision(scored, hot_rows=hot_rows)) == [(0.642857, 0.611111)]


def test_one_class_scores_zero(scored):
    one_class = scored.where("added_to_cart = 0")
    assert rows(metrics.auc_and_precision(one_class)) == [(0.0, 0.0)]


def test_cooccurrence(spark):
    baskets = lines(spark, [("s1", 10), ("s1", 20), ("s1", 10), ("s2", 20), ("s2", 30)])
    edges = stats.item_cooccurrence(baskets)
    assert rows(edges, "item_a", "item_b", "cooc") == [
        (10, 10, 2), (10, 20, 2), (20, 10, 2), (20, 30, 1), (30, 20, 1),
    ]
    cart = spark.createDataFrame(
        [("c", 20), ("c", 20), ("c", 30)], "session_id STRING, item_id BIGINT"
    )
    candidates = spark.createDataFrame(
        [("c", 10), ("c", 99), ("none", 10)], "session_id STRING, item_id BIGINT"
    )
    for split_items in (4096, 1):
        got = features.cart_cooccurrence(candidates, cart, edges, split_items)
        assert rows(got, "session_id", "item_id", "cart_cooccurrence") == [
            ("c", 10, 1.333333), ("c", 99, 0.0), ("none", 10, 0.0),
        ]


def test_category_transitions(spark):
    items = spark.createDataFrame(
        [(1, "main"), (2, "drink"), (3, "dessert")], "item_id BIGINT, category STRING"
    )
    inter = lines(spark, [("s1", 1), ("s1", 2), ("s1", 1), ("s2", 2), ("s2", 3)])
    for hot_rows in (1_000_000, 1):
        got = stats.category_transitions(inter, items, hot_rows)
        assert rows(got) == [
            ("drink", "dessert", 1, 0.333333),
            ("drink", "main", 1, 0.333333),
            ("main", "drink", 1, 0.333333),
        ]


def test_user_vector(spark):
    inter = lines(spark, [("s", 1), ("s", 2), ("s", 3)])
    vectors = spark.createDataFrame(
        [(1, [1.0, 0.0]), (3, [0.0, 1.0])], "item_id BIGINT, vec ARRAY<DOUBLE>"
    )
    unpack = lambda df: rows(df, F.col("vec")[0], F.col("vec")[1])
    assert unpack(embeddings.user_vectors(inter, vectors)) == [(0.450166, 0.549834)]
    assert unpack(embeddings.user_vectors(inter, vectors, recency_weight=False)) == [(0.5, 0.5)]
    unknown = vectors.where("item_id = 99")
    assert embeddings.user_vectors(inter, unknown).count() == 0
    looked_up = embeddings.lookup_vectors(inter.where("item_id = 2"), vectors, dim=2)
    assert looked_up.first().vec == [0.0, 0.0]


def test_acceptance_probability(spark):
    data = [("budget", 100.0, 0.0), ("regular", 50.0, 0.5), ("premium", 0.0, 1.0)]
    df = spark.createDataFrame(data, "user_segment STRING, price DOUBLE, score DOUBLE")
    got = business.acceptance_prob(df)
    assert rows(got, "user_segment", "acceptance_prob") == [
        ("budget", 0.038627), ("premium", 0.39), ("regular", 0.136469),
    ]
    constant = business.acceptance_prob(df.withColumn("score", F.lit(7.0)))
    assert {r.score_normalized for r in constant.collect()} == {0.5}
    odd = spark.createDataFrame(
        [("other", 0.0, "a", 1), ("regular", None, "b", 1)],
        "user_segment STRING, price DOUBLE, line_key STRING, item_id INT",
    )
    drawn = business.acceptance_draw(business.acceptance_prob(odd))
    assert rows(drawn, "user_segment", "acceptance_prob")[0] == ("other", 0.15)
    assert drawn.where("price IS NULL").first().accepted == 0


def test_loading_drops_lines_without_header(spark):
    order_items = spark.createDataFrame(
        [(o, 5, datetime(2024, 1, 1), 0, 0) for o in (1, 2, 9)],
        "order_id BIGINT, item_id BIGINT, added_timestamp TIMESTAMP_NTZ, is_recommended INT, "
        "added_after_recommendation INT",
    )
    orders = spark.createDataFrame(
        [(1, 7, 3), (2, None, 3)], "order_id BIGINT, user_id BIGINT, restaurant_id BIGINT"
    )
    joined = readers.join_order_header(order_items, orders)
    assert rows(readers.null_profile(joined)) == [(2, 1, 0)]
    inter = readers.build_interactions(order_items, orders)
    assert rows(inter, "session_id", "user_id", "added_to_cart", "ordered") == [("sess_1", 7, 1, 1)]
    with pytest.raises(ValueError, match="is_recommended"):
        readers.build_interactions(order_items.drop("is_recommended"), orders)
    with pytest.raises(ValueError, match="lacks columns: b"):
        require_columns(spark.range(1), ["id", "b"])


def test_temporal_split(spark):
    times = [
        datetime(2024, 2, 7, 23, 59), datetime(2024, 2, 8), datetime(2024, 2, 14, 23, 59),
        datetime(2024, 2, 15),
    ]
    df = spark.createDataFrame([(t,) for t in times], "timestamp TIMESTAMP_NTZ")
    options = {"split_date": "2024-02-15", "test_days": 7}
    labels = [r.split for r in split.temporal_split(df, **options).orderBy("timestamp").collect()]
    assert labels == ["train", "val", "val", "test"]
    assert [f.count() for f in split.split_frames(df, **options)] == [1, 2, 1]


def test_cart_features(spark):
    items = spark.createDataFrame(
        [(1, "main", 100.0, 1), (2, "drink", 40.0, 0)],
        "item_id BIGINT, category STRING, price DOUBLE, veg_flag INT",
    )
    carts = spark.createDataFrame(
        [("a", 1), ("a", 1), ("a", 2), ("u", 50)], "session_id STRING, item_id BIGINT"
    )
    candidates = spark.createDataFrame(
        [("a", 105.0), ("none", 105.0), ("u", 105.0)], "session_id STRING, price DOUBLE"
    )
    got = features.add_price_progression(features.add_cart_features(candidates, carts, items))
    by_session = {r.session_id: r.asDict() for r in got.collect()}
    a = by_session["a"]
    names = ["cart_size", "cart_total_price", "cart_avg_price", "cart_has_main",
             "cart_has_drink", "cart_has_dessert", "cart_veg_ratio"]
    assert [a[n] for n in names] == [3, 140.0, 70.0, 1, 1, 0, 0.5]
    assert (a["price_vs_cart_avg"], round(a["price_ratio_to_cart"], 6)) == (35.0, 1.478873)
    assert [by_session["none"][n] for n in names] == [0, 0, 0, 0, 0, 0, 0.5]
    assert [by_session["u"][n] for n in names] == [1, 0, None, 0, 0, 0, None]


def test_context(spark):
    times = [(2024, 1, 6, 6, 0), (2024, 1, 6, 10, 30), (2024, 1, 6, 15, 0), (2024, 1, 6, 22, 0),
             (2024, 1, 6, 5, 59)]
    df = spark.createDataFrame(
        [(i, datetime(*t)) for i, t in enumerate(times)], "id INT, timestamp TIMESTAMP_NTZ"
    )
    got = features.add_context_features(df).orderBy("id").collect()
    slots = [(r.is_breakfast, r.is_lunch, r.is_dinner, r.is_late_night) for r in got]
    assert slots == [(1, 0, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0), (0, 0, 0, 1), (0, 0, 0, 1)]
    assert (got[0].day_of_week, got[0].is_weekend) == (5, 1)


def test_helpers(spark):
    hours = spark.createDataFrame([(0,), (6,), (18,)], "h INT")
    got = rows(hours, "h", *cyclical(F.col("h"), 24))
    assert [(round(a, 6) + 0.0, round(b, 6) + 0.0) for _, a, b in got] == [
        (0.0, 1.0), (1.0, 0.0), (-1.0, 0.0)
    ]
    pairs = spark.createDataFrame([(1.0, 0.0), (None, 1.0), (1.0, 4.0)], "a DOUBLE, b DOUBLE")
    got = [r[0] for r in pairs.select(safe_divide(F.col("a"), F.col("b"))).collect()]
    assert got == [0.0, None, 0.25]
    values = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0, 100.0, None)], "x DOUBLE")
    for hot_rows in (1_000_000, 2):
        clipped = [r.x for r in features.clip_outliers(values, "x", hot_rows=hot_rows).collect()]
        assert sorted(round(x, 6) for x in clipped if x is not None) == [1.04, 2, 3, 4, 96.16]
        assert clipped.count(None) == 1


def test_price_match(spark):
    data = [("budget", 149.0), ("budget", 150.0), ("premium", 200.0), ("premium", 201.0),
            ("regular", 10.0), ("budget", None)]
    df = spark.createDataFrame(data, "s STRING, price DOUBLE").select(
        "price", F.lit(0).alias("veg_preference_veg"), F.lit(0).alias("is_veg"),
        (F.col("s") == "budget").cast("int").alias("segment_budget"),
        (F.col("s") == "premium").cast("int").alias("segment_premium"),
    )
    got = [r.user_item_price_match for r in features.add_interaction_features(df).collect()]
    assert got == [1, 0, 0, 1, 0, 0]


def test_candidate_set_check(spark):
    def samples(*counts):
        data = [
            (f"s{i}", label)
            for i, (pos, neg) in enumerate(counts)
            for label in [1] * pos + [0] * neg
        ]
        return spark.createDataFrame(data, "session_id STRING, added_to_cart INT")

    fine = stats.candidate_set_check(samples((1, 5), (1, 4)), strict=True).first()
    assert (fine.sessions, fine.few_negatives, fine.min_negatives) == (2, 1, 4)
    for bad in ((0, 3), (2, 0)):
        with pytest.raises(ValueError, match="invalid candidate set"):
            stats.candidate_set_check(samples((1, 5), bad), strict=True)


def test_business_metrics(spark):
    recs = [(o, i, 0, 0.0) for o, i in ((1, 1), (1, 2), (2, 3), (2, 4), (3, 5), (3, 1), (4, 2), (4, 3))]
    recs[0], recs[1], recs[2] = (1, 1, 1, 30.0), (1, 2, 1, 30.0), (2, 3, 1, 60.0)
    df = spark.createDataFrame(recs, "order_id INT, item_id INT, accepted INT, price DOUBLE")
    items = spark.range(10).withColumnRenamed("id", "item_id")
    assert rows(business.business_metrics(df, items)) == [(0.5, 0.1, 0.5, 0.5, 2.0, 0.75)]
    empty = business.business_metrics(df.where("order_id > 9"), items)
    assert rows(empty) == [(0.0, 0.0, 0.0, 0.0, 0.0, 0.0)]


@pytest.mark.parametrize("page", [256, 3])
def test_negatives(spark, page):
    items = spark.createDataFrame(
        [(i, 1) for i in range(20)] + [(100, 2)], "item_id BIGINT, restaurant_id BIGINT"
    )
    data = [("a", 3, 1), ("b", 100, 2), ("c", 5, 9), ("d", 100, 1)]
    inter = spark.createDataFrame(
        [(k, k, k, 1, i, r, 1) for k, i, r in data],
        "order_id STRING, session_id STRING, line_key STRING, user_id INT, item_id BIGINT, "
        "restaurant_id BIGINT, added_to_cart INT",
    )
    got = sampling.sample_uniform(inter, items, 40, page=page).collect()
    negatives = {k: [r.item_id for r in got if r.line_key == k and not r.added_to_cart] for k in "abcd"}
    assert sorted(negatives["a"]) == [i for i in range(20) if i != 3]
    assert negatives["b"] == [] and negatives["c"] == []
    # An item that is not on the menu excludes nothing.
    assert sorted(negatives["d"]) == list(range(20))
    assert sum(r.added_to_cart for r in got) == 4


def test_repeated_lines_have_their_own_keys(spark):
    lines = spark.createDataFrame(
        [(1, 5, 0, 0, "b")] * 3 + [(1, 6, 0, 0, "b")],
        "order_id INT, item_id INT, is_recommended INT, added_after_recommendation INT, note STRING",
    ).withColumn("added_timestamp", F.lit("2024-01-01 10:00:00").cast("timestamp_ntz"))
    orders = spark.createDataFrame([(1, 7, 3, "a")], "order_id INT, user_id INT, restaurant_id INT, note STRING")
    got = readers.build_interactions(lines, orders)
    assert sorted(r.line_key for r in got.collect()) == [
        "1-5-2024-01-01 10:00:00",
        "1-5-2024-01-01 10:00:00-r2",
        "1-5-2024-01-01 10:00:00-r3",
        "1-6-2024-01-01 10:00:00",
    ]


def test_report_as_text(spark, tmp_path):
    report = spark.createDataFrame(
        [("ranking", "auc", 0.75), ("business", "aov_lift", 0.5)], "section STRING, metric STRING, value DOUBLE"
    )
    path = sinks.save_report_text(report, str(tmp_path / "report"))
    assert [r.value for r in spark.read.text(path).collect()] == [
        "business | aov_lift: 50.00%",
        "ranking | auc: 0.7500",
    ]


def test_csv_folder(spark, tmp_path):
    tables = {
        "users": "note,user_id,user_segment,veg_preference,order_frequency,preferred_cuisine\n"
        "hi,7,budget,veg,low,Thai\n",
        "restaurants": "restaurant_id,city\n3,Pune\n",
        "items": "item_id,restaurant_id,category,veg_flag,price,popularity_score\n"
        "5,3,main,1,abc,0.5\n",
        "carts": "session_id,cart_items\nsess_1,\"5,5,6\"\n",
        "orders": "order_id,user_id,restaurant_id\n1,7,3\n",
        "order_items": "order_id,item_id,added_timestamp,is_recommended,added_after_recommendation"
        ",position_in_cart\n1,5,2024-01-01 10:00:00,1,0,1\n9,5,2024-01-01 10:00:00,1,0,1\n",
    }
    for name, text in tables.items():
        (tmp_path / f"{name}.csv").write_text(text)
    found = readers.load_all(spark, str(tmp_path))
    assert found["users"].columns[0] == "user_id" and found["users"].first().note == "hi"
    assert found["items"].first().price is None
    assert found["restaurants"].first().city == "Pune"
    assert rows(readers.cart_lines(found["carts"]), "item_id") == [(5,), (5,), (6,)]
    line = found["interactions"].collect()
    assert [(r.session_id, r.timestamp, r.user_id) for r in line] == [
        ("sess_1", datetime(2024, 1, 1, 10), 7)
    ]


def test_rows_that_do_not_parse_are_counted_and_kept(spark, tmp_path):
    tables = {
        "users": "user_id,user_segment\n7,budget\nU8,regular\n",
        "restaurants": "restaurant_id,city\n3,Pune\n",
        "items": "item_id,restaurant_id,price\nI1,3,10\n5,3,abc\n6,3,2.5\n,3,1\n",
        "carts": "session_id,cart_items\nsess_1,5\nsess_2,5,6\n",
        "orders": "order_id,user_id,restaurant_id\n1,7,3\n2,U8,3\n",
        "order_items": "order_id,item_id,added_timestamp,is_recommended,added_after_recommendation\n"
        "1,5,2024-01-01 10:00:00,1,0\n1,I1,2024-01-01 10:00:00,1,0\n2,6,2024-01-01 10:00:00,1,0\n",
    }
    for name, text in tables.items():
        (tmp_path / f"{name}.csv").write_text(text)
    seen = {}
    found = readers.load_all(spark, str(tmp_path), observations=seen)
    lost = {(r["table"], tuple(r["columns"])): (r["record"], r["kept"]) for r in found["rejects"].collect()}
    assert {k: v[1] for k, v in lost.items()} == {
        ("users", ("user_id",)): False,
        ("items", ("item_id",)): False,
        ("items", ("price",)): True,
        ("carts", ("row",)): False,
        ("orders", ("user_id",)): False,
        ("order_items", ("item_id",)): False,
    }
    assert '"I1"' in lost["items", ("item_id",)][0] and lost["carts", ("row",)][0] == "sess_2,5,6"
    # A missing id is no failed parse: the row stays, as null_profile counts it.
    assert rows(found["items"].fillna(-1), "item_id", "price") == [(-1, 1.0), (5, -1.0), (6, 2.5)]
    assert seen["items"].get == {"rows": 4, "rejected": 1, "repaired": 1}
    assert [(r.order_id, r.item_id) for r in found["interactions"].collect()] == [(1, 5)]
    assert seen["order_items"].get == {"rows": 3, "rejected": 1, "repaired": 0}

    as_text = found["users"].select(F.lit("I9").alias("user_id"), "user_segment")
    as_text.write.parquet(str(tmp_path / "typed"))
    checked = readers.checked_table(spark, str(tmp_path / "typed"), schemas.USERS, "parquet")
    assert readers.usable_rows(checked, ["user_id"]).count() == 0
    assert readers.rejected_rows(checked, ["user_id"], "users").first()["record"].startswith('{"user_id":"I9"')


def test_files_with_other_headers_are_refused(spark, tmp_path):
    folder = tmp_path / "users.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("user_id,user_segment\n7,budget\n")
    (folder / "b.csv").write_text("user_segment,user_id\nbudget,8\n")
    with pytest.raises(Exception, match="header|CSV"):
        readers.load_users(spark, str(folder)).collect()
