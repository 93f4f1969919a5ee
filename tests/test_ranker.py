"""Learned models on a planted signal, and their persistence."""

import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartwise.operators import boosting, embeddings, features, metrics, ranker, sampling, stats
from cartwise.operators.split import split_frames
from cartwise.plans import flow
from cartwise.sources import retail, sinks

QUICK = ranker.RankerParams(trees=5, max_depth=3, min_rows_per_leaf=5)


@pytest.fixture(scope="module")
def planted(spark):
    """One positive and four negatives a line; feature a leads the label, b is noise."""
    base = spark.range(2000).select(
        (F.col("id") / 10).cast("int").cast("long").alias("order_id"),
        (F.col("id") / 5).cast("int").cast("string").alias("line_key"),
        (F.col("id") % 5).alias("item_id"),
        (F.col("id") % 5 == 0).cast("int").alias("added_to_cart"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000).alias("b"),
    )
    noise = F.pmod(F.xxhash64("item_id", "line_key"), F.lit(1000)) / 1000
    return base.withColumn("a", F.col("added_to_cart") * 0.8 + noise).cache()


@pytest.fixture(scope="module")
def fitted(planted):
    return ranker.fit_ranker(
        planted.where("order_id >= 50"), ["a", "b"], planted.where("order_id < 50"), QUICK
    )


def test_both_learners_find_the_signal(planted, fitted):
    pairwise = ranker.fit_pairwise(planted, ["a", "b"])
    for model in (fitted, pairwise):
        scored = ranker.predict(model, planted)
        assert metrics.auc_and_precision(scored).first().auc > 0.9


def test_importance_history_and_info(spark, planted, fitted):
    importance = ranker.feature_importance(fitted, spark)
    assert ranker.top_features(importance, 1).first().feature == "a"
    history = ranker.training_history(fitted, planted, every=2)
    assert history.count() >= 1 and history.where("ndcg_10 < ndcg_5").isEmpty()
    linear = ranker.fit_pairwise(planted, ["a", "b"])
    weights = {r.feature: r.importance for r in ranker.feature_importance(linear, spark).collect()}
    assert weights["a"] > weights["b"] and sum(weights.values()) == pytest.approx(1)
    assert ranker.model_info(linear, spark).first().n_trees is None
    info = ranker.model_info(fitted, spark, history).first()
    assert (info.status, info.n_features) == ("trained", 2)
    assert ranker.model_info(None, spark).first().status == "not_trained"


def test_last_stage_equals_prediction(planted, fitted):
    last = fitted.trees.getNumTrees
    staged = ranker.staged_scores(fitted, planted, [last])
    columns = ("line_key", "item_id", F.round("score", 6))
    assert rows(staged, *columns) == rows(ranker.predict(fitted, planted), *columns)


def test_saved_model_scores_the_same(spark, planted, fitted, tmp_path):
    path = ranker.save_ranker(
        fitted, {"importance": ranker.feature_importance(fitted, spark)}, str(tmp_path / "m")
    )
    loaded, tables = ranker.load_ranker(spark, path, ("importance",))
    assert (loaded.features, loaded.params) == (fitted.features, fitted.params)
    again = ranker.predict(loaded, planted)
    assert rows(again, "line_key", "item_id", "score") == rows(
        ranker.predict(fitted, planted), "line_key", "item_id", "score"
    )
    assert tables["importance"].count() == 2


def test_cross_validation(planted):
    _, scores = ranker.fit_cv(planted, ["a", "b"], 3, QUICK)
    summary = ranker.cv_summary(scores).first()
    assert scores.count() == 3 and 0.5 < summary.mean_score <= 1
    assert summary.best_fold in (0, 1, 2)
    folds = ranker.group_kfold(planted, 3)
    sizes = [r[1] for r in folds.groupBy("fold").agg(F.sum("group_size")).collect()]
    assert max(sizes) - min(sizes) <= 10


def test_missing_feature_is_an_error(planted, fitted):
    with pytest.raises(ValueError, match="features missing: b"):
        ranker.predict(fitted, planted.drop("b"))


def test_frames_equal_the_single_operators(spark, sf):
    inter, users, items = (f(spark, sf) for f in (retail.interactions, retail.users, retail.items))
    vectors, carts = retail.item_vectors(spark, sf), retail.cart_rows(inter)
    split = {"split_date": retail.SPLIT_DATE, "test_days": retail.TEST_DAYS}
    frames = flow.featured_frames(inter, users, items, vectors, carts, 5, **split)
    train, val, _ = split_frames(inter, **split)
    single = features.engineer_features(
        sampling.sample_uniform(val, items, 5),
        users,
        items,
        stats.user_stats(train, users),
        stats.item_stats(train, items),
        carts,
    )
    single = embeddings.add_embedding_features(
        single, vectors, embeddings.user_vectors(train, vectors)
    )
    single = embeddings.add_cart_similarity(single, carts, vectors)
    assert len(frames.features) == 47
    assert set(frames.features) == set(features.feature_names(single))
    names = ["line_key", "item_id", "added_to_cart", *sorted(frames.features)]
    assert rows(frames.val.fillna(-1.0), *names) == rows(single.fillna(-1.0), *names)


def test_fitted_item_vectors(spark, sf):
    inter = retail.interactions(spark, sf)
    vectors, users = embeddings.embedding_tables(inter, dim=8, epochs=1)
    assert vectors.count() == 200
    assert {len(r.vec) for r in users.limit(5).collect()} == {8}


def test_report_lines(spark):
    report = spark.createDataFrame(
        [("ranking", "auc", 0.7), ("business", "attach_rate", 0.125), ("business", "avg", 2.0)],
        "section STRING, metric STRING, value DOUBLE",
    )
    assert rows(sinks.report_lines(report), "line") == [
        ("attach_rate: 12.50%",), ("auc: 0.7000",), ("avg: 2.00",)
    ]


def test_swap_weight_is_the_change_of_ndcg(spark):
    """Two positives at ranks 1 and 3, a negative between them."""
    scored = spark.createDataFrame(
        [("o", 1, 10, 1, 3.0), ("o", 1, 20, 0, 2.0), ("o", 2, 30, 1, 1.0)],
        f"order_id string, line_key long, item_id long, {ranker.LABEL} int, score double",
    )
    ideal = 1 + 1 / math.log2(3)
    assert ranker.swap_weights(scored).first()["_weight"] == pytest.approx((1 - 1 / math.log2(3)) / ideal)


def test_pairwise_scores_rows_with_nulls(spark):
    frame = spark.createDataFrame(
        [(f"o{i}", i, 10 + j, int(j == 0), float(j == 0) + 0.1 * j, 1.0) for i in range(40) for j in range(3)],
        f"order_id string, line_key long, item_id long, {ranker.LABEL} int, a double, b double",
    )
    fitted = ranker.fit_pairwise(frame, ["a", "b"])
    scored = ranker.predict(fitted, frame.withColumn("b", F.lit(None).cast("double")))
    assert scored.where("score is null").count() == 0
    assert not [c for c in scored.columns if c.startswith("_filled_")]


def test_registered_fits_use_the_defaults(monkeypatch):
    from types import SimpleNamespace

    from cartwise.plans import catalog, flow

    class Called(Exception):
        pass

    def called(*args, **kwargs):
        raise Called(args, kwargs)

    frames = SimpleNamespace(train="train", val="val", test="test", features=["a"])
    monkeypatch.setattr(catalog, "_frames", lambda spark, d: frames)
    monkeypatch.setattr(catalog, "_splits", lambda spark, d: ("train", "val", "test"))
    monkeypatch.setattr(catalog, "_once", lambda spark, d, name, build: build())
    for owner, name in (
        (ranker, "fit_pairwise"), (ranker, "fit_cv"), (flow, "train_production"),
        (embeddings, "fit_item_vectors"), (embeddings, "embedding_tables"),
    ):
        monkeypatch.setattr(owner, name, called)
    for query in ("ranker_fit", "ranker_predict", "ranker_cv", "item2vec_fit", "embedding_tables"):
        with pytest.raises(Called) as found:
            catalog.QUERIES[query](None, "none")
        args, kwargs = found.value.args
        assert not kwargs and not any(isinstance(a, ranker.RankerParams) for a in args)


def test_learning_rows_are_drawn_before_the_fan_out(spark, sf):
    """The sample of a fit holds lines with all their candidates, and no featured frame is written."""
    inter, items = retail.interactions(spark, sf), retail.items(spark, sf)
    split = {"split_date": retail.SPLIT_DATE, "test_days": retail.TEST_DAYS}
    frames = flow.featured_frames(
        inter, retail.users(spark, sf), items, retail.item_vectors(spark, sf), n_negatives=5, **split
    )
    assert frames.lines["train"].agg(F.sum("n_candidates")).first()[0] == frames.train.count()
    drawn = frames.learning("train", 2000, 42)
    assert 1000 < drawn.count() < 3000
    assert set(drawn.columns) == set(frames.train.columns)
    whole = frames.train.join(drawn.select("line_key").distinct(), "line_key", "left_semi")
    columns = ("line_key", "item_id", *frames.features)
    assert rows(drawn, *columns) == rows(whole, *columns)
    assert "/featured-" not in "".join(frames.train.inputFiles())


def test_cross_validation_from_lines(spark, planted):
    """Folds of lines, whose candidates are made when they are read, score as folds of candidates."""
    params = boosting.BoostingParams(trees=3, max_depth=3, min_rows_per_leaf=5)
    made = []

    def featured(lines):
        made.append(lines.columns)
        return planted.join(lines.select("line_key"), "line_key", "left_semi")

    lines = planted.where("added_to_cart = 1").select(
        "order_id", "line_key", F.lit(5).cast("long").alias("n_candidates")
    )
    _, plain = ranker.fit_cv(planted, ["a", "b"], 3, params)
    _, scores = ranker.fit_cv(lines, ["a", "b"], 3, params, featured=featured)
    assert rows(scores) == rows(plain)
    assert len(made) == 9 and all("a" not in columns for columns in made)
