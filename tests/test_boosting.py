"""Listwise boosting: gradients by hand, groups over batches, history, early stop, odd frames."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartwise.operators import boosting, metrics, ranker
from cartwise.session import new_path

SMALL = boosting.BoostingParams(trees=12, max_depth=3, min_rows_per_leaf=5, learning_rate=0.3, patience=4)


def brute_gradients(y, s, truncation):
    """All pairs one by one, and the ideal of the truncated group."""
    order = sorted(range(len(y)), key=lambda i: (-s[i], i))
    gain = {i: 1 / math.log2(r + 2) if r < truncation else 0.0 for r, i in enumerate(order)}
    ideal = sum(1 / math.log2(r + 2) for r in range(min(truncation, int(sum(y)))))
    g, h = [0.0] * len(y), [0.0] * len(y)
    for i in range(len(y)):
        for j in range(len(y)):
            if y[i] > y[j]:
                wrong = 1 / (1 + math.exp(s[i] - s[j]))
                weight = abs(gain[i] - gain[j]) / ideal
                g[i] += wrong * weight
                g[j] -= wrong * weight
                h[i] += wrong * (1 - wrong) * weight
                h[j] += wrong * (1 - wrong) * weight
    return g, h


def test_gradients_of_a_group_by_hand():
    """A relevant row below an irrelevant one: swapping them changes NDCG by 1 - 1 / log2(3)."""
    g, h, at_5, at_10 = boosting.lambda_function(30)(np.array([0.0, 1.0]), np.array([1.0, 0.0]))
    change, wrong = 1 - 1 / math.log2(3), 1 / (1 + math.exp(-1))
    assert g.tolist() == pytest.approx([-wrong * change, wrong * change])
    assert h.tolist() == pytest.approx([wrong * (1 - wrong) * change] * 2)
    assert (at_5, at_10) == pytest.approx((1 / math.log2(3),) * 2)


@pytest.mark.parametrize("truncation", [1, 3, 30])
def test_gradients_equal_all_pairs(truncation):
    draw = random.Random(2)
    for _ in range(60):
        n = draw.randint(1, 25)
        y = [float(draw.random() < 0.4) for _ in range(n)]
        s = [round(draw.gauss(0, 1), 1) for _ in range(n)]
        g, h, *_ = boosting.lambda_function(truncation)(np.array(y), np.array(s))
        if sum(y) in (0, n):
            assert not g.any() and not h.any()
            continue
        expected = brute_gradients(y, s, truncation)
        assert g.tolist() == pytest.approx(expected[0]) and h.tolist() == pytest.approx(expected[1])
        assert abs(g.sum()) < 1e-9


def test_groups_spread_over_batches(spark):
    """Any cut into batches gives the same rows."""
    draw = random.Random(3)
    g = np.repeat(np.arange(30), [draw.randint(1, 9) for _ in range(30)]).astype(np.int64)
    y = np.array([float(draw.random() < 0.4) for _ in g])
    s = np.array([draw.gauss(0, 1) for _ in g])
    run = boosting._gradient_udf(5).func

    def answered(cuts):
        parts = zip(*[np.split(c, cuts) for c in (g, y, s)])
        out = run(iter([tuple(pa.array(c) for c in part) for part in parts]))
        return [row for batch in out for row in batch.to_pylist()]

    whole = answered([])
    assert len(whole) == len(g)
    for _ in range(30):
        cuts = sorted(draw.sample(range(len(g)), draw.randint(1, 12)))
        assert str(answered(cuts)) == str(whole)


@pytest.fixture(scope="module")
def planted(spark):
    """Groups of ten. ``c``, the same for a whole group, says how many rows are wanted, ``a``
    roughly which: a learner of single rows spends its splits on c, which orders nothing."""
    draw = random.Random(4)
    out = []
    for order in range(300):
        c = draw.gauss(0, 1)
        pull = [draw.gauss(0, 1) for _ in range(10)]
        wanted = sorted(range(10), key=lambda i: -pull[i])[: 7 if c > 0 else 1]
        for i in range(10):
            out.append((order, f"{order}-{i // 5}", i, int(i in wanted), pull[i] + draw.gauss(0, 0.7), c))
    schema = "order_id long, line_key string, item_id long, added_to_cart int, a double, b double"
    return spark.createDataFrame(out, schema).cache()


@pytest.fixture(scope="module")
def fitted(planted):
    return ranker.fit_listwise(planted.where("order_id >= 100"), ["a", "b"], planted.where("order_id < 100"), SMALL)


def mean_ndcg(fitted, frame):
    per_group = metrics.group_metrics(ranker.predict(fitted, frame), (10,))
    return per_group.agg(F.avg("ndcg_full_10")).first()[0]


def test_ndcg_above_the_pointwise_trees(planted):
    train, val = planted.where("order_id >= 100"), planted.where("order_id < 100")
    few = {"trees": 3, "max_depth": 1, "min_rows_per_leaf": 5, "feature_fraction": "all", "learning_rate": 0.3}
    plain = ranker.fit_ranker(train, ["a", "b"], None, ranker.RankerParams(**few))
    listwise = ranker.fit_listwise(train, ["a", "b"], None, boosting.BoostingParams(**few))
    assert mean_ndcg(listwise, val) > mean_ndcg(plain, val) + 0.03


def test_history_holds_every_round(planted, fitted):
    rounds = len(fitted.history) // 2
    assert {(d, i) for d, i, _, _ in fitted.history} == {(d, i) for d in ("train", "valid") for i in range(1, rounds + 1)}
    valid = {i: b for d, i, _, b in fitted.history if d == "valid"}
    best = fitted.params["best_iteration"]
    assert valid[best] == max(valid.values()) and fitted.trees.getNumTrees == best
    assert rounds == SMALL.trees or rounds == best + SMALL.patience
    staged = ranker.training_history(fitted, planted.where("order_id < 100")).collect()
    assert {r.iteration for r in staged} == set(range(1, best + 1))
    for r in staged:
        assert r.ndcg_10 == pytest.approx(valid[r.iteration], abs=1e-9)


def test_last_stage_equals_prediction_and_reload(spark, planted, fitted, tmp_path):
    last = fitted.trees.getNumTrees
    columns = ("line_key", "item_id", F.round("score", 9))
    predicted = rows(ranker.predict(fitted, planted), *columns)
    assert rows(ranker.staged_scores(fitted, planted, [last]), *columns) == predicted
    assert ranker.staged_scores(fitted, planted, [1, last]).count() == planted.count() * len({1, last})
    path = ranker.save_ranker(fitted, {}, str(tmp_path / "m"))
    loaded, _ = ranker.load_ranker(spark, path)
    assert rows(ranker.predict(loaded, planted), *columns) == predicted
    importance = {r.feature: r.importance for r in ranker.feature_importance(fitted, spark).collect()}
    assert sum(importance.values()) == pytest.approx(1)


def test_the_sample_is_bounded_and_takes_whole_groups(planted):
    drawn = boosting.learning_rows(planted, "order_id", 1500, 1)
    sizes = {r[0] for r in drawn.groupBy("order_id").count().select("count").collect()}
    assert sizes == {10} and 1000 < drawn.count() < 2000
    one = planted.withColumn("order_id", F.lit(1)).withColumn("line_key", F.concat_ws("-", "line_key", "item_id"))
    assert 1000 < boosting.learning_rows(one, "order_id", 1500, 1).count() < 2000


def test_frames_without_pairs_nulls_and_no_validation(planted):
    alike = planted.where("order_id < 20").withColumn("added_to_cart", F.lit(0))
    params = boosting.BoostingParams(trees=2, max_depth=2)
    flat = ranker.fit_listwise(alike, ["a", "b"], None, params)
    assert {r.score for r in ranker.predict(flat, planted).select("score").collect()} == {0.0}
    nulls = planted.withColumn("b", F.when(F.col("item_id") > 2, F.col("b"))).withColumn(
        "order_id", F.when(F.col("order_id") > 10, F.col("order_id"))
    )
    some = ranker.fit_listwise(nulls, ["a", "b"], None, params)
    assert some.trees.getNumTrees == 2 and [h[0] for h in some.history] == ["train"] * 2
    assert ranker.predict(some, nulls).where("score IS NULL").count() == 0


@pytest.mark.parametrize("rounds", [1, 3])
def test_scores_are_written_once_in_many_rounds(planted, fitted, monkeypatch, rounds):
    """Tables hold the scores of some rounds, and where they are cut changes no tree."""
    names = []
    monkeypatch.setattr(boosting, "new_path", lambda spark, name: names.append(name) or new_path(spark, name))
    monkeypatch.setattr(boosting, "ROUNDS_PER_TABLE", rounds)
    train, val = planted.where("order_id >= 100"), planted.where("order_id < 100")
    again = ranker.fit_listwise(train, ["a", "b"], val, SMALL)
    assert [h[:2] for h in again.history] == [h[:2] for h in fitted.history]
    assert [h[2:] for h in again.history] == [pytest.approx(h[2:], abs=1e-9) for h in fitted.history]
    assert again.params["best_iteration"] == fitted.params["best_iteration"]
    assert len(names) <= 1 + len(again.history) // 2 // rounds
