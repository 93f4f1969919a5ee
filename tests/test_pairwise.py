"""The linear ranker: all pairs of a group, exact weights, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwise.operators import metrics, pairwise, ranker

SCHEMA = "order_id long, line_key string, item_id long, added_to_cart int, a double, b double, c double"


def explicit(out, rounds, penalty):
    """Every pair as a row, gradient steps by Newton, weights from sorted scores."""
    groups = {}
    for r in out:
        groups.setdefault(r[0], []).append(r)
    beta = None
    for _ in range(rounds):
        z, w = [], []
        for rows in groups.values():
            rows = sorted(rows, key=lambda r: (r[2], r[1]))
            x, y = np.array([r[4:] for r in rows]), np.array([r[3] for r in rows])
            gain = None
            if beta is not None:
                order = np.argsort(-(x - x[0]) @ beta, kind="stable")
                gain = np.zeros(len(rows))
                gain[order] = 1 / np.log2(np.arange(len(rows)) + 2.0)
                gain /= (1 / np.log2(np.arange(y.sum()) + 2.0)).sum() if y.sum() else 1
            for i in np.flatnonzero(y == 1):
                for j in np.flatnonzero(y == 0):
                    z.append(x[i] - x[j])
                    w.append(1.0 if gain is None else abs(gain[i] - gain[j]))
        z, w = np.array(z), np.array(w)
        spread = np.sqrt((w[:, None] * z**2).sum(0) / w.sum())
        live = spread > 0
        u, b = z[:, live] / spread[live], np.zeros(live.sum())
        for _ in range(60):
            p = 1 / (1 + np.exp(u @ b))
            slope = -(w * p) @ u / w.sum() + penalty * b
            bend = (u * (w * p * (1 - p))[:, None]).T @ u / w.sum() + penalty * np.eye(live.sum())
            b = b - np.linalg.solve(bend, slope)
        beta = np.zeros(z.shape[1])
        beta[live] = b / spread[live]
    return beta


def made(groups, seed):
    draw = np.random.default_rng(seed)
    out = []
    for o in range(groups):
        c = float(draw.normal())
        for line in range(int(draw.integers(1, 4))):
            for i in range(int(draw.integers(1, 6))):
                a, wanted = float(draw.normal()), int(i == 0)
                out.append((o, f"{o}-{line}", int(draw.integers(0, 50)), wanted, a + wanted, float(draw.integers(0, 3)), c))
    return out


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_weights_equal_those_of_explicit_pairs(spark, rounds):
    out = made(80, 1)
    fitted = ranker.fit_pairwise(spark.createDataFrame(out, SCHEMA), ["a", "b", "c"], rounds)
    found = fitted.trees.coefficients.toArray()
    assert found == pytest.approx(explicit(out, rounds, 0.001), rel=1e-5, abs=1e-7)
    # The same for all rows of a group: no pair tells anything about it.
    assert found[2] == 0


def test_positives_meet_the_negatives_of_other_lines(spark):
    """One line holds only the positive, the other only negatives: pairs of one line are none."""
    out = [
        (o, f"{o}-{'p' if i == 0 else 'n'}", i, int(i == 0), (i == 0) * 0.5 + (o * 7 + i * 3) % 10 / 10, 0.0, 0.0)
        for o in range(60) for i in range(4)
    ]
    frame = spark.createDataFrame(out, SCHEMA)
    fitted = ranker.fit_pairwise(frame, ["a", "b"])
    assert fitted.trees.coefficients.toArray() == pytest.approx(explicit([r[:6] for r in out], 2, 0.001), rel=1e-5)
    assert metrics.auc_and_precision(ranker.predict(fitted, frame)).first().auc > 0.8


def test_chunks_and_blocks_of_any_size(spark, monkeypatch):
    out = made(50, 2) + [(999, f"l{i}", i, int(i % 3 == 0), float(i % 7), float(i % 2), 1.0) for i in range(90)]
    expected = explicit(out, 2, 0.001)
    monkeypatch.setattr(pairwise, "CHUNK_ROWS", 5)
    monkeypatch.setattr(pairwise, "PAIRS", 7)
    fitted = ranker.fit_pairwise(spark.createDataFrame(out, SCHEMA), ["a", "b", "c"])
    assert fitted.trees.coefficients.toArray() == pytest.approx(expected, rel=1e-5, abs=1e-7)


def test_rows_without_group_or_label(spark, tmp_path):
    """Rows without a group are those of their line, a null label takes no part, no pair means weight 0."""
    out = made(40, 3)
    lonely = [(None, r[1], *r[2:]) for r in out]
    frame = spark.createDataFrame(lonely, SCHEMA)
    by_line = [(r[1], *r[1:]) for r in out]
    fitted = ranker.fit_pairwise(frame, ["a", "b"], 1)
    assert fitted.trees.coefficients.toArray() == pytest.approx(explicit([r[:6] for r in by_line], 1, 0.001), rel=1e-5)
    flat = ranker.fit_pairwise(frame.withColumn("added_to_cart", F.lit(None).cast("int")), ["a", "b"])
    assert flat.trees.coefficients.toArray().tolist() == [0.0, 0.0]
    loaded, _ = ranker.load_ranker(spark, ranker.save_ranker(fitted, {}, str(tmp_path / "m")))
    columns = ("line_key", "item_id", "a", "score")
    assert sorted(ranker.predict(loaded, frame).select(*columns).collect()) == sorted(
        ranker.predict(fitted, frame).select(*columns).collect()
    )
