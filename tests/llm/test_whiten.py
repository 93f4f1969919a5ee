"""Whitening against dense numpy on small tables; eigenpairs of hard spectra; odd vectors."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwise.llm import whiten


def spectra():
    draw = np.random.default_rng(0)
    q, _ = np.linalg.qr(draw.standard_normal((40, 40)))
    yield draw.standard_normal((1, 1)) ** 2
    a = draw.standard_normal((30, 50))
    yield a @ a.T
    for values in (
        np.repeat(np.arange(1.0, 9), 5),
        np.r_[np.linspace(5, 5 + 1e-11, 10), np.zeros(30)],
        np.r_[1e12, 1e6, 1, 1e-3, np.zeros(36)],
        np.full(40, 3.0),
        10.0 ** np.arange(-10, 10, 0.5),
    ):
        v = (q * values) @ q.T
        yield (v + v.T) / 2
    yield np.diag(np.arange(1.0, 20))


@pytest.mark.parametrize("v", list(spectra()))
def test_leading_eigenpairs(v):
    found = whiten.leading(v, 32)
    truth = np.linalg.eigvalsh(v)[::-1]
    size = abs(truth).max()
    k = len(found.values)
    error = 64 * len(v) * np.finfo(float).eps * size
    assert found.certified
    assert min(32, (truth > 4 * error).sum()) <= k <= min(32, (truth > error / 4).sum())
    assert np.abs(found.values - truth[:k]).max() < 1e-11 * size
    assert np.abs(v @ found.vectors - found.vectors * found.values).max() < 1e-11 * size
    assert np.abs(found.vectors.T @ found.vectors - np.eye(k)).max() < 1e-12


def test_counts_are_those_of_the_eigenvalues():
    a = np.random.default_rng(1).standard_normal((25, 25))
    v = a + a.T
    values = np.linalg.eigvalsh(v)
    shifts = np.linspace(values[0] - 1, values[-1] + 1, 200)
    below = whiten.counts_below(*whiten.tridiagonal(v), shifts)
    assert below.tolist() == [(values < s).sum() for s in shifts]


def test_no_component_without_variance():
    assert len(whiten.leading(np.zeros((3, 3)), 5).values) == 0


def vectors():
    draw = np.random.default_rng(2)
    mix = draw.standard_normal((6, 6))
    rows = [(i, (draw.standard_normal(6) @ mix).astype(np.float32).tolist()) for i in range(300)]
    odd = [
        (900, None),
        (901, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
        (902, [math.nan] + [0.0] * 5),
        (903, [math.inf] + [0.0] * 5),
        (904, []),
        (905, [1.0, 2.0]),
    ]
    return rows + [(None, rows[0][1]), (7, rows[7][1]), (7, rows[7][1])], odd


def test_rows_equal_dense_whitening(spark):
    good, odd = vectors()
    table = spark.createDataFrame(good + odd, "vec_id long, embedding array<float>")
    for name in ("id", "v", "x", "d", "i", "j", "s", "component", "n", "label"):
        table = table.withColumn(name, F.lit("other"))
    out = whiten.whiten(table).collect()
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in good], np.int64)
    n, sums = len(x), x.sum(0)
    z = x - sums / n
    v = z.T @ z / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    assert len(out) == n * 6
    deviation = ((n * x - sums) ** 2).sum(1)
    expected = {}
    for (vec_id, _), row, d in zip(good, z, deviation.tolist()):
        for k in range(6):
            expected.setdefault((str(vec_id), k + 1), []).append((d, abs(row @ axes[:, k]) / math.sqrt(values[k])))
    signs: dict[int, set[int]] = {}
    place = {i: row for (i, _), row in zip(good, z)}
    for r in out:
        want = expected[str(r.vec_id), r.component]
        assert any(r.deviation == d and abs(abs(r.whitened) - w) < 1e-8 for d, w in want)
        assert r.n == n and r.certified and r.identity_error < 1e-10
        assert abs(r.explained - values[r.component - 1] / np.trace(v)) < 1e-12
        if abs(r.whitened) > 1e-6:
            along = place[r.vec_id] @ axes[:, r.component - 1]
            signs.setdefault(r.component, set()).add(int(np.sign(along) * np.sign(r.whitened)))
    assert all(len(s) == 1 for s in signs.values())


def test_tables_without_a_component(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], vectors()[1][:5], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 4):
        out = whiten.whiten(spark.createDataFrame(rows, schema))
        assert out.count() == 0 and out.columns[:3] == ["vec_id", "component", "n"]


def test_huge_entries_saturate_and_deviations_stay_exact(spark):
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])]
    out = whiten.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {r.deviation for r in out if r.vec_id != 3} == {None}
    x = np.array([[2**46 + 10**6, 10**6], [-(2**46) + 10**6, 64 + 10**6], [10**6, 128 + 10**6]])
    assert {r.deviation for r in out if r.vec_id == 3} == {int(((3 * x[2] - x.sum(0)) ** 2).sum())}
