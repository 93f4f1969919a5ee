"""Whitening of vectors with eigenpairs found by slicing the spectrum.

Spark sums the entries of all vectors (exact long sums), then the products of the centred
vectors, block by block in the tasks; only the d x d covariance V reaches the driver, d being
the length of a vector. There Householder reflections bring V to tridiagonal form, which
keeps its eigenvalues, so that factoring a shift as L D L^T takes d divisions and many shifts
are factored at once. The number of negative pivots of V - s*I is the number of eigenvalues
below s. Slicing by these counts puts each leading eigenvalue into an interval of its own;
Rayleigh quotient iteration from there converges cubically, and a quotient that leaves its
interval is started again from a narrower one. In the end the counts just above and just
below each eigenvalue have to frame its number (``certified``). Eigenvalues that no shift can
tell apart in double precision are a cluster: their vectors are taken together, as an
orthonormal basis. Vectors of near eigenvalues are made orthogonal to those before them.

Rows: a vector that is null, empty or holds null, NaN or infinite entries has no result and
takes no part in any sum; so do vectors whose length is not the most common one among the
rest (ties: the longer one). Null and repeated ids are rows like any other, repeated vectors
count as often as they stand. Only components with an eigenvalue well above the rounding error
of V (64 d epsilon of its size) are returned, so equal vectors, a single vector and an empty table give no rows; fewer than
``components`` come out if V has lower rank. Entries beyond +-2^46 saturate there before they
become whole numbers. ``deviation`` is exact and null where it does not fit a long. Texts play
no part; a very long vector needs d^2 doubles a task and on the driver. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPONENTS = 32
SCALE = 64
OFFSET = 1_000_000
#: Rows of one block of products, so that a block of long vectors stays small.
BLOCK_VALUES = 1 << 20
_LIMIT = float(1 << 46)
_EPS = float(np.finfo(float).eps)


class Eigen(NamedTuple):
    """Leading eigenpairs by falling value; vectors are columns."""

    values: np.ndarray
    vectors: np.ndarray
    certified: bool


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the eigenvalues of ``v``."""
    a = np.array(v, float)
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        x[0] += norm if x[0] >= 0 else -norm
        x /= np.linalg.norm(x)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ x
        p -= (x @ p) * x
        rest -= 2 * (np.outer(x, p) + np.outer(p, x))
        a[k + 1 :, k] -= 2 * x * (x @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
    return np.diag(a).copy(), np.diag(a, -1).copy()


def counts_below(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Eigenvalues below each shift: negative pivots of L D L^T of the shifted matrix."""
    shifts = np.asarray(shifts, float)
    tiny = np.finfo(float).tiny / _EPS
    pivot = diagonal[0] - shifts
    below = (pivot < 0).astype(np.int64)
    for i in range(1, len(diagonal)):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = (diagonal[i] - shifts) - off[i - 1] ** 2 / pivot
        below += pivot < 0
    return below


def leading(v: np.ndarray, components: int) -> Eigen:
    """The ``components`` largest eigenpairs of the symmetric matrix ``v`` above rounding error."""
    d = len(v)
    diagonal, off = tridiagonal(v)
    radius = np.zeros(d)
    radius[:-1] += np.abs(off)
    radius[1:] += np.abs(off)
    bottom, top = float((diagonal - radius).min()), float((diagonal + radius).max())
    size = max(abs(bottom), abs(top))
    error = 4 * d * _EPS * size
    bottom, top = bottom - error, top + error
    # Nearer to the rounding error an eigenvalue has no correct digits left.
    wanted = min(components, d - int(counts_below(diagonal, off, np.array([16 * error]))[0])) if size > 0 else 0
    # Slices hold eigenvalues number first+1 to last, counted from the largest.
    slices, ready = [(bottom, top, 0, d)] if wanted else [], []
    while slices:
        middles = np.array([(low + high) / 2 for low, high, _, _ in slices])
        above = d - counts_below(diagonal, off, middles)
        next_slices = []
        for (low, high, first, last), middle, n in zip(slices, middles, above.tolist()):
            for part in ((middle, high, first, n), (low, middle, n, last)):
                if part[2] >= min(part[3], wanted):
                    continue
                small = part[1] - part[0] <= error
                alone = part[3] - part[2] == 1 and part[1] - part[0] <= 1e-2 * max(abs(part[1]), error)
                (ready if small or alone else next_slices).append(part)
        slices = next_slices
    vectors = np.zeros((d, 0))
    values: list[float] = []
    start = np.random.default_rng(13)
    for low, high, first, last in sorted(ready, key=lambda part: part[2]):
        if last - first == 1:
            value, vector = _isolated(v, diagonal, off, low, high, first, error, vectors, start)
            found = vector[:, None]
            values.append(value)
        else:
            found = _cluster(v, (low + high) / 2, last - first, error, vectors, start)
            values += np.einsum("ij,ij->j", found, v @ found).tolist()
        vectors = np.c_[vectors, found]
    vectors, out = vectors[:, :wanted], np.array(values[:wanted])
    if not wanted:
        return Eigen(out, vectors, True)
    margin = error + 1e-12 * np.abs(out)
    over = d - counts_below(diagonal, off, out + margin)
    least = d - counts_below(diagonal, off, out - margin)
    number = np.arange(1, wanted + 1)
    return Eigen(out, vectors, bool(np.all((over < number) & (number <= least))))


def _solved(v: np.ndarray, shift: float, right: np.ndarray, error: float) -> np.ndarray:
    """Solution of the shifted system; an exactly singular one is moved by a rounding error."""
    for move in (0.0, error / 16, error):
        try:
            out = np.linalg.solve(v - (shift + move) * np.eye(len(v)), right)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(out).all():
            return out
    return right


def _orthogonal(x: np.ndarray, before: np.ndarray) -> np.ndarray:
    """``x`` without its parts along the columns of ``before``, taken off twice."""
    for _ in range(2):
        x = x - before @ (before.T @ x)
    return x


def _isolated(v, diagonal, off, low, high, first, error, before, start) -> tuple[float, np.ndarray]:
    """Eigenpair of the only eigenvalue in (low, high) by Rayleigh quotient iteration."""
    d = len(v)
    while True:
        x = start.standard_normal(d)
        value = (low + high) / 2
        last = np.inf
        for step in range(14):
            # Two steps from the middle of the slice give the quotient a start near its own.
            x = _solved(v, value if step > 1 else (low + high) / 2, x, error)
            x = _orthogonal(x / np.linalg.norm(x), before)
            x /= np.linalg.norm(x)
            moved = v @ x
            value = float(x @ moved)
            left = np.linalg.norm(moved - value * x)
            # Below the rounding error of V the residual falls on until it stands still.
            outside = step > 1 and not low - error <= value <= high + error
            if left == 0 or (left <= error and left > last / 2) or outside:
                break
            last = left
        if low - error <= value <= high + error or high - low <= error:
            return value, x
        # The quotient went to a neighbour: a narrower slice starts nearer to its own.
        for _ in range(8):
            middle = (low + high) / 2
            if d - int(counts_below(diagonal, off, np.array([middle]))[0]) > first:
                low = middle
            else:
                high = middle


def _cluster(v, value, size, error, before, start) -> np.ndarray:
    """Orthonormal vectors of ``size`` eigenvalues that no shift tells apart."""
    x = start.standard_normal((len(v), size))
    for _ in range(4):
        x = _solved(v, value, x, error)
        x, _ = np.linalg.qr(_orthogonal(x / np.linalg.norm(x, axis=0), before))
    return x


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)


def _blocks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    rows = max(1, BLOCK_VALUES // max(1, length))
    for batch in batches:
        for first in range(0, len(batch), rows):
            part = batch.slice(first, rows)
            yield part, _matrix(part["x"], length)


def _sum_of_products(table: DataFrame, length: int, width: int, rows_of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all vectors of z z^T, z = ``rows_of`` the block; one matrix a task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros((width, width)), False
        for _, x in _blocks(batches, length):
            z = rows_of(x)
            total += z.T @ z
            any_rows = True
        if any_rows:
            i, j = np.triu_indices(width)
            yield pa.RecordBatch.from_pydict({"i": pa.array(i.astype(np.int32)), "j": pa.array(j.astype(np.int32)), "v": pa.array(total[i, j])})

    sums = table.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((width, width))
    i, j, values = (sums[c].to_numpy() for c in ("i", "j", "v"))
    out[i, j] = values
    out[j, i] = values
    return out


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over dimensions of (n*x - S)^2, exact; null beyond a long."""
    s = np.array(sums, float)
    rough = ((n * x.astype(float) - s) ** 2).sum(1)
    if (np.abs(x).max(initial=0) * float(n) < 2**62) and np.abs(s).max(initial=0) < 2**62:
        fits = rough < 2.0**63 * (1 - 1e-9)
        exact = ((n * x - np.array(sums, np.int64)) ** 2).sum(1)
        if fits.all():
            return pa.array(exact)
        return pa.array(np.where(fits, exact, 0), mask=~fits)
    out = [sum((n * c - t) ** 2 for c, t in zip(row, sums)) for row in x.tolist()]
    return pa.array([v if v < 2**63 else None for v in out], pa.int64())


def whiten(
    table: DataFrame,
    components: int = COMPONENTS,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    offset: int = OFFSET,
) -> DataFrame:
    """One row per usable vector and component: its whitened coordinate.

    Entries c become x = floor(scale * c) + offset. Columns: the id, component (from 1 by
    falling eigenvalue e), n (usable vectors), deviation (sum of (n*x - S)^2, S the sums),
    whitened ((x - S/n) on the unit eigenvector, over sqrt(e)), explained (e over the trace
    of V), identity_error (largest absolute entry of the whitened covariance minus the
    identity, measured on all rows), eigenvalue, and certified (the counts confirm the
    numbering of all components).
    """
    id_type = table.schema[vec_id].dataType.simpleString()
    value = lambda c: F.floor(F.greatest(F.lit(-_LIMIT), F.least(F.lit(_LIMIT), c.cast("double") * scale))) + F.lit(offset)
    usable = table.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{vector}`").alias("v")).where(_usable(F.col("v")))
    vectors = usable.select("id", F.transform("v", value).cast("array<bigint>").alias("x"))
    answer = (
        f"`{vec_id}` {id_type}, component int, n bigint, deviation bigint, whitened double, "
        "explained double, identity_error double, eigenvalue double, certified boolean"
    )
    lengths = usable.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).take(1)
    if not lengths:
        return table.sparkSession.createDataFrame([], answer)
    d, n = int(lengths[0]["d"]), int(lengths[0]["count"])
    vectors = vectors.where(F.size("x") == d)
    sums = _exact_sums(vectors, d)
    mean = np.array([s // n + (s % n) / n for s in sums])

    v = _sum_of_products(vectors, d, d, lambda x: x - mean) / n
    eigen = leading(v, components)
    k = len(eigen.values)
    if not k:
        return table.sparkSession.createDataFrame([], answer)
    axes = eigen.vectors / np.sqrt(eigen.values)
    trace = float(np.trace(v))
    explained = eigen.values / trace
    whitened_covariance = _sum_of_products(vectors, d, k, lambda x: (x - mean) @ axes) / n
    worst = float(np.abs(whitened_covariance - np.eye(k)).max())
    certified, eigenvalues = eigen.certified, eigen.values

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = max(1, BLOCK_VALUES // max(d, 8 * k))
        for batch in batches:
            for first in range(0, len(batch), rows):
                part = batch.slice(first, rows)
                x = _matrix(part["x"], d)
                m = len(part)
                at = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        part["id"].take(at),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n, np.int64)),
                        _deviations(x, n, sums).take(at),
                        pa.array(((x - mean) @ axes).reshape(-1)),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, worst)),
                        pa.array(np.tile(eigenvalues, m)),
                        pa.array(np.full(m * k, certified)),
                    ],
                    [vec_id, "component", "n", "deviation", "whitened", "explained", "identity_error", "eigenvalue", "certified"],
                )

    return vectors.mapInArrow(answers, answer)


def _exact_sums(vectors: DataFrame, length: int) -> list[int]:
    """Sum of each entry over all vectors, exact: tasks add longs, Spark adds decimals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = [0] * length, False
        for _, x in _blocks(batches, length):
            total = [a + b for a, b in zip(total, _column_sums(x))]
            any_rows = True
        if any_rows:
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(length), pa.int32()), "s": pa.array([str(t) for t in total])})

    rows = vectors.mapInArrow(run, "i int, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    out = [0] * length
    for row in rows:
        out[row["i"]] = int(row["s"])
    return out


def _column_sums(x: np.ndarray) -> list[int]:
    # A block has at most 2^20 rows of values below 2^47, so halves of 24 bits cannot overflow.
    high, low = x >> 24, x & ((1 << 24) - 1)
    return [(int(a) << 24) + int(b) for a, b in zip(high.sum(0), low.sum(0))]
