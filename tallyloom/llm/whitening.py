"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

The entries of a vector become whole numbers of a grid, ``floor(64 * c) + 1000000``, so that equal vectors are equal in
every bit and sums are exact. The model is fitted on each distinct vector once; copies are dropped before they are
shuffled, so a vector in a third of all rows is one row per task. Three passes over the staged distinct vectors give
the sums, the centred scatter and the covariance of the result; what reaches the driver is one number per pair of
dimensions. There the scatter A is factored as L L' with pivots, and the columns of L are rotated until they are
orthogonal: their squared lengths are the eigenvalues of A, and the columns scaled to length one its eigenvectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import common as C

SCALE, SHIFT = 64, 1_000_000
#: Grid values end here on both sides, so that they fit a long.
_EDGE = float(1 << 61)
_EPS = np.finfo(np.float64).eps
_SWEEPS = 60
#: Squares that add up to less than this are added as longs.
_SAFE = 9.0e18


@dataclass(frozen=True)
class Whitening:
    """A fitted model: ``n`` distinct vectors, their exact ``sums``, and the components (one per row) by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    trace: float
    eigenvalues: np.ndarray
    components: np.ndarray
    identity_error: float

    @property
    def dims(self) -> int:
        return len(self.sums)


# Vectors ------------------------------------------------------------------------------------------------------------


def grid_rows(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a list column: rows without null or non-finite entries, their lengths, and all their grid values with row starts."""
    length = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = pc.cast(vectors.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(length)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    kept = pc.is_valid(vectors).to_numpy(zero_copy_only=False) & (bad[starts[1:]] == bad[starts[:-1]]) & (length > 0)
    with np.errstate(invalid="ignore", over="ignore"):
        values = np.clip(np.floor(SCALE * np.nan_to_num(entries)), -_EDGE, _EDGE).astype(np.int64) + SHIFT
    return np.flatnonzero(kept), length, values, starts


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per vector: dimensions and grid values, as 32-bit numbers where all of them fit."""
    for batch in batches:
        rows, length, values, starts = grid_rows(batch.column(0))
        out = []
        for a, b in zip(starts[rows].tolist(), (starts[rows] + length[rows]).tolist(), strict=True):
            x = values[a:b]
            small = x.astype(np.int32)
            out.append((small if np.array_equal(small, x) else x).tobytes())
        yield pa.record_batch({"dims": pa.array(length[rows], pa.int64()), "x": pa.array(out, pa.binary())})


def _matrices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    for batch in batches:
        blobs = batch.column(batch.schema.names.index("x")).to_pylist()
        if blobs:
            yield np.stack([np.frombuffer(x, np.int32 if len(x) == 4 * dims else np.int64).astype(np.int64) for x in blobs])


class _Centred:
    """Subtracts the mean: its whole part from the whole numbers, the rest as doubles."""

    def __init__(self, n: int, sums: tuple[int, ...]):
        self.n = n
        self.floor = np.array([s // n for s in sums], np.int64)
        self.left = np.array([s % n for s in sums], object)
        self.rest = np.array([(s % n) / n for s in sums])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor).astype(np.float64) - self.rest

    def deviations(self, x: np.ndarray, centred: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - S)^2, exact; None where it does not fit a long."""
        rough = np.square(centred * self.n).sum(axis=1)
        safe = rough < _SAFE
        out = np.full(len(x), None, object)
        if safe.any():
            y = self.n * (x[safe] - self.floor) - self.left.astype(np.int64)
            out[safe] = (y * y).sum(axis=1)
        for i in np.flatnonzero(~safe).tolist():
            total = sum((self.n * (int(v) - int(f)) - r) ** 2 for v, f, r in zip(x[i], self.floor, self.left, strict=True))
            out[i] = total if total < 1 << 63 else None
        return out.tolist()


# Factorisation ------------------------------------------------------------------------------------------------------


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """``l`` with ``l @ l.T == a`` to rounding, one column per pivot, largest remaining pivot first."""
    n = len(a)
    order, rest = np.arange(n), a.diagonal().astype(np.float64).copy()
    low = np.zeros((n, n))
    least, k = n * _EPS * max(rest.max(initial=0.0), 0.0), 0
    while k < n:
        p = k + int(np.argmax(rest[k:]))
        if rest[p] <= least:
            break
        for array in (order, rest, low):
            array[[k, p]] = array[[p, k]]
        low[k, k] = np.sqrt(rest[k])
        low[k + 1 :, k] = (a[order[k + 1 :], order[k]] - low[k + 1 :, :k] @ low[k, :k]) / low[k, k]
        rest[k + 1 :] -= low[k + 1 :, k] ** 2
        k += 1
    result = np.empty((n, k))
    result[order] = low[:, :k]
    return result


def orthogonal_columns(factor: np.ndarray) -> np.ndarray:
    """Columns of the factor, rotated in pairs from the right until all are orthogonal.

    All pairs of a round are disjoint and rotated together; a sweep meets every pair once.
    """
    columns = factor.T.copy()
    r = len(columns)
    if r % 2:
        columns = np.vstack([columns, np.zeros((1, columns.shape[1]))])
    ring = np.arange(len(columns))
    half = len(ring) // 2
    for _ in range(_SWEEPS):
        turned = False
        for _ in range(max(1, len(ring) - 1)):
            p, q = ring[:half], ring[half:][::-1]
            x, y = columns[p], columns[q]
            alpha, beta, gamma = (np.einsum("ij,ij->i", u, v) for u, v in ((x, x), (y, y), (x, y)))
            turn = np.abs(gamma) > 4 * _EPS * np.sqrt(alpha * beta)
            if turn.any():
                turned = True
                zeta = (beta[turn] - alpha[turn]) / (2 * gamma[turn])
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                c = (1 / np.hypot(1.0, t))[:, None]
                s = c * t[:, None]
                columns[p[turn]], columns[q[turn]] = c * x[turn] - s * y[turn], s * x[turn] + c * y[turn]
            ring[1:] = np.roll(ring[1:], 1)
        if not turned:
            break
    lengths = np.einsum("ij,ij->i", columns, columns)
    return columns[np.argsort(-lengths, kind="stable")[:r]].T


def principal_axes(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above rounding, falling, and their unit eigenvectors as rows."""
    columns = orthogonal_columns(pivoted_cholesky(scatter))
    values = np.einsum("ij,ij->j", columns, columns)
    real = values > len(scatter) * _EPS * values.max(initial=0.0)
    return values[real], (columns[:, real] / np.sqrt(values[real])).T


# Spark --------------------------------------------------------------------------------------------------------------


def _entry_sums(df: DataFrame, run) -> dict[tuple[int, int], float]:
    """Entries (i, j) that the tasks give, added up."""
    entries = df.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    return {(r.i, r.j): r.v for r in entries.collect()}


def _upper(matrix: np.ndarray) -> pa.RecordBatch:
    i, j = np.triu_indices(len(matrix))
    return pa.record_batch({"i": i.astype(np.int32), "j": j.astype(np.int32), "v": matrix[i, j]})


def _symmetric(entries: dict[tuple[int, int], float], n: int) -> np.ndarray:
    matrix = np.zeros((n, n))
    for (i, j), v in entries.items():
        if i >= 0:
            matrix[i, j] = matrix[j, i] = v
    return matrix


def fit(vectors: DataFrame, column: str = "embedding", components: int = 16) -> Whitening | None:
    """Fit on the distinct grid vectors of a table; None if there are none.

    Vectors that are null or empty or hold a null or non-finite entry are left out. All vectors of a model have one
    number of dimensions, the one that most distinct vectors have (the largest of several); others are left out too.
    There are at most ``components`` components, fewer where the covariance has fewer eigenvalues above rounding.
    """
    C.limit_batches(vectors.sparkSession)
    distinct = C.staged(vectors.select(F.col(f"`{column}`")).mapInArrow(_encoded, "dims long, x binary").distinct())
    sizes = distinct.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    if not sizes:
        return None
    dims, n = sizes[0]
    listed = distinct.filter(F.col("dims") == dims)

    def add(batches):
        low, high = np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for x in _matrices(batches, dims):
            low += (x & 0xFFFFFFFF).sum(axis=0)
            high += (x >> 32).sum(axis=0)
        yield pa.record_batch({"i": np.arange(dims, dtype=np.int32), "low": low, "high": high})

    parts = [F.sum(F.col(name).cast("decimal(38,0)")).alias(name) for name in ("low", "high")]
    added = {r.i: int(r.low) + (int(r.high) << 32) for r in listed.mapInArrow(add, "i int, low long, high long").groupBy("i").agg(*parts).collect()}
    sums = tuple(added[i] for i in range(dims))
    centre = _Centred(n, sums)

    def scatter(batches):
        total = np.zeros((dims, dims))
        for x in _matrices(batches, dims):
            y = centre(x)
            total += y.T @ y
        yield _upper(total)

    whole = _symmetric(_entry_sums(listed, scatter), dims)
    values, axes = principal_axes(whole)
    values, axes = values[:components] / n, axes[:components]
    project, k = (axes / np.sqrt(values)[:, None]).T, len(values)

    def check(batches):
        total, mean = np.zeros((k, k)), np.zeros(k)
        for x in _matrices(batches, dims):
            y = centre(x) @ project
            total += y.T @ y
            mean += y.sum(axis=0)
        yield _upper(total)
        yield pa.record_batch({"i": np.full(k, -1, np.int32), "j": np.arange(k, dtype=np.int32), "v": mean})

    found = _entry_sums(listed, check) if k else {}
    mean = np.array([found.get((-1, j), 0.0) for j in range(k)]) / n
    covariance = _symmetric(found, k) / n - np.outer(mean, mean)
    error = float(np.abs(covariance - np.eye(k)).max(initial=0.0))
    return Whitening(n, sums, float(np.trace(whole)) / n, values, axes, error)


_ROWS = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, model: Whitening | None, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row per vector and component: the vector's place along it, in units of the standard deviation there.

    ``n`` is the size of the fit list, ``deviation`` the exact sum over dimensions of (n x - S)^2 (null where it does not
    fit a long), ``explained`` the share of the component in the variance, ``identity_error`` the largest entry by which
    the covariance of the whitened fit list differs from the identity. Left out are vectors that :func:`fit` leaves
    out; without a model there are no rows. Repeated rows and rows with equal or null keys are rows of their own.
    """
    schema = f"{key} long, {_ROWS}"
    chosen = vectors.select(F.col(f"`{key}`").cast("long").alias(key), F.col(f"`{column}`"))
    if model is None:
        return chosen.limit(0).selectExpr(key, *(f"cast(null as {kind}) as {name}" for name, kind in (part.split() for part in _ROWS.split(", "))))
    k, dims = len(model.eigenvalues), model.dims
    centre, project = _Centred(model.n, model.sums), (model.components / np.sqrt(model.eigenvalues)[:, None]).T
    explained = model.eigenvalues / model.trace if k else model.eigenvalues

    def run(batches):
        for batch in batches:
            rows, length, values, starts = grid_rows(batch.column(1))
            rows = rows[length[rows] == dims]
            x = values[starts[rows][:, None] + np.arange(dims)]
            y = centre(x)
            repeat, size = np.repeat(np.arange(len(rows)), k), len(rows) * k
            yield pa.record_batch(
                {
                    key: batch.column(0).take(pa.array(rows[repeat], pa.int64())),
                    "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows)),
                    "n": np.full(size, model.n, np.int64),
                    "deviation": pa.array(centre.deviations(x, y), pa.int64()).take(pa.array(repeat, pa.int64())),
                    "whitened": (y @ project).ravel(),
                    "explained": np.tile(explained, len(rows)),
                    "identity_error": np.full(size, model.identity_error),
                }
            )

    return chosen.mapInArrow(run, schema)
