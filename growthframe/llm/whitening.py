"""Embedding whitening: exact sums and a centred covariance by Spark, its leading eigenpairs by FEAST contour integration."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthframe.llm.common import arrow_map, saved

#: Nodes of the Gauss-Legendre rule on the upper half of a contour (the lower half is its mirror image).
NODES = 8
#: Eigenvalues in a contour, at most, where a gap allows the cut.
PER_CONTOUR = 4
#: A component whose eigenvalue is less than this share of the trace has no variance to scale by.
LEAST = 1e-12


# The covariance, of bounded size: its order is the number of dimensions -----------------------------


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of an orthogonally similar tridiagonal matrix (Householder reflections)."""
    a, d = v.copy(), len(v)
    for k in range(d - 2):
        x = a[k + 1:, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        x[0] += np.copysign(norm, x[0])
        x /= np.linalg.norm(x)
        sub = a[k + 1:, k + 1:]
        p = sub @ x
        q = p - x * (x @ p)
        sub -= 2 * (np.outer(x, q) + np.outer(q, x))
        a[k + 1, k] = a[k, k + 1] = -np.copysign(norm, a[k + 1, k])
        a[k + 2:, k] = a[k, k + 2:] = 0
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_above(tri: tuple[np.ndarray, np.ndarray], shifts: np.ndarray) -> np.ndarray:
    """Eigenvalues above each shift: positive pivots of the LDL^T of the shifted matrix (Sylvester's law of inertia)."""
    diagonal, off = tri
    shifts = np.atleast_1d(np.asarray(shifts, float))
    tiny = np.finfo(float).tiny * 4 + np.finfo(float).eps ** 2 * (np.abs(diagonal).max() + np.abs(off).max(initial=0))
    pivot, n = np.ones(len(shifts)), np.zeros(len(shifts), np.int64)
    for k in range(len(diagonal)):
        pivot = diagonal[k] - shifts - (off[k - 1] ** 2 / pivot if k else 0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        n += pivot > 0
    return n


def leading_values(tri: tuple[np.ndarray, np.ndarray], many: int, top: float) -> np.ndarray:
    """The ``many`` largest eigenvalues, roughly, by bisection with inertia counts; ``top`` is above all of them."""
    low, high = np.zeros(many), np.full(many, top)
    rank = np.arange(1, many + 1)
    for _ in range(48):
        middle = (low + high) / 2
        above = count_above(tri, middle) >= rank
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return (low + high) / 2


def contours(tri: tuple[np.ndarray, np.ndarray], trace: float, many: int) -> list[tuple[float, float, int]]:
    """Intervals ``(low, high, eigenvalues in it)`` that hold the ``many`` largest; cut where neighbours are apart."""
    d = len(tri[0])
    values = leading_values(tri, d, trace * (1 + 1e-9))
    values = values[values > LEAST * trace]
    cuts = [min(trace * 1.001, values[0] * 1.05)] if len(values) else []
    edges, at = cuts[:], 0
    while at < min(many, len(values)):
        best, where = -1.0, len(values)
        for k in range(at + 1, len(values) + 1):
            below = values[k] if k < len(values) else 0.0
            gap = (values[k - 1] - below) / values[k - 1]
            if gap > best and (k - at <= PER_CONTOUR or best < 1e-3):
                best, where = gap, k
            if k - at >= PER_CONTOUR and best >= 1e-3:
                break
        below = values[where] if where < len(values) else 0.0
        edges.append((values[where - 1] + below) / 2)
        at = where
    counts = count_above(tri, np.array(edges)) if edges else []
    return [(low, high, int(b - a)) for high, low, a, b in zip(edges, edges[1:], counts, counts[1:])]


def feast(v: np.ndarray, low: float, high: float, many: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``many`` eigenpairs of ``v`` with eigenvalues in ``low`` to ``high``.

    Quadrature over a circle around the interval of the resolvent, applied to a block of vectors by complex shifted
    solves, projects onto the wanted eigenvectors; Rayleigh-Ritz extracts them; repeated until the residuals are those of
    double precision. The count that inertia gave must be met, or the block is widened."""
    d = len(v)
    middle, radius = (low + high) / 2, (high - low) / 2
    x, w = np.polynomial.legendre.leggauss(NODES)
    angle = np.pi * (x + 1) / 2
    turn = np.exp(1j * angle)
    size, scale = min(d, many + max(4, many // 2)), np.abs(v).sum(1).max()
    rng = np.random.default_rng(seed)
    while True:
        block = rng.standard_normal((d, size))
        for _ in range(30):
            projected = np.zeros((d, size))
            for t, weight in zip(turn, w):
                solved = np.linalg.solve((middle + radius * t) * np.eye(d) - v, block.astype(complex))
                projected += weight / 2 * radius * np.real(t * solved)
            q, _ = np.linalg.qr(projected)
            q, _ = np.linalg.qr(q)
            values, small = np.linalg.eigh(q.T @ v @ q)
            block = q @ small
            inside = (values > low) & (values <= high)
            left = np.linalg.norm(v @ block[:, inside] - block[:, inside] * values[inside], axis=0)
            if inside.sum() == many and (left <= 4e-14 * scale).all():
                return values[inside], block[:, inside]
        if inside.sum() == many and (left <= 1e-10 * scale).all():
            return values[inside], block[:, inside]
        if size == d:
            raise ArithmeticError(f"{int(inside.sum())} of {many} eigenpairs between {low} and {high}")
        size = min(d, 2 * size)


def leading_pairs(v: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``many`` largest eigenvalues of a covariance, falling, and their unit eigenvectors as columns (largest entry positive).

    Fewer where fewer have any variance."""
    trace = float(np.trace(v))
    if not len(v) or trace <= 0:
        return np.zeros(0), np.zeros((len(v), 0))
    found = [feast(v, *interval) for interval in contours(tridiagonal(v), trace, many) if interval[2]]
    values = np.concatenate([np.zeros(0), *[e for e, _ in found]])
    vectors = np.concatenate([np.zeros((len(v), 0)), *[u for _, u in found]], 1)
    order = np.argsort(-values, kind="stable")[:many]
    values, vectors = values[order], vectors[:, order]
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    largest = np.abs(vectors).argmax(0) if vectors.size else np.zeros(0, int)
    return values, vectors * np.sign(vectors[largest, np.arange(len(values))])


# The rows ----------------------------------------------------------------------------------------


def _vectors(batch: pa.RecordBatch, column: int, size: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per length met (or of ``size`` alone): which rows hold such a vector of finite entries, and its integers."""
    lists = batch.column(column)
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    for n in np.unique(lengths) if size is None else [size]:
        rows = np.flatnonzero(lengths == n)
        if n and len(rows):
            flat = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, n)
            good = np.isfinite(flat).all(1)
            if good.any():
                yield rows[good], np.floor(1024 * flat[good]).astype(np.int64) + 100000


class Fit(NamedTuple):
    """What the fit list says: number of vectors, sums of each dimension, falling eigenvalues, eigenvectors as columns, trace."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, exact up to one rounding: n * x - S is a whole number."""
        whole = self.sums // self.n
        return (x - whole) - (self.sums - whole * self.n) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list:
        """Sum over the dimensions of (n * x - S)^2, exact; None beyond a long."""
        far = max(int(np.abs(x).max(initial=0)) * self.n + int(np.abs(self.sums).max(initial=0)), 1)
        if far < 1 << 62 and far * far * len(self.sums) < 1 << 63:
            return ((x * self.n - self.sums) ** 2).sum(1).tolist()
        sums = [int(s) for s in self.sums]
        exact = [sum((self.n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
        return [e if e < 1 << 63 else None for e in exact]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        for rows, x in _vectors(batch, 0):
            n, s = held.get(x.shape[1], (0, 0))
            held[x.shape[1]] = n + len(rows), s + x.sum(0)
    for d, (n, s) in held.items():
        yield pa.record_batch([pa.array(np.full(d, d), pa.int32()), pa.array(np.arange(d), pa.int32()), pa.array(s, pa.int64()), pa.array(np.full(d, n), pa.int64())], names=["d", "at", "s", "n"])


def _products(of, width: int, size: int):
    """Per task, the sums of products of every two of the ``width`` columns that ``of`` makes of the integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for _, x in _vectors(batch, 0, size):
                for k in range(0, len(x), 4096):
                    y = of(x[k:k + 4096])
                    total += y.T @ y
        i, j = np.triu_indices(width)
        yield pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "p"])

    return run


def _covariance(vectors: DataFrame, of, width: int, size: int, n: int) -> np.ndarray:
    cells = arrow_map(vectors, _products(of, width, size), "i int, j int, p double").groupBy("i", "j").agg(F.sum("p").alias("p")).toArrow()
    out = np.zeros((width, width))
    i, j = cells["i"].to_numpy(), cells["j"].to_numpy()
    out[i, j] = out[j, i] = cells["p"].to_numpy() / n
    return out


def fit(vectors: DataFrame, many: int = 8) -> tuple[Fit | None, float]:
    """The fit over every valid vector of the one column of ``vectors``, and the identity error of what it whitens; None for no vector."""
    sums = saved(arrow_map(vectors, _sums, "d int, at int, s long, n long").groupBy("d", "at").agg(F.sum("s").alias("s"), F.sum("n").alias("n")), "vector-sums")
    most = sums.where("at = 0").orderBy(F.desc("n"), F.desc("d")).first()
    if most is None:
        return None, 0.0
    n, d = most["n"], most["d"]
    whole = np.array([r["s"] for r in sums.where(F.col("d") == d).orderBy("at").collect()], np.int64)
    start = Fit(n, whole, np.zeros(0), np.zeros((d, 0)), 0.0)
    v = _covariance(vectors, start.centred, d, d, n)
    values, components = leading_pairs(v, many)
    done = Fit(n, whole, values, components, float(np.trace(v)))
    if not len(values):
        return done, 0.0
    same = _covariance(vectors, done.whitened, len(values), d, n)
    return done, float(np.abs(same - np.eye(len(values))).max())


def whiten(rows: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id", many: int = 8) -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)`` per valid row and component.

    An entry c counts as floor(1024 * c) + 100000. Rows whose vector is NULL or empty or holds a NULL, NaN or infinite entry
    are left out, and so are those of another length than the most common one (of equally common: the longest).
    Three passes: sums (exact), products of centred vectors, and those of the whitened ones as a
    check; tasks send one table of the size of the dimensions each. The covariance, whose size does not depend on the
    number of rows, is decomposed on the driver: intervals from inertia counts, FEAST in each, and as many
    pairs as were counted. Components have variance (their eigenvalue is over 1e-12 of the trace): with a single
    vector, or equal ones, there are none, and no rows. ``deviation`` is NULL beyond a long. Repeated rows and ids give repeated
    results; a NULL id stays; other columns play no part; an empty table gives an empty one."""
    found, error = fit(rows.select(vector_col), many)
    kind = rows.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if found is None:
        return rows.sparkSession.createDataFrame([], schema)
    k, d = len(found.values), len(found.sums)
    explained = found.values / found.trace if found.trace else found.values

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _vectors(batch, 1, d):
                m = len(at) * k
                yield pa.record_batch([
                    batch.column(0).take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1), len(at)), pa.int32()), pa.array(np.full(m, found.n)),
                    pa.array(found.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k))), pa.array(found.whitened(x).reshape(-1)),
                    pa.array(np.tile(explained, len(at))), pa.array(np.full(m, error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return arrow_map(rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")), of, schema)
