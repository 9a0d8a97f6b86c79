"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Vectors are scaled to integers x = floor(scale * c); the *fit list* holds each distinct x once.
With X the centred rows of the fit list (x - S/n), the principal components are the right
singular vectors of X.  The bidiagonalisation alternates, block by block of right vectors V_j,

    U_j A_j ~ X V_j - U (U'X V_j)            V_(j+1) B_j ~ X'U_j - V (V'X'U_j)

with full reorthogonalisation of both sides; the SVD of the small block-bidiagonal matrix U'X V
gives components and deviations.

How it is distributed.  Every left vector is a product u = X p with a vector p of the dimension's length,
so nothing as long as the list is stored: a step is one pass that computes W = X V_j and U = X P
rows by rows and adds up U'W (for the reorthogonalisation), W'W and X'W.  From these the
driver has A_j, P_j, and X'U_j, since X'U of earlier steps is known.

A block has as many vectors as components are asked for: one vector would find one direction only of an
eigenvalue that occurs several times, and needs that many times the passes.  A last Rayleigh-Ritz pass
over the span of all right vectors gives the eigenvectors and their residuals; steps go on until
these are small or no direction is left.

Scale.  Rows shuffle once, to find distinct vectors (equal ones are pre-aggregated, so a vector held
by a third of the rows is no hot key).  Every pass reads the stored list and returns sums of
fixed size, added up in two stages.  Steps number at most the dimension over the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import bounded_batches, materialize

#: largest residual |V q - e q| / e_1 of a component that counts as converged
RESIDUAL = 1e-12
#: tasks of the second stage of a sum
SUM_TASKS = 16
LONG_MAX = (1 << 63) - 1


def scaled(vector: Column, scale: float) -> Column:
    """array<bigint> of floor(scale * c); values beyond a long stay at its ends."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))


def usable(vector: Column) -> Column:
    """Whether a vector is there, not empty and holds finite entries only."""
    inf = F.lit(float("inf"))
    finite = F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < inf), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(df: DataFrame, column: str, fold: Callable[[np.ndarray], np.ndarray], length: int, dims: int) -> np.ndarray:
    """Sum of ``fold(rows)`` (vectors of ``length`` doubles) over all blocks of rows, in two stages."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                total += fold(_matrix(b.column(column).slice(at, 4096), dims))
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["s"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for b in batches:
            if b.num_rows:
                total += _matrix(b.column("s"), length).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["s"])

    parts = bounded_batches(df.select(column)).mapInArrow(part, "s array<double>")
    rows = parts.repartition(SUM_TASKS).mapInArrow(add, "s array<double>").collect()
    return np.sum([r["s"] for r in rows], axis=0) if rows else np.zeros(length)


def _exact_sums(df: DataFrame, column: str, dims: int) -> tuple[int, list[int]]:
    """Rows and exact per-dimension sums, whatever their size: halves of 32 bits are added apart."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for b in batches:
            x = _matrix(b.column(column), dims)
            n += len(x)
            low += (x & 0xFFFFFFFF).sum(axis=0)
            high += (x >> 32).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array(np.arange(dims)[None].tolist()), pa.array([low.tolist()], pa.list_(pa.int64())),
                                          pa.array([high.tolist()], pa.list_(pa.int64()))], ["n", "d", "low", "high"])

    parts = bounded_batches(df.select(column)).mapInArrow(part, "n long, d array<long>, low array<long>, high array<long>")
    n = parts.agg(F.sum("n")).first()[0] or 0
    wide = "decimal(38,0)"
    rows = parts.select(F.explode(F.arrays_zip("d", "low", "high")).alias("z")) \
        .groupBy("z.d").agg(F.sum(F.col("z.low").cast(wide)).alias("low"), F.sum(F.col("z.high").cast(wide)).alias("high")).collect()
    s = [0] * dims
    for r in rows:
        s[r["d"]] = int(r["low"]) + (int(r["high"]) << 32)
    return n, s


class Bidiagonalisation:
    """The block recurrence: right vectors ``v`` (rows), left vectors as ``p`` (u = X p), ``z`` = X'u.

    ``new`` is the newest block of right vectors, None when no direction is left."""

    def __init__(self, start: np.ndarray, small: float):
        self.v = np.linalg.qr(start.T)[0].T
        self.new: np.ndarray | None = self.v
        self.p = np.zeros((0, start.shape[1]))
        self.z = np.zeros((0, start.shape[1]))
        self.small = small

    def step(self, products: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """Take in the newest block; ``products(new, p)`` returns U'W, W'W and X'W of W = X new."""
        p = self.new
        while True:
            uw, ww, xw = products(p, self.p)
            gram = ww - uw.T @ uw
            value, vector = np.linalg.eigh((gram + gram.T) / 2)
            keep = value > max(self.small, 1e-14 * np.diag(ww).max(initial=0.0))
            turn = vector[:, keep] / np.sqrt(value[keep])
            p, z = turn.T @ (p - uw.T @ self.p), turn.T @ (xw.T - uw.T @ self.z)
            # where most of W lay in the span of U, rounding is left: orthogonalise once more
            if not keep.any() or value[keep].min() > 1e-6 * np.diag(ww).max():
                break
        self.p, self.z = np.r_[self.p, p], np.r_[self.z, z]
        rest = z
        for _ in range(2):
            rest = rest - (rest @ self.v.T) @ self.v
        _, size, basis = np.linalg.svd(rest, full_matrices=False)
        basis = basis[size ** 2 > max(self.small, 1e-26 * (self.z ** 2).sum())]
        for _ in range(2):
            basis = basis - (basis @ self.v.T) @ self.v
        self.last = rest
        self.new = np.linalg.qr(basis.T)[0].T if len(basis) and len(self.v) < self.v.shape[1] else None

    def residual(self, count: int) -> float:
        """Largest part of X'u outside the right vectors among the ``count`` leading singular triplets of the small
        matrix U'X V, relative to the largest singular value."""
        if self.new is None:
            return 0.0
        left, sigma, _ = np.linalg.svd(self.z @ self.v.T, full_matrices=False)
        if len(sigma) < count:
            return 1.0
        tail = left[len(left) - len(self.last):, :count].T @ self.last
        return float(np.linalg.norm(tail, axis=1).max() / sigma[0])

    def grow(self) -> None:
        self.v = np.r_[self.v, self.new]


def components(fit: DataFrame, column: str, n: int, mean: np.ndarray, count: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, float]:
    """(components (k, dims), eigenvalues (k), trace) of the fit list's covariance, k <= count:
    directions without variance are left out."""
    dims = len(mean)
    trace = float(_sums(fit, column, lambda x: np.array([((x - mean) ** 2).sum()]), 1, dims)[0]) / n
    if not trace > 0:
        return np.zeros((0, dims)), np.zeros(0), 0.0

    def products(new: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        b, k = len(new), len(p)

        def fold(x: np.ndarray) -> np.ndarray:
            xc = x - mean
            w = xc @ new.T
            return np.concatenate([((xc @ p.T).T @ w).ravel(), (w.T @ w).ravel(), (xc.T @ w).ravel()])
        s = _sums(fit, column, fold, (k + b + dims) * b, dims)
        return s[:k * b].reshape(k, b), s[k * b:(k + b) * b].reshape(b, b), s[(k + b) * b:].reshape(dims, b)

    run = Bidiagonalisation(np.random.default_rng(seed).normal(size=(min(count, dims), dims)), n * trace * 1e-26)
    want = RESIDUAL
    while True:
        run.step(products)
        if run.residual(count) > want:
            run.grow()
            continue
        # Rayleigh-Ritz over all right vectors
        basis = run.v
        vq = _sums(fit, column, lambda x: ((x - mean).T @ ((x - mean) @ basis.T)).ravel(), dims * len(basis), dims).reshape(dims, -1) / n
        small = basis @ vq
        e, w = np.linalg.eigh((small + small.T) / 2)
        keep = np.argsort(-e)[:count]
        keep = keep[e[keep] > trace * 1e-14]
        found, value = (w[:, keep].T @ basis), e[keep]
        residual = np.linalg.norm(vq @ w[:, keep] - found.T * value, axis=0) if len(keep) else np.zeros(1)
        if run.new is None or residual.max() <= 10 * RESIDUAL * max(value.max(initial=0), 1e-300):
            return found, value, trace
        want /= 10
        run.grow()


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int = 4, scale: float = 256.0,
           seed: int = 0) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for every usable row and
    component up to ``count``, numbered from 1 by falling eigenvalue.

    Rows whose vector is null, empty, or holds a null or a non-finite entry are left out, and so are
    vectors of another length than most distinct ones have (the longer of two equally frequent).
    Repeated rows and ids keep their rows; the fit list has each vector once.  A direction without
    variance is no component: an empty table, and one with a single distinct vector, give no
    rows.  ``deviation`` (squared distance to the mean in units of 1/n) is exact, and null where it is
    no long.  Extra columns do not matter."""
    vec = F.col(vector_col)
    base = rows.select(F.col(id_col).alias("id"), vec.alias("c")).where(usable(F.col("c"))).select("id", scaled(F.col("c"), scale).alias("x"))
    distinct = materialize(base.select("x").groupBy("x").agg(F.count(F.lit(1)).alias("copies")), "whiten-distinct")
    lengths = distinct.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    dims = lengths["d"] if lengths else 1
    same = F.size("x") == dims
    fit = distinct.where(same).select("x")
    n, total = _exact_sums(fit, "x", dims)
    mean = np.array([s / n for s in total]) if n else np.zeros(dims)
    found, value, trace = components(fit, "x", n, mean, count, seed) if n else (np.zeros((0, dims)), np.zeros(0), 0.0)
    project = found / np.sqrt(value)[:, None]
    k = len(value)
    error = 0.0
    if k:
        def fold(x: np.ndarray) -> np.ndarray:
            y = (x - mean) @ project.T
            return np.r_[(y.T @ y).ravel(), y.sum(axis=0)]
        s = _sums(fit, "x", fold, k * k + k, dims) / n
        error = float(np.abs(s[:k * k].reshape(k, k) - np.outer(s[k * k:], s[k * k:]) - np.eye(k)).max())
    explained = (value / trace).tolist()
    kind = rows.select(F.col(id_col)).schema[0].dataType.simpleString()
    wide = max((abs(t) for t in total), default=0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0 or k == 0:
                continue
            x = _matrix(b.column("x"), dims)
            y = (x - mean) @ project.T
            dev = _deviations(x, n, total, wide)
            at = np.repeat(np.arange(len(x)), k)
            m = len(at)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(m, n, np.int64)), pa.array([dev[i] for i in at], pa.int64()), pa.array(y.ravel()),
                 pa.array(np.tile(explained, len(x))), pa.array(np.full(m, error))],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    out = bounded_batches(base.where(same)).mapInArrow(
        work, f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return out.withColumnRenamed("id", id_col)


def _deviations(x: np.ndarray, n: int, total: list[int], wide: int) -> list[int | None]:
    """Exact sums of (n x - S)^2: in longs where no step can overflow, else in Python integers."""
    top = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + wide
    if top * top * x.shape[1] <= LONG_MAX:
        return ((x * n - np.array(total, np.int64)) ** 2).sum(axis=1).tolist()
    out = [sum((int(c) * n - s) ** 2 for c, s in zip(row, total)) for row in x]
    return [v if v <= LONG_MAX else None for v in out]
