"""Exact k-nearest-neighbour regression by pivots, rings and query blocks.

Training points belong to the cell of their nearest pivot and are ordered in it by their distance to it; runs
of ``chunk_rows`` points of that order are *chunks*, so a cell that holds a third of the points, or thousands of
copies of one, is many chunks.  A chunk is known by the smallest and largest of these distances (its ring).

A query bounds its k-th neighbour by the points nearest to the pivots, and by the triangle inequality needs only
the cells whose separating plane, and in them the chunks whose ring, lie within that bound.  Queries are
ordered by cell and ring, too, and taken in blocks; a block meets a chunk once, as matrices, if one of its queries
needs it.  Nothing is compared that the bounds exclude, and no bound excludes a neighbour: the answer is that of a
full scan.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.operators.baselines import MODEL, YHAT
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.blocks import _bounded, ordered_ranks
from chronoweave.session import store

CELLS = 1 << 21
#: relative slack of the bounds against rounding
SLACK = 1e-9


def _points(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Euclidean distances (rows of x, rows of p), from differences, so equal points are at exactly 0."""
    out = np.empty((len(x), len(p)))
    step = max(1, CELLS // max(1, p.size))
    for i in range(0, len(x), step):
        out[i:i + step] = np.sqrt(((x[i:i + step, None, :] - p[None]) ** 2).sum(axis=2))
    return out


def choose_pivots(points: DataFrame, count: int) -> np.ndarray:
    """``count`` distinct points, drawn by the hash of their coordinates."""
    h = F.xxhash64("_x")
    rows = points.select("_x", h.alias("h")).groupBy("h").agg(F.min("_x").alias("_x")).orderBy("h").limit(count).collect()
    return np.array([r["_x"] for r in rows], float)


def assign(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``points`` with ``_c``, the nearest pivot (the first of equally near ones), and ``_r``, its distance."""
    width = pivots.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            d = _distances(_points(b.column("_x"), width), pivots)
            c = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(c.astype(np.int32)), pa.array(d[np.arange(len(c)), c])],
                                             [*b.schema.names, "_c", "_r"])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema)
    return _bounded(points).mapInArrow(work, f"{kinds}, _c int, _r double")


def _visits(queries: DataFrame, pivots: np.ndarray, nearest: list[np.ndarray], radius: np.ndarray, k: int) -> DataFrame:
    """(_q, _b, _cell, _near, _far): the cells that each query needs and the ring in each."""
    width = pivots.shape[1]
    padded = np.full((len(pivots), k), np.inf)
    for c, r in enumerate(nearest):
        padded[c, :len(r)] = r
    between = _distances(pivots, pivots)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _points(b.column("_x"), width) if b.num_rows else np.zeros((0, width))
            step = max(1, CELLS // padded.size)
            for s in range(0, len(x), step):
                d = _distances(x[s:s + step], pivots)
                up = (d[:, :, None] + padded[None]).reshape(len(d), -1)
                near = min(k, up.shape[1])
                bound = np.partition(up, near - 1, axis=1)[:, near - 1] * (1 + SLACK) + 1e-300
                home = d.argmin(axis=1)
                # distance to the plane between the query's own cell and the other
                apart = between[home]
                with np.errstate(divide="ignore", invalid="ignore"):
                    plane = np.where(apart > 0, (d ** 2 - d[np.arange(len(d)), home][:, None] ** 2) / (2 * apart), 0.0)
                slack = SLACK * (d.max(axis=1) + 1)
                wide = (bound + slack)[:, None]
                need = (plane <= wide) & (d - radius[None] <= wide)
                q, c = np.nonzero(need)
                take = pa.array(q + s)
                yield pa.RecordBatch.from_arrays(
                    [b.column("_q").take(take), b.column("_b").take(take), pa.array(c.astype(np.int32)),
                     pa.array(d[q, c] - wide[q, 0]), pa.array(d[q, c] + wide[q, 0])], ["_q", "_b", "_cell", "_near", "_far"])
    return _bounded(queries.select("_q", "_b", "_x")).mapInArrow(work, "_q long, _b long, _cell int, _near double, _far double")


def _compare(pairs: DataFrame, width: int, k: int) -> DataFrame:
    """(_q, _d, _t, _y): the k nearest points of a chunk for every query of a block that needs it."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                one = b.slice(i, 1)
                x = one.column("x").flatten().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                t, y = one.column("t").flatten().to_numpy(), one.column("y").flatten().to_numpy()
                qx = one.column("qx").flatten().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                q = one.column("q").flatten().to_numpy()
                rank = np.argsort(t, kind="stable")
                x, t, y = x[rank], t[rank], y[rank]
                near = min(k, len(t))
                step = max(1, CELLS // x.size)
                for s in range(0, len(q), step):
                    d = ((qx[s:s + step, None, :] - x[None]) ** 2).sum(axis=2)
                    # of equally distant points the first ones in training order
                    best = np.argsort(d, axis=1, kind="stable")[:, :near]
                    rows = np.repeat(q[s:s + step], near)
                    at = best.ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows), pa.array(np.take_along_axis(d, best, 1).ravel()), pa.array(t[at]), pa.array(y[at])], ["_q", "_d", "_t", "_y"])
    return _bounded(pairs).mapInArrow(work, "_q long, _d double, _t long, _y double")


def knn_regression(train: DataFrame, test: DataFrame, features: Sequence[str], ks: Sequence[int] = (15,), target: str = Y,
                   row_cols: Sequence[str] = (ID, DS), pivots: int = 64, chunk_rows: int = 4096, query_rows: int = 1024,
                   name: str = "KNN") -> DataFrame:
    """(row_cols, model, y_hat): the mean target of the ``k`` nearest training rows for every row of ``test``
    and every ``k`` of ``ks``; all training rows if they are fewer.

    Distances are Euclidean over ``features`` as they are (scale them before).  Equally distant
    rows count in the order of ``row_cols``.  Training rows with a NULL or NaN feature or target
    are left out; test rows with one, and all rows without training rows, have a NULL
    prediction.  Rows of ``test`` that repeat ``row_cols`` each get theirs."""
    k = max(ks)
    width = len(features)
    x = F.array(*[F.col(c).cast("double") for c in features])
    whole = F.forall("_x", lambda v: v.isNotNull() & ~F.isnan(v))
    y = F.col(target).cast("double")
    tr = train.select(*row_cols, x.alias("_x"), y.alias("_y")).where(whole & F.col("_y").isNotNull() & ~F.isnan("_y"))
    tr = store(ordered_ranks(tr, list(row_cols), [], "_t").select("_t", "_x", "_y"))
    asked = store(test.select(*row_cols, x.alias("_x")).withColumn("_q", F.monotonically_increasing_id()))
    names = [F.lit(f"{name}{j}") for j in ks]

    places = choose_pivots(tr, pivots)
    if len(places):
        cells = ordered_ranks(assign(tr, places), ["_r", "_t"], ["_c"], "_rank")
        cells = store(cells.withColumn("_k", F.floor(F.col("_rank") / chunk_rows)))
        head = cells.where(F.col("_rank") < k).groupBy("_c").agg(F.array_sort(F.collect_list("_r")).alias("r")).collect()
        far = {r["_c"]: r["r"] for r in cells.groupBy("_c").agg(F.max("_r").alias("r")).collect()}
        nearest = {r["_c"]: np.array(r["r"]) for r in head}
        queries = ordered_ranks(assign(asked.where(whole).select("_q", "_x"), places), ["_c", "_r", "_q"], [], "_rank")
        queries = store(queries.select("_q", "_x", F.floor(F.col("_rank") / query_rows).alias("_b")))
        visits = _visits(queries, places, [nearest.get(c, np.zeros(0)) for c in range(len(places))],
                         np.array([far.get(c, -np.inf) for c in range(len(places))]), k)
        rings = cells.groupBy("_c", "_k").agg(F.min("_r").alias("lo"), F.max("_r").alias("hi")) \
            .groupBy("_c").agg(F.collect_list(F.struct("_k", "lo", "hi")).alias("rings"))
        met = visits.join(rings, F.col("_cell") == F.col("_c")).select("_q", "_b", "_c", "_near", "_far", F.explode("rings").alias("g")) \
            .where((F.col("g.lo") <= F.col("_far")) & (F.col("g.hi") >= F.col("_near"))).select("_b", "_q", "_c", F.col("g._k").alias("_k"))
        # a block of queries and a chunk meet once, with the queries that need it
        blocks = met.join(queries.select("_q", "_x"), "_q").groupBy("_b", "_c", "_k") \
            .agg(F.collect_list(F.struct("_q", "_x")).alias("a")).select("_c", "_k", F.col("a._q").alias("q"), F.col("a._x").alias("qx"))
        chunks = cells.groupBy("_c", "_k").agg(F.collect_list(F.struct("_t", "_x", "_y")).alias("a")) \
            .select("_c", "_k", F.col("a._t").alias("t"), F.col("a._x").alias("x"), F.col("a._y").alias("y"))
        found = _compare(blocks.join(chunks, ["_c", "_k"]), width, k)
        order = Window.partitionBy("_q").orderBy("_d", "_t")
        best = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)
        means = best.groupBy("_q").agg(*[F.avg(F.when(F.col("n") <= j, F.col("_y"))).alias(f"m{j}") for j in ks])
        out = asked.join(means, "_q", "left")
        values = [F.col(f"m{j}") for j in ks]
    else:
        out, values = asked, [F.lit(None).cast("double") for _ in ks]
    return out.select(*row_cols, F.explode(F.arrays_zip(F.array(*names).alias("m"), F.array(*values).alias("v"))).alias("z")) \
        .select(*row_cols, F.col("z.m").alias(MODEL), F.col("z.v").alias(YHAT))
