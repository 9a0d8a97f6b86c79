"""Array blocks: imperative per-series code on bounded pieces of a series.

Where a column expression cannot say what to do (nearest neighbours, LOESS, non-linear
recursions), rows are gathered into one row per ``(series, block)`` whose columns are arrays, and
numpy works on the arrays inside ``mapInArrow``.  No task ever holds a series, only blocks:

* :func:`gather` collects blocks of bounded length with copies of the rows around their edges;
* :func:`map_blocks` runs a function on every block and returns rows again;
* :func:`fold_blocks` runs a recursion ``state_t = f(state_(t-1), row_t)`` of any form in parallel
  in time: every block starts from a guess, then blocks whose start differs from their
  predecessor's end are run again, until none does.  The result is that of the sequential loop, bit for
  bit; recursions that forget their start need two or three rounds;
* :func:`ordered_ranks` numbers rows by value (not by time) from a range-partitioned order.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.panel import ID
from chronoweave.plans.series import POS, _keys
from chronoweave.session import store

BLOCK = "_blk"
#: rows of a block; its arrays are what a task holds at a time
ARRAY_ROWS = 4096
#: bytes of an Arrow batch of blocks
BATCH_BYTES = 16 << 20

Arrays = dict[str, np.ndarray]


def _bounded(df: DataFrame) -> DataFrame:
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    conf = df.sparkSession.conf
    if int(re.sub(r"[^0-9]", "", conf.get(key))) > BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return df


def gather(df: DataFrame, cols: Sequence[str], id_cols: str | Sequence[str] = ID, pos_col: str = POS,
           block_rows: int | Column = ARRAY_ROWS, back: int | Column = 0, ahead: int | Column = 0,
           scalars: Sequence[str] = ()) -> DataFrame:
    """One row per (series, block): arrays of ``pos_col`` and ``cols`` in order of position, with
    ``back`` / ``ahead`` positions of the neighbour blocks, and ``_lo``, the block's first own position, and
    ``_size``, its length.  Lengths and reaches may differ by series (columns); a reach may not be
    longer than the block.  ``scalars`` are columns constant in a series, kept as they are."""
    keys = _keys(id_cols)
    size, back, ahead = ((c if isinstance(c, Column) else F.lit(c)).cast("long") for c in (block_rows, back, ahead))
    x = df.select(*keys, F.col(pos_col).cast("long").alias("_p"), *cols, *scalars, size.alias("_size"), back.alias("_back"), ahead.alias("_ahead"))
    own = F.floor(F.col("_p") / F.col("_size"))
    off = F.col("_p") - F.col("_own") * F.col("_size")
    targets = F.array(F.col("_own"), F.when(off >= F.col("_size") - F.col("_back"), F.col("_own") + 1),
                      F.when(off < F.col("_ahead"), F.col("_own") - 1))
    x = x.withColumn("_own", own).withColumn(BLOCK, F.explode(F.filter(targets, lambda t: t.isNotNull())))
    rows = x.groupBy(*keys, BLOCK).agg(F.array_sort(F.collect_list(F.struct("_p", *cols))).alias("_a"), F.first("_size").alias("_size"),
                                       F.max((F.col("_own") == F.col(BLOCK)).cast("int")).alias("_any"),
                                       *[F.first(s).alias(s) for s in scalars])
    return rows.where(F.col("_any") == 1).select(
        *keys, BLOCK, (F.col(BLOCK) * F.col("_size")).alias("_lo"), "_size", *scalars,
        F.col("_a").getField("_p").alias("_p"), *[F.col("_a").getField(c).alias(c) for c in cols])


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    flat = column.values.to_numpy(zero_copy_only=False)
    at = column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(at[:-1], at[1:])]


def _block_inputs(batch: pa.RecordBatch, names: Sequence[str]) -> list[list]:
    out = []
    for n in names:
        c = batch.column(n)
        out.append(_lists(c) if pa.types.is_list(c.type) else c.to_pylist())
    return out


def map_blocks(blocks: DataFrame, fn: Callable[..., Arrays], out: Mapping[str, str], cols: Sequence[str],
               id_cols: str | Sequence[str] = ID, pos_col: str = POS, scalars: Sequence[str] = ()) -> DataFrame:
    """Rows (series, position, ``out`` columns) of ``fn(p, own, *cols, **scalars)`` on every block of
    :func:`gather`.  ``p`` are the positions, ``own`` marks the block's own rows; the returned
    arrays have a value for each own row."""
    keys = _keys(id_cols)
    kinds = {f.name: f.dataType.simpleString() for f in blocks.schema}
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in keys] + [f"`{pos_col}` long"] + [f"`{n}` {t}" for n, t in out.items()])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            p, lo, size, *rest = _block_inputs(b, ["_p", "_lo", "_size", *cols, *scalars])
            for i in range(b.num_rows):
                own = (p[i] >= lo[i]) & (p[i] < lo[i] + size[i])
                args = [r[i] for r in rest]
                got = fn(p[i], own, *args[:len(cols)], **dict(zip(scalars, args[len(cols):])))
                at = p[i][own]
                yield pa.RecordBatch.from_arrays(
                    [b.column(k).take(pa.array(np.full(len(at), i, np.int64))) for k in keys] + [pa.array(at, pa.int64())]
                    + [_column(got[n], t) for n, t in out.items()], [*keys, pos_col, *out])

    return _bounded(blocks).mapInArrow(work, schema)


_ARROW = {"double": pa.float64(), "int": pa.int32(), "long": pa.int64(), "bigint": pa.int64(), "boolean": pa.bool_()}


def _column(values: np.ndarray, kind: str) -> pa.Array:
    """An Arrow column; NaN is NULL."""
    return pa.array(values, _ARROW[kind], from_pandas=True)


Fold = Callable[..., tuple[Arrays, np.ndarray]]


def fold_blocks(blocks: DataFrame, fn: Fold, init: Callable[..., np.ndarray], out: Mapping[str, str], cols: Sequence[str],
                id_cols: str | Sequence[str] = ID, pos_col: str = POS, scalars: Sequence[str] = ()) -> DataFrame:
    """Rows (series, position, ``out`` columns) of a recursion over whole series.

    ``init(**scalars)`` is the state before a series' first row; ``fn(p, state, *cols, **scalars)`` runs one
    block from a state and returns its output arrays and its end state (an array of doubles; NaN
    counts as equal to NaN).  Blocks without halo (:func:`gather`); those without rows are
    simply passed over.  Rounds: at most the number of blocks of the longest series, in
    practice as many as the recursion needs to forget its start."""
    keys = _keys(id_cols)
    kinds = {f.name: f.dataType.simpleString() for f in blocks.schema}
    key_schema = ", ".join(f"`{k}` {kinds[k]}" for k in [*keys, BLOCK])
    stored = store(blocks)

    def inputs(b: pa.RecordBatch) -> tuple[list, list, list]:
        p, start, *rest = _block_inputs(b, ["_p", "_start", *cols, *scalars])
        return p, start, rest

    def run(p, start, args):
        named = dict(zip(scalars, args[len(cols):]))
        state = init(**named) if start is None or len(start) == 0 else start
        return fn(p, np.array(state, float), *args[:len(cols)], **named)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            p, start, rest = inputs(b)
            state = [run(p[i], start[i], [r[i] for r in rest])[1].tolist() for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(k) for k in [*keys, BLOCK]] + [b.column("_start"), pa.array(state, pa.list_(pa.float64()))],
                                             [*keys, BLOCK, "_start", "_end"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            p, start, rest = inputs(b)
            for i in range(b.num_rows):
                got, _ = run(p[i], start[i], [r[i] for r in rest])
                yield pa.RecordBatch.from_arrays(
                    [b.column(k).take(pa.array(np.full(len(p[i]), i, np.int64))) for k in keys] + [pa.array(p[i], pa.int64())]
                    + [_column(got[n], t) for n, t in out.items()], [*keys, pos_col, *out])

    end_schema = f"{key_schema}, _start array<double>, _end array<double>"
    nothing = F.array().cast("array<double>")
    before = Window.partitionBy(*keys).orderBy(BLOCK)
    state = store(_bounded(stored.withColumn("_start", nothing)).mapInArrow(ends, end_schema))
    while True:
        want = state.withColumn("_want", F.coalesce(F.lag("_end").over(before), nothing))
        # array equality counts NaN as equal to NaN
        stale = store(want.where(F.col("_want") != F.col("_start")).select(*keys, BLOCK, F.col("_want").alias("_start")))
        if stale.isEmpty():
            break
        redone = _bounded(stored.join(stale, [*keys, BLOCK])).mapInArrow(ends, end_schema)
        state = store(state.join(stale, [*keys, BLOCK], "left_anti").unionByName(redone))
    final = stored.join(state.select(*keys, BLOCK, "_start"), [*keys, BLOCK])
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in keys] + [f"`{pos_col}` long"] + [f"`{n}` {t}" for n, t in out.items()])
    return _bounded(final).mapInArrow(rows, schema)


def fold_summaries(blocks: DataFrame, fn: Callable[..., tuple[np.ndarray, np.ndarray]], init: Callable[..., np.ndarray], cols: Sequence[str],
                   id_cols: str | Sequence[str], scalars: Sequence[str] = ()) -> DataFrame:
    """One row (series, block, ``_sum``, ``_end``) per block of a recursion: ``fn(p, state, *cols, **scalars)`` returns what the
    block adds (an array of doubles) and its end state.  Rounds as in :func:`fold_blocks`; nothing is returned by row."""
    keys = _keys(id_cols)
    kinds = {f.name: f.dataType.simpleString() for f in blocks.schema}
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in [*keys, BLOCK]) + ", _start array<double>, _end array<double>, _sum array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = pa.list_(pa.float64())
        for b in batches:
            if b.num_rows == 0:
                continue
            p, start, *rest = _block_inputs(b, ["_p", "_start", *cols, *scalars])
            ends, sums = [], []
            for i in range(b.num_rows):
                args = [r[i] for r in rest]
                named = dict(zip(scalars, args[len(cols):]))
                state = np.array(init(**named) if len(start[i]) == 0 else start[i], float)
                add, end = fn(p[i], state, *args[:len(cols)], **named)
                ends.append(end.tolist())
                sums.append(add.tolist())
            yield pa.RecordBatch.from_arrays([b.column(k) for k in [*keys, BLOCK]] + [b.column("_start"), pa.array(ends, many), pa.array(sums, many)],
                                             [*keys, BLOCK, "_start", "_end", "_sum"])

    nothing = F.array().cast("array<double>")
    before = Window.partitionBy(*keys).orderBy(BLOCK)
    state = store(_bounded(blocks.withColumn("_start", nothing)).mapInArrow(run, schema))
    while True:
        want = state.withColumn("_want", F.coalesce(F.lag("_end").over(before), nothing))
        stale = want.where(F.col("_want") != F.col("_start")).select(*keys, BLOCK, F.col("_want").alias("_start"))
        if stale.isEmpty():
            return state.select(*keys, BLOCK, "_sum", "_end")
        stale = store(stale)
        redone = _bounded(blocks.join(stale, [*keys, BLOCK])).mapInArrow(run, schema)
        state = store(state.join(stale, [*keys, BLOCK], "left_anti").unionByName(redone))


def ordered_ranks(df: DataFrame, order_cols: Sequence[str], id_cols: str | Sequence[str] = ID, out: str = "_rank",
                  weight: str | None = None, cum: str = "_cum") -> DataFrame:
    """``out`` = 0-based rank of each row within its series by ``order_cols`` and, given ``weight``, ``cum`` =
    sum of the weights of the rows before it.

    Rows are range-partitioned and sorted by (series, order), stored, and ranked from the row counts
    of each (series, partition): one long series spreads over as many partitions as it
    fills.  Rows with equal series and order meet in one partition, so pre-aggregate ties."""
    keys = _keys(id_cols)
    by = [F.col(c) for c in [*keys, *order_cols]]
    x = store(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_row", F.monotonically_increasing_id()))
    x = x.withColumn("_part", F.shiftright("_row", 33))
    w = F.col(weight) if weight else F.lit(1)
    parts = x.groupBy(*keys, "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"), F.sum(w).alias("_w"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(*keys, "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
                           F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_woff"))
    y = x.join(offsets, [*keys, "_part"]).withColumn(out, (F.col("_off") + F.col("_row") - F.col("_first")).cast("long"))
    if weight:
        inner = Window.partitionBy(*keys, "_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
        y = y.withColumn(cum, (F.col("_woff") + F.coalesce(F.sum(w).over(inner), F.lit(0))).cast("long"))
    return y.drop("_row", "_part", "_first", "_off", "_woff")


def group_quantiles(df: DataFrame, value_col: str, qs: Mapping[str, float], id_cols: str | Sequence[str] = ID) -> DataFrame:
    """One row per series: exact interpolated quantiles of ``value_col`` (NULLs left out), ``qs`` naming them.

    Values are counted, ranked on a range-partitioned order and picked by rank, so a series with
    billions of different values needs no more memory than others."""
    keys = _keys(id_cols)
    v = df.where(F.col(value_col).isNotNull()).select(*keys, F.col(value_col).cast("double").alias("_qv"))
    counts = v.groupBy(*keys, "_qv").agg(F.count(F.lit(1)).alias("_qm"))
    ranked = ordered_ranks(counts, ["_qv"], keys, "_qr", "_qm", "_qc")
    ranked = ranked.join(ranked.groupBy(*keys).agg(F.sum("_qm").alias("_qn")), keys)

    def picked(rank: Column) -> Column:
        return F.max(F.when((F.col("_qc") <= rank) & (rank < F.col("_qc") + F.col("_qm")), F.col("_qv")))
    places = {name: F.lit(float(q)) * (F.col("_qn") - 1) for name, q in qs.items()}
    ends = ranked.groupBy(*keys).agg(*[picked(F.floor(r)).alias(f"_a_{n}") for n, r in places.items()],
                                     *[picked(F.ceil(r)).alias(f"_b_{n}") for n, r in places.items()],
                                     *[F.first(r - F.floor(r)).alias(f"_f_{n}") for n, r in places.items()])
    return ends.select(*keys, *[(F.col(f"_a_{n}") + (F.col(f"_b_{n}") - F.col(f"_a_{n}")) * F.col(f"_f_{n}")).alias(n) for n in qs])
