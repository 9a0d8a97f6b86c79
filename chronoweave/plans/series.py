"""Skew-safe building blocks for per-series ordered computations.

A plain ``Window.partitionBy(unique_id)`` sends a whole series to one task.  When one
series holds a large share of all rows that task becomes the job.  The helpers here
keep every shuffle keyed by ``(unique_id, block)`` instead:

* :func:`with_positions` numbers rows inside each series (0-based) from per
  ``(series, time bucket)`` counts, a prefix over that small count table and a
  ``row_number`` inside each bucket.
* :func:`halo_window` evaluates bounded ROWS frames per block of ``block_rows``
  positions; rows near a block edge are copied into the neighbour block (the halo) so
  frames that cross the edge see the same rows as an unsplit window.
* :func:`decay_scan` computes ``s_t = sum_{j<=t} beta^(t-j) v_j`` (EWM / exponential
  smoothing) as a two-level scan: block sums, a carry from the previous blocks, and a
  running sum inside the block.
* :func:`carry_last` forward/backward fills (last/next non-null value) the same way.

With the default block size a short series is a single block, so small inputs cost
one extra aggregation over a plain window.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from chronoweave.panel import DS, ID

POS = "_pos"
DEFAULT_BLOCK_ROWS = 1 << 16
DEFAULT_BUCKET_DAYS = 31


def _keys(id_cols: str | Sequence[str]) -> list[str]:
    return [id_cols] if isinstance(id_cols, str) else list(id_cols)


def time_bucket(ds: Column, bucket_days: int = DEFAULT_BUCKET_DAYS) -> Column:
    """Calendar bucket of ``bucket_days`` days (time-zone free)."""
    return F.floor(F.datediff(F.to_date(ds), F.lit("1970-01-01").cast("date")) / F.lit(bucket_days))


EPOCH = "1970-01-05 00:00:00"  # a Monday, so weekly steps align with Monday weeks


def regular_positions(df: DataFrame, freq: str = "D", time_col: str = DS, pos_col: str = POS) -> DataFrame:
    """Positions for a *regular* grid: whole ``freq`` steps since a fixed epoch.

    A pure column expression (no shuffle).  On a gap-free series consecutive rows differ
    by exactly one, which is all the block plans need (ordering, offsets inside blocks,
    dense block numbers); absolute values are never used as a row count."""
    from chronoweave.functions.timekeys import steps_between
    return df.withColumn(pos_col, steps_between(F.lit(EPOCH).cast("timestamp_ntz"), F.col(time_col), freq))


def positioned(df: DataFrame, id_cols: str | Sequence[str] = ID, freq: str | None = None,
               pos_col: str = POS) -> tuple[DataFrame, bool]:
    """Add positions unless present: epoch steps when ``freq`` says the grid is regular,
    else ranks from :func:`with_positions`.  Returns ``(df, added)``."""
    if pos_col in df.columns:
        return df, False
    if freq:
        return regular_positions(df, freq, pos_col=pos_col), True
    return with_positions(df, id_cols, pos_col=pos_col), True


def with_positions(df: DataFrame, id_cols: str | Sequence[str] = ID, time_col: str = DS,
                   bucket_days: int = DEFAULT_BUCKET_DAYS, pos_col: str = POS) -> DataFrame:
    """Add ``pos_col`` = 0-based rank of each row inside its series, ordered by ``time_col``."""
    keys = _keys(id_cols)
    x = df.withColumn("_tb", time_bucket(F.col(time_col), bucket_days))
    counts = x.groupBy(*keys, "_tb").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_tb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_tb", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inner = Window.partitionBy(*keys, "_tb").orderBy(time_col)
    return (x.join(offsets, [*keys, "_tb"])
             .withColumn(pos_col, (F.col("_off") + F.row_number().over(inner) - 1).cast("long"))
             .drop("_tb", "_off"))


def halo_window(df: DataFrame, back: int, ahead: int, build: Callable[[WindowSpec], dict[str, Column]],
                id_cols: str | Sequence[str] = ID, pos_col: str = POS,
                block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Evaluate window columns whose ROWS frames reach ``back`` rows back and ``ahead`` ahead.

    ``build(w)`` receives a spec partitioned by ``(series, block)`` and ordered by position
    and returns the new columns.  Frames must stay within ``[-back, ahead]``.
    """
    keys = _keys(id_cols)
    L = int(block_rows)
    if back > L or ahead > L:
        raise ValueError("frame wider than a block; raise block_rows")
    own = F.floor(F.col(pos_col) / L)
    off = F.col(pos_col) - own * L
    targets = F.array(own,
                      F.when(off >= L - back, own + 1) if back > 0 else F.lit(None).cast("long"),
                      F.when(off < ahead, own - 1) if ahead > 0 else F.lit(None).cast("long"))
    x = (df.withColumn("_own", own)
           .withColumn("_blk", F.explode(F.filter(targets, lambda t: t.isNotNull()))))
    w = Window.partitionBy(*keys, "_blk").orderBy(pos_col)
    return x.withColumns(build(w)).where(F.col("_blk") == F.col("_own")).drop("_blk", "_own")


def decay_block(betas: Sequence[float], block_rows: int = DEFAULT_BLOCK_ROWS) -> int:
    """Block length of :func:`decay_scan`: ``beta^-off`` stays below e^300 for every beta."""
    return max(1, min(int(block_rows), min(int(300.0 / -math.log(b)) for b in betas)))


def decay_carries(beta: float, length: int) -> list[float]:
    """Weights of the previous blocks' sums, newest first, in the state entering a block of :func:`decay_scan`."""
    k_max = 1 + math.ceil(83.0 / (length * -math.log(beta)))
    return [f for k in range(1, k_max + 1) if (f := beta ** (k * length)) > 0.0]


def decay_scan(df: DataFrame, value: Column | dict[str, tuple[Column, float]], beta: float | None = None,
               out: str | None = None, id_cols: str | Sequence[str] = ID, pos_col: str = POS,
               block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``out_t = sum_{j<=t} beta^(t-j) * value_j`` along each series, 0 <= beta < 1.

    Several scans share one pass when ``value`` is a dict ``out -> (value, beta)``.
    Inside a block the sum is ``beta^off_t * cumsum(beta^-off_j * v_j)``; the block length
    is capped so ``beta^-off`` stays below e^300 for every beta.  The state entering block
    c is ``sum_k beta^(kL) * T_(c-k)`` over the previous blocks' sums ``T``; blocks whose
    weight is below 1e-36 of the newest are left out (they cannot change a double).
    """
    keys = _keys(id_cols)
    specs = value if isinstance(value, dict) else {out: (value, beta)}
    specs = {o: (v, float(b)) for o, (v, b) in specs.items()}
    x = df
    for o, (v, b) in list(specs.items()):
        if b <= 0.0:
            x = x.withColumn(o, v)
            del specs[o]
    if not specs:
        return x
    L = decay_block([b for _, b in specs.values()], block_rows)
    x = (x.withColumn("_sb", F.floor(F.col(pos_col) / L))
          .withColumn("_so", F.col(pos_col) - F.col("_sb") * L))
    names = list(specs)
    x = x.withColumns({f"_sw{i}": F.pow(F.lit(specs[o][1]), -F.col("_so")) * specs[o][0] for i, o in enumerate(names)})
    blocks = x.groupBy(*keys, "_sb").agg(*[F.sum(f"_sw{i}").alias(f"_sT{i}") for i in range(len(names))])
    # one SQL text per carry: building the same sum from column objects costs thousands of
    # driver calls for a grid of parameters
    over = f"over (partition by {', '.join(f'`{k}`' for k in keys)}, _blk order by _sb)"
    carries, reach = {}, 1
    for i, o in enumerate(names):
        terms = [f"{f!r}D * coalesce(lag(_sT{i}, {k}) {over}, 0.0D)" for k, f in enumerate(decay_carries(specs[o][1], L), 1)]
        carries[f"_sS{i}"] = F.expr(" + ".join(["0.0D", *terms]))
        reach = max(reach, len(terms))
    # the carry looks a few blocks back only, so the block table is split with a halo, too
    blocks = halo_window(blocks, reach, 0, lambda w: carries, keys, "_sb").select(*keys, "_sb", *carries)
    run = Window.partitionBy(*keys, "_sb").orderBy(pos_col).rowsBetween(Window.unboundedPreceding, 0)
    y = x.join(blocks, [*keys, "_sb"]).withColumns({
        o: F.pow(F.lit(specs[o][1]), F.col("_so")) * (F.col(f"_sS{i}") + F.sum(f"_sw{i}").over(run))
        for i, o in enumerate(names)})
    return y.drop("_sb", "_so", *[f"_sw{i}" for i in range(len(names))], *[f"_sS{i}" for i in range(len(names))])


def carry_last(df: DataFrame, value_col: str, out: str, forward: bool = True,
               id_cols: str | Sequence[str] = ID, pos_col: str = POS,
               block_rows: int = DEFAULT_BLOCK_ROWS, inclusive: bool = True) -> DataFrame:
    """Last non-null ``value_col`` at or before (``forward``) / at or after each row
    (strictly before / after when not ``inclusive``)."""
    keys = _keys(id_cols)
    L = int(block_rows)
    x = df.withColumn("_cb", F.floor(F.col(pos_col) / L))
    if forward:
        inner = Window.partitionBy(*keys, "_cb").orderBy(pos_col).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        within = F.last(value_col, ignorenulls=True).over(inner)
        edge = F.max_by(value_col, F.when(F.col(value_col).isNotNull(), F.col(pos_col)))
        prior = Window.partitionBy(*keys).orderBy("_cb").rowsBetween(Window.unboundedPreceding, -1)
        carried = F.last("_ce", ignorenulls=True).over(prior)
    else:
        inner = Window.partitionBy(*keys, "_cb").orderBy(pos_col).rowsBetween(0 if inclusive else 1, Window.unboundedFollowing)
        within = F.first(value_col, ignorenulls=True).over(inner)
        edge = F.min_by(value_col, F.when(F.col(value_col).isNotNull(), F.col(pos_col)))
        after = Window.partitionBy(*keys).orderBy("_cb").rowsBetween(1, Window.unboundedFollowing)
        carried = F.first("_ce", ignorenulls=True).over(after)
    blocks = x.groupBy(*keys, "_cb").agg(edge.alias("_ce"))
    blocks = blocks.select(*keys, "_cb", carried.alias("_cc"))
    return (x.join(blocks, [*keys, "_cb"])
             .withColumn(out, F.coalesce(within, F.col("_cc")))
             .drop("_cb", "_cc"))


def series_stats(df: DataFrame, id_cols: str | Sequence[str] = ID, time_col: str = DS, value_col: str | None = None) -> DataFrame:
    """Per-series first/last time and row count (partial aggregate, skew-safe)."""
    keys = _keys(id_cols)
    aggs = [F.min(time_col).alias("_first"), F.max(time_col).alias("_last"), F.count(F.lit(1)).alias("_n")]
    if value_col:
        aggs += [F.min_by(value_col, time_col).alias("_y_first"), F.max_by(value_col, time_col).alias("_y_last")]
    return df.groupBy(*keys).agg(*aggs)


def prefix_sums(df: DataFrame, values: dict[str, Column], id_cols: str | Sequence[str] = ID,
                pos_col: str = POS, block_rows: int = DEFAULT_BLOCK_ROWS, lag: int = 0) -> DataFrame:
    """Running sums ``out_t = sum_{j <= t - lag} v_j`` for each ``out: v`` (expanding frames).

    Block totals, an exclusive prefix over the (small) block table, and a running sum
    inside the block.  ``lag`` > 0 shifts the frame end back (``rowsBetween(-inf, -lag)``)
    by evaluating the sums at position ``t - lag`` and moving them forward with a halo
    window of ``lag`` rows."""
    keys = _keys(id_cols)
    L = int(block_rows)
    x = df.withColumn("_pb", F.floor(F.col(pos_col) / L))
    for i, v in enumerate(values.values()):
        x = x.withColumn(f"_pv{i}", v)
    blocks = x.groupBy(*keys, "_pb").agg(*[F.sum(f"_pv{i}").alias(f"_pt{i}") for i in range(len(values))])
    before = Window.partitionBy(*keys).orderBy("_pb").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*keys, "_pb", *[F.coalesce(F.sum(f"_pt{i}").over(before), F.lit(0)).alias(f"_pc{i}")
                                           for i in range(len(values))])
    run = Window.partitionBy(*keys, "_pb").orderBy(pos_col).rowsBetween(Window.unboundedPreceding, 0)
    tmp = {name if lag == 0 else f"_ps{i}": F.col(f"_pc{i}") + F.sum(f"_pv{i}").over(run)
           for i, name in enumerate(values)}
    y = x.join(blocks, [*keys, "_pb"]).withColumns(tmp)
    y = y.drop("_pb", *[f"_pv{i}" for i in range(len(values))], *[f"_pc{i}" for i in range(len(values))])
    if lag == 0:
        return y
    names = list(values)
    return halo_window(y, lag, 0, lambda w: {n: F.lag(f"_ps{i}", lag).over(w) for i, n in enumerate(names)},
                       keys, pos_col, block_rows).drop(*[f"_ps{i}" for i in range(len(names))])


def forward_scan(df: DataFrame, last: dict[str, str] | None = None, sums: dict[str, Column] | None = None,
                 id_cols: str | Sequence[str] = ID, pos_col: str = POS, block_rows: int = DEFAULT_BLOCK_ROWS,
                 last_inclusive: bool = False) -> DataFrame:
    """One block pass for several forward scans at once: ``last`` maps output -> column
    (last non-null value before the row, or at/before when ``last_inclusive``) and
    ``sums`` maps output -> value (running sum up to and including the row).  One block
    aggregate, one join and one window spec serve all of them."""
    keys = _keys(id_cols)
    last, sums = last or {}, sums or {}
    L = int(block_rows)
    x = df.withColumn("_fb", F.floor(F.col(pos_col) / L))
    for i, v in enumerate(sums.values()):
        x = x.withColumn(f"_fv{i}", v)
    aggs = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(pos_col))).alias(f"_fe{i}") for i, c in enumerate(last.values())]
    aggs += [F.sum(f"_fv{i}").alias(f"_ft{i}") for i in range(len(sums))]
    blocks = x.groupBy(*keys, "_fb").agg(*aggs)
    prior = Window.partitionBy(*keys).orderBy("_fb").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*keys, "_fb",
                           *[F.last(f"_fe{i}", ignorenulls=True).over(prior).alias(f"_fc{i}") for i in range(len(last))],
                           *[F.coalesce(F.sum(f"_ft{i}").over(prior), F.lit(0)).alias(f"_fs{i}") for i in range(len(sums))])
    w = Window.partitionBy(*keys, "_fb").orderBy(pos_col)
    wl = w.rowsBetween(Window.unboundedPreceding, 0 if last_inclusive else -1)
    ws = w.rowsBetween(Window.unboundedPreceding, 0)
    cols = {o: F.coalesce(F.last(c, ignorenulls=True).over(wl), F.col(f"_fc{i}")) for i, (o, c) in enumerate(last.items())}
    cols.update({o: F.col(f"_fs{i}") + F.sum(f"_fv{i}").over(ws) for i, o in enumerate(sums)})
    y = x.join(blocks, [*keys, "_fb"]).withColumns(cols)
    return y.drop("_fb", *[f"_fv{i}" for i in range(len(sums))], *[f"_fc{i}" for i in range(len(last))],
                  *[f"_fs{i}" for i in range(len(sums))])
