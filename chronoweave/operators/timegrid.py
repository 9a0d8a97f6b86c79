"""Time-grid generation: padding, common grids, future frames, nested splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.functions.timekeys import add_steps, steps_between, ts_lit
from chronoweave.panel import DS, ID, Y, freq_interval
from chronoweave.plans.series import _keys

CHUNK_STEPS = 4096


def _grid(bounds: DataFrame, keys: list[str], lo: str, hi: str, freq: str, chunk_steps: int = CHUNK_STEPS) -> DataFrame:
    """Explode ``[lo, hi]`` per key into one row per ``freq`` step.

    Two levels: first one row per chunk of ``chunk_steps`` steps, re-hashed on
    ``(key, chunk)``, then the steps of each chunk.  A long series is therefore generated
    by many tasks, not by the one task that holds its bounds row.
    """
    step = freq_interval(freq)
    n_chunks = F.floor(steps_between(F.col(lo), F.col(hi), freq) / chunk_steps)
    # an explicit partition count: the chunk table is tiny, so an adaptive shuffle would
    # coalesce it into one task and the (large) step expansion below would run there
    n_parts = int(bounds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = (bounds.select(*keys, lo, hi, F.explode(F.sequence(F.lit(0), n_chunks.cast("int"))).alias("_c"))
                    .repartition(n_parts, *keys, "_c"))
    c_lo = add_steps(F.col(lo), F.col("_c") * chunk_steps, freq)
    c_hi = F.least(add_steps(F.col(lo), F.col("_c") * chunk_steps + (chunk_steps - 1), freq), F.col(hi))
    return chunks.select(*keys, F.explode(F.sequence(c_lo, c_hi, step)).alias(DS))


def pad_by_time(df: DataFrame, freq: str = "D", id_cols: str | Sequence[str] = ID, time_col: str = DS,
                start: str | None = None, end: str | None = None,
                fill: dict[str, object] | None = None) -> DataFrame:
    """G01 ``pad_by_time``: complete each series' regular grid between its first and last
    time (or the given ``start``/``end``); new rows carry NULLs unless ``fill`` gives
    a value per column.  The grid joins the data on ``(series, ds)``."""
    keys = _keys(id_cols)
    x = df if time_col == DS else df.withColumnRenamed(time_col, DS)
    bounds = x.groupBy(*keys).agg(F.min(DS).alias("_lo"), F.max(DS).alias("_hi"))
    if start is not None:
        bounds = bounds.withColumn("_lo", ts_lit(start))
    if end is not None:
        bounds = bounds.withColumn("_hi", ts_lit(end))
    grid = _grid(bounds, keys, "_lo", "_hi", freq)
    out = grid.join(x, [*keys, DS], "left")
    if fill:
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})
    if time_col != DS:
        out = out.withColumnRenamed(DS, time_col)
    return out.select(*df.columns)


def common_grid(df: DataFrame, freq: str = "D", id_cols: str | Sequence[str] = ID,
                fill: dict[str, object] | None = None) -> DataFrame:
    """One grid from the global first to the global last time for every series.

    The grid is never shuffled or joined: the data rows and one mark for each ``(series, chunk)`` of
    ``CHUNK_STEPS`` steps are sorted inside their chunk, and each row fills the steps up to the next one."""
    keys = _keys(id_cols)
    span = df.agg(F.struct(F.min(DS).alias("lo"), F.max(DS).alias("hi")).alias("_s")).scalar()
    lo, hi = span.getField("lo"), span.getField("hi")

    def at(k: Column) -> Column:
        c = F.floor(k / CHUNK_STEPS) * CHUNK_STEPS
        return add_steps(add_steps(lo, c, freq), k - c, freq)

    def place(ds: Column) -> Column:
        """Step of a time on the grid, NULL off it (whole steps fall one short at clamped month ends)."""
        k = steps_between(lo, ds, freq)
        return F.when(at(k) == ds, k).when(at(k + 1) == ds, k + 1)

    whole = steps_between(lo, hi, freq)
    last = F.when(at(whole + 1) <= hi, whole + 1).otherwise(whole)
    others = [c for c in df.columns if c not in (*keys, DS)]
    data = df.select(*keys, *others, place(F.col(DS)).alias("_k"), F.lit(1).alias("_data"))
    for c in ("_k", *keys):  # a NULL key has a grid without data
        data = data.where(F.col(c).isNotNull())
    marks = (df.select(*keys).distinct().select(*keys, F.explode(F.sequence(F.lit(0), F.floor(last / CHUNK_STEPS).cast("int"))).alias("_c"))
               .select(*keys, (F.col("_c") * F.lit(CHUNK_STEPS).cast("long")).alias("_k"), F.lit(0).alias("_data")))
    # an explicit partition count, as in _grid: the rows are few before they are filled
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = (data.unionByName(marks, allowMissingColumns=True).withColumn("_c", F.floor(F.col("_k") / CHUNK_STEPS))
             .repartition(n_parts, *keys, "_c"))
    following = F.lead("_k").over(Window.partitionBy(*keys, "_c").orderBy("_k", "_data"))
    until = F.coalesce(following, F.least((F.col("_c") + 1) * CHUNK_STEPS, last + 1)) - 1
    x = x.withColumn("_to", F.when(F.col("_data") == 1, F.greatest(until, F.col("_k"))).otherwise(until))
    x = x.withColumn("_i", F.explode(F.when(F.col("_to") >= F.col("_k"), F.sequence("_k", "_to"))))
    out = x.select(*keys, at(F.col("_i")).alias(DS), *[F.when(F.col("_i") == F.col("_k"), F.col(c)).alias(c) for c in others])
    if fill:
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})
    return out.select(*df.columns)


def future_frame(df: DataFrame, h: int, freq: str = "D", id_cols: str | Sequence[str] = ID,
                 bind: bool = True) -> DataFrame:
    """G03/G04 ``future_frame``: ``h`` steps after each series' last time, value columns NULL.

    With ``bind`` the history is returned too (``unionByName``)."""
    keys = _keys(id_cols)
    last = df.groupBy(*keys).agg(F.max(DS).alias("_last"))
    fut = last.select(*keys, F.explode(F.sequence(add_steps(F.col("_last"), 1, freq),
                                                   add_steps(F.col("_last"), h, freq),
                                                   freq_interval(freq))).alias(DS))
    return df.unionByName(fut, allowMissingColumns=True) if bind else fut


def future_length(length: str | int, freq: str = "D") -> int:
    """Number of ``freq`` steps in a length given as a count or text (``"2 months"``)."""
    if isinstance(length, int):
        return length
    import re
    m = re.match(r"^\s*(\d+)\s*(hour|day|week|month|quarter|year)s?\s*$", length.lower())
    if not m:
        raise ValueError(length)
    k, unit = int(m.group(1)), m.group(2)
    per_day = {"H": 24, "D": 1}
    days = {"hour": 1 / 24, "day": 1, "week": 7, "month": 30.4375, "quarter": 91.3125, "year": 365.25}[unit]
    if freq in per_day:
        return int(round(k * days * per_day[freq]))
    if freq == "W":
        return int(round(k * days / 7))
    months = {"month": 1, "quarter": 3, "year": 12}.get(unit)
    if months is None:
        raise ValueError("sub-month length for a monthly series")
    return k * months // {"M": 1, "Q": 3, "Y": 12}[freq]


def nest_split(df: DataFrame, length_test: int, id_cols: str | Sequence[str] = ID) -> DataFrame:
    """G05 ``nest_timeseries`` + ``split_nested_timeseries``: label each row ``future``
    (NULL target), ``test`` (last ``length_test`` actual rows) or ``train``.

    The position from the end comes from per-series counts, not from a whole-series window.
    """
    from chronoweave.plans.series import with_positions
    keys = _keys(id_cols)
    actual = df.where(F.col(Y).isNotNull())
    n = actual.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    pos = with_positions(actual, keys).join(n, keys)
    labelled = pos.withColumn("set", F.when(F.col("_pos") >= F.col("_n") - length_test, "test").otherwise("train"))
    fut = df.where(F.col(Y).isNull()).withColumn("set", F.lit("future"))
    return labelled.drop("_pos", "_n").unionByName(fut)
