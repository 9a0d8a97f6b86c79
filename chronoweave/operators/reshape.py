"""Projection, reshaping, cleaning and joins."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.panel import DS, ID, Y
from chronoweave.plans.series import _keys

KEYS = (ID, DS, Y)


def select_columns(df: DataFrame, regex: str | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keep the key columns plus columns matching ``regex`` (keys only when None)."""
    pat = re.compile(regex) if regex else None
    extra = [c for c in df.columns if c not in keys and pat is not None and pat.search(c)]
    return df.select(*[c for c in keys if c in df.columns], *extra)


def model_columns(df: DataFrame, non_model: Sequence[str] = (ID, DS, Y, "cutoff")) -> list[str]:
    """Model columns of a wide forecast frame (anchored names; interval columns
    ``<model>-lo-<L>`` / ``-hi-`` excluded)."""
    iv = re.compile(r"-(lo|hi)-\d+(\.\d+)?$")
    return [c for c in df.columns if c not in non_model and not iv.search(c)]


def reindex(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Project in the given order, creating missing columns as NULL."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in columns])


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None,
         var_name: str = "variable", value_name: str = "value") -> DataFrame:
    """Wide -> long (``unpivot``)."""
    values = values or [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), list(values), var_name, value_name)


def pivot_wider(df: DataFrame, index: Sequence[str], names_from: str, values_from: str,
                levels: Sequence[object], agg: str = "first") -> DataFrame:
    """Long -> wide with an explicit level list (no extra pass to discover levels)."""
    fn = {"first": F.first, "sum": F.sum, "mean": F.avg, "max": F.max, "min": F.min}[agg]
    return df.groupBy(*index).pivot(names_from, list(levels)).agg(fn(values_from))


def filter_by_time(df: DataFrame, start: str | None = None, end: str | None = None, time_col: str = DS) -> DataFrame:
    """Inclusive partial-date bounds (``"2019-12"`` .. ``"2019"``): the end bound is
    expanded to the first instant after its period and compared with ``<``.  Bounds are
    literals, so the predicate reaches the Parquet scan."""
    from chronoweave.functions.timekeys import expand_bound, ts_lit
    c = F.col(time_col)
    cond = F.lit(True)
    if start:
        cond = cond & (c >= ts_lit(expand_bound(start, False)))
    if end:
        cond = cond & (c < ts_lit(expand_bound(end, True)))
    return df.where(cond)


def between_time(c: Column, start: str, end: str) -> Column:
    """Inclusive boolean ``start <= c <= end`` with partial-date expansion."""
    from chronoweave.functions.timekeys import expand_bound, ts_lit
    return (c >= ts_lit(expand_bound(start, False))) & (c < ts_lit(expand_bound(end, True)))


def tail_per_series(df: DataFrame, n: int, id_cols: str | Sequence[str] = ID) -> DataFrame:
    """Last ``n`` rows of every series (positions from per-series counts)."""
    from chronoweave.plans.series import POS, with_positions
    keys = _keys(id_cols)
    cnt = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return with_positions(df, keys).join(cnt, keys).where(F.col(POS) >= F.col("_n") - n).drop(POS, "_n")


def head_per_series(df: DataFrame, n: int, id_cols: str | Sequence[str] = ID) -> DataFrame:
    """First ``n`` rows of every series."""
    from chronoweave.plans.series import POS, with_positions
    keys = _keys(id_cols)
    return with_positions(df, keys).where(F.col(POS) < n).drop(POS)


def lump_levels(c: Column, keep: Sequence[object], other: object) -> Column:
    """Recode every level outside ``keep`` to ``other``."""
    return F.when(c.isin(list(keep)), c).otherwise(F.lit(other))


def century_repair(text: Column, fmt: str = "dd-MM-yy HH:mm", max_year: int = 2019) -> Column:
    """Parse ``dd-MM-yy HH:mm`` and move years after ``max_year`` back a century."""
    ts = F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")
    return F.when(F.year(ts) > max_year, F.timestamp_add("YEAR", F.lit(-100), ts).cast("timestamp_ntz")).otherwise(ts)


def strip_prefix_index(c: Column, prefix: str = "V", offset: int = -1) -> Column:
    """``V12`` -> ``12 + offset`` (column position to time index)."""
    return F.regexp_replace(c, f"^{re.escape(prefix)}", "").cast("int") + F.lit(offset)


def sample_series(df: DataFrame, strata: str, n: int, seed: int = 123, id_col: str = ID) -> DataFrame:
    """Deterministic sample of ``n`` series per stratum (hash order, not ``rand``)."""
    ids = df.select(strata, id_col).distinct().withColumn("_h", F.xxhash64(F.col(id_col), F.lit(seed)))
    # two phases: the n smallest hashes of each (stratum, hash bucket), then of the stratum,
    # so a stratum holding most series is not ranked in one task
    w1 = Window.partitionBy(strata, F.pmod(F.col("_h"), F.lit(64))).orderBy("_h", id_col)
    cand = ids.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= n).drop("_r")
    w = Window.partitionBy(strata).orderBy("_h", id_col)
    return cand.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r", "_h")


def to_intermittent(df: DataFrame, prop_of_zeros: float = 0.9, seed: int = 1992, value_col: str = Y,
                    id_cols: str | Sequence[str] = ID) -> DataFrame:
    """Set a hash-chosen share ``prop_of_zeros`` of the values to 0 (first row kept)."""
    keys = _keys(id_cols)
    h = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.col(DS), F.lit(seed)), F.lit(1_000_000))
    stats = df.groupBy(*keys).agg(F.min(DS).alias("_first"))
    return (df.join(stats, keys)
              .withColumn(value_col, F.when((F.col(DS) != F.col("_first")) & (h < int(prop_of_zeros * 1_000_000)), F.lit(0.0))
                          .otherwise(F.col(value_col)))
              .drop("_first"))


def rename_by_pattern(df: DataFrame, pattern: str, repl: str = "") -> DataFrame:
    """Rename columns by regex substitution (e.g. strip ``-median``)."""
    return df.withColumnsRenamed({c: re.sub(pattern, repl, c) for c in df.columns if re.search(pattern, c)})


def drop_by_pattern(df: DataFrame, pattern: str) -> DataFrame:
    """Drop columns whose names match ``pattern``."""
    return df.drop(*[c for c in df.columns if re.search(pattern, c)])


# ---- joins -------------------------------------------------------------------------

def left_join_fill(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
                   fill: dict[str, object]) -> DataFrame:
    """Left equi-join on differently named time keys, then constant-fill."""
    r = right.withColumnRenamed(right_on, "_rk")
    return left.join(r, F.col(left_on) == F.col("_rk"), "left").drop("_rk").fillna(fill)


def semi_join(df: DataFrame, keys_df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``keys_df`` (``%in%``)."""
    return df.join(keys_df.select(*on).distinct(), list(on), "left_semi")
