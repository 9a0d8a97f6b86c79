"""Time-bucketed aggregation.

Buckets are *floors* (``date_trunc`` / epoch-aligned multi-unit buckets, Monday weeks),
documented where pandas labels buckets by their end.  All aggregations are hash
aggregates with map-side partial aggregation; quantiles use a mergeable sketch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.aggs import agg_expr, quantile
from chronoweave.panel import DS, ID, Y, floor_time
from chronoweave.plans.series import _keys

AggSpec = str | Callable[[str], Column]


def summarize_by_time(df: DataFrame, time_col: str, value_cols: str | Sequence[str], freq: str = "D",
                      agg: AggSpec | Sequence[AggSpec] = "sum", by: Sequence[str] = (),
                      out_time: str = DS, digits: int | None = None) -> DataFrame:
    """Aggregate ``value_cols`` per ``freq`` bucket (and ``by`` groups).

    One aggregate keeps the column name; several produce ``<col>_<agg>``.  ``freq`` may be
    multi-unit (``"2W"``), which covers ``apply_by_time``."""
    vals = [value_cols] if isinstance(value_cols, str) else list(value_cols)
    aggs = [agg] if (isinstance(agg, str) or callable(agg)) else list(agg)
    single = len(aggs) == 1
    exprs = []
    for c in vals:
        for a in aggs:
            e = agg_expr(a, c)
            if digits is not None:
                e = F.round(e, digits)
            name = c if single else f"{c}_{a if isinstance(a, str) else getattr(a, '__name__', 'fn')}"
            exprs.append(e.alias(name))
    return df.groupBy(*by, floor_time(F.col(time_col), freq).alias(out_time)).agg(*exprs)


def count_by_time(df: DataFrame, time_col: str, freq: str = "D", by: Sequence[str] = (), out: str = "n") -> DataFrame:
    """Rows per bucket."""
    return df.groupBy(*by, floor_time(F.col(time_col), freq).alias(DS)).agg(F.count(F.lit(1)).alias(out))


def mutate_by_time(df: DataFrame, value_col: str, freq: str, agg: AggSpec = "mean",
                   id_cols: str | Sequence[str] = ID, out: str | None = None) -> DataFrame:
    """Attach the bucket statistic to every row (aggregate + join, not a window, so a
    hot bucket is pre-aggregated map-side)."""
    keys = _keys(id_cols)
    out = out or f"{value_col}_{agg if isinstance(agg, str) else 'fn'}"
    x = df.withColumn("_bkt", floor_time(F.col(DS), freq))
    stat = x.groupBy(*keys, "_bkt").agg(agg_expr(agg, value_col).alias(out))
    return x.join(stat, [*keys, "_bkt"]).drop("_bkt")


def spread_to_daily(weekly: DataFrame, id_cols: str | Sequence[str] = ID) -> DataFrame:
    """Low -> high frequency: each weekly total spread evenly over its 7 days."""
    keys = _keys(id_cols)
    days = F.sequence(F.col(DS), F.timestamp_add("DAY", F.lit(6), F.col(DS)).cast("timestamp_ntz"), F.expr("INTERVAL 1 day"))
    return weekly.select(*keys, F.explode(days).alias("_d"), (F.col(Y) / 7.0).alias(Y)).withColumnRenamed("_d", DS)


def boxplot_stats(df: DataFrame, value_col: str, freq: str, by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Min, q1, median, q3, max and the number of values beyond 1.5*IQR per bucket."""
    x = df.withColumn("_bkt", floor_time(F.col(DS), freq))
    g = [*by, "_bkt"]
    s = x.groupBy(*g).agg(F.min(value_col).alias("ymin"), quantile(value_col, [0.25, 0.5, 0.75]).alias("_q"),
                          F.max(value_col).alias("ymax"))
    s = s.select(*g, "ymin", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"), "ymax")
    fence = x.join(s, g).where((F.col(value_col) < F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) |
                                (F.col(value_col) > F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))))
    outl = fence.groupBy(*g).agg(F.count(F.lit(1)).alias("n_outliers"))
    return (s.join(outl, g, "left").withColumn("n_outliers", F.coalesce("n_outliers", F.lit(0)))
             .withColumnRenamed("_bkt", DS))


def seasonal_diagnostics(df: DataFrame, value_col: str = Y, features: Sequence[str] = ("hour", "wday", "week", "month", "quarter", "year"),
                         by: Sequence[str] = (ID,)) -> DataFrame:
    """Distribution of the value by calendar feature level: long
    ``(*by, feature, level, n, q1, median, q3, mean)``."""
    from chronoweave.functions.calendar import calendar_column
    lv = F.stack(F.lit(len(features)), *[x for f in features for x in (F.lit(f), calendar_column(F.col(DS), f).cast("int"))])
    long = df.select(*by, value_col, lv.alias("feature", "level"))
    return long.groupBy(*by, "feature", "level").agg(
        F.count(F.lit(1)).alias("n"), quantile(value_col, [0.25, 0.5, 0.75]).alias("_q"), F.avg(value_col).alias("mean")
    ).select(*by, "feature", "level", "n", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
             F.col("_q")[2].alias("q3"), F.round("mean", 6).alias("mean"))


def value_counts(df: DataFrame, cols: Sequence[str], out: str = "n") -> DataFrame:
    """Frequency table."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(out))


def temporal_hierarchy(df: DataFrame, levels: Sequence[str] = ("D", "W", "2W", "M", "Q", "Y"),
                       value_col: str = Y, id_cols: str | Sequence[str] = ID) -> DataFrame:
    """The same series summed at several frequencies, stacked with a ``level`` column."""
    keys = _keys(id_cols)
    parts = [df.groupBy(*keys, floor_time(F.col(DS), lv).alias(DS)).agg(F.sum(value_col).alias(value_col))
               .withColumn("level", F.lit(lv)) for lv in levels]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
