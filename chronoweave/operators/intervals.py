"""Prediction intervals (L01-L06) from backtest or test residuals.

Quantiles of absolute errors are grouped by ``(series, model, step)``; they use the
mergeable quantile sketch, so residual tables of any size aggregate map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.aggs import quantile
from chronoweave.operators.baselines import MODEL, STEP, YHAT
from chronoweave.panel import DS, ID, Y

NORMAL_Z = {80: 1.2815515655446004, 90: 1.6448536269514722, 95: 1.959963984540054, 99: 2.5758293035489004}


def conformal_error(cv: DataFrame, future: DataFrame, levels: Sequence[int] = (80, 95), digits: int = 6) -> DataFrame:
    """L01 ``conformal_error``: for each (series, model, step) the ``level`` quantile of the
    absolute CV errors; interval = forecast +/- that quantile.  ``future`` carries ``step``."""
    q = cv.groupBy(ID, MODEL, STEP).agg(*[quantile(F.abs(F.col(YHAT) - F.col(Y)), lv / 100.0).alias(f"_q{lv}") for lv in levels])
    x = future.join(q, [ID, MODEL, STEP], "left")
    cols = {}
    for lv in levels:
        cols[f"lo_{lv}"] = F.round(F.col(YHAT) - F.col(f"_q{lv}"), digits)
        cols[f"hi_{lv}"] = F.round(F.col(YHAT) + F.col(f"_q{lv}"), digits)
    return x.withColumns(cols).drop(*[f"_q{lv}" for lv in levels])


def conformal_distribution(cv: DataFrame, future: DataFrame, levels: Sequence[int] = (80, 95), digits: int = 6) -> DataFrame:
    """L02 ``conformal_distribution``: quantiles of the paths ``y_hat +/- |e|`` at
    ``(1 -/+ level)/2``."""
    e = cv.select(ID, MODEL, STEP, F.abs(F.col(YHAT) - F.col(Y)).alias("_a"))
    paths = e.select(ID, MODEL, STEP, F.explode(F.array(F.col("_a"), -F.col("_a"))).alias("_d"))
    qs = []
    for lv in levels:
        qs += [quantile("_d", (1 - lv / 100.0) / 2).alias(f"_lo{lv}"), quantile("_d", (1 + lv / 100.0) / 2).alias(f"_hi{lv}")]
    q = paths.groupBy(ID, MODEL, STEP).agg(*qs)
    x = future.join(q, [ID, MODEL, STEP], "left")
    cols = {}
    for lv in levels:
        cols[f"lo_{lv}"] = F.round(F.col(YHAT) + F.col(f"_lo{lv}"), digits)
        cols[f"hi_{lv}"] = F.round(F.col(YHAT) + F.col(f"_hi{lv}"), digits)
    return x.withColumns(cols).drop(*[c for lv in levels for c in (f"_lo{lv}", f"_hi{lv}")])


def split_conformal(residuals: DataFrame, future: DataFrame, levels: Sequence[int] = (80, 95), by_id: bool = True,
                    digits: int = 6) -> DataFrame:
    """Finite-sample split conformal: the ``ceil((n+1)*level)``-th smallest absolute
    test residual, i.e. the discrete quantile at ``min(1, ceil((n+1) level)/n)``."""
    g = [ID, MODEL] if by_id else [MODEL]
    r = residuals.withColumn("_a", F.abs(F.col(YHAT) - F.col(Y)))
    n = r.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"))
    r = r.join(n, g)
    # the rank depends on the group size, so the k-th value is picked by rank; residual
    # groups are test windows (bounded by the horizon times the number of windows)
    from pyspark.sql import Window
    w = Window.partitionBy(*g).orderBy("_a")
    rk = r.withColumn("_rk", F.row_number().over(w))
    qs = []
    for lv in levels:
        k = F.least(F.col("_n"), F.ceil((F.col("_n") + 1) * (lv / 100.0)))
        qs.append(F.max(F.when(F.col("_rk") == k, F.col("_a"))).alias(f"_q{lv}"))
    q = rk.groupBy(*g).agg(*qs)
    x = future.join(q, g, "left")
    cols = {}
    for lv in levels:
        cols[f"lo_{lv}"] = F.round(F.col(YHAT) - F.col(f"_q{lv}"), digits)
        cols[f"hi_{lv}"] = F.round(F.col(YHAT) + F.col(f"_q{lv}"), digits)
    return x.withColumns(cols).drop(*[f"_q{lv}" for lv in levels])


def normal_interval(residuals: DataFrame, future: DataFrame, levels: Sequence[int] = (80, 95), by_id: bool = True,
                    digits: int = 6) -> DataFrame:
    """``y_hat +/- z_level * sd(residuals)`` (sample sd)."""
    g = [ID, MODEL] if by_id else [MODEL]
    s = residuals.groupBy(*g).agg(F.stddev_samp(F.col(Y) - F.col(YHAT)).alias("_sd"))
    x = future.join(s, g, "left")
    cols = {}
    for lv in levels:
        cols[f"lo_{lv}"] = F.round(F.col(YHAT) - F.lit(NORMAL_Z[lv]) * F.col("_sd"), digits)
        cols[f"hi_{lv}"] = F.round(F.col(YHAT) + F.lit(NORMAL_Z[lv]) * F.col("_sd"), digits)
    return x.withColumns(cols).drop("_sd")


def coverage(intervals: DataFrame, actuals: DataFrame, levels: Sequence[int] = (80, 95), by: Sequence[str] = (MODEL,),
             digits: int = 6) -> DataFrame:
    """Share of actuals inside each interval and mean width."""
    x = intervals.join(actuals.select(ID, DS, Y), [ID, DS])
    aggs = []
    for lv in levels:
        inside = ((F.col(Y) >= F.col(f"lo_{lv}")) & (F.col(Y) <= F.col(f"hi_{lv}"))).cast("double")
        aggs += [F.round(F.avg(inside), digits).alias(f"coverage_{lv}"),
                 F.round(F.avg(F.col(f"hi_{lv}") - F.col(f"lo_{lv}")), digits).alias(f"width_{lv}")]
    return x.groupBy(*by).agg(*aggs)
