"""Invertible value transforms.

Data-dependent transforms return ``(transformed_df, params_df)``; the parameter table
has one row per series (or one row for a global transform) and is joined back, so the
same parameters can be applied later to forecasts (``back_transform``).  Parameter
tables are aggregates (partial, skew-safe); joins are left to AQE, which broadcasts
them when their measured size is small and otherwise sort-merges with skew splitting.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.panel import ID, Y


def safe_log(c: Column) -> Column:
    """Natural log, NULL for non-positive input (Spark and SQL engines disagree there)."""
    return F.when(c > 0, F.ln(c))


def safe_log1p(c: Column) -> Column:
    return F.when(c > -1, F.log1p(c))


def boxcox(c: Column, lam: float | Column, shift: float = 1.0) -> Column:
    """Box-Cox of ``c + shift``: ``((x^l - 1)/l)`` or ``ln(x)`` when l = 0; NULL if x <= 0."""
    x = c + F.lit(shift)
    lam_c = lam if isinstance(lam, Column) else F.lit(float(lam))
    return F.when(x > 0, F.when(lam_c == 0, F.ln(x)).otherwise((F.pow(x, lam_c) - 1) / lam_c))


def inv_boxcox(c: Column, lam: float | Column, shift: float = 1.0) -> Column:
    lam_c = lam if isinstance(lam, Column) else F.lit(float(lam))
    return F.when(lam_c == 0, F.exp(c)).otherwise(F.pow(c * lam_c + 1, 1 / lam_c)) - F.lit(shift)


LAMBDA_GRID = [round(-1.0 + 0.1 * i, 1) for i in range(31)]  # -1.0 .. 2.0


def boxcox_lambda(df: DataFrame, value_col: str = Y, by: Sequence[str] = (ID,), shift: float = 1.0,
                  grid: Sequence[float] = LAMBDA_GRID) -> DataFrame:
    """E02 auto: per group the grid lambda maximising the Box-Cox profile log-likelihood
    ``-n/2 * ln(var_pop(z_l)) + (l - 1) * sum(ln x)``.  One aggregate computes the sums for
    every grid value at once (no row expansion); the best value is picked with ``max_by``
    over the unpivoted per-group result."""
    x = F.col(value_col) + F.lit(shift)
    aggs = [F.count(F.when(x > 0, 1)).alias("_n"), F.sum(safe_log(x)).alias("_sl")]
    for i, lam in enumerate(grid):
        z = boxcox(F.col(value_col), lam, shift)
        aggs += [F.sum(z).alias(f"_s{i}"), F.sum(z * z).alias(f"_q{i}")]
    s = df.groupBy(*by).agg(*aggs)
    ll = []
    for i, lam in enumerate(grid):
        var = F.col(f"_q{i}") / F.col("_n") - F.pow(F.col(f"_s{i}") / F.col("_n"), 2)
        ll.append(F.struct(F.lit(float(lam)).alias("lam"),
                           (-F.col("_n") / 2 * safe_log(var) + (lam - 1) * F.col("_sl")).alias("ll")))
    return (s.select(*by, F.explode(F.array(*ll)).alias("_c"))
             .groupBy(*by).agg(F.max_by("_c.lam", "_c.ll").alias("lambda")))


def min_max(df: DataFrame, value_col: str = Y, by: Sequence[str] = (ID,)) -> tuple[DataFrame, DataFrame]:
    """Scale to [0, 1] per group; returns ``(df, params(min_x, max_x))``."""
    p = df.groupBy(*by).agg(F.min(value_col).alias("min_x"), F.max(value_col).alias("max_x"))
    j = _attach(df, p, by)
    out = j.withColumn(value_col, F.try_divide(F.col(value_col) - F.col("min_x"), F.col("max_x") - F.col("min_x")))
    return out.drop("min_x", "max_x"), p


def _attach(df: DataFrame, params: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join a parameter table: by key, or (global, one row) as scalar columns."""
    if by:
        return df.join(params, list(by), "left")
    one = params.select(F.struct(*params.columns).alias("_p")).scalar()
    return df.withColumns({c: one[c] for c in params.columns})


def standardize(df: DataFrame, value_col: str = Y, by: Sequence[str] = (ID,), ddof: int = 0,
                train: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(x - mean) / sd`` with population (``ddof=0``, Python) or sample
    (``ddof=1``, R) sd; parameters learned on ``train`` when given (no leakage)."""
    src = train if train is not None else df
    sd = F.stddev_pop if ddof == 0 else F.stddev_samp
    p = src.groupBy(*by).agg(F.avg(value_col).alias("mean_x"), sd(value_col).alias("stdev_x"))
    out = _attach(df, p, by).withColumn(value_col, F.try_divide(F.col(value_col) - F.col("mean_x"), F.col("stdev_x")))
    return out.drop("mean_x", "stdev_x"), p


def inv_standardize(c: Column, mean: Column, sd: Column) -> Column:
    return c * sd + mean


def log_interval(df: DataFrame, value_col: str = Y, by: Sequence[str] = (ID,), lb: float = 0.0,
                 ub: float | str = "auto", offset: float = 1.0, ub_factor: float = 1.10,
                 train: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``ln((x + o - lb) / (ub - (x + o)))``; ``ub='auto'`` is ``1.10 * max(x)``.
    NULL where the ratio is not positive."""
    src = train if train is not None else df
    ub_c = F.max(value_col) * ub_factor if ub == "auto" else F.lit(float(ub))
    p = src.groupBy(*by).agg(F.lit(float(lb)).alias("lower_bound"), ub_c.cast("double").alias("upper_bound"),
                             F.lit(float(offset)).alias("offset"))
    j = _attach(df, p, by)
    xo = F.col(value_col) + F.col("offset")
    out = j.withColumn(value_col, safe_log(F.try_divide(xo - F.col("lower_bound"), F.col("upper_bound") - xo)))
    return out.drop("lower_bound", "upper_bound", "offset"), p


def inv_log_interval(c: Column, lb: Column, ub: Column, offset: Column) -> Column:
    """``(ub - lb) * e^x / (1 + e^x) + lb - offset``."""
    return (ub - lb) * F.exp(c) / (1 + F.exp(c)) + lb - offset


def back_transform(df: DataFrame, value_cols: Sequence[str], std_params: DataFrame | None,
                   logint_params: DataFrame | None, by: Sequence[str] = (ID,)) -> DataFrame:
    """E07 ``back_transform_data``: inverse standardisation, then inverse log-interval, of
    every listed column (target, forecasts and interval bounds alike)."""
    x = df
    if std_params is not None:
        x = _attach(x, std_params, by)
        x = x.withColumns({c: inv_standardize(F.col(c), F.col("mean_x"), F.col("stdev_x")) for c in value_cols})
        x = x.drop("mean_x", "stdev_x")
    if logint_params is not None:
        x = _attach(x, logint_params, by)
        x = x.withColumns({c: inv_log_interval(F.col(c), F.col("lower_bound"), F.col("upper_bound"), F.col("offset"))
                           for c in value_cols})
        x = x.drop("lower_bound", "upper_bound", "offset")
    return x


def deseasonalize(df: DataFrame, value_col: str = Y, period: int = 7, phase: Column | None = None,
                  by: Sequence[str] = (ID,), out: str = "y_deseason") -> DataFrame:
    """Subtract the per-phase mean (phase defaults to ISO weekday - 1 for period 7)."""
    ph = phase if phase is not None else F.weekday(F.col("ds"))
    x = df.withColumn("_ph", ph)
    m = x.groupBy(*by, "_ph").agg(F.avg(value_col).alias("_pm"))
    return x.join(m, [*by, "_ph"]).withColumn(out, F.col(value_col) - F.col("_pm")).drop("_ph", "_pm")


def transform_columns(df: DataFrame, cols: Sequence[str], fn: Callable[[Column], Column]) -> DataFrame:
    """Apply a column function to several columns."""
    return df.withColumns({c: fn(F.col(c)) for c in cols})


def normalize_features(df: DataFrame, cols: Sequence[str], train: DataFrame) -> DataFrame:
    """E10 ``step_normalize``: centre/scale features with train-only mean and sample sd."""
    p = train.agg(*[F.avg(c).alias(f"_m_{i}") for i, c in enumerate(cols)],
                  *[F.stddev_samp(c).alias(f"_s_{i}") for i, c in enumerate(cols)])
    one = p.select(F.struct(*p.columns).alias("_p")).scalar()
    return df.withColumns({c: F.try_divide(F.col(c) - one[f"_m_{i}"], one[f"_s_{i}"]) for i, c in enumerate(cols)})


def scaled_forecast(train: DataFrame, h: int, model: Callable, freq: str = "D", value_col: str = Y) -> DataFrame:
    """Fit ``model`` on per-series standardised values and invert its forecasts with the
    same parameters.  A constant series (no scale) is centred only."""
    scale = F.when(F.col("stdev_x") > 0, F.col("stdev_x")).otherwise(F.lit(1.0))
    p = train.groupBy(ID).agg(F.avg(value_col).alias("mean_x"), F.stddev_pop(value_col).alias("stdev_x")).withColumn("stdev_x", scale)
    x = train.join(p, ID).withColumn(value_col, (F.col(value_col) - F.col("mean_x")) / F.col("stdev_x")).drop("mean_x", "stdev_x")
    fc = model(x, h, freq=freq)
    return fc.join(p, ID).withColumn("y_hat", inv_standardize(F.col("y_hat"), F.col("mean_x"), F.col("stdev_x"))).drop("mean_x", "stdev_x")
