"""Anomaly detection and cleaning.

Decomposition uses bounded centred windows (halo blocks) and per-phase statistics, or STL;
fences are exact per-series quantiles of the remainder.  The cap on the share of
anomalies keeps the most distant fence violators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.functions.aggs import quantile
from chronoweave.operators import fill, windows
from chronoweave.operators.diagnostics import classical_decomposition
from chronoweave.operators.stl import stl
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.series import POS, _keys, decay_scan, halo_window, positioned


def median_decomposition(df: DataFrame, value_col: str = Y, period: int = 7, trend_window: int = 91,
                         freq: str | None = None, id_cols: str | Sequence[str] = ID) -> DataFrame:
    """'twitter'-style robust decomposition: trend = centred rolling median over
    ``trend_window`` (partial at the edges), season = per-phase median of the detrended
    values, remainder = y - trend - season."""
    keys = _keys(id_cols)
    x, added = positioned(df, keys, freq)
    x = windows.augment_rolling(x, value_col, trend_window, "median", center=True, partial=True, id_cols=keys)
    x = x.withColumnRenamed(f"{value_col}_rolling_median_win_{trend_window}", "trend")
    x = x.withColumn("_ph", F.pmod(F.col(POS), F.lit(period)))
    ph = x.groupBy(*keys, "_ph").agg(quantile(F.col(value_col) - F.col("trend"), 0.5).alias("season"))
    x = x.join(ph, [*keys, "_ph"], "left").withColumn("remainder", F.col(value_col) - F.col("trend") - F.col("season"))
    x = x.drop("_ph")
    return x.drop(POS) if added else x


def anomalize(df: DataFrame, value_col: str = Y, period: int = 7, trend_window: int = 91, iqr_alpha: float = 0.05,
              max_anomalies: float = 0.2, method: str = "twitter", freq: str | None = None,
              id_cols: str | Sequence[str] = ID, digits: int = 6, robust: int = 2) -> DataFrame:
    """Decomposition (``method``: 'twitter', 'stl' or 'classical') -> IQR fence on the remainder (``q1 - f*iqr``, ``q3 + f*iqr``,
    ``f = 0.15 / iqr_alpha``) -> at most ``max_anomalies`` of the rows flagged (the most
    distant) -> ``observed_clean`` = value clipped to the recomposed bounds.  ``robust`` is the number of
    outer rounds of STL."""
    keys = _keys(id_cols)
    if method == "twitter":
        d = median_decomposition(df, value_col, period, trend_window, freq, keys)
    elif method == "stl":
        d = stl(df, value_col, period, outer=robust, freq=freq, id_cols=keys, digits=12)
    else:
        d = classical_decomposition(df, value_col, period, freq=freq, id_cols=keys, digits=12)
    f = round(0.15 / iqr_alpha, 10)  # 0.15/0.05 is 2.9999999999999996 in binary
    q = d.groupBy(*keys).agg(quantile("remainder", [0.25, 0.75]).alias("_q"), F.count("remainder").alias("_n"))
    q = q.select(*keys, "_n", F.col("_q")[0].alias("_q1"), F.col("_q")[1].alias("_q3"))
    x = d.join(q, keys, "left")
    lo = F.col("_q1") - f * (F.col("_q3") - F.col("_q1"))
    hi = F.col("_q3") + f * (F.col("_q3") - F.col("_q1"))
    x = x.withColumn("remainder_l1", lo).withColumn("remainder_l2", hi)
    dist = F.greatest(F.col("remainder") - F.col("remainder_l2"), F.col("remainder_l1") - F.col("remainder"), F.lit(0.0))
    x = x.withColumn("_dist", dist)
    # cap: keep the floor(max_anomalies * n) most distant fence violators.  Only violators
    # (far outside the fence, a small share of a series) enter this ranking window.
    cand = x.where(F.col("_dist") > 0).select(*keys, DS, "_dist")
    w = Window.partitionBy(*keys).orderBy(F.col("_dist").desc(), F.col(DS))
    ranked = cand.withColumn("_rk", F.row_number().over(w)).drop("_dist")
    x = x.join(ranked, [*keys, DS], "left")
    x = x.withColumn("anomaly", ((F.col("_dist") > 0) & (F.col("_rk") <= F.floor(F.col("_n") * max_anomalies))).cast("int"))
    x = x.withColumn("recomposed_l1", F.col("trend") + F.col("season") + F.col("remainder_l1"))
    x = x.withColumn("recomposed_l2", F.col("trend") + F.col("season") + F.col("remainder_l2"))
    clean = F.when(F.col("anomaly") == 1, F.least(F.greatest(F.col(value_col), F.col("recomposed_l1")), F.col("recomposed_l2"))) \
             .otherwise(F.col(value_col))
    x = x.withColumn("observed_clean", clean)
    out = ["trend", "season", "remainder", "remainder_l1", "remainder_l2", "recomposed_l1", "recomposed_l2", "observed_clean"]
    return x.withColumns({c: F.round(c, digits) for c in out}).drop("_q1", "_q3", "_n", "_dist", "_rk")


def ts_clean(df: DataFrame, value_col: str = Y, period: int = 7, iqr_factor: float = 3.0, freq: str | None = None,
             id_cols: str | Sequence[str] = ID, within: tuple[str, str] | None = None, digits: int = 6, method: str = "classical",
             robust: int = 2) -> DataFrame:
    """J03/J04/J05 ``ts_clean_vec``: flag remainder values beyond ``iqr_factor * IQR``
    (classical decomposition, or STL with ``robust`` outer rounds), set them to NULL and re-fill by
    seasonal interpolation (B15).  ``within=(start, end)`` applies the cleaned value only inside that range."""
    keys = _keys(id_cols)
    if method == "stl":
        d = stl(df, value_col, period, outer=robust, freq=freq, id_cols=keys, digits=12)
    else:
        d = classical_decomposition(df, value_col, period, freq=freq, id_cols=keys, digits=12)
    q = d.groupBy(*keys).agg(quantile("remainder", [0.25, 0.75]).alias("_q"))
    x = d.join(q, keys, "left")
    iqr = F.col("_q")[1] - F.col("_q")[0]
    flag = (F.col("remainder") < F.col("_q")[0] - iqr_factor * iqr) | (F.col("remainder") > F.col("_q")[1] + iqr_factor * iqr)
    x = x.withColumn("outlier", F.coalesce(flag, F.lit(False)).cast("int"))
    masked = x.select(*keys, DS, F.when(F.col("outlier") == 1, F.lit(None)).otherwise(F.col(value_col)).alias("_v"), "outlier", value_col)
    filled = fill.impute_seasonal(masked.withColumnRenamed(value_col, "_orig"), "_v", period, freq=freq, id_cols=keys)
    cleaned = F.round(F.col("_v"), digits)
    if within is not None:
        from chronoweave.operators.reshape import between_time
        cleaned = F.when(between_time(F.col(DS), *within), cleaned).otherwise(F.col("_orig"))
    return filled.select(*keys, DS, F.col("_orig").alias(value_col), "outlier", cleaned.alias("y_clean"))


def ewma_detector(df: DataFrame, value_col: str = Y, lam: float = 0.2, k: float = 3.0, freq: str | None = None,
                  id_cols: str | Sequence[str] = ID, digits: int = 6) -> DataFrame:
    """J07 SD-EWMA: ``mu_t = lam*x_t + (1-lam)*mu_(t-1)`` and
    ``v_t = lam*(x_t - mu_(t-1))^2 + (1-lam)*v_(t-1)`` (both started at the first value /
    zero); flag ``|x_t - mu_(t-1)| > k * sqrt(v_(t-1))``.  Two block scans and two halo
    lags; no series is gathered."""
    keys = _keys(id_cols)
    x, added = positioned(df, keys, freq)
    x = windows.smoothed_level(x, value_col, lam, "_mu", keys)
    x = halo_window(x, 1, 0, lambda w: {"_mu_prev": F.lag("_mu", 1).over(w)}, keys)
    x = x.withColumn("_e2", F.pow(F.col(value_col) - F.col("_mu_prev"), 2))
    x = decay_scan(x, F.lit(lam) * F.coalesce(F.col("_e2"), F.lit(0.0)), 1.0 - lam, "_var", keys)
    x = halo_window(x, 1, 0, lambda w: {"_var_prev": F.lag("_var", 1).over(w)}, keys)
    z = F.try_divide(F.abs(F.col(value_col) - F.col("_mu_prev")), F.sqrt(F.col("_var_prev")))
    x = x.withColumn("ewma_score", F.round(z, digits)).withColumn("anomaly_ewma", F.coalesce(z > k, F.lit(False)).cast("int"))
    x = x.withColumn("ewma_mean", F.round("_mu", digits)).drop("_mu", "_mu_prev", "_e2", "_var", "_var_prev")
    return x.drop(POS) if added else x


def ensemble_score(flags: DataFrame, flag_cols: Sequence[str], weights: Sequence[float] | None = None,
                   digits: int = 6) -> DataFrame:
    """``score`` = mean of the 0/1 detector flags; ``score_w`` = weighted mean with
    weights ``rev(1..m) / sum(1..m)`` (first detector weighs most) unless given."""
    m = len(flag_cols)
    w = list(weights) if weights is not None else [(m - i) / (m * (m + 1) / 2) for i in range(m)]
    score = sum(F.col(c) for c in flag_cols) / m
    score_w = sum(F.lit(wi) * F.col(c) for wi, c in zip(w, flag_cols))
    return flags.withColumn("score", F.round(score, digits)).withColumn("score_w", F.round(score_w, digits))
