"""Series diagnostics: profile, missingness, ACF/PACF/CCF, decomposition, regression
(A06, A07, I01-I08)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.aggs import quantile
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.series import DEFAULT_BLOCK_ROWS, POS, _keys, halo_window, positioned, with_positions


def series_diagnostics(df: DataFrame, id_cols: str | Sequence[str] = ID, unit: str = "DAY") -> DataFrame:
    """Per series ``n, start, end`` and the min / median / max gap between
    consecutive times (in ``unit``)."""
    keys = _keys(id_cols)
    x = with_positions(df.select(*keys, DS), keys)
    x = halo_window(x, 1, 0, lambda w: {"_prev": F.lag(DS, 1).over(w)}, keys)
    x = x.withColumn("_gap", F.timestamp_diff(unit, F.col("_prev"), F.col(DS)))
    return x.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(DS).alias("start"), F.max(DS).alias("end"),
                                F.min("_gap").alias("gap_min"), quantile("_gap", 0.5).alias("gap_median"),
                                F.max("_gap").alias("gap_max"))


def missingness(df: DataFrame, digits: int = 6) -> DataFrame:
    """NULL count and share per column, long ``(column, n_missing, pct_missing)``."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot(["_n"], cols, "column", "n_missing")
    return long.select("column", "n_missing", F.round(F.col("n_missing") / F.col("_n") * 100, digits).alias("pct_missing"))


def _centered(df: DataFrame, keys: list[str], value_col: str, out: str) -> DataFrame:
    m = df.groupBy(*keys).agg(F.avg(value_col).alias("_mean"))
    return df.join(m, keys).withColumn(out, F.col(value_col) - F.col("_mean")).drop("_mean")


def acf(df: DataFrame, value_col: str = Y, max_lag: int = 28, freq: str | None = None, id_cols: str | Sequence[str] = ID,
        block_rows: int = DEFAULT_BLOCK_ROWS, digits: int = 6) -> DataFrame:
    """``acf_k = sum(c_t c_(t-k)) / sum(c_t^2)`` (c = y - mean) for k = 0..max_lag,
    with the white-noise bound 1.96/sqrt(n): long ``(id, lag, acf, bound)``."""
    keys = _keys(id_cols)
    x = _centered(positioned(df.where(F.col(value_col).isNotNull()), keys, freq)[0], keys, value_col, "_c")
    x = halo_window(x, max_lag, 0, lambda w: {f"_l{k}": F.lag("_c", k).over(w) for k in range(1, max_lag + 1)},
                    keys, block_rows=block_rows)
    sums = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col("_c") * F.col("_c")).alias("_s0"),
                                *[F.sum(F.col("_c") * F.col(f"_l{k}")).alias(f"_s{k}") for k in range(1, max_lag + 1)])
    long = sums.select(*keys, "_n", "_s0", F.explode(F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"_s{k}").alias("s"))
                                                               for k in range(0, max_lag + 1)])).alias("_e"))
    return long.select(*keys, F.col("_e.lag").alias("lag"),
                       F.round(F.try_divide(F.coalesce(F.col("_e.s"), F.lit(0.0)), F.col("_s0")), digits).alias("acf"),
                       F.round(F.lit(1.96) / F.sqrt("_n"), digits).alias("bound"))


def pacf(acf_df: DataFrame, id_cols: str | Sequence[str] = ID) -> DataFrame:
    """Partial autocorrelations from an ACF table by Durbin-Levinson, a batch of series at a
    time; what a series contributes is its max_lag + 1 autocorrelations."""
    keys = _keys(id_cols)

    def partial(r: np.ndarray) -> list[float]:
        L = len(r) - 1
        out = np.full(L + 1, np.nan)
        out[0] = 1.0
        phi = np.array([])
        for k in range(1, L + 1):
            if k == 1:
                phi_kk = r[1]
            else:
                den = 1.0 - np.dot(phi, r[1:k])
                phi_kk = (r[k] - np.dot(phi, r[1:k][::-1])) / den if den != 0 else np.nan
            phi = np.append(phi - phi_kk * phi[::-1], phi_kk)
            out[k] = phi_kk
        return np.round(out, 6).tolist()

    def dl(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            if len(pdf):
                yield pdf[keys].assign(_p=[partial(np.array(r, float)) for r in pdf["_r"]])

    rows = acf_df.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("lag", "acf"))), lambda s: s["acf"]).alias("_r"))
    schema = ", ".join(f"{k} string" for k in keys) + ", _p array<double>"
    return rows.mapInPandas(dl, schema).select(*keys, F.posexplode("_p").alias("lag", "pacf"))


def ccf(df: DataFrame, target: str, regressors: Sequence[str], max_lag: int = 14, freq: str | None = None, id_cols: str | Sequence[str] = ID,
        block_rows: int = DEFAULT_BLOCK_ROWS, digits: int = 6) -> DataFrame:
    """Cross-correlation of the target with lagged regressors,
    ``sum((y_t - y_bar)(x_(t-k) - x_bar)) / sqrt(sum((y-y_bar)^2) sum((x-x_bar)^2))``:
    long ``(id, regressor, lag, ccf)``."""
    keys = _keys(id_cols)
    x = positioned(df.where(F.col(target).isNotNull()), keys, freq)[0]
    x = _centered(x, keys, target, "_cy")
    for r in regressors:
        x = _centered(x, keys, r, f"_cx_{r}")
    x = halo_window(x, max_lag, 0, lambda w: {f"_l_{r}_{k}": F.lag(f"_cx_{r}", k).over(w)
                                              for r in regressors for k in range(1, max_lag + 1)}, keys, block_rows=block_rows)
    aggs = [F.sum(F.col("_cy") * F.col("_cy")).alias("_syy")]
    for r in regressors:
        aggs.append(F.sum(F.col(f"_cx_{r}") * F.col(f"_cx_{r}")).alias(f"_sxx_{r}"))
        aggs.append(F.sum(F.col("_cy") * F.col(f"_cx_{r}")).alias(f"_s_{r}_0"))
        aggs += [F.sum(F.col("_cy") * F.col(f"_l_{r}_{k}")).alias(f"_s_{r}_{k}") for k in range(1, max_lag + 1)]
    sums = x.groupBy(*keys).agg(*aggs)
    items = [F.struct(F.lit(r).alias("regressor"), F.lit(k).alias("lag"),
                      F.try_divide(F.coalesce(F.col(f"_s_{r}_{k}"), F.lit(0.0)), F.sqrt(F.col("_syy") * F.col(f"_sxx_{r}"))).alias("v"))
             for r in regressors for k in range(0, max_lag + 1)]
    return sums.select(*keys, F.explode(F.array(*items)).alias("_e")).select(
        *keys, "_e.regressor", "_e.lag", F.round("_e.v", digits).alias("ccf"))


def classical_decomposition(df: DataFrame, value_col: str = Y, period: int = 7, freq: str | None = None, id_cols: str | Sequence[str] = ID,
                            block_rows: int = DEFAULT_BLOCK_ROWS, digits: int = 6) -> DataFrame:
    """Additive classical decomposition.  Trend = centred moving average of length
    ``period`` (a 2 x period MA when even), seasonal = per-phase mean of the detrended
    series re-centred to sum to zero, remainder = y - trend - seasonal."""
    keys = _keys(id_cols)
    x = positioned(df, keys, freq)[0]
    half = period // 2
    if period % 2 == 1:
        build = lambda w: {"trend": F.when(F.count(value_col).over(w.rowsBetween(-half, half)) == period,
                                           F.avg(value_col).over(w.rowsBetween(-half, half)))}
    else:
        def build(w):
            fw = w.rowsBetween(-half, half)
            s = F.sum(value_col).over(fw)
            edge = F.first(value_col).over(fw) + F.last(value_col).over(fw)
            return {"trend": F.when(F.count(value_col).over(fw) == period + 1, (s - edge / 2) / period)}
    x = halo_window(x, half, half, build, keys, block_rows=block_rows)
    x = x.withColumn("_ph", F.pmod(F.col(POS), F.lit(period)))
    ph = x.groupBy(*keys, "_ph").agg(F.avg(F.col(value_col) - F.col("trend")).alias("_s"))
    adj = ph.groupBy(*keys).agg(F.avg("_s").alias("_sm"))
    ph = ph.join(adj, keys).select(*keys, "_ph", (F.col("_s") - F.col("_sm")).alias("season"))
    out = x.join(ph, [*keys, "_ph"], "left").withColumn("remainder", F.col(value_col) - F.col("trend") - F.col("season"))
    return out.withColumns({c: F.round(c, digits) for c in ("trend", "season", "remainder")}).drop("_ph", POS)


def seasonal_strength(decomp: DataFrame, id_cols: str | Sequence[str] = ID, digits: int = 6) -> DataFrame:
    """I08 features: trend and seasonal strength ``max(0, 1 - var(rem)/var(rem + comp))``."""
    keys = _keys(id_cols)
    return decomp.groupBy(*keys).agg(
        F.round(F.greatest(F.lit(0.0), 1 - F.try_divide(F.var_samp("remainder"), F.var_samp(F.col("remainder") + F.col("trend")))), digits).alias("trend_strength"),
        F.round(F.greatest(F.lit(0.0), 1 - F.try_divide(F.var_samp("remainder"), F.var_samp(F.col("remainder") + F.col("season")))), digits).alias("seasonal_strength"))


def loess(df: DataFrame, value_col: str = Y, span: int = 91, degree: int = 1, freq: str | None = None,
          id_cols: str | Sequence[str] = ID, block_rows: int = DEFAULT_BLOCK_ROWS, out: str = "loess",
          digits: int = 6) -> DataFrame:
    """I04 LOESS smoother (non-robust): at each row a tricube-weighted local polynomial
    (degree 0 or 1) over a centred ROWS frame of ``span`` rows (partial at the edges;
    distances scaled by half the span + 1).  The bounded frame keeps it a halo-window
    computation; the local fit uses closed-form weighted sums."""
    keys = _keys(id_cols)
    x, added = positioned(df, keys, freq)
    half = span // 2

    def build(w):
        fw = w.rowsBetween(-half, half)
        return {"_pts": F.collect_list(F.struct(F.col(POS).alias("p"), F.col(value_col).alias("v"))).over(fw)}

    def fit():
        pts = F.col("_pts")
        d = lambda s: (s["p"] - F.col(POS)).cast("double")
        wt = lambda s: F.pow(1 - F.pow(F.abs(d(s)) / (half + 1), 3), 3)
        valid = F.filter(pts, lambda s: s["v"].isNotNull())
        def total(fn):
            return F.aggregate(valid, F.lit(0.0), lambda acc, s: acc + fn(s))
        s0, t0 = total(lambda s: wt(s)), total(lambda s: wt(s) * s["v"])
        if degree == 0:
            return {out: F.try_divide(t0, s0)}
        s1, s2 = total(lambda s: wt(s) * d(s)), total(lambda s: wt(s) * d(s) * d(s))
        t1 = total(lambda s: wt(s) * d(s) * s["v"])
        return {"_s0": s0, "_s1": s1, "_s2": s2, "_t0": t0, "_t1": t1}

    y = halo_window(x, half, half, build, keys, block_rows=block_rows)
    sums = fit()
    if degree == 0:
        y = y.withColumns(sums)
    else:
        y = y.withColumns(sums).withColumn(out, F.try_divide(F.col("_s2") * F.col("_t0") - F.col("_s1") * F.col("_t1"),
                                                             F.col("_s0") * F.col("_s2") - F.col("_s1") * F.col("_s1")))
    y = y.withColumn(out, F.round(out, digits)).drop("_pts", "_s0", "_s1", "_s2", "_t0", "_t1")
    return y.drop(POS) if added else y


def mstl(df: DataFrame, value_col: str = Y, periods: Sequence[int] = (7, 30), freq: str | None = None,
         id_cols: str | Sequence[str] = ID, digits: int = 6) -> DataFrame:
    """M18 decomposition: classical decompositions applied period by period (shortest
    first) to the series with the previous seasonal components removed; returns
    ``seasonal_<p>`` per period, ``trend`` (from the last period's moving average) and
    ``remainder``."""
    keys = _keys(id_cols)
    x = df
    adj = value_col
    for i, p in enumerate(periods):
        d = classical_decomposition(x.withColumn("_adj", F.col(adj)), "_adj", p, freq=freq, id_cols=keys, digits=12)
        x = d.withColumnRenamed("season", f"seasonal_{p}").drop("remainder", "_adj")
        if i < len(periods) - 1:
            x = x.drop("trend")
        x = x.withColumn(f"_adj{i}", F.col(adj) - F.col(f"seasonal_{p}"))
        adj = f"_adj{i}"
    seas = sum((F.col(f"seasonal_{p}") for p in periods), F.lit(0.0))
    x = x.withColumn("remainder", F.col(value_col) - F.col("trend") - seas)
    x = x.drop(*[f"_adj{i}" for i in range(len(periods))])
    return x.withColumns({c: F.round(c, digits) for c in ["trend", "remainder", *[f"seasonal_{p}" for p in periods]]})


def user_features(df: DataFrame, features: Mapping[str, Callable[[Column], Column]], value_col: str = Y,
                  id_cols: str | Sequence[str] = ID) -> DataFrame:
    """User series features; each maps the value column to an aggregate, so all of them
    are partial aggregates of one pass."""
    return df.groupBy(*_keys(id_cols)).agg(*[fn(F.col(value_col)).alias(name) for name, fn in features.items()])


def series_table(df: DataFrame, fit: Mapping[str, Column], rows: Callable[[Column], Column], id_cols: str | Sequence[str] = ID) -> DataFrame:
    """A per-series table function.  ``fit`` names the aggregates that stand for a fitted
    series; ``rows`` maps their struct to an array of result rows."""
    keys = _keys(id_cols)
    s = df.groupBy(*keys).agg(*[c.alias(n) for n, c in fit.items()]).select(*keys, F.struct(*fit).alias("_s"))
    return s.select(*keys, F.inline(rows(F.col("_s"))))
