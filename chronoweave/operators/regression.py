"""Per-series regression forecasters: linear trend + weekday (M07), autoregression with
recursive forecasting (M08, O01, O02), an additive changepoint-trend + Fourier model
(M19, N11) and residual-boosted hybrids (M25).

Fits are per-series least squares from aggregated normal equations
(:mod:`chronoweave.plans.ols`); recursion runs inside one SQL ``aggregate`` per series
over the last ``max(lags)`` values (a bounded tail, never the series).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.calendar import calendar_column
from chronoweave.functions.timekeys import add_steps, steps_between
from chronoweave.operators import timegrid, windows
from chronoweave.operators.baselines import MODEL, STEP, YHAT, horizon
from chronoweave.panel import DS, ID, Y
from chronoweave.plans import ols
from chronoweave.plans.series import POS, _keys, regular_positions


def _design_trend_weekday(df: DataFrame) -> tuple[DataFrame, list[str]]:
    x = df.withColumn("trend", F.datediff(F.to_date(DS), F.lit("1970-01-01").cast("date")).cast("double"))
    feats = ["trend"]
    for d in range(2, 8):
        x = x.withColumn(f"wday_{d}", (calendar_column(F.col(DS), "wday") == d).cast("double"))
        feats.append(f"wday_{d}")
    return x, feats


def trend_weekday(train: DataFrame, h: int, freq: str = "D", id_cols: str | Sequence[str] = ID) -> DataFrame:
    """``y ~ trend + weekday`` per series, predicted on the future frame."""
    keys = _keys(id_cols)
    x, feats = _design_trend_weekday(train)
    coefs, design = ols.fit_ols(x, keys, feats, Y)
    fut = horizon(train.groupBy(*keys).agg(F.max(DS).alias("_T")), keys, h, freq)
    fx, _ = _design_trend_weekday(fut)
    p = ols.predict(fx, coefs, keys, design, YHAT)
    return p.select(*keys, DS, F.lit("TrendWeekday").alias(MODEL), YHAT)


def ar_fit(train: DataFrame, lags: Sequence[int], freq: str = "D", id_cols: str | Sequence[str] = ID,
           ridge: float = 0.0) -> tuple[DataFrame, list[str]]:
    """``y_t = c + sum_k phi_k y_(t-k)`` per series by least squares on lag features."""
    keys = _keys(id_cols)
    x = windows.augment_lags(regular_positions(train, freq), Y, list(lags), freq=freq, id_cols=keys).drop(POS)
    return ols.fit_ols(x, keys, [f"y_lag_{k}" for k in lags], Y, ridge=ridge)


def recursive_forecast(train: DataFrame, coefs: DataFrame, lags: Sequence[int], h: int, freq: str = "D",
                       id_cols: str | Sequence[str] = ID, name: str = "AR") -> DataFrame:
    """Step-by-step forecast feeding predictions back as lags.

    Each series contributes its last ``max(lags)`` values (ordered) and its coefficient
    row; ``aggregate`` over ``1..h`` appends one prediction per step."""
    keys = _keys(id_cols)
    m = max(lags)
    last = train.groupBy(*keys).agg(F.max(DS).alias("_T"))
    tail = (train.join(last, keys).where(steps_between(F.col(DS), F.col("_T"), freq) < m)
                 .groupBy(*keys).agg(F.max("_T").alias("_T"),
                                     F.transform(F.array_sort(F.collect_list(F.struct(DS, Y))), lambda s: s[Y]).alias("_hist")))
    base = tail.join(coefs.select(*keys, "coef"), keys)

    def step(acc: Column, _s: Column) -> Column:
        pred = F.element_at(F.col("coef"), 1)
        for i, k in enumerate(lags):
            pred = pred + F.element_at(F.col("coef"), i + 2) * F.element_at(acc, -k)
        return F.concat(acc, F.array(pred))

    path = F.aggregate(F.sequence(F.lit(1), F.lit(h)), F.col("_hist"), step)
    out = base.select(*keys, "_T", F.slice(path, -h, h).alias("_f"))
    out = out.select(*keys, "_T", F.posexplode("_f").alias("_i", YHAT))
    return out.select(*keys, add_steps(F.col("_T"), F.col("_i") + 1, freq).alias(DS), F.lit(name).alias(MODEL), YHAT)


def recursive_apply(train: DataFrame, h: int, tail: int, fn: Callable[[Column], Column], freq: str = "D",
                    id_cols: str | Sequence[str] = ID, name: str = "user") -> DataFrame:
    """Forecast step by step with a user function of the last values.

    ``fn`` maps the array of the last ``tail`` values (oldest first, predictions included) to
    the next one.  Only that many values per series are kept, so a series is never gathered;
    a series with fewer values has a NULL forecast."""
    keys = _keys(id_cols)
    last = train.groupBy(*keys).agg(F.max(DS).alias("_T"))
    hist = (train.join(last, keys).where(steps_between(F.col(DS), F.col("_T"), freq) < tail)
            .groupBy(*keys).agg(F.max("_T").alias("_T"),
                                F.transform(F.array_sort(F.collect_list(F.struct(DS, Y))), lambda s: s[Y].cast("double")).alias("_hist")))

    def step(acc: Column, _s: Column) -> Column:
        return F.concat(acc, F.array(F.when(F.size(acc) >= tail, fn(F.slice(acc, -tail, tail)))))

    path = F.aggregate(F.sequence(F.lit(1), F.lit(h)), F.col("_hist"), step)
    out = hist.select(*keys, "_T", F.posexplode(F.slice(path, -h, h)).alias("_i", YHAT))
    return out.select(*keys, add_steps(F.col("_T"), F.col("_i") + 1, freq).alias(DS), F.lit(name).alias(MODEL), YHAT)


def ar(train: DataFrame, h: int, lags: Sequence[int] = (1, 7, 14, 30), freq: str = "D",
       id_cols: str | Sequence[str] = ID) -> DataFrame:
    coefs, _ = ar_fit(train, lags, freq, id_cols)
    return recursive_forecast(train, coefs, lags, h, freq, id_cols)


# ---- additive changepoint trend + seasonality (Prophet-like) -------------------------

def _prophet_design(df: DataFrame, n_changepoints: int, cp_range: float, weekly: int, yearly: int) -> tuple[DataFrame, list[str]]:
    """Columns: t in [0,1] over the training span, hinge ``max(t - c_i, 0)`` at
    changepoints evenly spread over the first ``cp_range`` of the span, weekly and
    yearly Fourier terms.  Needs per-series ``_t0``/``_t1`` (training span)."""
    span = F.greatest(F.timestamp_diff("DAY", F.col("_t0"), F.col("_t1")), F.lit(1))
    t = F.timestamp_diff("DAY", F.col("_t0"), F.col(DS)) / span
    x = df.withColumn("t", t.cast("double"))
    feats = ["t"]
    for i in range(1, n_changepoints + 1):
        c = cp_range * i / (n_changepoints + 1)
        x = x.withColumn(f"cp_{i}", F.greatest(F.col("t") - F.lit(c), F.lit(0.0)))
        feats.append(f"cp_{i}")
    day = F.datediff(F.to_date(DS), F.lit("1970-01-01").cast("date")).cast("double")
    for name, period, order in (("weekly", 7.0, weekly), ("yearly", 365.25, yearly)):
        for k in range(1, order + 1):
            arg = F.lit(2 * math.pi * k / period) * day
            x = x.withColumn(f"{name}_sin_{k}", F.sin(arg)).withColumn(f"{name}_cos_{k}", F.cos(arg))
            feats += [f"{name}_sin_{k}", f"{name}_cos_{k}"]
    return x, feats


def prophet_fitted(train: DataFrame, id_cols: str | Sequence[str] = ID, n_changepoints: int = 10, cp_range: float = 0.9,
                   weekly: int = 3, yearly: int = 5, ridge: float = 1.0) -> DataFrame:
    """``(keys, ds, y, fitted)``: the model of :func:`prophet_like` on its train rows."""
    keys = _keys(id_cols)
    span = train.groupBy(*keys).agg(F.min(DS).alias("_t0"), F.max(DS).alias("_t1"))
    x, feats = _prophet_design(train.join(span, keys), n_changepoints, cp_range, weekly, yearly)
    coefs, design = ols.fit_ols(x, keys, feats, Y, ridge=ridge)
    return ols.predict(x, coefs, keys, design, "fitted").select(*keys, DS, Y, "fitted")


def prophet_like(train: DataFrame, h: int, freq: str = "D", id_cols: str | Sequence[str] = ID,
                 n_changepoints: int = 10, cp_range: float = 0.9, weekly: int = 3, yearly: int = 5,
                 ridge: float = 1.0, components: bool = False) -> DataFrame:
    """Per-series ridge fit of piecewise-linear trend + Fourier seasonality; with
    ``components`` the output adds ``trend``, ``weekly`` and ``yearly`` contributions."""
    keys = _keys(id_cols)
    span = train.groupBy(*keys).agg(F.min(DS).alias("_t0"), F.max(DS).alias("_t1"))
    x, feats = _prophet_design(train.join(span, keys), n_changepoints, cp_range, weekly, yearly)
    coefs, design = ols.fit_ols(x, keys, feats, Y, ridge=ridge)
    fut = horizon(span.withColumn("_T", F.col("_t1")), keys, h, freq)
    fx, _ = _prophet_design(fut, n_changepoints, cp_range, weekly, yearly)
    p = ols.predict(fx, coefs, keys, design, YHAT)
    out = p.select(*keys, DS, F.lit("ProphetLike").alias(MODEL), YHAT, *(design[1:] if components else []))
    if not components:
        return out
    cj = out.join(coefs.select(*keys, "coef"), keys)
    def part(prefixes):
        terms = [F.element_at("coef", i + 1) * (F.lit(1.0) if c == "_one" else F.col(c))
                 for i, c in enumerate(design) if any(c.startswith(pf) for pf in prefixes) or (c == "_one" and "_one" in prefixes)]
        e = terms[0]
        for t_ in terms[1:]:
            e = e + t_
        return e
    return cj.select(*keys, DS, MODEL, YHAT, part(["_one", "t", "cp_"]).alias("trend"),
                     part(["weekly_"]).alias("weekly"), part(["yearly_"]).alias("yearly"))


def mfles(train: DataFrame, h: int, season: int = 7, rounds: int = 3, lr_trend: float = 0.9, lr_season: float = 0.9,
          alpha: float = 0.3, fourier_order: int = 3, freq: str = "D", id_cols: str | Sequence[str] = ID) -> DataFrame:
    """M20 (re-aimed) MFLES-style boosted decomposition: start from the per-series median,
    then for ``rounds`` rounds fit a linear trend and a Fourier seasonality to the current
    residual (each shrunk by its learning rate), finally exponential smoothing of the last
    residual.  Forecast = median + sum of the shrunk trend and season fits + ES level.
    Each fit is a per-series least squares from aggregated normal equations; the residual
    panel is checkpointed between rounds so the plan stays shallow."""
    from chronoweave.functions.aggs import quantile
    from chronoweave.operators.smoothing import _positions, ses_levels
    from chronoweave.session import cut_lineage
    keys = _keys(id_cols)
    span = train.groupBy(*keys).agg(F.min(DS).alias("_t0"), F.max(DS).alias("_T"), quantile(Y, 0.5).alias("_med"))

    def design(df: DataFrame) -> tuple[DataFrame, list[str]]:
        t = F.timestamp_diff("DAY", F.col("_t0"), F.col(DS)).cast("double")
        x = df.withColumn("t", t)
        day = F.datediff(F.to_date(DS), F.lit("1970-01-01").cast("date")).cast("double")
        fcols = []
        for k in range(1, fourier_order + 1):
            arg = F.lit(2 * math.pi * k / season) * day
            x = x.withColumn(f"fs_{k}", F.sin(arg)).withColumn(f"fc_{k}", F.cos(arg))
            fcols += [f"fs_{k}", f"fc_{k}"]
        return x, fcols

    x, fcols = design(train.select(*keys, DS, Y).join(span, keys))
    x = cut_lineage(x.withColumn("_res", F.col(Y) - F.col("_med")))
    fits = []
    for r in range(rounds):
        ct, dt_ = ols.fit_ols(x, keys, ["t"], "_res")
        x = ols.predict(x, ct, keys, dt_, "_p").withColumn("_res", F.col("_res") - lr_trend * F.col("_p")).drop("_p")
        cs, ds_ = ols.fit_ols(x, keys, fcols, "_res", intercept=False)
        x = ols.predict(x, cs, keys, ds_, "_p").withColumn("_res", F.col("_res") - lr_season * F.col("_p")).drop("_p")
        x = cut_lineage(x)
        fits += [(ct, dt_, lr_trend), (cs, ds_, lr_season)]
    es = ses_levels(_positions(x.select(*keys, DS, F.col("_res").alias(Y)), keys, freq), keys, [alpha]) \
        .select(*keys, F.col("level_0").alias("_es"))
    fut, _ = design(horizon(span, keys, h, freq))
    fut = fut.join(es, keys, "left")
    total = F.col("_med") + F.coalesce(F.col("_es"), F.lit(0.0))
    for i, (c, d, lr) in enumerate(fits):
        fut = ols.predict(fut, c, keys, d, f"_f{i}")
        total = total + lr * F.coalesce(F.col(f"_f{i}"), F.lit(0.0))
    return fut.select(*keys, DS, F.lit("MFLES").alias(MODEL), total.alias(YHAT))
