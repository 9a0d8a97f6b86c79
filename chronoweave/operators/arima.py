"""Seasonal ARIMA re-aimed as two-stage least squares (Hannan-Rissanen), M16/M17.

``z = (1-B)^d (1-B^m)^D y``; stage 1 fits a long autoregression of ``z`` and keeps its
residuals as innovation estimates; stage 2 regresses ``z`` on its own lags and lagged
innovations (non-seasonal and seasonal terms, their product terms left free).  All fits
are per-series normal equations (aggregates); order selection (AutoARIMA) solves every
candidate's sub-system from the same sums and keeps the lowest AIC.  Forecasts run the
recursion over the last ``m+1`` values with future innovations at zero, then undo the
differencing.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoweave.functions.timekeys import add_steps, steps_between
from chronoweave.operators import windows
from chronoweave.operators.baselines import MODEL, YHAT
from chronoweave.panel import DS, ID, Y
from chronoweave.plans import ols
from chronoweave.plans.series import POS, _keys, halo_window, regular_positions

FULL = ["z_1", "z_m", "z_m1", "e_1", "e_m", "e_m1"]


def _terms(p: int, q: int, P: int, Q: int) -> list[str]:
    t = []
    if p:
        t.append("z_1")
    if P:
        t.append("z_m")
    if p and P:
        t.append("z_m1")
    if q:
        t.append("e_1")
    if Q:
        t.append("e_m")
    if q and Q:
        t.append("e_m1")
    return t


def sarima(train: DataFrame, h: int, m: int = 7, order: tuple[int, int, int, int] | None = (1, 1, 1, 1),
           long_ar: int = 14, freq: str = "D", id_cols: str | Sequence[str] = ID,
           diffs: tuple[int, int] | None = (1, 1)) -> DataFrame:
    """M16 SARIMA(p,d,q)(P,D,Q)[m] with p, q, P, Q, d, D in {0, 1}.  ``order=None`` = M17
    AutoARIMA: all 16 (p,q,P,Q) by AIC; ``diffs=None`` picks (d, D) per series as the
    differencing with the smallest variance (no differencing = mean-centred series).
    Output adds ``order`` = the chosen specification."""
    keys = _keys(id_cols)
    x = regular_positions(train.select(*keys, DS, Y), freq)
    x = halo_window(x, m + 1, 0, lambda w: {"_y1": F.lag(Y, 1).over(w), "_ym": F.lag(Y, m).over(w),
                                            "_ym1": F.lag(Y, m + 1).over(w)}, keys)
    variants = {(0, 0): F.col(Y), (1, 0): F.col(Y) - F.col("_y1"), (0, 1): F.col(Y) - F.col("_ym"),
                (1, 1): F.col(Y) - F.col("_y1") - F.col("_ym") + F.col("_ym1")}
    if diffs is None:
        v = x.groupBy(*keys).agg(F.avg(Y).alias("_mu"),
                                 *[F.var_pop(c).alias(f"_v{a}{b}") for (a, b), c in variants.items()])
        # smallest variance first; ties -> fewer differences (struct order: v, k)
        choice = v.select(*keys, "_mu", F.array_sort(F.array(*[F.struct(F.coalesce(F.col(f"_v{a}{b}"), F.lit(float("inf"))).alias("v"),
                                                                   F.lit(a + b).alias("k"), F.lit(a).alias("nd"), F.lit(b).alias("ns"))
                                                          for (a, b) in variants]))[0].alias("_c"))
        choice = choice.select(*keys, "_mu", F.col("_c.nd").alias("_nd"), F.col("_c.ns").alias("_ns"))
    else:
        choice = x.groupBy(*keys).agg(F.avg(Y).alias("_mu")).withColumn("_nd", F.lit(diffs[0])).withColumn("_ns", F.lit(diffs[1]))
    x = x.join(choice, keys)
    z = F.when((F.col("_nd") == 0) & (F.col("_ns") == 0), F.col(Y) - F.col("_mu"))
    for (a, b), c in variants.items():
        if (a, b) != (0, 0):
            z = z.when((F.col("_nd") == a) & (F.col("_ns") == b), c)
    x = x.withColumn("z", z)
    # stage 1: long autoregression of z
    x = halo_window(x, long_ar, 0, lambda w: {f"zl_{k}": F.lag("z", k).over(w) for k in range(1, long_ar + 1)}, keys)
    lcols = [f"zl_{k}" for k in range(1, long_ar + 1)]
    c1, d1 = ols.fit_ols(x, keys, lcols, "z", intercept=False)
    x = ols.predict(x, c1, keys, d1, "_zhat").withColumn("e", F.col("z") - F.col("_zhat")).drop("_zhat", *lcols)
    # stage 2 regressors
    x = halo_window(x, m + 1, 0, lambda w: {"z_1": F.lag("z", 1).over(w), "z_m": F.lag("z", m).over(w),
                                            "z_m1": F.lag("z", m + 1).over(w), "e_1": F.lag("e", 1).over(w),
                                            "e_m": F.lag("e", m).over(w), "e_m1": F.lag("e", m + 1).over(w)}, keys)
    sums, design = ols.normal_equations(x, keys, FULL, "z", intercept=False)
    sums = sums.join(choice, keys)
    cands = [order] if order is not None else list(itertools.product((0, 1), repeat=4))
    key_fields = [f for f in sums.schema.fields if f.name in keys]
    schema = T.StructType(key_fields + [T.StructField("order", T.StringType()), T.StructField("aic", T.DoubleType()),
                                        T.StructField("coef", T.ArrayType(T.DoubleType())),
                                        T.StructField("_nd", T.IntegerType()), T.StructField("_ns", T.IntegerType()),
                                        T.StructField("_mu", T.DoubleType())])
    k = len(FULL)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, r in pdf.iterrows():
            xx = np.zeros((k, k))
            xy = np.array([r[f"_xy_{i}"] for i in range(k)], dtype=float)
            for i in range(k):
                for j in range(i, k):
                    xx[i, j] = xx[j, i] = r[f"_xx_{i}_{j}"]
            n, yy = float(r["_n"]), float(r["_yy"])
            best = None
            for (p, q, P, Q) in cands:
                idx = [FULL.index(t) for t in _terms(p, q, P, Q)]
                coef = np.zeros(k)
                if idx:
                    try:
                        b = np.linalg.solve(xx[np.ix_(idx, idx)], xy[idx])
                    except np.linalg.LinAlgError:
                        continue
                    coef[idx] = b
                sse = yy - 2 * coef @ xy + coef @ xx @ coef
                if n <= 0 or sse <= 0:
                    continue
                aic = n * math.log(sse / n) + 2 * (len(idx) + 1)
                if best is None or aic < best[1]:
                    d_, D_ = int(r["_nd"]), int(r["_ns"])
                    best = (f"SARIMA({p},{d_},{q})({P},{D_},{Q})[{m}]", aic, coef.tolist())
            if best is None:  # an exact fit, or too few rows: the differences alone
                best = (f"SARIMA(0,{int(r['_nd'])},0)(0,{int(r['_ns'])},0)[{m}]", None, [0.0] * k)
            out.append({**{kk: r[kk] for kk in keys}, "order": best[0], "aic": best[1], "coef": best[2],
                        "_nd": int(r["_nd"]), "_ns": int(r["_ns"]), "_mu": float(r["_mu"])})
        return pd.DataFrame(out, columns=[f.name for f in schema.fields])

    # one row a series and some dozen numbers: batches of series, no shuffle
    fits = sums.mapInPandas(lambda pdfs: (fit(p) for p in pdfs if len(p)), schema)
    # stage-2 innovations on the tail rows, then the recursion
    last = x.groupBy(*keys).agg(F.max(DS).alias("_T"))
    tail = x.drop("_mu", "_nd", "_ns").join(last, keys).where(steps_between(F.col(DS), F.col("_T"), freq) <= m) \
            .join(fits.select(*keys, "coef"), keys)
    resid = F.col("z") - sum((F.element_at("coef", i + 1) * F.coalesce(F.col(c), F.lit(0.0)) for i, c in enumerate(FULL)), F.lit(0.0))
    tail = tail.withColumn("_e2", resid)
    hist = tail.groupBy(*keys).agg(
        F.max("_T").alias("_T"),
        F.transform(F.array_sort(F.collect_list(F.struct(DS, Y, "z", "_e2"))), lambda s: s[Y]).alias("_Y"),
        F.transform(F.array_sort(F.collect_list(F.struct(DS, Y, "z", "_e2"))), lambda s: s["z"]).alias("_Z"),
        F.transform(F.array_sort(F.collect_list(F.struct(DS, Y, "z", "_e2"))), lambda s: F.coalesce(s["_e2"], F.lit(0.0))).alias("_E"))
    base = hist.join(fits, keys)

    def step(acc: Column, _s: Column) -> Column:
        Z, E, Yv = acc["Z"], acc["E"], acc["Y"]
        feats = [F.element_at(Z, -1), F.element_at(Z, -m), F.element_at(Z, -(m + 1)),
                 F.element_at(E, -1), F.element_at(E, -m), F.element_at(E, -(m + 1))]
        zn = sum((F.element_at(F.col("coef"), i + 1) * F.coalesce(f, F.lit(0.0)) for i, f in enumerate(feats)), F.lit(0.0))
        d_, D_ = F.col("_nd"), F.col("_ns")
        yn = F.when((d_ == 0) & (D_ == 0), zn + F.col("_mu")).otherwise(
            zn + d_ * F.element_at(Yv, -1) + D_ * F.element_at(Yv, -m) - d_ * D_ * F.element_at(Yv, -(m + 1)))
        return F.struct(F.concat(Yv, F.array(yn)).alias("Y"), F.concat(Z, F.array(zn)).alias("Z"),
                        F.concat(E, F.array(F.lit(0.0))).alias("E"))

    init = F.struct(F.col("_Y").alias("Y"), F.col("_Z").alias("Z"), F.col("_E").alias("E"))
    path = F.aggregate(F.sequence(F.lit(1), F.lit(h)), init, step)
    out = base.select(*keys, "_T", "order", F.posexplode(F.slice(path["Y"], -h, h)).alias("_i", YHAT))
    name = F.lit("AutoARIMA") if order is None else F.lit("SARIMA")
    return out.select(*keys, add_steps(F.col("_T"), F.col("_i") + 1, freq).alias(DS), name.alias(MODEL), YHAT, "order")
