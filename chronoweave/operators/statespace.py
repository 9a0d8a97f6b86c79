"""Additive exponential-smoothing state-space models (M13 Holt-Winters, M14 AutoETS
re-aimed) as aggregates.

With fixed parameters the state recursion is linear, ``x_t = F x_(t-1) + g y_t``, so the
final state is ``F^(n-1-t0) x_t0 + sum_j F^(n-1-j) g y_j``.  The weights ``F^r g`` and
the powers ``F^r`` depend only on the parameters: they are computed once on the driver
until ``F^r`` converges (to 0, or to the projection of the seasonal unit root) at ``K``;
observations older than ``K`` share the converged weight and enter as one conditional
sum.  The weight table is a small broadcast keyed by (candidate, r).  Every
series is then one weighted aggregate; no series is gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.operators.baselines import MODEL, STEP, YHAT, horizon
from chronoweave.operators.smoothing import _positions
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.series import _keys

#: powers tabulated on the driver at most; a form that converges later is refused, not cut
MAX_POWERS = 50_000


def hw_matrices(alpha: float, beta: float, gamma: float, m: int, phi: float = 1.0, trend: bool = True,
                seasonal: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Transition ``F`` and gain ``g`` of additive ETS on the full state
    ``(level, trend, s_t, s_(t-1), ..., s_(t-m+1))``; an absent trend or season keeps its
    rows at zero, so every form shares one state layout (and one weight table)."""
    d = 2 + m
    Fm = np.zeros((d, d))
    g = np.zeros(d)
    L, B, S, last_s = 0, 1, 2, 2 + m - 1
    # level: alpha*(y - s_(t-m)) + (1-alpha)*(l + phi*b)
    Fm[L, L] = 1 - alpha
    if trend:
        Fm[L, B] = (1 - alpha) * phi
    if seasonal:
        Fm[L, last_s] = -alpha
    g[L] = alpha
    if trend:  # b' = beta*(l' - l) + phi*(1-beta)*b
        Fm[B, :] = beta * Fm[L, :]
        Fm[B, L] -= beta
        Fm[B, B] += phi * (1 - beta)
        g[B] = beta * alpha
    if seasonal:  # s' = gamma*(y - l - phi*b) + (1-gamma)*s_(t-m); then shift
        Fm[S, L] = -gamma
        if trend:
            Fm[S, B] = -gamma * phi
        Fm[S, last_s] = 1 - gamma
        g[S] = gamma
        for i in range(1, m):
            Fm[S + i, S + i - 1] = 1.0
    return Fm, g


def power_tables(Fm: np.ndarray, g: np.ndarray) -> tuple[list[list[float]], list[list[float]]]:
    """``[F^r g]`` and flattened ``[F^r]`` for r = 0..K, where ``F^r`` has converged at
    ``K`` (changes below 1e-15, the rounding floor): to 0 for damped/non-seasonal forms, or to the fixed
    projection of the seasonal unit root.  Row ``K`` therefore stands for every r >= K."""
    d = Fm.shape[0]
    P = np.eye(d)
    wg, pw = [], []
    for _ in range(MAX_POWERS):
        wg.append((P @ g).tolist())
        pw.append(P.reshape(-1).tolist())
        nxt = Fm @ P
        if np.abs(nxt - P).max() < 1e-15 * max(1.0, np.abs(P).max()):  # floating-point noise floor
            return wg, pw
        P = nxt
    raise ValueError(f"the powers of this form have not converged after {MAX_POWERS} steps; raise alpha, beta or gamma")


def ets_grid(train: DataFrame, h: int, candidates: dict[str, dict], season: int = 7, freq: str = "D",
             id_cols: str | Sequence[str] = ID) -> DataFrame:
    """Forecast every candidate ``name -> dict(alpha, beta, gamma, phi, trend, seasonal)``
    for every series in one pass: one broadcast weight table keyed by candidate, one join,
    one aggregate grouped by (series, candidate).  Output ``model`` = candidate name.

    Initial state from the first two seasons: level = mean of season 1, trend = (mean
    season 2 - mean season 1)/m, seasonal = season 1 minus level; the recursion starts
    after the first season; series shorter than 2m get no forecast."""
    keys = _keys(id_cols)
    spark: SparkSession = train.sparkSession
    m = season
    d = 2 + m
    rows, meta = [], []
    for name, p in candidates.items():
        Fm, g = hw_matrices(p.get("alpha", 0.3), p.get("beta", 0.1), p.get("gamma", 0.1), m, p.get("phi", 1.0),
                            p.get("trend", True), p.get("seasonal", True))
        wg, pw = power_tables(Fm, g)
        rows += [(name, r, wg[r], pw[r]) for r in range(len(wg))]
        meta.append((name, len(wg), bool(p.get("trend", True)), bool(p.get("seasonal", True)), float(p.get("phi", 1.0))))
    table = spark.createDataFrame(rows, f"{MODEL} string, _r long, _wg array<double>, _pw array<double>")
    cands = spark.createDataFrame([(n, k - 1, tr, se, ph) for n, k, tr, se, ph in meta],
                                  f"{MODEL} string, _K long, _tr boolean, _se boolean, _phi double")
    ks = sorted({k - 1 for _, k, _, _, _ in meta})
    x = _positions(train, keys, freq)
    x = x.withColumn("_i", F.col("_n") - 1 - F.col("_r"))  # index from the series start
    first = x.where(F.col("_i") < 2 * m).groupBy(*keys).agg(
        F.avg(F.when(F.col("_i") < m, F.col(Y))).alias("_m1"), F.avg(F.when(F.col("_i") >= m, F.col(Y))).alias("_m2"),
        *[F.max(F.when(F.col("_i") == i, F.col(Y))).alias(f"_y{i}") for i in range(m)],
        F.max("_n").alias("_n"), F.max("_T").alias("_T"))
    # contributions of observations after the first season, every candidate at once
    after = x.where(F.col("_i") >= m)
    obs = after.join(F.broadcast(table.select(MODEL, "_r", "_wg")), "_r")  # r <= K: exact weight rows
    sums = obs.groupBy(*keys, MODEL).agg(*[F.sum(F.element_at("_wg", k + 1) * F.col(Y)).alias(f"_s{k}") for k in range(d)])
    # r > K: the converged weight F^K g times the sum of those observations
    tails = after.groupBy(*keys).agg(*[F.sum(F.when(F.col("_r") > k, F.col(Y))).alias(f"_tail{k}") for k in ks])
    st = sums.join(first, keys).join(F.broadcast(cands), MODEL).join(tails, keys, "left")
    tail = F.lit(0.0)
    for k in ks:
        tail = F.when(F.col("_K") == k, F.coalesce(F.col(f"_tail{k}"), F.lit(0.0))).otherwise(tail)
    st = st.withColumn("_tail", tail)
    st = st.join(F.broadcast(table.select(MODEL, F.col("_r").alias("_K"), F.col("_wg").alias("_wgK"))), [MODEL, "_K"], "left")
    init = [F.col("_m1"), F.when(F.col("_tr"), (F.col("_m2") - F.col("_m1")) / m).otherwise(F.lit(0.0))]
    init += [F.when(F.col("_se"), F.col(f"_y{i}") - F.col("_m1")).otherwise(F.lit(0.0)) for i in range(m - 1, -1, -1)]
    st = st.withColumn("_x0", F.array(*init)).withColumn("_p", F.least(F.col("_n") - m, F.col("_K")))
    st = st.join(F.broadcast(table.select(MODEL, F.col("_r").alias("_p"), "_pw")), [MODEL, "_p"], "left")
    state = []
    for k in range(d):
        init_k = sum((F.element_at("_pw", k * d + j + 1) * F.element_at("_x0", j + 1) for j in range(d)), F.lit(0.0))
        state.append(F.coalesce(init_k, F.lit(0.0)) + F.coalesce(F.col(f"_s{k}"), F.lit(0.0))
                     + F.element_at("_wgK", k + 1) * F.col("_tail"))
    st = st.withColumn("_state", F.array(*state)).where(F.col("_n") >= 2 * m)
    phi = F.col("_phi")
    damp = F.when(phi == 1.0, F.col(STEP).cast("double")).otherwise(phi * (1 - F.pow(phi, F.col(STEP))) / (1 - phi))
    idx = F.lit(2 + m) - F.pmod(F.col(STEP) - 1, F.lit(m))  # 1-based seasonal index for the step
    fc = (F.element_at("_state", 1) + F.when(F.col("_tr"), damp * F.element_at("_state", 2)).otherwise(F.lit(0.0))
          + F.when(F.col("_se"), F.element_at("_state", idx.cast("int"))).otherwise(F.lit(0.0)))
    out = horizon(st.select(*keys, MODEL, "_T", "_state", "_tr", "_se", "_phi"), [*keys, MODEL], h, freq)
    return out.select(*keys, DS, MODEL, fc.alias(YHAT))


def ets_additive(train: DataFrame, h: int, alpha: float = 0.3, beta: float = 0.1, gamma: float = 0.1,
                 season: int = 7, trend: bool = True, seasonal: bool = True, phi: float = 1.0,
                 freq: str = "D", id_cols: str | Sequence[str] = ID, name: str = "HoltWinters") -> DataFrame:
    """Additive Holt-Winters (``trend``/``seasonal`` select ETS(A,A,A), (A,N,A), (A,A,N),
    (A,N,N); ``phi < 1`` damps)."""
    return ets_grid(train, h, {name: dict(alpha=alpha, beta=beta, gamma=gamma, phi=phi, trend=trend, seasonal=seasonal)},
                    season, freq, id_cols)


ETS_FORMS = {
    "ETS_ANN": dict(trend=False, seasonal=False),
    "ETS_AAN": dict(trend=True, seasonal=False),
    "ETS_AAdN": dict(trend=True, seasonal=False, phi=0.9),
    "ETS_ANA": dict(trend=False, seasonal=True),
    "ETS_AAA": dict(trend=True, seasonal=True),
}


def auto_ets(train: DataFrame, h: int, season: int = 7, freq: str = "D", id_cols: str | Sequence[str] = ID,
             alphas: Sequence[float] = (0.1, 0.3, 0.5), validation: int | None = None) -> DataFrame:
    """M14 re-aimed: every additive form x alpha is fitted on the series minus its last
    ``validation`` steps, scored there (RMSE), and the best per series is refit on all
    data.  Model choice by validation error instead of an information criterion."""
    from chronoweave.operators import metrics, splits
    keys = _keys(id_cols)
    v = validation or h
    sp = splits.time_series_split(train, v, freq, keys)
    fit_part = sp.where(F.col("set") == "train").select(*keys, DS, Y)
    val_part = sp.where(F.col("set") == "test").select(*keys, DS, Y)
    cands = {f"{form}_a{int(a * 10)}": dict(kw, alpha=a) for form, kw in ETS_FORMS.items() for a in alphas}
    fc = ets_grid(fit_part, v, cands, season, freq, keys)
    score = metrics.point_metrics(metrics.score_frame(fc, val_part, keys), by=[*keys, MODEL], digits=12)
    best = metrics.best_model(score, "rmse", by=keys).groupBy(*keys).agg(F.min(MODEL).alias(MODEL))
    full = ets_grid(train, h, cands, season, freq, keys)
    return full.join(best, [*keys, MODEL]).withColumn("selected", F.col(MODEL)).withColumn(MODEL, F.lit("AutoETS"))
