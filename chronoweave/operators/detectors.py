"""Control-chart detectors with a training prefix (J07): probabilistic EWMA, SD-EWMA and its two-stage form.

The recursions run in blocks of time, in parallel, until every block starts from its predecessor's
end (:func:`chronoweave.plans.blocks.fold_blocks`): the flags are those of the sequential charts.  What is learned
from the training prefix (at most 750 rows by default) is fitted on the prefix alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.operators.neighbours import training_rows
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.blocks import ARRAY_ROWS, fold_blocks, gather, map_blocks
from chronoweave.plans.series import POS, _keys, with_positions

LAMBDAS = tuple(round(0.1 * i, 1) for i in range(1, 11))


def _prepared(df: DataFrame, value_col: str, keys: list[str], train: int | None) -> DataFrame:
    """Observed rows with positions from 0 and the series' training length ``_n``."""
    seen = df.where(F.col(value_col).isNotNull()).select(*keys, DS, F.col(value_col).cast("double").alias("_v"))
    size = seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    n: Column = training_rows(F.col("_rows")) if train is None else F.lit(train).cast("long")
    return with_positions(seen, keys).join(size.select(*keys, n.alias("_n")), keys)


def probabilistic_ewma(df: DataFrame, value_col: str = Y, alpha: float = 0.8, beta: float = 0.3, limit: float = 3.0, train: int | None = None,
                       id_cols: str | Sequence[str] = ID, block_rows: int = ARRAY_ROWS, digits: int = 6) -> DataFrame:
    """Rows of ``df`` with ``pewma_mean`` and ``pewma_sd`` (before the row) and ``anomaly_pewma`` (0/1).

    Mean and variance follow m' = a m + (1 - a) x and v' = a (v + (1 - a) (x - m)^2).  In training (the first
    ``train`` rows, default :func:`training_rows`) a = 1 - 1/t, afterwards a = alpha (1 - beta P), with P the normal
    density of the standardised deviation, so an unlikely value moves the chart less.  After training a row is an
    anomaly if it lies more than ``limit`` deviations from the mean.  NULL values are passed over."""
    keys = _keys(id_cols)
    x = _prepared(df, value_col, keys, train)

    def chart(p, state, v, _n):
        mean, var = state
        m, s, flag = np.empty(len(v)), np.empty(len(v)), np.zeros(len(v), np.int32)
        for i in range(len(v)):
            t = int(p[i]) + 1
            value = float(v[i])
            if t == 1:
                mean, var = value, 0.0
            d, sd = value - mean, math.sqrt(var)
            m[i], s[i] = mean, sd
            if t <= _n:
                a = 1 - 1 / t
            else:
                flag[i] = abs(d) > limit * sd
                z = d / sd if sd > 0 else 0.0
                a = alpha * (1 - beta * math.exp(-z * z / 2) / math.sqrt(2 * math.pi))
            var = a * (var + (1 - a) * d * d)
            mean += (1 - a) * d
        return {"_m": m, "_s": s, "_f": flag}, np.array([mean, var])
    found = fold_blocks(gather(x, ["_v"], keys, POS, block_rows, scalars=["_n"]), chart, lambda _n: np.zeros(2),
                        {"_m": "double", "_s": "double", "_f": "int"}, ["_v"], keys, POS, ["_n"])
    out = found.join(x.select(*keys, POS, DS), [*keys, POS]).select(
        *keys, DS, F.round("_m", digits).alias("pewma_mean"), F.round("_s", digits).alias("pewma_sd"), F.col("_f").alias("anomaly_pewma"))
    return df.join(out, [*keys, DS], "left").withColumn("anomaly_pewma", F.coalesce("anomaly_pewma", F.lit(0)))


def fit_ewma(v: np.ndarray) -> tuple[float, float, float]:
    """(lambda, start, variance) on the training values: the lambda of the grid with the least sum of squared one-step
    errors from their mean (the smallest of equals), and the mean square of these errors."""
    best = (math.inf, 0.0)
    start = float(v.mean())
    for lam in LAMBDAS:
        z, sse = start, 0.0
        for x in v.tolist():
            sse += (x - z) ** 2
            z += lam * (x - z)
        best = min(best, (sse, lam))
    return best[1], start, best[0] / len(v)


@lru_cache(maxsize=None)
def ks_p_value(d: float, m: int, n: int) -> float:
    """P(D >= d) of the two-sample Kolmogorov-Smirnov statistic without ties: the share of lattice paths
    from (0, 0) to (m, n) that reach |i/m - j/n| >= d."""
    ways = [[0] * (n + 1) for _ in range(m + 1)]
    for i in range(m + 1):
        for j in range(n + 1):
            if abs(i / m - j / n) < d - 1e-12:
                ways[i][j] = 1 if i == j == 0 else (ways[i - 1][j] if i else 0) + (ways[i][j - 1] if j else 0)
    return 1 - ways[m][n] / math.comb(m + n, m)


def ks_statistic(a: np.ndarray, b: np.ndarray) -> float:
    """Largest distance between the two samples' distribution functions."""
    x = np.sort(np.r_[a, b])
    return float(np.abs(np.searchsorted(np.sort(a), x, "right") / len(a) - np.searchsorted(np.sort(b), x, "right") / len(b)).max())


def sd_ewma(df: DataFrame, value_col: str = Y, limit: float = 3.0, theta: float = 0.1, train: int | None = None, window: int = 5,
            confirm: float = 0.05, id_cols: str | Sequence[str] = ID, block_rows: int = ARRAY_ROWS, digits: int = 6) -> DataFrame:
    """Rows of ``df`` with ``ewma_lambda``, ``ewma_mean`` and ``ewma_sd`` (before the row), ``anomaly_sd`` and ``anomaly_two_stage`` (0/1).

    z' = z + lambda (x - z) with the lambda, start and error variance that :func:`fit_ewma` learns on the
    first ``train`` rows (default :func:`training_rows`); the variance follows s' = theta e^2 + (1 - theta) s.  After training
    a row is an anomaly if it lies more than ``limit`` deviations from z.  The second stage keeps it if the
    ``window`` values before it and the ``window`` values from it on differ (two-sample Kolmogorov-Smirnov test at level ``confirm``;
    fewer values at the ends).  NULL values are passed over; a series without a training row has no flags."""
    keys = _keys(id_cols)
    x = _prepared(df, value_col, keys, train)
    prefix = gather(x.where(F.col(POS) < F.col("_n")), ["_v"], keys, POS, 1 << 40)

    def learn(p, own, v):
        return {n: np.full(len(v), c) for n, c in zip(("_lam", "_z0", "_s0"), fit_ewma(v))}
    fitted = map_blocks(prefix, learn, {"_lam": "double", "_z0": "double", "_s0": "double"}, ["_v"], keys).where(F.col(POS) == 0).drop(POS)
    rows = x.join(fitted, keys)
    extra = ["_n", "_lam", "_z0", "_s0"]

    def chart(p, state, v, _n, _lam, _z0, _s0):
        z, var = state
        m, s, flag = np.empty(len(v)), np.empty(len(v)), np.zeros(len(v), np.int32)
        for i in range(len(v)):
            e = float(v[i]) - z
            m[i], s[i] = z, math.sqrt(var)
            flag[i] = p[i] >= _n and abs(e) > limit * s[i]
            var = theta * e * e + (1 - theta) * var
            z += _lam * e
        return {"_m": m, "_s": s, "_f": flag}, np.array([z, var])
    found = fold_blocks(gather(rows, ["_v"], keys, POS, block_rows, scalars=extra), chart,
                        lambda _n, _lam, _z0, _s0: np.array([_z0, _s0]), {"_m": "double", "_s": "double", "_f": "int"}, ["_v"], keys, POS, extra)
    found = found.join(rows.select(*keys, POS, DS, "_v", "_lam"), [*keys, POS])

    def second(p, own, v, f):
        out = np.zeros(int(own.sum()), np.int32)
        for j, i in enumerate(np.flatnonzero(own)):
            a, b = v[max(0, i - window):i], v[i:i + window]
            out[j] = bool(f[i]) and len(a) > 0 and ks_p_value(ks_statistic(a, b), len(a), len(b)) <= confirm
        return {"_g": out}
    stage = map_blocks(gather(found, ["_v", "_f"], keys, POS, max(block_rows, window), window, window), second, {"_g": "int"}, ["_v", "_f"], keys)
    out = found.join(stage, [*keys, POS]).select(
        *keys, DS, F.col("_lam").alias("ewma_lambda"), F.round("_m", digits).alias("ewma_mean"), F.round("_s", digits).alias("ewma_sd"),
        F.col("_f").alias("anomaly_sd"), F.col("_g").alias("anomaly_two_stage"))
    flags = {c: F.coalesce(c, F.lit(0)) for c in ("anomaly_sd", "anomaly_two_stage")}
    return df.join(out, [*keys, DS], "left").withColumns(flags)
