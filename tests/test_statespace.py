"""Aggregate-form smoothing models equal their sequential recursions."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from chronoweave.operators import smoothing, statespace


def _panel(spark, n=60, seed=3):
    rng = np.random.default_rng(seed)
    ds = pd.date_range("2021-01-01", periods=n, freq="D")
    y = 10 + 0.1 * np.arange(n) + 3 * np.sin(2 * np.pi * np.arange(n) / 7) + rng.normal(0, 1, n)
    pdf = pd.DataFrame({"unique_id": "s", "ds": ds, "y": y})
    return spark.createDataFrame(pdf).withColumn("ds", F.col("ds").cast("timestamp_ntz")), y


def test_holt_matches_loop(spark):
    df, y = _panel(spark)
    got = smoothing.holt(df, 3, 0.3, 0.1).orderBy("ds").toPandas()["y_hat"].to_numpy()
    l, b = y[0], y[1] - y[0]
    for x in y[1:]:
        ln = 0.3 * x + 0.7 * (l + b)
        b = 0.1 * (ln - l) + 0.9 * b
        l = ln
    np.testing.assert_allclose(got, [l + s * b for s in (1, 2, 3)], rtol=1e-9)


def test_holt_winters_matches_loop(spark):
    df, y = _panel(spark)
    a, bt, g, m = 0.3, 0.1, 0.1, 7
    got = statespace.ets_additive(df, 10, a, bt, g, m).orderBy("ds").toPandas()["y_hat"].to_numpy()
    l = y[:m].mean()
    b = (y[m:2 * m].mean() - y[:m].mean()) / m
    s = list(y[:m] - l)  # s[i] = seasonal of index i (oldest first)
    for t in range(m, len(y)):
        sm = s[t - m]
        ln = a * (y[t] - sm) + (1 - a) * (l + b)
        bn = bt * (ln - l) + (1 - bt) * b
        s.append(g * (y[t] - l - b) + (1 - g) * sm)
        l, b = ln, bn
    n = len(y)
    ref = [l + hh * b + s[n + hh - 1 - m * ((hh - 1) // m + 1)] for hh in range(1, 11)]
    np.testing.assert_allclose(got, ref, rtol=1e-9)


def test_holt_winters_long_series_uses_tail(spark):
    """A series longer than the power table (observations beyond K share the converged weight)."""
    df, y = _panel(spark, n=1500, seed=5)
    a, bt, g, m = 0.5, 0.3, 0.3, 7
    Fm, gg = statespace.hw_matrices(a, bt, g, m)
    assert len(statespace.power_tables(Fm, gg)[0]) < 1490
    got = statespace.ets_additive(df, 7, a, bt, g, m).orderBy("ds").toPandas()["y_hat"].to_numpy()
    l = y[:m].mean()
    b = (y[m:2 * m].mean() - y[:m].mean()) / m
    s = list(y[:m] - l)
    for t in range(m, len(y)):
        sm = s[t - m]
        ln = a * (y[t] - sm) + (1 - a) * (l + b)
        bn = bt * (ln - l) + (1 - bt) * b
        s.append(g * (y[t] - l - b) + (1 - g) * sm)
        l, b = ln, bn
    n = len(y)
    ref = [l + hh * b + s[n + hh - 1 - m] for hh in range(1, 8)]
    np.testing.assert_allclose(got, ref, rtol=1e-9)


def test_loess_matches_numpy(spark):
    from chronoweave.operators import diagnostics as dg
    df, y = _panel(spark, n=80, seed=9)
    got = dg.loess(df, "y", 21, 1, block_rows=16, digits=12).orderBy("ds").toPandas()["loess"].to_numpy()
    half, n, ref = 10, len(y), []
    for t in range(n):
        idx = np.arange(max(0, t - half), min(n, t + half + 1))
        d = (idx - t).astype(float)
        w = (1 - (np.abs(d) / (half + 1)) ** 3) ** 3
        X = np.vstack([np.ones_like(d), d]).T
        beta = np.linalg.solve(X.T @ (w[:, None] * X), X.T @ (w * y[idx]))
        ref.append(beta[0])
    np.testing.assert_allclose(got, ref, rtol=1e-9, atol=1e-9)


def test_wavelet_matches_numpy(spark):
    from chronoweave.operators import windows
    df, y = _panel(spark, n=70, seed=11)
    got = windows.augment_wavelet(df, "y", (2, 4), block_rows=13).orderBy("ds").toPandas()
    n = len(y)
    for s in (2, 4):
        reach = int(np.ceil(3.0 * s))
        ref = []
        for t in range(n):
            acc = 0.0
            for j in range(max(0, t - reach), min(n, t + reach + 1)):
                u = (j - t) / s
                acc += np.exp(-u * u / 2) * np.cos(5 * u) / np.sqrt(s) * y[j]
            ref.append(acc)
        np.testing.assert_allclose(got[f"y_wavelet_morlet_scale_{s}"].to_numpy(), ref, rtol=1e-9, atol=1e-9)
