import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoweave.operators import theta
from chronoweave.operators.smoothing import ALPHA_GRID


def panel(spark, series):
    rows = [(k, i, float(v)) for k, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "unique_id string, i int, y double").select(
        "unique_id", F.timestamp_add("MONTH", F.col("i"), F.lit("2015-01-01").cast("timestamp_ntz")).alias("ds"), "y")


def states(y, a, l0, w, h):
    """The state recursion, one row at a time; returns one-step predictions and forecasts."""
    level, mean, A, B = a * y[0] + (1 - a) * l0, y[0], y[0], 0.0
    mus, out = [y[0]], []
    for t in range(2, len(y) + h + 1):
        mu = level + w * ((1 - a) ** (t - 1) * A + (1 - (1 - a) ** t) / a * B)
        x = y[t - 1] if t <= len(y) else mu
        (mus if t <= len(y) else out).append(mu)
        level = a * x + (1 - a) * level
        B = ((t - 2) * B + 6 / t * (x - mean)) / (t + 1)
        mean = ((t - 1) * mean + x) / t
        A = mean - (t + 1) / 2 * B
    return mus, out


def brute(y, h, optimize):
    """Every smoothing constant; start level and w by least squares on the recursion's own responses."""
    best = None
    for a in ALPHA_GRID:
        zero = np.array(states(y, a, 0.0, 0.0, 0)[0][1:])
        f1 = np.array(states(y, a, 1.0, 0.0, 0)[0][1:]) - zero
        f2 = np.array(states(y, a, 0.0, 1.0, 0)[0][1:]) - zero
        e = np.array(y[1:]) - zero
        w = 0.5
        if optimize:
            w = float(np.linalg.lstsq(np.c_[f1, f2], e, rcond=None)[0][1])
            w = min(max(w, 0.0), theta.W_MAX)
        l0 = float(f1 @ (e - w * f2) / (f1 @ f1))
        sse = float(((e - l0 * f1 - w * f2) ** 2).sum())
        if best is None or sse < best[0] - 1e-9 * abs(best[0]):
            best = (sse, a, l0, w)
    return states(y, *best[1:], h)[1]


def series():
    rng = np.random.default_rng(0)
    t = np.arange(80)
    return {"a": (100 + 2 * t + rng.normal(0, 5, 80)).tolist(), "b": (50 + np.cumsum(rng.normal(0, 3, 60))).tolist(),
            "c": (1e6 + 1000 * t[:30] + rng.normal(0, 500, 30)).tolist()}


@pytest.mark.parametrize("optimize", [True, False])
def test_equals_state_recursion(spark, optimize):
    data = series()
    rows = theta.dynamic_theta(panel(spark, data), 6, optimize, freq="M").orderBy("unique_id", "ds").collect()
    for name, y in data.items():
        got = [r["y_hat"] for r in rows if r["unique_id"] == name]
        assert got == pytest.approx(brute(y, 6, optimize), rel=1e-6)
    assert rows[0]["ds"].isoformat().startswith("2021-09-01")


def test_seasonal(spark):
    rng = np.random.default_rng(1)
    t = np.arange(72)
    factor = 1 + 0.4 * np.sin(2 * math.pi * t / 12)
    y = (100 + t) * factor * np.exp(rng.normal(0, 0.01, 72))
    data = {"m": y.tolist(), "z": (y - 60).tolist(), "n": rng.normal(100, 5, 72).tolist(), "s": [5.0, 6.0, 7.0]}
    kinds = {r["unique_id"]: r["_kind"] for r in theta.seasonal_indices(panel(spark, data), 12, "M").collect()}
    assert (kinds["m"], kinds["n"], kinds["s"]) == ("multiplicative", "none", "none") and kinds["z"] in ("additive", "multiplicative")
    rows = theta.dynamic_theta(panel(spark, data), 12, season=12, freq="M").orderBy("unique_id", "ds").collect()
    got = np.array([r["y_hat"] for r in rows if r["unique_id"] == "m"])
    want = (100 + 72 + np.arange(12)) * (1 + 0.4 * np.sin(2 * math.pi * np.arange(12) / 12))
    assert np.abs(got / want - 1).max() < 0.08
    # indices are the mean ratios to the centred moving average
    ma = np.array([(y[i - 6:i + 7].sum() - (y[i - 6] + y[i + 6]) / 2) / 12 for i in range(6, 66)])
    ratio = np.array([np.mean((y[6:66] / ma)[(np.arange(6, 66) % 12) == p]) for p in range(12)])
    first = {r["ds"].month: r["_index"] for r in theta.seasonal_indices(panel(spark, {"m": data["m"]}), 12, "M").collect()}
    assert [first[p + 1] for p in range(12)] == pytest.approx((ratio / ratio.mean()).tolist(), rel=1e-9)


def test_short_and_empty(spark):
    rows = theta.dynamic_theta(panel(spark, {"a": [7.0], "b": [1.0, 2.0]}), 2, freq="M").orderBy("unique_id", "ds").collect()
    assert [r["y_hat"] for r in rows[:2]] == [7.0, 7.0] and len(rows) == 4
    assert all(math.isfinite(r["y_hat"]) for r in rows)
    assert theta.dynamic_theta(panel(spark, {"a": [7.0]}).limit(0), 2, freq="M").collect() == []
