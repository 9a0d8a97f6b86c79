import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoweave.operators import sarimax as sx

M = 4


def panel(spark, series, extra=None):
    rows = [(k, i, float(v), float(extra[k][i]) if extra else 0.0) for k, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "unique_id string, i int, y double, x double").select(
        "unique_id", F.timestamp_add("DAY", F.col("i"), F.lit("2020-01-01").cast("timestamp_ntz")).alias("ds"), "y", "x")


def loop(order, x, w, z, skip):
    """Innovations straight from the definition, one row at a time."""
    r = z.shape[1]
    phi, Phi, theta, Theta = order.split(np.array(x)[r:])
    n = w - z @ np.array(x)[:r]
    get = lambda v, t: v[t] if t >= 0 else 0.0
    e = np.zeros(len(w))
    for t in range(skip, len(w)):
        v = 0.0
        for i, a in enumerate([1.0, *(-phi)]):
            for j, b in enumerate([1.0, *(-Phi)]):
                v += a * b * get(n, t - i - M * j)
        for i, a in enumerate([1.0, *theta]):
            for j, b in enumerate([1.0, *Theta]):
                if i or j:
                    v -= a * b * get(e, t - i - M * j)
        e[t] = v
    return e


def test_innovations_and_derivatives_equal_loop():
    rng = np.random.default_rng(0)
    o = sx.Order(2, 1, 1, 1, M)
    w, z = rng.normal(size=60), rng.normal(size=(60, 2))
    x = np.r_[0.5, -0.2, rng.uniform(-0.4, 0.4, o.size)]
    state = np.zeros(o.back * 3 + o.memory * (1 + len(x)))
    e, J, parts = [], [], 0
    for a, b in ((0, 7), (7, 8), (8, 40), (40, 60)):  # blocks of any length, the state handed on
        ei, Ji, state = sx.innovations(o, x, w[a:b], z[a:b], state, np.arange(a, b), o.back)
        e.append(ei)
        J.append(Ji)
    e, J = np.concatenate(e), np.concatenate(J)
    assert np.allclose(e, loop(o, x, w, z, o.back), atol=1e-10)
    for i in range(len(x)):
        d = np.zeros(len(x))
        d[i] = 1e-6
        slope = (loop(o, x + d, w, z, o.back) - loop(o, x - d, w, z, o.back)) / 2e-6
        assert np.allclose(J[:, i], slope, atol=1e-5)


def simulate(rng, n, phi=0.6, theta=0.4):
    e = rng.normal(size=n + 50)
    v = np.zeros(n + 50)
    for t in range(1, n + 50):
        v[t] = phi * v[t - 1] + e[t] + theta * e[t - 1]
    return v[50:]


def test_fit_is_a_minimum_and_finds_the_parameters(spark):
    rng = np.random.default_rng(1)
    x = {k: rng.normal(size=n) for k, n in (("a", 500), ("b", 90))}
    series = {"a": 3 + 2 * x["a"] + simulate(rng, 500), "b": -1 + 0.5 * x["b"] + simulate(rng, 90)}
    df = panel(spark, series, x)
    fits = {r["unique_id"]: r for r in sx.fit_sarimax(df, (0, 0), [(1, 1, 0, 0)], M, ["x"], block_rows=64).collect()}
    o = sx.Order(1, 1, 0, 0, M)
    for k, y in series.items():
        z = np.c_[x[k], np.ones(len(y))]
        got = np.array(fits[k]["x"])
        sse = float((loop(o, got, y, z, 1) ** 2).sum())
        assert fits[k]["sse"] == pytest.approx(sse, rel=1e-9)
        for i in range(4):  # no step in any direction is better
            for s in (1e-3, -1e-3):
                assert (loop(o, got + s * np.eye(4)[i], y, z, 1) ** 2).sum() > sse - 1e-6 * sse
        n = len(y) - 1
        assert fits[k]["aicc"] == pytest.approx(n * math.log(sse / n) + 10 + 60 / (n - 6), rel=1e-9)
    # four standard errors and more: 0.05 for the slope, 0.16 for the constant, 0.05 for phi and theta
    assert (np.abs(np.array(fits["a"]["x"]) - [2, 3, 0.6, 0.4]) < [0.2, 0.65, 0.2, 0.2]).all()


def test_forecast_equals_loop(spark):
    rng = np.random.default_rng(2)
    y = np.cumsum(simulate(rng, 120)) + np.tile([5, 0, -5, 0], 30)
    x = rng.normal(size=126)
    y = y + 3 * x[:120]
    df = panel(spark, {"a": y}, {"a": x[:120]})
    future = panel(spark, {"a": np.zeros(126)}, {"a": x}).where(F.col("ds") > F.lit("2020-04-29").cast("timestamp_ntz"))
    fit = sx.fit_sarimax(df, (1, 1), [(1, 1, 0, 1)], M, ["x"]).first()
    rows = sx.sarimax(df, 6, (1, 1, 1), (0, 1, 1), M, ["x"], future).orderBy("ds").collect()
    o = sx.Order(1, 1, 0, 1, M)
    delta = sx.difference_lags(1, 1, M)
    assert delta.tolist() == [1, -1, 0, 0, -1, 1]
    ye, par = list(y), np.array(fit["x"])
    w = np.convolve(y, delta)[5:120]
    zx = np.convolve(x, delta)[5:126]
    z = np.c_[zx, np.zeros(len(zx))]  # two differences: no constant
    e = list(loop(o, par, w, z[:len(w)], 1))
    n = list(w - z[:len(w)] @ par[:2])
    phi, _, theta, Theta = o.split(par[2:])
    for s in range(6):
        nt = phi[0] * n[-1] + theta[0] * e[-1] + Theta[0] * e[-M] + theta[0] * Theta[0] * e[-M - 1]
        n.append(nt)
        e.append(0.0)
        wt = nt + z[len(w) + s] @ par[:2]
        ye.append(wt + ye[-1] + ye[-M] - ye[-M - 1])
    assert [r["y_hat"] for r in rows] == pytest.approx(ye[120:], rel=1e-7)
    assert rows[0]["order"] == "(1,1,1)(0,1,1)[4]" and rows[0]["model"] == "SARIMAX"


def kpss_loop(v):
    n = len(v)
    c = v - v.mean()
    lag = int(4 * (n / 100) ** 0.25)
    spread = c @ c + sum(2 * (1 - k / (lag + 1)) * (c[k:] @ c[:-k]) for k in range(1, lag + 1))
    return (np.cumsum(c) ** 2).sum() / spread / n


def test_differences(spark):
    rng = np.random.default_rng(3)
    flat, walk = rng.normal(size=200), np.cumsum(rng.normal(size=200))
    season = np.tile([9.0, 0, -9, 0], 50) + rng.normal(size=200)
    df = panel(spark, {"flat": flat, "walk": walk, "season": season, "const": np.ones(30)})
    x = sx.positioned(df, ["unique_id"], "D")[0]
    got = {r["unique_id"]: r["kpss"] for r in sx.kpss(x, "y").collect()}
    assert [got["flat"], got["walk"]] == pytest.approx([kpss_loop(flat), kpss_loop(walk)], rel=1e-9) and got["const"] is None
    d = {r["unique_id"]: (r["nd"], r["ns"]) for r in sx.choose_differences(df, M, "D").collect()}
    assert (d["flat"], d["walk"], d["season"], d["const"]) == ((0, 0), (1, 0), (0, 1), (0, 0))


def test_auto_arima_and_short_series(spark):
    rng = np.random.default_rng(4)
    df = panel(spark, {"a": 10 + simulate(rng, 150), "s": [1.0, 2.0, 3.0], "one": [7.0], "const": [4.0] * 40})
    rows = sx.auto_arima(df, 3, M, (1, 1, 0, 0), passes=4).collect()
    by = {k: [r["y_hat"] for r in rows if r["unique_id"] == k] for k in ("a", "s", "one", "const")}
    assert all(len(v) == 3 and all(math.isfinite(p) for p in v) for v in by.values())  # no series vanishes
    assert by["const"] == pytest.approx([4.0] * 3, abs=1e-6)
    assert {r["order"] for r in rows if r["unique_id"] == "a"} & {"(1,0,0)(0,0,0)[4]", "(1,0,1)(0,0,0)[4]"}
    assert sx.auto_arima(df.limit(0), 3, M, (1, 1, 0, 0), passes=1).collect() == []
