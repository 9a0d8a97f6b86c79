import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoweave.operators import anomaly, stl
from chronoweave.plans.blocks import group_quantiles


def panel(spark, series):
    rows = [(k, i, None if v is None else float(v)) for k, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "unique_id string, i int, y double").select(
        "unique_id", F.timestamp_add("DAY", F.col("i"), F.lit("2020-01-01").cast("timestamp_ntz")).alias("ds"), "y")


def loess_brute(y, width, degree, rho, places):
    """One place at a time: the nearest points, their weights, a weighted line by normal equations."""
    n, out = len(y), []
    q = min(width, n)
    for x0 in places:
        left = min(max(x0 - (q - 1) // 2, 0), n - q)
        pts = range(left, left + q)
        h = max(abs(x0 - left), abs(left + q - 1 - x0)) + max(width - n, 0) // 2
        w = []
        for j in pts:
            d = abs(j - x0)
            w.append((0 if d > 0.999 * h else 1 if d <= 0.001 * h else (1 - (d / h) ** 3) ** 3) * rho[j])
        s = sum(w)
        if s <= 0:
            out.append(y[min(max(x0, 0), n - 1)])
            continue
        sx, sy = sum(a * j for a, j in zip(w, pts)) / s, sum(a * y[j] for a, j in zip(w, pts)) / s
        var = sum(a * (j - sx) ** 2 for a, j in zip(w, pts)) / s
        slope = sum(a * (j - sx) * (y[j] - sy) for a, j in zip(w, pts)) / s / var if degree and var > 1e-6 * h * h else 0.0
        out.append(sy + slope * (x0 - sx))
    return out


def stl_brute(y, p, ns, nt, nl, inner, outer):
    n = len(y)
    there = [0.0 if v is None else 1.0 for v in y]
    y = [0.0 if v is None else v for v in y]
    trend, rho = [0.0] * n, list(there)
    for k in range(outer + 1):
        for _ in range(inner):
            cycle = [0.0] * (n + 2 * p)
            for ph in range(p):
                sub = [y[i] - trend[i] for i in range(ph, n, p)]
                for m, v in enumerate(loess_brute(sub, ns, 1, [rho[i] for i in range(ph, n, p)], range(-1, len(sub) + 1))):
                    cycle[ph + m * p] = v
            low = cycle
            for width in (p, p, 3):
                low = [sum(low[i:i + width]) / width for i in range(len(low) - width + 1)]
            low = loess_brute(low, nl, 1, [1.0] * n, range(n))
            season = [cycle[p + i] - low[i] for i in range(n)]
            trend = loess_brute([y[i] - season[i] for i in range(n)], nt, 1, rho, range(n))
        if k < outer:
            e = [abs(y[i] - trend[i] - season[i]) for i in range(n)]
            h = 6 * float(np.median([v for v, t in zip(e, there) if t]))
            rho = [0.0 if not t else 1.0 if v <= 0.001 * h else 0.0 if v > 0.999 * h else (1 - (v / h) ** 2) ** 2 for v, t in zip(e, there)]
    return trend, season


def series(n, seed, gaps=()):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    y = 10 + 0.02 * t + 3 * np.sin(2 * math.pi * t / 7) * (1 + t / n) + rng.normal(0, 0.5, n)
    y[rng.integers(0, n, 4)] += 20
    return [None if i in gaps else float(v) for i, v in enumerate(y)]


@pytest.mark.parametrize("outer", [0, 2])
def test_blocks_equal_sequential_stl(spark, outer):
    data = {"a": series(420, 0), "b": series(97, 1, gaps=(5, 50, 96)), "c": series(14, 2)}
    s = stl.spans(7, 7)
    assert (s.trend, s.low_pass) == (15, 9)
    got = stl.stl(panel(spark, data), period=7, outer=outer, freq="D", block_rows=180, digits=None).orderBy("unique_id", "ds").collect()
    for name, y in data.items():
        trend, season = stl_brute(y, 7, 7, 15, 9, 2, outer)
        rows = [r for r in got if r["unique_id"] == name]
        assert [r["trend"] for r in rows] == pytest.approx(trend, abs=1e-7)
        assert [r["season"] for r in rows] == pytest.approx(season, abs=1e-7)
        assert [r["remainder"] is None for r in rows] == [v is None for v in y]


def test_short_and_empty(spark):
    rows = stl.stl(panel(spark, {"a": [1, 2, 3]}), period=7, freq="D").collect()
    assert [(r["trend"], r["season"], r["remainder"]) for r in rows] == [(None, None, None)] * 3
    assert stl.stl(panel(spark, {"a": [1, 2]}).limit(0), period=7, freq="D").collect() == []


def test_newest_days_are_flagged(spark):
    """Classical decomposition leaves half a period at the ends out; STL does not."""
    y = [v for v in series(300, 5)]
    rng = np.random.default_rng(6)
    y = (10 + 3 * np.sin(2 * math.pi * np.arange(300) / 7) + rng.normal(0, 0.3, 300)).tolist()
    y[-1] += 15
    y[150] -= 15
    df = panel(spark, {"a": y})
    got = anomaly.anomalize(df, period=7, method="stl", freq="D").orderBy("ds").collect()
    assert [i for i, r in enumerate(got) if r["anomaly"]] == [150, 299]
    clean = anomaly.ts_clean(df, period=7, freq="D", method="stl").orderBy("ds").collect()
    assert [i for i, r in enumerate(clean) if r["outlier"]] == [150, 299]
    assert abs(clean[299]["y_clean"] - 10) < 5


def test_mstl_separates_two_seasons(spark):
    t = np.arange(500)
    a, b = 3 * np.sin(2 * math.pi * t / 7), 5 * np.sin(2 * math.pi * t / 30)
    rows = stl.mstl(panel(spark, {"a": (20 + 0.01 * t + a + b).tolist()}), periods=(30, 7), freq="D", block_rows=900).orderBy("ds").collect()
    for name, want in (("seasonal_7", a), ("seasonal_30", b), ("trend", 20 + 0.01 * t)):
        assert np.abs(np.array([r[name] for r in rows]) - want).max() < 0.7
    assert all(abs(r["y"] - r["trend"] - r["seasonal_7"] - r["seasonal_30"] - r["remainder"]) < 1e-5 for r in rows)


def test_group_quantiles(spark):
    rng = np.random.default_rng(3)
    data = {"a": rng.normal(size=501), "b": rng.integers(0, 4, 100).astype(float), "c": np.array([5.0])}
    df = spark.createDataFrame([(k, float(v)) for k, vs in data.items() for v in vs] + [("a", None), ("d", None)], "unique_id string, v double")
    got = {r["unique_id"]: r for r in group_quantiles(df, "v", {"q1": 0.25, "m": 0.5, "q9": 0.9}).collect()}
    assert set(got) == {"a", "b", "c"}
    for k, v in data.items():
        assert [got[k][n] for n in ("q1", "m", "q9")] == pytest.approx(np.quantile(v, [0.25, 0.5, 0.9]).tolist(), abs=1e-12)
