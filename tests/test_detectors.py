import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoweave.operators import detectors


def panel(spark, series):
    rows = [(k, i, None if v is None else float(v)) for k, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "unique_id string, i int, y double").select(
        "unique_id", F.timestamp_add("DAY", F.col("i"), F.lit("2020-01-01").cast("timestamp_ntz")).alias("ds"), "y")


def data():
    rng = np.random.default_rng(0)
    a = rng.normal(10, 1, 500)
    a[300:] += 6  # a shift of level
    a[200] += 9   # a single spike
    return {"a": a.tolist(), "b": rng.normal(size=90).tolist(), "c": [1.0, 1.0, 1.0], "d": [None, 2.0, None, 5.0]}


def training(n):
    return math.floor(0.15 * min(n, 5000))


def pewma_loop(y, alpha=0.8, beta=0.3, limit=3.0):
    n, out = training(len(y)), []
    s1 = s2 = None
    for t, x in enumerate(y, 1):
        if t == 1:
            s1, s2 = x, x * x
        sd = math.sqrt(max(s2 - s1 * s1, 0.0))
        out.append((s1, sd, int(t > n and abs(x - s1) > limit * sd)))
        z = (x - s1) / sd if sd > 0 else 0.0
        a = 1 - 1 / t if t <= n else alpha * (1 - beta * math.exp(-z * z / 2) / math.sqrt(2 * math.pi))
        s1, s2 = a * s1 + (1 - a) * x, a * s2 + (1 - a) * x * x
    return out


def sd_loop(y, limit=3.0, theta=0.1, window=5, level=0.05):
    n = training(len(y))
    if n < 1:
        return None
    z0 = float(np.mean(y[:n]))

    def errors(lam):
        z, e = z0, []
        for x in y[:n]:
            e.append(x - z)
            z = lam * x + (1 - lam) * z
        return e
    lam = min(detectors.LAMBDAS, key=lambda v: (sum(e * e for e in errors(v)), v))
    z, s, out = z0, sum(e * e for e in errors(lam)) / n, []
    for t, x in enumerate(y):
        f = int(t >= n and abs(x - z) > limit * math.sqrt(s))
        g = 0
        if f:
            a, b = y[max(0, t - window):t], y[t:t + window]
            g = int(len(a) > 0 and ks_all(a, b) <= level)
        out.append((lam, z, math.sqrt(s), f, g))
        s = theta * (x - z) ** 2 + (1 - theta) * s
        z = lam * x + (1 - lam) * z
    return out


def statistic(a, b):
    return max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in [*a, *b])


def ks_all(a, b):
    """p value by all ways to deal the ranks."""
    d, m, n = statistic(a, b), len(a), len(b)
    hits = total = 0
    for pick in itertools.combinations(range(m + n), m):
        rest = [i for i in range(m + n) if i not in pick]
        total += 1
        hits += statistic(list(pick), rest) >= d - 1e-12
    return hits / total


def test_probabilistic_ewma_equals_loop(spark):
    series = data()
    got = detectors.probabilistic_ewma(panel(spark, series), block_rows=64).orderBy("unique_id", "ds").collect()
    for name in "abc":
        rows = [r for r in got if r["unique_id"] == name]
        want = pewma_loop(series[name])
        assert [r["pewma_mean"] for r in rows] == pytest.approx([w[0] for w in want], abs=2e-6)
        assert [r["pewma_sd"] for r in rows] == pytest.approx([w[1] for w in want], abs=2e-5)
        assert [r["anomaly_pewma"] for r in rows] == [w[2] for w in want]
    a = [r["anomaly_pewma"] for r in got if r["unique_id"] == "a"]
    assert a[200] == 1 and a[300] == 1
    assert [(r["pewma_mean"], r["anomaly_pewma"]) for r in got if r["unique_id"] == "d"] == [(None, 0), (2.0, 0), (None, 0), (2.0, 1)]


def test_sd_ewma_equals_loop(spark):
    series = data()
    got = detectors.sd_ewma(panel(spark, series), block_rows=64).orderBy("unique_id", "ds").collect()
    for name in "ab":
        rows = [r for r in got if r["unique_id"] == name]
        want = sd_loop(series[name])
        for i, c in enumerate(("ewma_lambda", "ewma_mean", "ewma_sd", "anomaly_sd", "anomaly_two_stage")):
            assert [r[c] for r in rows] == pytest.approx([w[i] for w in want], abs=2e-6), c
    a = [r for r in got if r["unique_id"] == "a"]
    assert a[200]["anomaly_sd"] == 1 and a[200]["anomaly_two_stage"] == 0  # a spike is no shift
    assert a[300]["anomaly_sd"] == 1 and a[300]["anomaly_two_stage"] == 1
    # no training row, no flags
    assert {(r["anomaly_sd"], r["anomaly_two_stage"], r["ewma_mean"]) for r in got if r["unique_id"] in "cd"} == {(0, 0, None)}
    assert len(got) == sum(map(len, series.values()))


def test_ks_p_values():
    assert detectors.ks_p_value(1.0, 5, 5) == pytest.approx(2 / 252)
    assert detectors.ks_p_value(0.8, 5, 5) == pytest.approx(20 / 252)
    rng = np.random.default_rng(1)
    for m, n in ((3, 4), (5, 2), (4, 4)):
        a, b = rng.normal(size=m), rng.normal(1, 1, size=n)
        d = detectors.ks_statistic(a, b)
        assert d == pytest.approx(statistic(a, b)) and detectors.ks_p_value(d, m, n) == pytest.approx(ks_all(a, b))


def test_empty(spark):
    none = panel(spark, {"a": [1.0]}).limit(0)
    assert detectors.probabilistic_ewma(none).collect() == [] and detectors.sd_ewma(none).collect() == []
