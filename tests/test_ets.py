import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoweave.operators import ets

M = 4


def panel(spark, series):
    rows = [(k, i, float(v)) for k, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "unique_id string, i int, y double").select(
        "unique_id", F.timestamp_add("DAY", F.col("i"), F.lit("2020-01-01").cast("timestamp_ntz")).alias("ds"), "y")


def errors(form, theta, y, x):
    """Innovations of one model from one start state, one row at a time, and the state after."""
    f = ets.FORMS[form]
    a, b, g, p = (float(v[0]) for v in f.parts(np.array([theta])))
    level, slope, seas = x[0], x[1] if f.trend else 0.0, list(x[1 + f.trend:])
    out = []
    for v in y:
        mu = level + p * slope + (seas[0] if f.seasonal else 0.0)
        e = v - mu
        out.append(e)
        level, slope = level + p * slope + a * e, p * slope + b * e
        if f.seasonal:
            seas = seas[1:] + [seas[0] + g * e]
    return np.array(out), [level] + [slope] * f.trend + seas


def least(form, theta, y):
    """Least sum of squares over the start state, from the model's responses to unit states."""
    s = ets.FORMS[form].size(M)
    e0 = errors(form, theta, y, [0.0] * s)[0]
    resp = np.array([e0 - errors(form, theta, y, np.eye(s)[i].tolist())[0] for i in range(s)]).T
    x = np.linalg.lstsq(resp, e0, rcond=1e-9)[0]
    return float(((e0 - resp @ x) ** 2).sum()), x


def search(form, y, rounds):
    f = ets.FORMS[form]
    cand = f.grid()
    for r in range(rounds + 1):
        if r:
            cand = f.around(np.array(best), 0.25 / 2 ** r)
        sse = [least(form, t, y)[0] for t in cand]
        best = cand[int(np.flatnonzero(np.array(sse) <= min(sse) * (1 + 1e-9))[0])].tolist()
    return best, min(sse)


def series():
    rng = np.random.default_rng(0)
    t = np.arange(90)
    return {"level": (20 + np.cumsum(rng.normal(0, 1, 90))).tolist(), "trend": (5 + 0.7 * t + rng.normal(0, 0.6, 90)).tolist(),
            "season": (10 + np.tile([3, -1, -4, 2], 23)[:90] + rng.normal(0, 0.5, 90)).tolist()}


def test_chosen_form_and_parameters_equal_a_search_per_series(spark):
    data = series()
    fits = ets.fit_ets(panel(spark, data), M, rounds=2, freq="D", block_rows=16).collect()  # several blocks, composed
    chosen = {r["unique_id"]: r["form"] for r in ets.best_form(ets.fit_ets(panel(spark, data), M, rounds=2, freq="D")).collect()}
    for name, y in data.items():
        mean = float(np.mean(y))
        centred = [v - mean for v in y]
        score = {}
        for form, f in ets.FORMS.items():
            theta, sse = search(form, centred, 2)
            row = next(r for r in fits if (r["unique_id"], r["form"]) == (name, form))
            assert row["sse"] == pytest.approx(sse, rel=1e-7)
            assert row["theta"] == pytest.approx(theta, abs=1e-9), (name, form)
            k, n = f.free(M), len(y)
            score[form] = n * math.log(sse / n) + 2 * k + 2 * k * (k + 1) / (n - k - 1)
            assert row["aicc"] == pytest.approx(score[form], rel=1e-7)
        assert chosen[name] == min(score, key=score.get)
    assert chosen["season"][-1] == "A" and chosen["level"][-1] == "N" and chosen["trend"][1] == "A"


def test_forecasts(spark):
    data = series()
    got = ets.holt_winters(panel(spark, data), 6, M, rounds=3).orderBy("unique_id", "ds").collect()
    for name, y in data.items():
        mean = float(np.mean(y))
        centred = [v - mean for v in y]
        theta, _ = search("AAA", centred, 3)
        _, x = least("AAA", theta, centred)
        _, state = errors("AAA", theta, centred, x.tolist())
        want = [mean + state[0] + (s + 1) * state[1] + state[2 + s % M] for s in range(6)]
        assert [r["y_hat"] for r in got if r["unique_id"] == name] == pytest.approx(want, rel=1e-6)


def test_composition_is_associative():
    rng = np.random.default_rng(1)
    f = ets.FORMS["AAdA"]
    theta = f.grid()
    y = rng.normal(size=37)
    whole = ets.block_piece(f, theta, M, y)
    parts = [ets.block_piece(f, theta, M, y[a:b]) for a, b in ((0, 5), (5, 20), (20, 37))]
    for got in (ets.compose(ets.compose(parts[0], parts[1]), parts[2]), ets.compose(parts[0], ets.compose(parts[1], parts[2]))):
        for u, v in zip(got, whole):
            assert np.allclose(u, v, atol=1e-8)


def test_short_constant_empty(spark):
    rows = ets.auto_ets(panel(spark, {"one": [5.0], "two": [1.0, 2.0], "const": [3.0] * 40}), 3, M).collect()
    assert len(rows) == 9 and all(math.isfinite(r["y_hat"]) for r in rows)
    assert [r["y_hat"] for r in rows if r["unique_id"] == "const"] == pytest.approx([3.0] * 3)
    assert {r["form"] for r in ets.best_form(ets.fit_ets(panel(spark, {"const": [3.0] * 40}), M, rounds=1)).collect()} == {"ANN"}
    assert ets.auto_ets(panel(spark, {"one": [5.0]}).limit(0), 3, M).collect() == []
