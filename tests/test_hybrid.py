"""Boosted hybrids: two stages against numpy, and a calendar effect that stage one cannot see."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from chronoweave.operators import hybrid, ml, regression
from chronoweave.panel import DS, ID, Y

START, N, H = dt.datetime(2021, 1, 1), 400, 28


def series(u, k):
    rng = np.random.default_rng(k)
    y, out = 5.0, []
    for i in range(N):
        d = START + dt.timedelta(days=i)
        y = 4 + 0.5 * y + rng.normal(0, 0.3)
        out.append((u, d, float(y + (6.0 if d.day <= 5 else 0.0))))
    return out


@pytest.fixture(scope="module")
def panel(spark):
    df = spark.createDataFrame([r for k, u in enumerate("abc") for r in series(u, k)], f"{ID} string, {DS} timestamp_ntz, {Y} double")
    cut = START + dt.timedelta(days=N - H)
    return df.where(F.col(DS) < cut), df.where(F.col(DS) >= cut)


def values(df, col):
    return {(r[ID], r[DS]): r[col] for r in df.collect()}


def test_two_stages_against_numpy(panel):
    tr, _ = panel
    lags = (1, 7)
    rows, targets, residuals, want = [], [], [], {}
    for u in "abc":
        v = np.array([r[2] for r in sorted(map(tuple, tr.where(F.col(ID) == u).collect()), key=lambda r: r[1])])
        x = np.array([[1, v[i - 1], v[i - 7]] for i in range(7, len(v))])
        b = np.linalg.lstsq(x, v[7:], rcond=None)[0]
        fit = x @ b
        for i, f in enumerate(fit, 7):
            d = START + dt.timedelta(days=i)
            want[u, d] = f
            rows.append([1, d.day, d.month])
            residuals.append(v[i] - f)
        path = list(v)
        for _ in range(H):
            path.append(b @ [1, path[-1], path[-7]])
        targets += [(u, START + dt.timedelta(days=len(v) + i), p) for i, p in enumerate(path[len(v):])]
    g = np.linalg.lstsq(np.array(rows, float), np.array(residuals), rcond=None)[0]
    fitted = hybrid.ar_fitted(tr, lags)
    got = {k: f for k, f in values(fitted, "fitted").items() if f is not None}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)
    out = values(hybrid.boosted(fitted, regression.ar(tr, H, lags), LinearRegression(solver="normal"), ("mday", "month")), "y_hat")
    assert len(out) == len(targets)
    for u, d, p in targets:
        assert abs(out[u, d] - (p + g @ [1, d.day, d.month])) < 1e-5


def test_boosting_finds_the_days_stage_one_misses(panel):
    tr, te = panel
    truth = values(te, Y)
    rmse = lambda fc: float(np.sqrt(np.mean([(v - truth[k]) ** 2 for k, v in values(fc, "y_hat").items()])))
    gbm = ml.estimators()["GBM"]
    first = regression.prophet_like(tr, H)
    both = hybrid.boosted(regression.prophet_fitted(tr), first, gbm)
    assert both.count() == te.count() and rmse(both) < 0.75 * rmse(first)


def test_fitted_values_are_those_of_the_forecast_model(panel):
    """On the train rows the fitted values leave residuals that sum to nothing (the model has an intercept)."""
    tr, _ = panel
    r = regression.prophet_fitted(tr, ridge=0.0, n_changepoints=2, yearly=1).groupBy(ID).agg(F.avg(F.col(Y) - F.col("fitted")).alias("m")).collect()
    assert len(r) == 3 and all(abs(x["m"]) < 1e-5 for x in r)
