"""The leaderboard over many candidates: cap, allowed algorithms, sort metric, best by criterion."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression

from chronoweave.operators import ml
from chronoweave.operators.ml import Candidate
from chronoweave.panel import DS, ID, Y


def rows(spark, n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, n)
    return spark.createDataFrame([("a", dt.datetime(2020 + seed, 1, 1) + dt.timedelta(days=i), float(3 + 2 * v + rng.normal(0, 0.1)), float(v))
                                  for i, v in enumerate(x)], f"{ID} string, {DS} timestamp_ntz, {Y} double, x double")


def test_leaderboard_against_numpy(spark):
    tr, te = rows(spark, 120, 0), rows(spark, 40, 1)
    tried = [Candidate("Flat", "GLM", LinearRegression(regParam=1000.0)), Candidate("Line", "GLM", LinearRegression(solver="normal")),
             Candidate("Stump", "Tree", DecisionTreeRegressor(maxDepth=1)), Candidate("Deep", "Tree", DecisionTreeRegressor(maxDepth=5)),
             Candidate("Late", "GLM", LinearRegression())]
    board, fitted = ml.automl(tr, te, ["x"], tried, max_models=4, sort="mae")
    got = {r["model"]: r for r in board.collect()}
    assert set(got) == set(fitted) == {"Flat", "Line", "Stump", "Deep"}  # the cap: the fifth is not tried
    a, b = (np.array([[r["x"], r[Y]] for r in d.collect()]) for d in (tr, te))
    w = np.polyfit(a[:, 0], a[:, 1], 1)
    e = np.polyval(w, b[:, 0]) - b[:, 1]
    assert abs(got["Line"]["mae"] - np.abs(e).mean()) < 1e-6 and abs(got["Line"]["rmse"] - np.sqrt((e ** 2).mean())) < 1e-6
    by_mae = sorted(got.values(), key=lambda r: r["mae"])
    assert [r["rank"] for r in by_mae] == [1, 2, 3, 4] and by_mae[0]["model"] == "Line"
    assert {m: got[m]["rank_in_algorithm"] for m in got} == {"Line": 1, "Flat": 2, "Deep": 1, "Stump": 2}
    assert ml.best_model(board) == "Line" and ml.best_model(board, "mae", "Tree") == "Deep"
    assert ml.best_model(board, "bias") == min(got.values(), key=lambda r: abs(r["bias"]))["model"]
    only, _ = ml.automl(tr, te, ["x"], tried, include=("Tree",))
    assert sorted(r["model"] for r in only.collect()) == ["Deep", "Stump"]
    with pytest.raises(ValueError):
        ml.automl(tr, te, ["x"], tried, exclude=("GLM", "Tree"))
    with pytest.raises(ValueError):
        ml.best_model(board, algorithm="GBM")


def test_candidates_have_every_algorithm_early():
    c = ml.candidates()
    assert len({x.name for x in c}) == len(c) and {x.algorithm for x in c[:4]} == {"GLM", "DRF", "GBM", "Tree"}
