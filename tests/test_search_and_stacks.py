"""Search, stacking and user-function operators: rules and invariants."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoweave.functions import transforms
from chronoweave.operators import baselines, diagnostics, ensemble, reshape, search, smoothing

D0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def panel(spark):
    rng = random.Random(3)
    rows = []
    for u in range(3):
        level = 20.0 + u
        for i in range(70):
            level += rng.gauss(0, 1)
            rows.append((f"s{u}", D0 + dt.timedelta(days=i), level + (i % 7)))
    return spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y double").cache()


def ses(params):
    return lambda tr, h, freq="D", id_cols="unique_id": smoothing.ses(tr, h, params["alpha"], freq, id_cols, name="SES")


def test_sequential_models_need_time_folds(panel):
    search.check_resampling(search.ROW_WISE, search.SHUFFLED_CV)
    search.check_resampling(search.SEQUENTIAL, search.TIME_CV)
    study = search.Study(search.narrowing({"alpha": (0.1, 0.9)}), ses)
    with pytest.raises(ValueError, match="time-ordered"):
        study.run(panel, search.Folds(7, 2, 7, resampling=search.SHUFFLED_CV), 1)


def test_search_scores_every_trial_and_refits_the_best(panel):
    folds = search.Folds(7, 2, 7)
    study = search.Study(search.narrowing({"alpha": (0.05, 0.95)}, explore=2), ses)
    trials = study.run(panel, folds, 4)
    assert [t.number for t in trials] == [0, 1, 2, 3] and all(0.05 <= t.params["alpha"] <= 0.95 for t in trials)
    pdf = panel.toPandas()
    for t in trials:  # the score is the RMSE over all folds and series
        err = []
        for _, g in pdf.groupby("unique_id"):
            y = g.sort_values("ds").y.to_numpy()
            for cut in (len(y) - 7, len(y) - 14):
                lv = y[0]
                for v in y[1:cut]:
                    lv = t.params["alpha"] * v + (1 - t.params["alpha"]) * lv
                err += [(lv - v) ** 2 for v in y[cut:cut + 7]]
        assert abs(np.sqrt(np.mean(err)) - t.score) < 1e-5
    best = min(trials, key=lambda t: t.score)
    want = {r["unique_id"]: r["y_hat"] for r in ses(best.params)(panel, 1).collect()}
    got = {r["unique_id"]: r["y_hat"] for r in study.refit(panel, folds, trials).where(F.col("ds") == F.lit(D0 + dt.timedelta(days=70)).cast("timestamp_ntz")).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_narrowing_stays_near_the_best():
    space = search.narrowing({"a": (0.0, 1.0)}, explore=2)
    seen = [search.Trial(0, space(0, []), 5.0), search.Trial(1, space(1, []), 1.0)]
    assert 0 <= seen[0].params["a"] < 0.5 <= seen[1].params["a"] <= 1
    for i in (2, 3, 4):
        p = space(i, seen)
        assert abs(p["a"] - seen[1].params["a"]) <= 0.5 ** (i - 1) / 2 + 1e-4


def test_scaled_forecast_is_inverted(panel):
    naive = lambda t, h, **kw: baselines.naive(t, h, **kw)
    a = {(r["unique_id"], r["ds"]): r["y_hat"] for r in transforms.scaled_forecast(panel, 3, naive).collect()}
    b = {(r["unique_id"], r["ds"]): r["y_hat"] for r in baselines.naive(panel, 3).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)
    flat = panel.withColumn("y", F.lit(4.0))
    assert all(abs(r["y_hat"] - 4.0) < 1e-12 for r in transforms.scaled_forecast(flat, 2, naive).collect())


def test_out_of_fold_has_one_row_per_fold_and_time(spark):
    rows = [("s", D0, D0 + dt.timedelta(days=1), m, 1.0 * k, 2.0) for k, m in enumerate(("A", "B"))]
    cv = spark.createDataFrame(rows, "unique_id string, cutoff timestamp_ntz, ds timestamp_ntz, model string, y_hat double, y double")
    r = ensemble.out_of_fold(cv, ["A", "B"]).collect()
    assert len(r) == 1 and (r[0]["A"], r[0]["B"], r[0]["y"]) == (0.0, 1.0, 2.0)


def test_user_functions_per_series(panel):
    r = diagnostics.user_features(panel, {"span": lambda c: F.max(c) - F.min(c)}).collect()
    p = panel.toPandas().groupby("unique_id").y
    assert {x["unique_id"]: round(x["span"], 9) for x in r} == (p.max() - p.min()).round(9).to_dict()
    rows = diagnostics.series_table(panel, {"n": F.count(F.lit(1))}, lambda s: F.array(F.struct(F.lit("n").alias("term"), s["n"].alias("v")))).collect()
    assert sorted((x["unique_id"], x["term"], x["v"]) for x in rows) == [(f"s{u}", "n", 70) for u in range(3)]


def test_intermittent_share_and_seeded_sample(spark, panel):
    a = reshape.to_intermittent(panel, 0.3).orderBy("unique_id", "ds").toPandas()
    b = reshape.to_intermittent(panel.repartition(5), 0.3).orderBy("unique_id", "ds").toPandas()
    assert a.equals(b)  # the same rows whatever the partitions
    share = (a.y == 0).mean()
    assert 0.15 < share < 0.45
    kept = a[a.y != 0].merge(panel.toPandas(), on=["unique_id", "ds"])
    assert (kept.y_x == kept.y_y).all()
