"""Recipes: learned on train rows, saved, loaded, baked on new rows; held against pandas."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest

from chronoweave.operators import recipe as rc
from chronoweave.panel import DS, ID, Y

START = dt.datetime(2020, 1, 1)


def panel(spark, n=60, ids=("a", "b", "c")):
    rng = np.random.default_rng(5)
    rows = [(u, START + dt.timedelta(days=i), float(rng.integers(1, 50)), float(i + k), "hot" if (i + k) % 3 else "cold")
            for k, u in enumerate(ids) for i in range(n)]
    return spark.createDataFrame(rows, f"{ID} string, {DS} timestamp_ntz, {Y} double, x double, kind string")


def split(df):
    cut = START + dt.timedelta(days=45)
    return df.where(df[DS] < cut), df.where(df[DS] >= cut)


def frame(df):
    return df.toPandas().sort_values([ID, DS], ignore_index=True)


STEPS = [rc.step("filter", condition="x >= 5"), rc.step("log1p", columns="y"), rc.step("signature", features=["wday", "month"]),
         rc.step("fourier", periods=[7], order=1), rc.step("spline", column="x", df=3), rc.step("dummy", column="kind"),
         rc.step("interact", left="kind_.*", right="ds_sin_7_1"), rc.step("normalize", columns="ds_wday|x"),
         rc.step("remove", columns="ds_month"), rc.step("role", columns="x", role="keep")]


def test_learned_on_train_only_and_baked_anywhere(spark, tmp_path):
    tr, te = split(panel(spark))
    prepared, baked = rc.prep(STEPS, tr)
    rc.save(spark, str(tmp_path / "recipe"), prepared)
    again = rc.load(spark, str(tmp_path / "recipe"))
    assert again == prepared
    got, raw, train = frame(rc.bake(again, te)), frame(te), frame(tr)
    train = train[train.x >= 5]
    assert len(got) == len(raw) and baked.count() == len(train)  # the filter chooses training rows only
    assert np.allclose(got.y, np.log1p(raw.y))
    assert np.allclose(got.x, (raw.x - train.x.mean()) / train.x.std())
    wday = train.ds.dt.weekday + 1
    assert np.allclose(got.ds_wday, (raw.ds.dt.weekday + 1 - wday.mean()) / wday.std())
    assert "ds_month" not in got and list(got.kind_hot) == [int(k == "hot") for k in raw.kind]
    assert np.allclose(got.inter_kind_hot__ds_sin_7_1, got.kind_hot * got.ds_sin_7_1)
    k = [train.x.min(), *np.quantile(train.x, [1 / 3, 2 / 3]), train.x.max()]
    z = [(v - k[0]) / (k[-1] - k[0]) for v in k]
    x = (raw.x - k[0]) / (k[-1] - k[0])
    d = lambda i: (np.maximum(x - z[i], 0) ** 3 - np.maximum(x - z[3], 0) ** 3) / (z[3] - z[i])
    assert np.allclose(got.x_ns_1, x) and np.allclose(got.x_ns_2, d(0) - d(2)) and np.allclose(got.x_ns_3, d(1) - d(2))
    assert "x" not in rc.predictors(prepared, baked) and {"kind_hot", "x_ns_2", "ds_wday"} <= set(rc.predictors(prepared, baked))
    assert prepared.columns_of("keep") == ["x"]


def test_lags_and_windows_see_history_only_through_it(spark):
    tr, te = split(panel(spark))
    steps = [rc.step("lag", columns="y", lags=[1, 20]), rc.step("slidify", column="x", window=5), rc.step("naomit", columns="y_lag_.*")]
    prepared, baked = rc.prep(steps, tr)
    assert baked.count() == 3 * (45 - 20)
    lag = "y_lag_20"
    got, whole = frame(rc.bake(prepared, te, tr)), frame(panel(spark))
    whole["want"] = whole.groupby(ID).y.shift(20)
    want = whole[whole.ds >= pd.Timestamp(START + dt.timedelta(days=45))]
    assert len(got) == len(want) and np.allclose(got[lag], want.want)
    alone = frame(rc.bake(prepared, te))
    assert alone[lag].isna().all() and len(alone) == len(want)


def test_clean_mends_train_rows_only(spark):
    from pyspark.sql import functions as F
    base = panel(spark, 84).withColumn(Y, F.weekday(DS) + 10.0)
    spike = base.withColumn(Y, F.when(F.col(DS) == F.lit(START + dt.timedelta(days=30)), 900.0).otherwise(F.col(Y)))
    prepared, baked = rc.prep([rc.step("clean", period=7)], spike)
    assert baked.agg(F.max(Y)).first()[0] < 100
    assert rc.bake(prepared, spike).agg(F.max(Y)).first()[0] == 900.0


def test_odd_rows(spark):
    tr, te = split(panel(spark))
    from pyspark.sql import functions as F
    steps = [rc.step("dummy", column="kind", drop_first=False), rc.step("normalize", columns="x|none")]
    prepared, _ = rc.prep(steps, tr.withColumn("x", F.lit(3.0)))
    new = te.limit(2).withColumn("kind", F.lit("new")).unionByName(te.limit(1).withColumn("kind", F.lit(None).cast("string")))
    got = frame(rc.bake(prepared, new))
    assert sorted(got.kind_hot.fillna(-1)) == [-1, 0, 0]
    assert not any(math.isnan(v) or math.isinf(v) for v in got.x)  # constant in the train rows: centred only
    assert rc.bake(prepared, te.limit(0)).count() == 0
    with pytest.raises(ValueError):
        rc.step("never")
    with pytest.raises(ValueError):
        rc.prep([rc.step("spline", column="x", df=2)], tr.limit(0))
    with pytest.raises(ValueError):
        rc.prep([rc.step("dummy", column="n")], spark.range(2000).select(F.lit("a").alias(ID), F.col("id").alias("n")))
