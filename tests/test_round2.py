"""Value tests of the repairs and additions of the second round."""

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronoweave.functions import aggs, calendar, holidays
from chronoweave.operators import outliers, regression, smoothing, windows
from chronoweave.plans.series import DEFAULT_BLOCK_ROWS  # noqa: F401

D0 = dt.datetime(2024, 1, 1)


def series(spark, values, start=D0, uid="s", skip=()):
    rows = [(uid, start + dt.timedelta(days=i), v) for i, v in enumerate(values) if i not in skip]
    return spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y double")


@pytest.mark.parametrize("block", [3, 1 << 20])
def test_ewm_over_nulls_equals_pandas(spark, block):
    rng = random.Random(1)
    y = [None, None, None] + [rng.choice([None, rng.uniform(0, 10)]) for _ in range(60)] + [10.0, 10.0]
    got = windows.augment_ewm(series(spark, y), "y", [0.1, 0.3], freq="D", block_rows=block).orderBy("ds").toPandas()
    for a, name in ((0.1, "y_ewm_mean_alpha_0_1"), (0.3, "y_ewm_mean_alpha_0_3")):
        want = pd.Series(y, dtype=float).ewm(alpha=a, adjust=True).mean()
        assert np.allclose(got[name].astype(float), want, equal_nan=True)


def test_gapped_series_is_refused(spark):
    full, gap = series(spark, [float(i) for i in range(8)]), series(spark, [float(i) for i in range(8)], skip=(3, 5))
    assert smoothing.ses(full, 2, 0.3, "D").count() == 2
    with pytest.raises(Exception, match="irregular series"):
        smoothing.ses(gap, 2, 0.3, "D").collect()


def test_centred_window_across_the_epoch(spark):
    df = series(spark, [10.0] * 9, start=dt.datetime(1970, 1, 1))
    got = windows.augment_rolling(df, "y", 3, "mean", center=True, freq="D").orderBy("ds").toPandas()["y_rolling_mean_win_3"]
    assert got.iloc[1:-1].tolist() == [10.0] * 7 and got.isna().sum() == 2
    blocks = windows.augment_rolling(df, "y", 3, "mean", center=True, freq="D", block_rows=4).orderBy("ds").toPandas()
    assert blocks["y_rolling_mean_win_3"].iloc[1:-1].tolist() == [10.0] * 7


def test_imapa_has_no_level_cap_and_keeps_every_series(spark):
    y = [float(i % 30 == 29) * (1 + i // 30) for i in range(240)]
    df = series(spark, y).unionByName(series(spark, [0.0] * 240, uid="none"))
    one = smoothing.imapa(df, 1, "D", grid=[0.3]).toPandas().set_index("unique_id")["y_hat"]

    def adida(k):
        sums = [sum(y[i * k:(i + 1) * k]) for i in range(len(y) // k)]
        level = sums[0]
        for s in sums[1:]:
            level = 0.3 * s + 0.7 * level
        return level / k
    assert abs(one["s"] - np.mean([adida(k) for k in range(1, 31)])) < 1e-9
    assert one["none"] == 0.0


def test_quantiles_are_exact(spark):
    n = 1_000_003
    df = spark.range(n).select(F.pmod(F.col("id") * 7919, F.lit(n)).cast("double").alias("v"))
    want = [q * (n - 1) for q in (0.25, 0.5, 0.99)]
    assert np.allclose(df.agg(aggs.quantile("v", [0.25, 0.5, 0.99]).alias("q")).first().q, want)
    assert np.allclose(aggs.global_quantiles(df, "v", [0.25, 0.5, 0.99]), want)
    few = spark.range(300_000).select((F.col("id") % 3).cast("double").alias("v"))
    assert aggs.global_quantiles(few, "v", [0.0, 0.5, 1.0]) == [0.0, 1.0, 2.0]
    assert aggs.global_quantiles(few.where("false"), "v", [0.5]) == [None]


def test_holidays_follow_the_data(spark):
    df = spark.createDataFrame([(dt.datetime(1899, 12, 25),), (dt.datetime(2155, 7, 4),), (dt.datetime(2024, 3, 5),), (None,)], "ds timestamp_ntz")
    got = {r["ds"]: r["is_holiday"] for r in holidays.augment_holiday_signature(df).collect()}
    assert got[dt.datetime(1899, 12, 25)] == 1 and got[dt.datetime(2155, 7, 4)] == 1 and got[dt.datetime(2024, 3, 5)] == 0


def test_one_hot_refuses_unbounded_levels(spark):
    with pytest.raises(ValueError, match="levels"):
        calendar.one_hot(spark.range(5000).select(F.col("id").cast("string").alias("c")), "c")


def test_t_quantile():
    for p, df, want in ((0.975, 10, 2.2281388519649), (0.95, 1, 6.3137515146750), (0.9995, 30, 3.6459586350420), (0.975, 1000, 1.9623390808264)):
        assert abs(outliers.t_quantile(p, df) - want) < 1e-8


def brute_gesd(y, r, alpha=0.05):
    left = list(range(len(y)))
    out, best = [], 0
    n = len(y)
    for i in range(1, min(r, n - 2) + 1):
        v = np.array([y[k] for k in left])
        m, s = v.mean(), v.std(ddof=1)
        k = max(left, key=lambda k: abs(y[k] - m))
        t = outliers.t_quantile(1 - alpha / (2 * (n - i + 1)), n - i - 1)
        crit = (n - i) * t / math.sqrt((n - i - 1 + t * t) * (n - i + 1))
        out.append(k)
        left.remove(k)
        if s > 0 and abs(y[k] - m) / s > crit:
            best = i
    return set(out[:best])


def test_gesd_against_brute_force(spark):
    rng = np.random.default_rng(2)
    frames, want = None, {}
    for u in range(4):
        y = rng.normal(0, 1, 200).tolist()
        for k in rng.choice(200, u * 3, replace=False):
            y[k] += float(rng.choice([-1, 1])) * rng.uniform(6, 12)
        want[f"s{u}"] = {D0 + dt.timedelta(days=k) for k in brute_gesd(y, 12)}
        f = series(spark, y, uid=f"s{u}")
        frames = f if frames is None else frames.unionByName(f)
    frames = frames.unionByName(series(spark, [3.0] * 30, uid="const")).unionByName(series(spark, [1.0, None], uid="short"))
    got = outliers.gesd(frames, max_outliers=12).toPandas()
    assert len(got) == 4 * 200 + 32
    for u, w in want.items():
        assert set(got[(got.unique_id == u) & (got.outlier == 1)].ds.dt.to_pydatetime()) == w
    assert got[got.unique_id.isin(["const", "short"])].outlier.sum() == 0
    assert max(map(len, want.values())) >= 6


def test_gesd_query_is_on_the_twitter_remainder(spark, monkeypatch):
    from chronoweave.plans import catalog_extras
    rng = np.random.default_rng(6)
    frames = None
    for u in range(3):  # trend, weekly season, and days out of line that lie inside the range of y
        y = [0.1 * i + 12 * (i % 7 == 2) + float(rng.normal()) for i in range(300)]
        for k in rng.choice(np.arange(60, 240), 5, replace=False):
            y[k] += 15 * float(rng.choice([-1, 1]))
        f = series(spark, y, uid=f"s{u}")
        frames = f if frames is None else frames.unionByName(f)
    monkeypatch.setattr(catalog_extras, "padded_daily", lambda spark, sf: frames)
    got = catalog_extras.j06(spark, "").toPandas().sort_values(["unique_id", "ds"])
    differs = 0
    for _, g in got.groupby("unique_id"):
        y = g.y.astype(float).reset_index(drop=True)
        off = y - y.rolling(91, center=True, min_periods=1).median()
        rest = off - off.groupby(y.index % 7).transform("median")
        assert np.allclose(rest, g.remainder, atol=1e-6)
        want = brute_gesd(rest.tolist(), 20)
        assert set(np.flatnonzero(g.outlier)) == want
        differs += len(want) >= 5 and not brute_gesd(y.tolist(), 20)
    assert differs == 3  # raw values hide them


def test_recursive_user_function(spark):
    y = [float(v) for v in range(1, 20)]
    fn = lambda h: (F.element_at(h, -1) + F.element_at(h, -3)) / 2
    got = regression.recursive_apply(series(spark, y).unionByName(series(spark, [1.0], uid="short")), 5, 3, fn, "D").orderBy("ds").toPandas()
    hist = list(y)
    for _ in range(5):
        hist.append((hist[-1] + hist[-3]) / 2)
    assert np.allclose(got[got.unique_id == "s"].y_hat, hist[-5:])
    assert got[got.unique_id == "short"].y_hat.isna().all()
