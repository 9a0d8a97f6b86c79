"""Micro fixtures (FIXTURES.md §5) for single operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chronoweave.functions.aggs import quantile
from chronoweave.functions.calendar import calendar_column
from chronoweave.functions.timekeys import add_steps
from chronoweave.operators import baselines, metrics, splits, timegrid
from chronoweave.functions import transforms as tf


def _df(spark, rows):
    return spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y double")


def d(s):
    return dt.datetime.fromisoformat(s)


def test_stats4(spark):
    df = _df(spark, [("s", d("2024-01-0%d" % (i + 1)), v) for i, v in enumerate([1.0, 2.0, 4.0, 9.0])])
    r = df.agg(F.median("y").alias("med"), F.stddev_samp("y").alias("sd"), F.stddev_pop("y").alias("psd"),
               quantile("y", 0.25).alias("q")).first()
    assert r.med == 3.0 and abs(r.sd - 3.5590260840104366) < 1e-12 and abs(r.psd - 3.082207001484488) < 1e-12
    assert r.q == 1.75


def test_month_end_and_sunday(spark):
    df = spark.createDataFrame([(d("2024-01-31"),)], "ds timestamp_ntz")
    got = df.select(*[add_steps(F.col("ds"), k, "M").alias(f"m{k}") for k in (1, 2, 3, 4)]).first()
    assert [v.date().isoformat() for v in got] == ["2024-02-29", "2024-03-31", "2024-04-30", "2024-05-31"]
    sun = spark.createDataFrame([(d("2024-01-07"),)], "ds timestamp_ntz")
    r = sun.select(calendar_column(F.col("ds"), "wday").alias("w"), F.date_trunc("week", "ds").alias("wk")).first()
    assert r.w == 7 and r.wk.date().isoformat() == "2024-01-01"


def test_gap_padding(spark):
    df = _df(spark, [("s", d("2024-01-01"), 1.0), ("s", d("2024-01-02"), 2.0), ("s", d("2024-01-05"), 5.0)])
    out = timegrid.pad_by_time(df, "D", fill={"y": 0.0}).orderBy("ds").collect()
    assert len(out) == 5 and [r.y for r in out] == [1.0, 2.0, 0.0, 0.0, 5.0]


def test_constant_series(spark):
    df = _df(spark, [("c", d("2024-01-%02d" % (i + 1)), 3.0) for i in range(20)])
    std, _ = tf.standardize(df, ddof=1)
    assert all(r.y is None for r in std.collect())  # sd 0 -> NULL, not an error
    tr, te = df.where("ds <= '2024-01-15'"), df.where("ds > '2024-01-15'")
    fc = baselines.naive(tr, 5)
    m = metrics.point_metrics(metrics.score_frame(fc, te)).first()
    assert m.mae == 0.0 and m.rmse == 0.0


def test_zero_values_give_null_mape(spark):
    df = _df(spark, [("z", d("2024-01-01"), 0.0)])
    fc = spark.createDataFrame([("z", d("2024-01-01"), "m", 1.0)], "unique_id string, ds timestamp_ntz, model string, y_hat double")
    assert metrics.point_metrics(metrics.score_frame(fc, df)).first().mape is None


def test_short_series_gives_no_fold(spark):
    df = _df(spark, [("s", d("2024-01-0%d" % (i + 1)), float(i)) for i in range(5)])
    w = splits.backtest_windows(df, 7, 2, 7)
    assert w.where("set = 'train'").count() == 0
