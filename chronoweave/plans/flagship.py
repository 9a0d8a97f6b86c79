"""The minimum end-to-end slice: orders -> daily panel -> pad -> 56-day holdout ->
seasonal naive (m = 7) -> per-series accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.operators import baselines, metrics, splits, timegrid
from chronoweave.panel import DS, ID, Y
from chronoweave.sources import panels

H = 56


def daily_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timegrid.pad_by_time(panels.orders_daily(spark, sf_dir).select(ID, DS, Y), "D", fill={Y: 0.0})


def holdout_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = daily_panel(spark, sf_dir)
    split = splits.time_series_split(panel, H, "D")
    train = split.where(F.col("set") == "train").select(ID, DS, Y)
    test = split.where(F.col("set") == "test").select(ID, DS, Y)
    fc = baselines.seasonal_naive(train, H, season=7)
    return metrics.point_metrics(metrics.score_frame(fc, test))
