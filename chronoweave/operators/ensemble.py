"""Forecast combinations over the long forecast table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.functions.aggs import quantile
from chronoweave.operators.baselines import MODEL, YHAT
from chronoweave.panel import DS, ID, Y


def ensemble_average(fc: DataFrame, kind: str = "mean", keys: Sequence[str] = (ID, DS), name: str | None = None,
                     models: Sequence[str] | None = None) -> DataFrame:
    """Mean or median of the member forecasts per ``(series, ds[, cutoff])``."""
    x = fc.where(F.col(MODEL).isin(list(models))) if models else fc
    agg = F.avg(YHAT) if kind == "mean" else F.median(YHAT)
    return x.groupBy(*keys).agg(agg.alias(YHAT)).withColumn(MODEL, F.lit(name or f"Ensemble_{kind}"))


def rank_loadings(metrics: DataFrame, metric: str = "rmse") -> DataFrame:
    """O07 loadings from ranks: the best model (smallest metric) gets the largest weight
    ``m``, the worst 1; normalised to sum 1.  ``metrics`` has one row per model (a small,
    model-sized table)."""
    w = Window.orderBy(F.col(metric).desc())
    r = metrics.withColumn("_w", F.rank().over(w).cast("double"))
    tot = r.agg(F.sum("_w")).scalar()
    return r.select(MODEL, (F.col("_w") / tot).alias("weight"))


def ensemble_weighted(fc: DataFrame, loadings: DataFrame | Mapping[str, float], keys: Sequence[str] = (ID, DS),
                      name: str = "Ensemble_weighted") -> DataFrame:
    """``sum(w * y_hat) / sum(w)`` with model loadings (a table or a fixed mapping)."""
    if isinstance(loadings, Mapping):
        spark = fc.sparkSession
        loadings = spark.createDataFrame([(k, float(v)) for k, v in loadings.items()], f"{MODEL} string, weight double")
    x = fc.join(F.broadcast(loadings), MODEL)  # one row per model: bounded by the model list
    return x.groupBy(*keys).agg((F.sum(F.col("weight") * F.col(YHAT)) / F.sum("weight")).alias(YHAT)) \
            .withColumn(MODEL, F.lit(name))


def select_by_rank(metrics: DataFrame, metric: str = "rmse", ranks: Sequence[int] | None = None,
                   exclude: Sequence[str] = ()) -> DataFrame:
    """Sub-model selection by rank slice (e.g. ranks 2..10) minus excluded names."""
    w = Window.orderBy(F.col(metric).asc(), F.col(MODEL))
    r = metrics.withColumn("_rk", F.row_number().over(w))
    if ranks is not None:
        r = r.where(F.col("_rk").isin(list(ranks)))
    if exclude:
        r = r.where(~F.col(MODEL).isin(list(exclude)))
    return r.select(MODEL, "_rk")


def relabel(fc: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename models (e.g. after combining model tables)."""
    expr = F.col(MODEL)
    for k, v in mapping.items():
        expr = F.when(F.col(MODEL) == k, F.lit(v)).otherwise(expr)
    return fc.withColumn(MODEL, expr)


def out_of_fold(cv: DataFrame, models: Sequence[str]) -> DataFrame:
    """The cross-validation frame with one column per model: ``(unique_id, cutoff, ds, y,
    <model>...)``; the models are named, so the pivot needs no pass of its own."""
    return cv.groupBy(ID, "cutoff", DS, Y).pivot(MODEL, list(models)).agg(F.first(YHAT))
