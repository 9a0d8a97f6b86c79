"""Temporal hierarchies (M24): forecasts at every aggregation level that divides the season, reconciled to agree.

A season of m steps is cut into blocks of k steps for every divisor k of m.  Each level is forecast on its own by any model of the
library, and the forecasts of a season's nodes are combined by least squares with structural weights (a
node's variance grows with the steps it sums).  The combination is a small table of weights, bottom step x
node, that depends on m alone; applying it is a join and a sum.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.timekeys import add_steps
from chronoweave.operators.baselines import MODEL, YHAT
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.series import POS, _keys, positioned

#: start of the made-up daily calendar on which the levels' blocks are numbered
ORIGIN = "2000-01-01"


def divisors(m: int) -> list[int]:
    return [k for k in range(1, m + 1) if m % k == 0]


def summing_matrix(m: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(nodes x bottom steps, nodes): a node (k, j) sums the steps j k .. (j + 1) k - 1."""
    nodes = [(k, j) for k in divisors(m) for j in range(m // k)]
    s = np.zeros((len(nodes), m))
    for i, (k, j) in enumerate(nodes):
        s[i, j * k:(j + 1) * k] = 1
    return s, nodes


def weights(m: int) -> list[tuple[int, int, int, float]]:
    """(bottom step, k, j, weight): (S' W S)^-1 S' W with W = 1 / k."""
    s, nodes = summing_matrix(m)
    w = np.array([1.0 / k for k, _ in nodes])
    p = np.linalg.solve(s.T @ (w[:, None] * s), s.T * w)
    return [(i, k, j, float(p[i, n])) for n, (k, j) in enumerate(nodes) for i in range(m)]


def aggregate_levels(train: DataFrame, m: int, freq: str, id_cols: str | Sequence[str] = ID) -> DataFrame:
    """(keys, k, ds, y): sums of ``k`` steps for every divisor, blocks counted back from the last step on a made-up daily
    calendar (``ds``); steps before the first whole season are left out."""
    keys = _keys(id_cols)
    x = positioned(train.select(*keys, DS, F.col(Y).cast("double").alias(Y)), keys, freq)[0]
    edge = x.groupBy(*keys).agg(F.max(POS).alias("_p1"), F.min(POS).alias("_p0"))
    whole = F.floor((F.col("_p1") - F.col("_p0") + 1) / m) * m
    x = x.join(edge, keys).withColumn("_r", F.col("_p1") - F.col(POS)).where(F.col("_r") < whole)
    x = x.withColumn("k", F.explode(F.array(*[F.lit(k) for k in divisors(m)]))).withColumn("_b", F.floor(F.col("_r") / F.col("k")))
    day = F.date_sub(F.lit(ORIGIN).cast("date"), F.col("_b").cast("int")).cast("timestamp_ntz")
    return x.groupBy(*keys, "k", "_b").agg(F.sum(Y).alias(Y)).select(*keys, "k", day.alias(DS), Y)


def temporal_hierarchy(train: DataFrame, h: int, model: Callable[..., DataFrame], season: int = 12, freq: str = "M", id_cols: str | Sequence[str] = ID,
                       all_levels: bool = False, name: str = "THIEF") -> DataFrame:
    """(keys, ds, model, y_hat) of ``h`` steps; with ``all_levels`` also ``k`` and ``step``, a block's number at its level, for every level.

    ``model(panel, h, freq=, id_cols=)`` forecasts a regular panel (any forecaster of the library).  Series must be on a regular grid without
    NULLs; one shorter than a season is forecast by ``model`` at the bottom level alone."""
    keys = _keys(id_cols)
    seasons = -(-h // season)
    levels = aggregate_levels(train, season, freq, keys)
    fc = model(levels, seasons * season, freq="D", id_cols=[*keys, "k"])
    step = F.datediff(DS, F.lit(ORIGIN).cast("date")) - 1
    fc = fc.select(*keys, "k", step.alias("_s"), YHAT).where(F.col("_s") * F.col("k") < seasons * season)
    per = (F.lit(season) / F.col("k")).cast("int")
    fc = fc.withColumn("_season", F.floor(F.col("_s") / per)).withColumn("j", (F.col("_s") % per).cast("int"))
    table = train.sparkSession.createDataFrame(weights(season), "_i int, k int, j int, _w double")
    bottom = fc.join(F.broadcast(table), ["k", "j"]).groupBy(*keys, "_season", "_i").agg(F.sum(F.col("_w") * F.col(YHAT)).alias(YHAT))
    bottom = bottom.withColumn("_s", F.col("_season") * season + F.col("_i"))
    last = train.groupBy(*keys).agg(F.max(DS).alias("_last"), F.count(F.lit(1)).alias("_n"))
    if all_levels:
        up = bottom.withColumn("k", F.explode(F.array(*[F.lit(k) for k in divisors(season)])))
        return up.groupBy(*keys, "k", F.floor(F.col("_s") / F.col("k")).alias("step")).agg(F.sum(YHAT).alias(YHAT)).withColumn(MODEL, F.lit(name))
    out = bottom.where(F.col("_s") < h).join(last.select(*keys, "_last"), keys).select(*keys, add_steps(F.col("_last"), F.col("_s") + 1, freq).alias(DS), F.lit(name).alias(MODEL), YHAT)
    short = train.join(last.where(F.col("_n") < season).select(*keys), keys, "left_semi")
    return out.unionByName(model(short, h, freq=freq, id_cols=keys).select(*keys, DS, F.lit(name).alias(MODEL), YHAT))
