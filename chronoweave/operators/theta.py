"""Dynamic theta models (M15) as least squares over block scans.

With ``s_t`` the smoothed level from zero, ``A_t + B_t t`` the line through the first t values and
c_t = (1-a)^(t-1) A_(t-1) + (1 - (1-a)^t) / a * B_(t-1), the one-step prediction of the dynamic theta
model is

    s_(t-1) + l_0 (1-a)^(t-1) + (1 - 1/theta) c_t

which is linear in the start level l_0 and in w = 1 - 1/theta.  For every smoothing constant a of a
grid, six sums over the series decide both, so all candidates of all series are fitted in one
pass over decay scans and running sums.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.timekeys import add_steps
from chronoweave.operators.baselines import MODEL, YHAT
from chronoweave.operators.smoothing import ALPHA_GRID
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.blocks import _bounded
from chronoweave.plans.series import POS, _keys, decay_scan, halo_window, positioned, prefix_sums

#: largest 1 - 1/theta that the optimised model may take
W_MAX = 0.9999


def seasonal_indices(df: DataFrame, season: int, freq: str, kind: str = "multiplicative", id_cols: str | Sequence[str] = ID,
                     limit: float = 1.645) -> DataFrame:
    """``df`` (columns of the panel) with ``_index``, the seasonal index of each row's phase (``pos mod season``), and ``_kind``.

    A series is seasonal if the autocorrelation at the season exceeds ``limit`` standard errors (Bartlett) and it
    has two seasons or more.  Indices are the mean ratios to (or differences from) a centred moving average, scaled to a mean
    of 1 (or 0).  Where ratios are not defined or some index is below 0.01, differences are used; series
    without a season have the index 0 and kind 'none'."""
    keys = _keys(id_cols)
    x, _ = positioned(df, keys, freq)
    mean = x.groupBy(*keys).agg(F.avg(Y).alias("_mean"), F.count(F.lit(1)).alias("_n"))
    x = x.join(mean, keys).withColumn("_c", F.col(Y) - F.col("_mean"))
    half = season // 2

    def build(w):
        cols = {f"_l{k}": F.lag("_c", k).over(w) for k in range(1, season + 1)}
        frame = w.rowsBetween(-half, half)
        if season % 2:
            ma = F.avg(Y).over(frame)
        else:
            ma = (F.sum(Y).over(frame) - (F.first(Y).over(frame) + F.last(Y).over(frame)) / 2) / season
        cols["_ma"] = F.when(F.count(Y).over(frame) == (season if season % 2 else season + 1), ma)
        return cols
    x = halo_window(x, max(season, half), half, build, keys)
    acf = x.groupBy(*keys).agg(F.first("_n").alias("_n"), F.sum(F.col("_c") ** 2).alias("_s0"),
                               *[F.sum(F.col("_c") * F.col(f"_l{k}")).alias(f"_s{k}") for k in range(1, season + 1)])
    r = {k: F.try_divide(F.coalesce(f"_s{k}", F.lit(0.0)), F.col("_s0")) for k in range(1, season + 1)}
    wide = F.sqrt((1 + 2 * sum((r[k] ** 2 for k in range(1, season)), F.lit(0.0))) / F.col("_n"))
    acf = acf.select(*keys, F.coalesce((F.abs(r[season]) > limit * wide) & (F.col("_n") >= 2 * season), F.lit(False)).alias("_seasonal"))
    x = x.withColumn("_ph", F.pmod(F.col(POS), F.lit(season)))
    ph = x.groupBy(*keys, "_ph").agg(F.avg(F.try_divide(F.col(Y), F.col("_ma"))).alias("_ratio"), F.avg(F.col(Y) - F.col("_ma")).alias("_diff"),
                                     F.min(Y).alias("_low"))
    scale = ph.groupBy(*keys).agg(F.avg("_ratio").alias("_rm"), F.avg("_diff").alias("_dm"), F.min("_ratio").alias("_rl"), F.min("_low").alias("_low"),
                                  F.count("_ratio").alias("_phases"))
    good = (F.lit(kind == "multiplicative") & (F.col("_low") > 0) & (F.col("_phases") == season) & (F.col("_rl") / F.col("_rm") >= 0.01))
    scale = scale.join(acf, keys).select(*keys, "_rm", "_dm", F.when(~F.col("_seasonal"), "none").when(F.coalesce(good, F.lit(False)), "multiplicative")
                                         .otherwise("additive").alias("_kind"))
    index = F.when(F.col("_kind") == "multiplicative", F.col("_ratio") / F.col("_rm")).when(F.col("_kind") == "additive", F.col("_diff") - F.col("_dm")).otherwise(0.0)
    table = ph.join(scale, keys).select(*keys, "_ph", "_kind", index.alias("_index"))
    return x.select(*df.columns, POS, "_ph").join(table, [*keys, "_ph"])


def dynamic_theta(train: DataFrame, h: int, optimize: bool = True, season: int | None = None, seasonal: str = "multiplicative", freq: str = "M",
                  grid: Sequence[float] = ALPHA_GRID, id_cols: str | Sequence[str] = ID) -> DataFrame:
    """(keys, ds, model, y_hat): DynamicOptimizedTheta (``optimize``) or DynamicTheta (theta = 2) forecasts of ``h`` steps.

    Per series the smoothing constant of ``grid`` with the least sum of squared one-step errors from the second row on, with
    its least-squares start level and (optimised) theta >= 1.  With ``season`` the seasonal indices of
    :func:`seasonal_indices` are taken out before and put back after.  Series must be on a regular grid without NULLs (pad first); a
    series of one row is forecast by its value."""
    keys = _keys(id_cols)
    base = train.select(*keys, DS, F.col(Y).cast("double").alias(Y))
    if season:
        x = seasonal_indices(base, season, freq, seasonal, keys)
        x = x.withColumn(Y, F.when(F.col("_kind") == "multiplicative", F.col(Y) / F.col("_index")).otherwise(F.col(Y) - F.col("_index")))
    else:
        x = positioned(base, keys, freq)[0].withColumns({"_ph": F.lit(0), "_kind": F.lit("none"), "_index": F.lit(0.0)})
    edge = x.groupBy(*keys).agg(F.min(POS).alias("_p0"), F.max(DS).alias("_last"), F.count(F.lit(1)).alias("_n"), F.min_by(Y, POS).alias("_y1"))
    x = x.select(*keys, POS, Y).join(edge, keys).withColumn("_t", (F.col(POS) - F.col("_p0") + 1).cast("double")).withColumn("_d", F.col(Y) - F.col("_y1"))
    # the line through the first t values, from running sums of y - y_1 (shifts cancel less)
    x = prefix_sums(x, {"_sy": F.col("_d"), "_sty": F.col("_t") * F.col("_d")}, keys)
    t = F.col("_t")
    slope = F.when(t > 1, 12 * (F.col("_sty") - (t + 1) / 2 * F.col("_sy")) / (t * (t * t - 1))).otherwise(0.0)
    x = x.withColumn("_B", slope).withColumn("_A", F.col("_y1") + F.col("_sy") / t - F.col("_B") * (t + 1) / 2)
    x = decay_scan(x, {f"_l{i}": (F.lit(a) * F.col(Y), 1.0 - a) for i, a in enumerate(grid)}, id_cols=keys)
    x = halo_window(x, 1, 0, lambda w: {"_pA": F.lag("_A", 1).over(w), "_pB": F.lag("_B", 1).over(w),
                                        **{f"_pl{i}": F.lag(f"_l{i}", 1).over(w) for i in range(len(grid))}}, keys)
    aggs = [F.first("_last").alias("_last"), F.first("_n").alias("_n"), F.first("_y1").alias("_y1"), F.max_by("_A", POS).alias("_A"), F.max_by("_B", POS).alias("_B"),
            F.max_by(F.col("_y1") + F.col("_sy") / t, POS).alias("_mean")]
    for i, a in enumerate(grid):
        f1 = F.pow(F.lit(1.0 - a), t - 1)
        f2 = f1 * F.col("_pA") + (1 - F.pow(F.lit(1.0 - a), t)) / a * F.col("_pB")
        e = F.when(t > 1, F.col(Y) - F.col(f"_pl{i}"))
        aggs.append(F.struct(F.lit(a).alias("a"), F.max_by(f"_l{i}", POS).alias("l"), F.sum(e * e).alias("ee"), F.sum(e * f1).alias("e1"), F.sum(e * f2).alias("e2"),
                             F.sum(F.when(t > 1, f1 * f1)).alias("f11"), F.sum(F.when(t > 1, f1 * f2)).alias("f12"),
                             F.sum(F.when(t > 1, f2 * f2)).alias("f22")).alias(f"_c{i}"))
    fits = x.groupBy(*keys).agg(*aggs).select(*keys, "_last", "_n", "_y1", "_A", "_B", "_mean", F.array(*[f"_c{i}" for i in range(len(grid))]).alias("_c"))
    name = "DynamicOptimizedTheta" if optimize else "DynamicTheta"

    kinds = {f.name: f.dataType.simpleString() for f in fits.schema}

    def forecast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            yhat = [_forecast(r, h, optimize) for r in rows]
            yield pa.RecordBatch.from_arrays([b.column(k) for k in keys] + [b.column("_last"), pa.array(yhat, pa.list_(pa.float64()))], [*keys, "_last", "_f"])
    f = _bounded(fits).mapInArrow(forecast, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + f", _last {kinds['_last']}, _f array<double>")
    f = f.select(*keys, "_last", F.posexplode("_f").alias("_s", "_v")).withColumn(DS, add_steps(F.col("_last"), F.col("_s") + 1, freq))
    if season:
        table = positioned(f.select(*keys, DS, "_v"), keys, freq)[0].withColumn("_ph", F.pmod(F.col(POS), F.lit(season)))
        index = seasonal_indices(base, season, freq, seasonal, keys).groupBy(*keys, "_ph").agg(F.first("_kind").alias("_kind"), F.first("_index").alias("_index"))
        f = table.join(index, [*keys, "_ph"], "left").withColumn(
            "_v", F.when(F.col("_kind") == "multiplicative", F.col("_v") * F.col("_index")).otherwise(F.col("_v") + F.coalesce("_index", F.lit(0.0))))
    return f.select(*keys, DS, F.lit(name).alias(MODEL), F.col("_v").alias(YHAT))


def _least(c: dict, optimize: bool) -> tuple[float, float, float]:
    """(sse, l_0, w) of one smoothing constant."""
    def start(w: float) -> float:
        return (c["e1"] - w * c["f12"]) / c["f11"] if c["f11"] > 0 else 0.0

    def sse(level: float, w: float) -> float:
        return (c["ee"] - 2 * level * c["e1"] - 2 * w * c["e2"] + level * level * c["f11"] + 2 * level * w * c["f12"] + w * w * c["f22"])
    w = 0.5
    if optimize:
        det = c["f11"] * c["f22"] - c["f12"] ** 2
        w = (c["f11"] * c["e2"] - c["f12"] * c["e1"]) / det if det > 1e-12 * c["f11"] * c["f22"] else 0.0
        w = min(max(w, 0.0), W_MAX)
    level = start(w)
    return sse(level, w), level, w


def _forecast(r: dict, h: int, optimize: bool) -> list[float]:
    """The recursion carried on with its own predictions as values."""
    n = r["_n"]
    if n < 2:
        return [r["_y1"]] * h
    best = min((( *_least(c, optimize), c) for c in r["_c"]), key=lambda x: (x[0], x[3]["a"]))
    _, l0, w, c = best
    a = c["a"]
    level = c["l"] + l0 * (1 - a) ** n
    mean, slope, icept = r["_mean"], r["_B"], r["_A"]
    out = []
    for t in range(n + 1, n + h + 1):
        mu = level + w * ((1 - a) ** (t - 1) * icept + (1 - (1 - a) ** t) / a * slope)
        out.append(mu)
        level = a * mu + (1 - a) * level
        slope = ((t - 2) * slope + 6 / t * (mu - mean)) / (t + 1)
        mean = ((t - 1) * mean + mu) / t
        icept = mean - (t + 1) / 2 * slope
    return out
