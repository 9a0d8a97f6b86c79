"""Seasonal-trend decomposition by LOESS (I05, J02, M18) over halo blocks.

STL alternates local regressions of bounded width: over the values of each phase of the season, over their
moving averages, and over the deseasonalised series.  So one pass of ``inner`` rounds gives a row the
value that the sequential algorithm gives it if the block holds the rows within the sum of these
widths.  Robustness weights need one number of the whole series, the median size of
its remainder; every outer round is a pass over blocks and an exact group quantile that no hot
series can hold up.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.panel import DS, ID, Y
from chronoweave.plans.blocks import ARRAY_ROWS, gather, group_quantiles, map_blocks
from chronoweave.plans.series import POS, _keys, positioned
from chronoweave.session import store

CELLS = 1 << 21


def odd_above(x: float) -> int:
    """The smallest odd number not below ``x``."""
    n = math.ceil(x)
    return n if n % 2 else n + 1


@dataclass(frozen=True)
class Spans:
    """Widths (odd numbers of points) and degrees of the local regressions."""

    period: int
    seasonal: int
    trend: int
    low_pass: int
    seasonal_degree: int = 1
    trend_degree: int = 1
    low_pass_degree: int = 1
    inner: int = 2

    @property
    def reach(self) -> int:
        one = (self.seasonal + 1) * self.period + self.period + 1 + self.low_pass + self.trend
        return one * self.inner


def spans(period: int, seasonal: int = 7, trend: int | None = None, low_pass: int | None = None, **more) -> Spans:
    """Usual widths: the trend's is the smallest odd number above 1.5 period / (1 - 1.5 / seasonal)."""
    if period < 2 or seasonal < 3 or seasonal % 2 == 0:
        raise ValueError("period of 2 or more and an odd seasonal width of 3 or more")
    return Spans(period, seasonal, trend or odd_above(1.5 * period / (1 - 1.5 / seasonal)), low_pass or odd_above(period + 1), **more)


def loess(y: np.ndarray, width: int, degree: int, rho: np.ndarray | None = None, beyond: int = 0) -> np.ndarray:
    """Local regression of evenly spaced points at each of them, and at ``beyond`` places past either end.

    Each place uses the ``width`` nearest points with tricube weights (times ``rho``); with fewer points all,
    with the bandwidth widened by half of what is missing.  A place whose points all weigh 0 keeps its value."""
    n = len(y)
    at = np.arange(-beyond, n + beyond)
    q = min(width, n)
    left = np.clip(at - (q - 1) // 2, 0, n - q)
    h = np.maximum(at - left, left + q - 1 - at) + (max(width - n, 0) // 2)
    out = np.empty(len(at))
    step = max(1, CELLS // q)
    for s in range(0, len(at), step):
        i = left[s:s + step, None] + np.arange(q)
        x0 = at[s:s + step, None]
        hh = h[s:s + step, None].astype(float)
        d = np.abs(i - x0)
        with np.errstate(invalid="ignore", divide="ignore"):
            w = np.where(d > 0.999 * hh, 0.0, np.where(d <= 0.001 * hh, 1.0, (1 - (d / hh) ** 3) ** 3))
        if rho is not None:
            w = w * rho[i]
        total = w.sum(axis=1, keepdims=True)
        ok = total[:, 0] > 0
        w = w / np.where(total > 0, total, 1.0)
        if degree > 0:
            mean = (w * i).sum(axis=1, keepdims=True)
            var = (w * (i - mean) ** 2).sum(axis=1, keepdims=True)
            wide = var > 1e-6 * hh ** 2
            w = np.where(wide, w * ((x0 - mean) / np.where(wide, var, 1.0) * (i - mean) + 1), w)
        own = y[np.clip(at[s:s + step], 0, n - 1)]
        out[s:s + step] = np.where(ok, (w * y[i]).sum(axis=1), own)
    return out


def _average(x: np.ndarray, width: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(x, width).mean(axis=1)


def rounds(y: np.ndarray, trend: np.ndarray, rho: np.ndarray, s: Spans) -> tuple[np.ndarray, np.ndarray]:
    """(trend, season) after ``inner`` rounds on consecutive rows; rows a period apart share a phase, so it
    does not matter where a block begins."""
    n, p = len(y), s.period
    season = np.zeros(n)
    for _ in range(s.inner):
        loose = y - trend
        cycle = np.zeros(n + 2 * p)
        for phase in range(min(p, n)):
            cycle[phase::p][:len(loose[phase::p]) + 2] = loess(loose[phase::p], s.seasonal, s.seasonal_degree, rho[phase::p], 1)
        low = _average(_average(_average(cycle, p), p), 3)
        season = cycle[p:p + n] - loess(low, s.low_pass, s.low_pass_degree)
        trend = loess(y - season, s.trend, s.trend_degree, rho)
    return trend, season


def stl(df: DataFrame, value_col: str = Y, period: int = 7, seasonal: int = 7, trend: int | None = None, low_pass: int | None = None,
        inner: int = 2, outer: int = 0, freq: str | None = None, id_cols: str | Sequence[str] = ID, block_rows: int = ARRAY_ROWS,
        digits: int | None = 6, **degrees) -> DataFrame:
    """Rows of ``df`` with ``trend``, ``season`` and ``remainder``: STL with odd widths ``seasonal`` (in
    seasons), ``trend`` and ``low_pass`` (in rows), ``inner`` rounds and ``outer`` robust repeats.

    Series must be on a regular grid.  NULL values weigh nothing; they get a trend and a season but no
    remainder.  A series shorter than two periods has NULL components."""
    keys = _keys(id_cols)
    s = spans(period, seasonal, trend, low_pass, inner=inner, **degrees)
    x, _ = positioned(df, keys, freq)
    x = x.withColumn("_v", F.col(value_col).cast("double"))
    size = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    state = x.select(*keys, POS, "_v", F.lit(0.0).alias("_t"), F.col("_v").isNotNull().cast("double").alias("_w")).join(size, keys)
    length = max(block_rows, s.reach)

    def decompose(pos, own, v, t, w, _n):
        if _n < 2 * period:
            none = np.full(int(own.sum()), np.nan)
            return {"_v": v[own], "_t": none, "_s": none}
        trend, season = rounds(np.where(np.isnan(v), 0.0, v), np.nan_to_num(t), w, s)
        return {"_v": v[own], "_t": trend[own], "_s": season[own]}
    for k in range(outer + 1):
        blocks = gather(state, ["_v", "_t", "_w"], keys, POS, length, s.reach, s.reach, ["_n"])
        found = map_blocks(blocks, decompose, {"_v": "double", "_t": "double", "_s": "double"}, ["_v", "_t", "_w"], keys, POS, ["_n"])
        if k == outer:
            break
        found = store(found.withColumn("_e", F.abs(F.col("_v") - F.col("_t") - F.col("_s"))))
        median = group_quantiles(found, "_e", {"_h": 0.5}, keys)
        u = F.try_divide(F.col("_e"), 6 * F.col("_h"))
        bisquare = F.when(F.col("_e") <= 0.001 * 6 * F.col("_h"), 1.0).when(u > 0.999, 0.0).otherwise(F.pow(1 - u * u, 2))
        weight = F.when(F.col("_v").isNull(), 0.0).when(F.col("_h") > 0, bisquare).otherwise((F.col("_e") <= 0).cast("double"))
        state = found.join(median, keys, "left").select(*keys, POS, "_v", "_t", weight.alias("_w")).join(size, keys)
    out = found.select(*keys, POS, F.col("_t").alias("trend"), F.col("_s").alias("season"), (F.col("_v") - F.col("_t") - F.col("_s")).alias("remainder"))
    if digits is not None:
        out = out.withColumns({c: F.round(c, digits) for c in ("trend", "season", "remainder")})
    return x.drop("_v").join(out, [*keys, POS]).select(*df.columns, "trend", "season", "remainder")


def mstl(df: DataFrame, value_col: str = Y, periods: Sequence[int] = (7, 30), iterate: int = 2, freq: str | None = None,
         id_cols: str | Sequence[str] = ID, block_rows: int = ARRAY_ROWS, digits: int = 6) -> DataFrame:
    """Rows of ``df`` with ``seasonal_<p>`` of every period, ``trend`` and ``remainder``: STL period by
    period (shortest first, widths 11, 15, 19 ...) on the series without the other seasons,
    ``iterate`` times over."""
    keys = _keys(id_cols)
    periods = sorted(periods)
    x = df.withColumns({f"seasonal_{p}": F.lit(0.0) for p in periods})
    for i in range(iterate if len(periods) > 1 else 1):
        for j, p in enumerate(periods):
            rest = sum((F.col(f"seasonal_{o}") for o in periods if o != p), F.lit(0.0))
            d = stl(x.drop("trend", "remainder").withColumn("_adj", F.col(value_col) - rest), "_adj", p, 11 + 4 * j, freq=freq, id_cols=keys,
                    block_rows=block_rows, digits=None)
            x = store(d.withColumn(f"seasonal_{p}", F.col("season")).drop("season", "_adj", "remainder"))
    seasons = sum((F.col(f"seasonal_{p}") for p in periods), F.lit(0.0))
    x = x.withColumn("remainder", F.col(value_col) - F.col("trend") - seasons)
    names = [*[f"seasonal_{p}" for p in periods], "trend", "remainder"]
    return x.select(*df.columns, *[F.round(c, digits).alias(c) for c in names])
