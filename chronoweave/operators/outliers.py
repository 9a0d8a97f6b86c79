"""Generalised extreme studentised deviate test (J06) over the tails of each series.

Each of at most ``max_outliers`` rounds removes the value farthest from the mean of what is
left, which is the smallest or the largest remaining value.  So count, sum, sum of squares
and the ``max_outliers`` lowest and highest values decide the test: one partial aggregate
and a two-phase top-n per series, never a whole series in one task."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.operators.windows import top_n
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.series import _keys


def _beta_cf(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(abs(1 - (a + b) * x / (a + 1)), tiny) * math.copysign(1, 1 - (a + b) * x / (a + 1))
    h = d
    for m in range(1, 300):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + num * d
            c = 1 + num / c
            d, c = (d if abs(d) > tiny else tiny), (c if abs(c) > tiny else tiny)
            d = 1 / d
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h


def t_upper(t: float, df: float) -> float:
    """P(T > t) of Student's t for t >= 0."""
    x = df / (df + t * t)
    a, b = df / 2, 0.5
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) if 0 < x < 1 else 0.0
    i = front * _beta_cf(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_cf(b, a, 1 - x) / b
    return i / 2


def t_quantile(p: float, df: float) -> float:
    """The ``p`` quantile (p >= 0.5) of Student's t, by bisection."""
    lo, hi = 0.0, 1.0
    while t_upper(hi, df) > 1 - p:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if t_upper(mid, df) > 1 - p else (lo, mid)
    return (lo + hi) / 2


def esd_count(n: int, mean: float, m2: float, low: Sequence[float], high: Sequence[float], alpha: float) -> tuple[int, int]:
    """How many of the lowest and highest values are outliers.  ``m2`` is the sum of squared
    deviations from ``mean``; ``low`` ascends, ``high`` descends."""
    a = b = 0
    best = (0, 0)
    left = n
    for i in range(1, min(len(low), len(high), n - 2) + 1):
        sd = math.sqrt(max(m2, 0.0) / (left - 1))
        below, above = mean - low[a], high[b] - mean
        dev = max(below, above)
        t = t_quantile(1 - alpha / (2 * (n - i + 1)), n - i - 1)
        crit = (n - i) * t / math.sqrt((n - i - 1 + t * t) * (n - i + 1))
        value = low[a] if below > above else high[b]
        a, b = (a + 1, b) if below > above else (a, b + 1)
        if sd > 0 and dev / sd > crit:
            best = (a, b)
        # mean and m2 without the value
        new = (mean * left - value) / (left - 1)
        m2 -= (value - mean) * (value - new)
        mean, left = new, left - 1
    return best


def gesd(df: DataFrame, value_col: str = Y, max_outliers: int = 20, alpha: float = 0.05, id_cols: str | Sequence[str] = ID) -> DataFrame:
    """Rows of ``df`` with ``outlier`` 0/1.  ``max_outliers`` is the test's own bound on how
    many values a series may have out of line; NULL values are never outliers; of equal
    values the earliest count first."""
    keys = _keys(id_cols)
    x = df.where(F.col(value_col).isNotNull()).select(*keys, DS, F.col(value_col).cast("double").alias("_v"))
    stats = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.avg("_v").alias("_mean"), F.var_pop("_v").alias("_var"))
    tails = None
    for side, order in (("low", F.struct("_v", DS)), ("high", F.struct(-F.col("_v"), F.col(DS)))):
        t = top_n(x, keys, order, max_outliers, keep_ties=False).groupBy(*keys).agg(
            F.array_sort(F.collect_list(F.struct((F.col("_v") if side == "low" else -F.col("_v")).alias("o"), F.col(DS).alias("d")))).alias(f"_{side}"))
        tails = t if tails is None else tails.join(t, keys)
    rows = stats.join(tails, keys)

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            k = [esd_count(int(n), m, v * n, [e["o"] for e in lo], [-e["o"] for e in hi], alpha)
                 for n, m, v, lo, hi in zip(pdf["_n"], pdf["_mean"], pdf["_var"], pdf["_low"], pdf["_high"])]
            yield pdf[keys].assign(_a=[a for a, _ in k], _b=[b for _, b in k])

    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keys)
    counts = rows.mapInPandas(test, f"{kinds}, _a int, _b int")
    found = rows.join(counts, keys).select(*keys, F.explode(F.array_distinct(F.concat(
        F.transform(F.expr("slice(_low, 1, _a)"), lambda e: e["d"]), F.transform(F.expr("slice(_high, 1, _b)"), lambda e: e["d"])))).alias(DS)) \
        .withColumn("outlier", F.lit(1))
    return df.join(found, [*keys, DS], "left").withColumn("outlier", F.coalesce("outlier", F.lit(0)))
