"""Aggregate registry: names accepted by ``summarize_by_time`` / ``apply_by_time``, and exact
quantiles of groups and of whole tables."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def quantile(c: str | Column, q: float | list[float]) -> Column:
    """Exact interpolated quantile of a group.  The aggregate merges maps of distinct values,
    so it is a partial aggregate; the distinct values of one group meet in one map.
    Quantiles of a whole table use :func:`global_quantiles`."""
    col = F.col(c) if isinstance(c, str) else c
    return F.percentile(col, F.array(*[F.lit(float(x)) for x in q]) if isinstance(q, (list, tuple)) else F.lit(float(q)))


def nth_smallest(v: DataFrame, r: int, n: int, enough: int = 100_000) -> float:
    """The ``r``-th (from 0) of the ``n`` values of the column ``v``: a sketch brackets the
    rank, one pass counts what is below and inside, and so on until few values are inside."""
    lo, hi, below, inside = float("-inf"), float("inf"), 0, n
    x = F.col("v")
    while inside > enough:
        q, slack = (r - below) / inside, 2.0 / 10_000
        cut = v.where((x >= lo) & (x <= hi)).agg(F.percentile_approx("v", [max(0.0, q - slack), min(1.0, q + slack)], 10_000),
                                                 F.min("v"), F.max("v")).first()
        a = cut[1] if q <= slack else cut[0][0]
        b = cut[2] if q >= 1 - slack else cut[0][1]
        if a == b:
            return a
        if (a, b) == (lo, hi):
            break  # many copies of few values
        lo, hi = a, b
        below, inside = v.agg(F.count_if(x < lo), F.count_if((x >= lo) & (x <= hi))).first()
    few = v.where((x >= lo) & (x <= hi)).groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.orderBy("v")) + F.lit(below)
    return few.withColumn("upto", upto).agg(F.min(F.when(F.col("upto") > r, x))).first()[0]


def global_quantiles(df: DataFrame, c: str | Column, qs: Sequence[float]) -> list[float | None]:
    """Exact interpolated quantiles of a whole column at any size; only the answers reach the
    driver."""
    v = df.select((F.col(c) if isinstance(c, str) else c).cast("double").alias("v")).where("v is not null")
    n = v.count()
    if not n:
        return [None] * len(qs)
    out = []
    for q in qs:
        rank = q * (n - 1)
        a = nth_smallest(v, math.floor(rank), n)
        b = nth_smallest(v, math.ceil(rank), n) if rank % 1 else a
        out.append(a + (b - a) * (rank % 1))
    return out


AGGS: dict[str, Callable[[str], Column]] = {
    "sum": lambda c: F.sum(c),
    "mean": lambda c: F.avg(c),
    "median": lambda c: quantile(c, 0.5),
    "std": lambda c: F.stddev_samp(c),
    "var": lambda c: F.var_samp(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
    "count": lambda c: F.count(c),
    "nunique": lambda c: F.count_distinct(c),
    "q25": lambda c: quantile(c, 0.25),
    "q75": lambda c: quantile(c, 0.75),
}


def agg_expr(name: str | Callable[[str], Column], c: str) -> Column:
    if callable(name):
        return name(c)
    if name not in AGGS:
        raise ValueError(f"unknown aggregate {name!r}; known: {sorted(AGGS)}")
    return AGGS[name](c)
