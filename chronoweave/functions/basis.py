"""Basis expansions as column expressions: Fourier terms (H04), B-splines (H05) and a
natural cubic spline basis (H06).

Spline knots are quantiles of the input column computed by one aggregate that Spark
evaluates as a scalar subquery; the basis itself is the Cox-de Boor recursion unrolled
into plain arithmetic on that knot array, so no row leaves the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.aggs import global_quantiles


def epoch_steps(ds: Column, freq: str = "D") -> Column:
    """Integer steps since 1970-01-01 (the Fourier time index)."""
    secs = F.unix_seconds(ds.cast("timestamp_ntz").cast("timestamp"))
    per = {"D": 86400, "H": 3600, "W": 7 * 86400, "min": 60, "S": 1}
    if freq in per:
        return F.floor(secs / per[freq])
    if freq == "M":
        return (F.year(ds) - 1970) * 12 + F.month(ds) - 1
    raise ValueError(freq)


def augment_fourier(df: DataFrame, time_col: str = "ds", periods: Sequence[float] = (7,), max_order: int = 1,
                    freq: str = "D", digits: int | None = None) -> DataFrame:
    """``<time>_sin_<period>_<k>`` / ``_cos_`` = sin/cos(2*pi*k*t/period), t = steps since epoch."""
    t = epoch_steps(F.col(time_col), freq)
    cols = {}
    for p in periods:
        for k in range(1, max_order + 1):
            arg = F.lit(2.0 * math.pi * k / p) * t
            s, c = F.sin(arg), F.cos(arg)
            if digits is not None:
                s, c = F.round(s, digits), F.round(c, digits)
            tag = f"{p:g}"
            cols[f"{time_col}_sin_{tag}_{k}"] = s
            cols[f"{time_col}_cos_{tag}_{k}"] = c
    return df.withColumns(cols)


def _bspline_levels(df: DataFrame, x: Column, knots: Column, n_knots: int, degree: int) -> tuple[DataFrame, list[str]]:
    """Add the B-spline basis of ``degree`` at ``x`` level by level (each Cox-de Boor
    level is a set of named columns built from the previous level, keeping expressions
    small).  ``knots`` is an array column (1-based ``element_at``).  Intervals are
    half-open except that the right boundary belongs to the last non-empty interval.
    Returns the frame and the ``n_knots - degree - 1`` basis column names."""
    df = df.withColumn("_bx", x).withColumn("_bk", knots)
    t = [F.element_at(F.col("_bk"), i + 1) for i in range(n_knots)]
    xc, right = F.col("_bx"), t[-1]
    cols = {}
    for i in range(n_knots - 1):
        inside = (xc >= t[i]) & (xc < t[i + 1])
        at_end = (xc == right) & (t[i + 1] == right) & (t[i] < right)
        cols[f"_b0_{i}"] = F.when(inside | at_end, F.lit(1.0)).otherwise(F.lit(0.0))
    df = df.withColumns(cols)
    for p in range(1, degree + 1):
        cols = {}
        for i in range(n_knots - p - 1):
            a = F.try_divide(xc - t[i], t[i + p] - t[i])
            b = F.try_divide(t[i + p + 1] - xc, t[i + p + 1] - t[i + 1])
            cols[f"_b{p}_{i}"] = (F.coalesce(a * F.col(f"_b{p-1}_{i}"), F.lit(0.0)) +
                                 F.coalesce(b * F.col(f"_b{p-1}_{i+1}"), F.lit(0.0)))
        df = df.withColumns(cols).drop(*[f"_b{p-1}_{i}" for i in range(n_knots - p)])
    return df.drop("_bx", "_bk"), [f"_b{degree}_{i}" for i in range(n_knots - degree - 1)]


def bspline_knots(df: DataFrame, col: str, df_: int = 5, degree: int = 3) -> tuple[Column, int]:
    """Knot vector (boundary knots repeated ``degree+1`` times, ``df - degree`` interior
    knots at equally spaced quantiles) as a scalar-subquery array column."""
    n_inner = max(df_ - degree, 0)
    probs = [(i + 1) / (n_inner + 1) for i in range(n_inner)]
    parts = [F.array_repeat(F.min(col).cast("double"), degree + 1)]
    if probs:
        parts.append(F.array(*[F.lit(k).cast("double") for k in global_quantiles(df, col, probs)]))
    parts.append(F.array_repeat(F.max(col).cast("double"), degree + 1))
    knots = df.agg(F.concat(*parts)).scalar()
    return knots, 2 * (degree + 1) + n_inner


def augment_bsplines(df: DataFrame, column_name: str = "ds_index_num", df_: int = 5, degree: int = 3,
                     digits: int | None = None, knots_from: DataFrame | None = None) -> DataFrame:
    """``bspline_<i>_degree_<d>`` for i = 1..df (basis without the intercept column).

    Knots come from ``knots_from`` (same column) when given -- e.g. the base panel, so
    a long feature plan is not re-evaluated just to place knots."""
    knots, n = bspline_knots(knots_from if knots_from is not None else df, column_name, df_, degree)
    x, names = _bspline_levels(df, F.col(column_name).cast("double"), knots, n, degree)
    out = {}
    for i, c in enumerate(names[1:], start=1):
        out[f"bspline_{i}_degree_{degree}"] = F.round(c, digits) if digits is not None else F.col(c)
    return x.withColumns(out).drop(*names)


def augment_natural_spline(df: DataFrame, column_name: str = "ds_index_num", deg_free: int = 2,
                           digits: int | None = None) -> DataFrame:
    """Natural cubic spline basis with ``deg_free`` columns ``ns_<i>``.

    Knots: boundary = min/max, ``deg_free - 1`` interior knots at quantiles.
    Basis (truncated-power form): N_1 = x, N_(k+1) = d_k - d_(K-1) with
    d_k = ((x-xi_k)^3_+ - (x-xi_K)^3_+)/(xi_K - xi_k), spanning the same space as R's ns()
    (a different but equivalent basis)."""
    n_inner = deg_free - 1
    probs = [(i + 1) / (n_inner + 1) for i in range(n_inner)]
    parts = [F.array(F.min(column_name).cast("double"))]
    if probs:
        parts.append(F.array(*[F.lit(k).cast("double") for k in global_quantiles(df, column_name, probs)]))
    parts.append(F.array(F.max(column_name).cast("double")))
    knots = df.agg(F.concat(*parts)).scalar()
    K = n_inner + 2
    xi = [F.element_at(knots, i + 1) for i in range(K)]
    lo, hi = xi[0], xi[-1]
    x = (F.col(column_name).cast("double") - lo) / (hi - lo)  # rescale to [0, 1] for conditioning
    z = [(k - lo) / (hi - lo) for k in xi]

    def cube_pos(v: Column) -> Column:
        return F.pow(F.greatest(v, F.lit(0.0)), 3)

    def d(k: int) -> Column:
        return F.try_divide(cube_pos(x - z[k]) - cube_pos(x - z[K - 1]), z[K - 1] - z[k])

    cols = [x] + [d(k) - d(K - 2) for k in range(0, K - 2)]
    out = {}
    for i, c in enumerate(cols[:deg_free], start=1):
        out[f"ns_{i}"] = F.round(c, digits) if digits is not None else c
    return df.withColumns(out)
