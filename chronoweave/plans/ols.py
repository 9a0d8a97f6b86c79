"""Least squares per group from aggregated normal equations.

``X'X`` and ``X'y`` are sums over rows, so they are partial aggregates grouped by the
model key (series, fold, parameter set ...).  Only the k x k systems, one row per key,
reach Python, where numpy solves a batch of keys at a time as one stack of systems
(``mapInPandas``: no shuffle, no call per key).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normal_equations(df: DataFrame, keys: Sequence[str], features: Sequence[str], target: str,
                     intercept: bool = True) -> tuple[DataFrame, list[str]]:
    """Sums ``n, X'X`` (upper triangle) and ``X'y`` per key; returns the frame and the
    design column list (``_one`` first when ``intercept``)."""
    design = (["_one"] if intercept else []) + list(features)
    x = df.where(F.col(target).isNotNull())
    for f in features:
        x = x.where(F.col(f).isNotNull())
    x = x.withColumn("_one", F.lit(1.0)) if intercept else x
    aggs = [F.count(F.lit(1)).alias("_n"), F.sum(F.col(target) * F.col(target)).alias("_yy")]
    for i, a in enumerate(design):
        aggs.append(F.sum(F.col(a) * F.col(target)).alias(f"_xy_{i}"))
        for j in range(i, len(design)):
            aggs.append(F.sum(F.col(a) * F.col(design[j])).alias(f"_xx_{i}_{j}"))
    return x.groupBy(*keys).agg(*aggs), design


def solve(sums: DataFrame, keys: Sequence[str], design: Sequence[str], ridge: float = 0.0,
          ridge_skip_first: bool = True) -> DataFrame:
    """Coefficients per key: ``(*keys, n, sse, coef array<double>)``; NULL coef when the
    system is singular.  ``ridge`` adds ``ridge * I`` (intercept unpenalised)."""
    k = len(design)
    key_fields = [f for f in sums.schema.fields if f.name in keys]
    schema = T.StructType(key_fields + [T.StructField("n", T.LongType()), T.StructField("sse", T.DoubleType()),
                                        T.StructField("coef", T.ArrayType(T.DoubleType()))])

    def fit(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            if len(pdf) == 0:
                continue
            xx, xy = stacked(pdf, k)
            if ridge:
                pen = np.eye(k) * ridge
                if ridge_skip_first and design and design[0] == "_one":
                    pen[0, 0] = 0.0
                xx = xx + pen
            beta = solve_each(xx, xy)
            sse = pdf["_yy"].to_numpy(float) - 2 * (beta * xy).sum(axis=1) + np.einsum("ni,nij,nj->n", beta, xx, beta)
            bad = np.isnan(beta).any(axis=1)
            out = pdf[[f.name for f in key_fields]].copy()
            out["n"] = pdf["_n"].astype("int64")
            out["sse"] = np.where(bad, None, sse)
            out["coef"] = [None if f else b.tolist() for f, b in zip(bad, beta)]
            yield out[[f.name for f in schema.fields]]

    return sums.mapInPandas(fit, schema)


def stacked(pdf: pd.DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, k, k) of ``X'X`` and (rows, k) of ``X'y`` from the columns of :func:`normal_equations`."""
    xx, xy = np.zeros((len(pdf), k, k)), np.zeros((len(pdf), k))
    for i in range(k):
        xy[:, i] = pdf[f"_xy_{i}"].to_numpy(float)
        for j in range(i, k):
            xx[:, i, j] = xx[:, j, i] = pdf[f"_xx_{i}_{j}"].to_numpy(float)
    return xx, xy


def solve_each(xx: np.ndarray, xy: np.ndarray) -> np.ndarray:
    """Solutions of a stack of systems; NaN for a singular one."""
    try:
        return np.linalg.solve(xx, xy[:, :, None])[:, :, 0]
    except np.linalg.LinAlgError:
        out = np.full(xy.shape, np.nan)
        for i in range(len(xx)):
            try:
                out[i] = np.linalg.solve(xx[i], xy[i])
            except np.linalg.LinAlgError:
                pass
        return out


def fit_ols(df: DataFrame, keys: Sequence[str], features: Sequence[str], target: str,
            intercept: bool = True, ridge: float = 0.0) -> tuple[DataFrame, list[str]]:
    sums, design = normal_equations(df, keys, features, target, intercept)
    return solve(sums, keys, design, ridge), design


def predict(df: DataFrame, coefs: DataFrame, keys: Sequence[str], design: Sequence[str], out: str = "y_hat") -> DataFrame:
    """``out = X . coef`` after joining the coefficient row of each key."""
    x = df.join(coefs.select(*keys, "coef"), list(keys), "left")
    terms = [F.element_at("coef", i + 1) * (F.lit(1.0) if c == "_one" else F.col(c)) for i, c in enumerate(design)]
    expr: Column = terms[0]
    for t in terms[1:]:
        expr = expr + t
    return x.withColumn(out, expr).drop("coef")
