"""Queries for clustering (I08/I09, C06), residual diagnostics (I07), MARS-style hinge
regression (N06), stacking (O09-O11), parameter grids and search (P01-P04), recipes
(H12) and nested per-series model reports (O04)."""

import itertools
import random

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from chronoweave.functions.aggs import quantile
from chronoweave.operators import backtest, baselines, diagnostics as dg, metrics, ml, smoothing
from chronoweave.operators.baselines import MODEL, YHAT
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.catalog_ml import ml_split
from chronoweave.plans.catalog_models import CV_MODELS, H, holdout, holdout_fc, padded_daily, r6
from chronoweave.plans.registry import register
from chronoweave.sources import panels
from chronoweave.session import cut_lineage


def series_features(spark, sf):
    """Per-series features of the monthly nation panel: mean, sd, acf1, trend and
    seasonal strength (classical decomposition, period 12)."""
    d = panels.nation_monthly(spark, sf).select(ID, DS, Y)
    from chronoweave.operators import timegrid
    p = timegrid.pad_by_time(d, "M", fill={Y: 0.0})
    base = p.groupBy(ID).agg(F.avg(Y).alias("mean"), F.stddev_samp(Y).alias("sd"))
    a1 = dg.acf(p, Y, 1, freq="M").where(F.col("lag") == 1).select(ID, F.col("acf").alias("acf1"))
    st = dg.seasonal_strength(dg.classical_decomposition(p, Y, 12, freq="M"))
    return base.join(a1, ID).join(st, ID)


@register("I09_kmeans_series_clusters", None, ids=("I09", "I08", "C06"))
def i09(spark, sf):
    feats = cut_lineage(series_features(spark, sf).fillna(0.0))
    cols = ["mean", "sd", "acf1", "trend_strength", "seasonal_strength"]
    best, best_cost = None, None
    for seed in (1, 2, 3, 4, 5):  # nstart: keep the lowest within-cluster cost
        pm = Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="_raw"),
                              StandardScaler(inputCol="_raw", outputCol="_f", withMean=True, withStd=True),
                              KMeans(k=3, seed=seed, featuresCol="_f", predictionCol="cluster")]).fit(feats)
        cost = pm.stages[-1].summary.trainingCost
        if best_cost is None or cost < best_cost:
            best, best_cost = pm, cost
    labels = best.transform(feats).select(ID, "cluster")
    # Right join of the labels back on the series (every series keeps a row)
    return labels.join(feats, ID, "right").select(ID, "cluster", *[F.round(c, 6).alias(c) for c in cols])


@register("I07_residual_diagnostics", None, ids=("I07",))
def i07(spark, sf):
    """Residual table of the holdout forecasts (actual, prediction, residual) and the
    residual ACF per series and model."""
    tr, te, fc = holdout_fc(spark, sf)
    res = metrics.score_frame(fc, te).withColumn("residual", F.col(Y) - F.col(YHAT))
    a = dg.acf(res.withColumnRenamed(ID, "_sid").withColumn(ID, F.concat_ws("|", "_sid", MODEL)).select(ID, DS, "residual"),
               "residual", 7, freq="D")
    return a.withColumn(MODEL, F.split(ID, "\\|")[1]).withColumn(ID, F.split(ID, "\\|")[0])


@register("N06_mars_hinge_lasso", None, ids=("N06",))
def n06(spark, sf):
    """MARS re-aimed: hinge features ``max(0, x - k)`` / ``max(0, k - x)`` at quantile knots
    of each input, then a lasso picks the terms."""
    tr, te, feats = ml_split(spark, sf)
    inputs = ["y_lag_56", "ds_yday", "ds_index_num"]
    qs = tr.agg(*[quantile(c, [0.25, 0.5, 0.75]).alias(c) for c in inputs]).first()
    def hinge(df):
        out = df
        for c in inputs:
            for i, k in enumerate(qs[c]):
                out = out.withColumn(f"h_{c}_{i}_p", F.greatest(F.col(c) - F.lit(float(k)), F.lit(0.0)))
                out = out.withColumn(f"h_{c}_{i}_m", F.greatest(F.lit(float(k)) - F.col(c), F.lit(0.0)))
        return out
    hcols = [f"h_{c}_{i}_{s}" for c in inputs for i in range(3) for s in ("p", "m")]
    fc, _ = ml.fit_predict(hinge(tr), hinge(te), hcols, {"MARS": ml.estimators()["Lasso"]})
    return r6(fc)


@register("O10_stacking_meta_learner", None, ids=("O10",))
def o10(spark, sf):
    """O09 out-of-fold (backtest) predictions pivoted wide by model -> O10 linear
    meta-learner fitted on them -> O11 applied to the refit base forecasts."""
    p = padded_daily(spark, sf)
    members = [baselines.naive, baselines.historic_average, baselines.window_average, baselines.seasonal_naive]
    names = ["Naive", "HistoricAverage", "WindowAverage", "SeasonalNaive"]
    cv = backtest.cross_validation(p, members, 14, 6, 14, "D")
    oof = cut_lineage(cv.groupBy(ID, "cutoff", DS, Y).pivot(MODEL, names).agg(F.first(YHAT)))
    meta = ml.pipeline(names, ml.estimators()["LinearRegression"]).fit(oof)
    fut = backtest.forecast(p, members, 14, "D").groupBy(ID, DS).pivot(MODEL, names).agg(F.first(YHAT))
    out = meta.transform(fut).select(ID, DS, F.lit("Stack_lm").alias(MODEL), F.col(YHAT))
    return r6(out)


def param_grid(kind: str, space: dict, size: int, seed: int = 123) -> list[dict]:
    """Regular (full factorial over ``space`` lists), random, or Latin-hypercube
    (``space`` ranges ``(lo, hi)``; one value per stratum, permuted per dimension)."""
    rng = random.Random(seed)
    if kind == "regular":
        keys = list(space)
        return [dict(zip(keys, v)) for v in itertools.product(*[space[k] for k in keys])]
    if kind == "random":
        return [{k: lo + (hi - lo) * rng.random() for k, (lo, hi) in space.items()} for _ in range(size)]
    if kind == "latin_hypercube":
        cols = {}
        for k, (lo, hi) in space.items():
            strata = [lo + (hi - lo) * (i + rng.random()) / size for i in range(size)]
            rng.shuffle(strata)
            cols[k] = strata
        return [{k: cols[k][i] for k in space} for i in range(size)]
    raise ValueError(kind)


@register("P02_grid_search_ses", None, ids=("P01", "P02", "C12"))
def p02(spark, sf):
    """A Latin-hypercube grid of SES alphas evaluated over time-based backtest
    windows (sequential models use time CV only), ranked by mean RMSE; the whole grid x
    windows x series is one job (each grid value is an extra column of the same scan)."""
    grid = sorted(round(g["alpha"], 4) for g in param_grid("latin_hypercube", {"alpha": (0.05, 0.95)}, 12))
    p = padded_daily(spark, sf)
    models = [(lambda a: (lambda tr, h, freq="D", id_cols=ID: smoothing.ses(tr, h, a, freq, id_cols, name=f"SES_{a}")))(a) for a in grid]
    cv = backtest.cross_validation(p, models, 14, 3, 14, "D")
    m = metrics.point_metrics(cv, by=[MODEL])
    return metrics.leaderboard(m, "rmse").withColumn("alpha", F.regexp_extract(MODEL, "SES_(.*)", 1).cast("double"))


@register("H12_recipe_pipeline", None, ids=("H12", "E10", "H10"))
def h12(spark, sf):
    """A recipe as a ``pyspark.ml`` Pipeline learned on train rows and baked on any
    rows: SQL steps (log1p target, calendar terms, drop columns) + train-learned
    standardisation of the features."""
    tr, te = holdout(spark, sf)
    steps = [
        SQLTransformer(statement="SELECT *, log1p(y) AS y_log, CAST(month(ds) AS DOUBLE) AS month, "
                                 "CAST(weekday(ds) + 1 AS DOUBLE) AS wday, CAST(dayofyear(ds) AS DOUBLE) AS yday FROM __THIS__"),
        VectorAssembler(inputCols=["month", "wday", "yday"], outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
        SQLTransformer(statement="SELECT unique_id, ds, y, y_log, features FROM __THIS__"),
    ]
    recipe = Pipeline(stages=steps).fit(tr)
    baked = recipe.transform(te)
    from pyspark.ml.functions import vector_to_array
    arr = vector_to_array("features")
    return baked.select(ID, DS, Y, F.round("y_log", 6).alias("y_log"),
                        *[F.round(arr[i], 6).alias(n) for i, n in enumerate(["month_std", "wday_std", "yday_std"])])


@register("O04_nested_fit_report", None, ids=("O04", "O05", "U08"))
def o04(spark, sf):
    """Many models per series on the holdout, with an error report (a series a
    model cannot score gets ``error``) and the best model per series."""
    tr, te = holdout(spark, sf)
    models = {"Naive": baselines.naive, "SeasonalNaive": lambda t, h, **kw: baselines.seasonal_naive(t, h, 7, **kw),
              "SES": lambda t, h, **kw: smoothing.ses(t, h, 0.3, **kw), "Theta": lambda t, h, **kw: smoothing.theta(t, h, 0.3, **kw)}
    fc = backtest.forecast(tr, models, H, "D")
    m = metrics.point_metrics(metrics.score_frame(fc, te))
    # every series has a row for every model, also where the model returned nothing for it
    asked = te.select(ID).distinct().select(ID, F.explode(F.array(*[F.lit(k) for k in models])).alias(MODEL))
    rows = asked.join(fc.groupBy(ID, MODEL).agg(F.count(F.lit(1)).alias("n_forecast")), [ID, MODEL], "left").join(m, [ID, MODEL], "left")
    reason = F.when(F.col("n_forecast").isNull(), "no forecast").when(F.col("rmse").isNull() | F.isnan("rmse"), "no score")
    rep = rows.withColumn("error", reason).fillna({"n_forecast": 0})
    best = metrics.best_model(m, "rmse", by=[ID]).select(ID, MODEL, F.lit(1).alias("is_best"))
    return rep.join(best, [ID, MODEL], "left").fillna({"is_best": 0})
