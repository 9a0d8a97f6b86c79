"""Queries for the feature workflow (H11), global ML models (N01-N10), per-series
regression and recursion (M07, M08, M19, M25, O01-O03)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.operators import ml, regression, splits
from chronoweave.operators.baselines import MODEL, YHAT
from chronoweave.operators import metrics
from chronoweave.panel import DS, ID, Y
from chronoweave.plans import workflow
from chronoweave.plans.catalog_models import H, holdout, padded_daily, r6
from chronoweave.plans.registry import register
from chronoweave.session import cut_lineage


def features(spark, sf):
    return workflow.feature_workflow(padded_daily(spark, sf), workflow.H, "D")


_PANELS: dict[tuple[str, str], DataFrame] = {}


def feature_panel(spark, sf) -> DataFrame:
    """The feature panel, stored once per session and table folder in the checkpoint folder:
    iterative estimators pass over their input many times, and the global models of one
    session share the panel instead of building it each."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _PANELS:
        _PANELS[key] = cut_lineage(features(spark, sf))
    return _PANELS[key]


def ml_split(spark, sf):
    """Train and test rows of the feature panel (the last 56 observed days of every series
    are the test rows) and the names of its features."""
    f = feature_panel(spark, sf)
    obs = f.where(F.col(Y).isNotNull())
    s = splits.time_series_split(obs, workflow.H, "D")
    feats = [c for c in workflow.feature_sets(f)["lag"] if c not in ("cutoff", "set")]
    return s.where(F.col("set") == "train").drop("set", "cutoff"), s.where(F.col("set") == "test").drop("set", "cutoff"), feats


@register("H11_feature_workflow", None, ids=("H11", "H10", "O03", "F10"))
def h11(spark, sf):
    return features(spark, sf)


def _ml_query(names, id_dummies=False):
    def q(spark, sf):
        tr, te, feats = ml_split(spark, sf)
        zoo = ml.estimators()
        fc, _ = ml.fit_predict(tr, te, feats, {n: zoo[n] for n in names}, id_dummies=id_dummies)
        return r6(fc)
    return q


register("N01_linear_regression_global", None, ids=("N01", "O03", "H14"))(_ml_query(["LinearRegression"]))
register("N02_penalized_regression", None, ids=("N02",))(_ml_query(["Ridge", "Lasso", "ElasticNet"]))
register("N03_decision_tree", None, ids=("N03",))(_ml_query(["DecisionTree"]))
register("N04_bagging_random_forest", None, ids=("N04",))(_ml_query(["Bagging", "RandomForest"]))
register("N05_gradient_boosting", None, ids=("N05",))(_ml_query(["GBM"]))
register("N09_global_model_id_dummies", None, ids=("N09", "H13"))(_ml_query(["LinearRegression"], id_dummies=True))


@register("N08_coefficients_importances", None, ids=("N08",))
def n08(spark, sf):
    tr, te, feats = ml_split(spark, sf)
    zoo = ml.estimators()
    _, fitted = ml.fit_predict(tr, te.limit(0), feats, {"LinearRegression": zoo["LinearRegression"], "GBM": zoo["GBM"]})
    lin = ml.coefficients_table(spark, fitted["LinearRegression"], feats).withColumn(MODEL, F.lit("LinearRegression"))
    gbm = ml.coefficients_table(spark, fitted["GBM"], feats).withColumn(MODEL, F.lit("GBM"))
    return lin.unionByName(gbm, allowMissingColumns=True)


@register("N10_automl_leaderboard", None, ids=("N10", "K15", "P02"))
def n10(spark, sf):
    tr, te, feats = ml_split(spark, sf)
    zoo = ml.estimators()
    fc, _ = ml.fit_predict(tr, te, feats, zoo)
    m = metrics.point_metrics(metrics.score_frame(fc, te), by=[MODEL])
    return metrics.leaderboard(m, "rmse")


@register("M07_trend_weekday_forecast", None, ids=("M07", "I06"))
def m07(spark, sf):
    tr, _ = holdout(spark, sf)
    return r6(regression.trend_weekday(tr, H))


@register("M08_autoregression_recursive", None, ids=("M08", "O01", "O02"))
def m08(spark, sf):
    tr, _ = holdout(spark, sf)
    return r6(regression.ar(tr, H, (1, 7, 14, 30)))


@register("M19_prophet_like_components", None, ids=("M19", "N11"))
def m19(spark, sf):
    tr, _ = holdout(spark, sf)
    out = regression.prophet_like(tr, H, components=True)
    return out.withColumns({c: F.round(c, 6) for c in (YHAT, "trend", "weekly", "yearly")})


@register("M25_hybrid_residual_boosting", None, ids=("M25",))
def m25(spark, sf):
    """Stage 1: per-series trend + weekday regression; stage 2: a global GBM on calendar
    features fitted to the stage-1 residuals; forecast = stage 1 + stage 2."""
    from chronoweave.functions import calendar
    from chronoweave.plans import ols
    tr, _ = holdout(spark, sf)
    x, feats = regression._design_trend_weekday(tr)
    coefs, design = ols.fit_ols(x, [ID], feats, Y)
    fitted = ols.predict(x, coefs, [ID], design, "_fit").withColumn("resid", F.col(Y) - F.col("_fit"))
    cal = ("month", "mday", "yday", "quarter", "mweek")
    fitted = cut_lineage(calendar.augment_timeseries_signature(fitted, DS, cal))  # boosting passes many times
    cal_cols = [f"ds_{c}" for c in cal]
    base = regression.trend_weekday(tr, H)
    fut = calendar.augment_timeseries_signature(base, DS, cal)
    zoo = ml.estimators()
    model = ml.pipeline(cal_cols, zoo["GBM"]).fit(fitted.withColumn(Y, F.col("resid")))
    boosted = model.transform(fut.withColumnRenamed(YHAT, "_stage1"))
    return r6(boosted.select(ID, DS, F.lit("TrendWeekday+GBM").alias(MODEL), (F.col("_stage1") + F.col(YHAT)).alias(YHAT)))


@register("M20_mfles_boosted_decomposition", None, ids=("M20",))
def m20(spark, sf):
    tr, _ = holdout(spark, sf)
    return r6(regression.mfles(tr, H, 7, 3))
