"""Queries for recipes (H12, H13, E10) and boosted hybrids."""

import uuid

from pyspark.sql import functions as F

from chronoweave.operators import hybrid, ml, recipe, regression
from chronoweave.operators.baselines import MODEL, YHAT
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.catalog_models import H, SPLIT, holdout, r6
from chronoweave.plans.registry import register
from chronoweave.plans.sqlpanels import cte
from chronoweave.session import cut_lineage, ensure_checkpoint_dir

#: lag, window over the lag, calendar, season and trend terms; training rows without orders go
FORECAST_RECIPE = (
    recipe.step("log1p", columns="y"), recipe.step("lag", columns="y", lags=[H]),
    recipe.step("slidify", column=f"y_lag_{H}", window=7, function="mean"),
    recipe.step("signature", features=["wday", "month", "index_num"]), recipe.step("fourier", periods=[7], order=1),
    recipe.step("spline", column="ds_index_num", df=2), recipe.step("filter", condition="y > 0"), recipe.step("dummy", column="unique_id"),
    recipe.step("interact", left="ds_wday", right="ds_sin_7_1"), recipe.step("normalize", columns=f"ds_wday|ds_month|y_lag_{H}"),
    recipe.step("naomit", columns=f"y_lag_{H}"), recipe.step("remove", columns="ds_index_num"))

_BAKED = ["y_lag_28", "y_lag_28_rolling_mean_win_7", "ds_wday", "ds_month", "ds_sin_7_1", "ds_cos_7_1", "ds_index_num_ns_1", "ds_index_num_ns_2",
          "inter_ds_wday__ds_sin_7_1"]


@register("H12_recipe_saved_and_baked", cte(**SPLIT) + """,
a as (select p.unique_id, p.ds, ln(1 + p.y) as y, p.ds > lt.T - interval 28 day as new, lag(ln(1 + p.y), 28) over (partition by p.unique_id order by p.ds) as l,
        isodow(p.ds) as wday, month(p.ds) as mon, epoch(p.ds) as x, datediff('day', date '1970-01-01', p.ds::date) as t
      from p join lt using (unique_id)),
b as (select *, avg(l) over (partition by unique_id order by ds rows between 3 preceding and 3 following) as win from a),
k as (select min(x) as lo, max(x) as hi, (quantile_cont(x, 0.5) - min(x)) / (max(x) - min(x)) as z from a where not new),
s as (select avg(wday) as wm, stddev_samp(wday) as ws, avg(mon) as mm, stddev_samp(mon) as ms, avg(l) as lm, stddev_samp(l) as ls from a where not new and y > 0),
c as (select b.*, (x - lo) / (hi - lo) as u, z, s.* from b, k, s where new)
select unique_id, ds, round(y, 6) as y, round((l - lm) / ls, 6) as y_lag_28, round(win, 6) as y_lag_28_rolling_mean_win_7,
       round((wday - wm) / ws, 6) as ds_wday, round((mon - mm) / ms, 6) as ds_month,
       round(sin(2 * pi() * t / 7), 6) as ds_sin_7_1, round(cos(2 * pi() * t / 7), 6) as ds_cos_7_1, round(u, 6) as ds_index_num_ns_1,
       round((pow(greatest(u, 0), 3) - pow(greatest(u - 1, 0), 3)) - (pow(greatest(u - z, 0), 3) - pow(greatest(u - 1, 0), 3)) / (1 - z), 6) as ds_index_num_ns_2,
       round(wday * sin(2 * pi() * t / 7), 6) as inter_ds_wday__ds_sin_7_1
from c""", ids=("H12", "H13", "E10", "H10", "A05"))
def h12_saved(spark, sf):
    """A recipe learned on the train rows, saved, loaded and baked on the newest rows of every series."""
    tr, te = holdout(spark, sf)
    prepared, _ = recipe.prep(FORECAST_RECIPE, tr)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/recipes/{uuid.uuid4().hex}"
    recipe.save(spark, path, prepared)
    baked = recipe.bake(recipe.load(spark, path), te, history=tr)
    return baked.select(ID, DS, *[F.round(c, 6).alias(c) for c in (Y, *_BAKED)])


@register("H12_recipe_forecast", None, ids=("H12", "H13", "N09", "O03"))
def h12_forecast(spark, sf):
    """A global linear model on the predictors of the recipe, its forecasts on the scale of the data."""
    tr, te = holdout(spark, sf)
    prepared, baked = recipe.prep(FORECAST_RECIPE, tr)
    feats = recipe.predictors(prepared, baked)
    fc, _ = ml.fit_predict(cut_lineage(baked), recipe.bake(prepared, te, history=tr), feats, {"LinearRegression": ml.estimators()["LinearRegression"]})
    return fc.select(ID, DS, MODEL, F.round(F.expm1(YHAT), 6).alias(YHAT))


@register("M25_arima_boosted", None, ids=("M25",))
def m25_arima(spark, sf):
    """Autoregression of chosen lags per series, boosted trees on its one-step residuals."""
    tr, _ = holdout(spark, sf)
    lags = (1, 7, 14, 30)
    return r6(hybrid.boosted(hybrid.ar_fitted(tr, lags), regression.ar(tr, H, lags), ml.estimators()["GBM"], name="AR+GBM"))


@register("M25_prophet_boosted", None, ids=("M25", "M19"))
def m25_prophet(spark, sf):
    """Changepoint trend and Fourier seasons per series, boosted trees on the residuals."""
    tr, _ = holdout(spark, sf)
    return r6(hybrid.boosted(regression.prophet_fitted(tr), regression.prophet_like(tr, H), ml.estimators()["GBM"], name="Prophet+GBM"))


@register("N10_automl_capped", None, ids=("N10", "K15", "P02"))
def n10_capped(spark, sf):
    """At most six models on the predictors of the recipe, sorted by MAE on the holdout rows."""
    tr, te = holdout(spark, sf)
    prepared, baked = recipe.prep(FORECAST_RECIPE, tr)
    board, _ = ml.automl(cut_lineage(baked), cut_lineage(recipe.bake(prepared, te, history=tr)), recipe.predictors(prepared, baked),
                         ml.candidates(), max_models=6, exclude=("Tree",), sort="mae")
    return board.select(MODEL, "algorithm", *[F.round(c, 6).alias(c) for c in ("bias", "mae", "rmse")], "rank", "rank_in_algorithm")
