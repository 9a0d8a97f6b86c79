"""Queries for prediction intervals (L01-L06) and ensembles."""

from pyspark.sql import functions as F

from chronoweave.operators import backtest, baselines, ensemble, intervals, metrics
from chronoweave.operators.baselines import MODEL, STEP, YHAT
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.catalog_models import CV, CV_MODELS, HOLD, H, cv_frame, holdout, holdout_fc, padded_daily, r6, split_sql
from chronoweave.plans.registry import register
from chronoweave.plans.sqlpanels import cte

FUT = dict(
    ft="select unique_id, max(ds) as T, arg_max(y, ds) as last_y, avg(y) as mean_y from p group by 1",
    fut="""select unique_id, T + to_days(s::int) as ds, s::int as step, 'Naive' as model, last_y as y_hat from ft cross join range(1, 15) r(s)
           union all select unique_id, T + to_days(s::int), s::int, 'HistoricAverage', mean_y from ft cross join range(1, 15) r(s)""",
)


def future_fc(spark, sf):
    p = padded_daily(spark, sf)
    fc = backtest.forecast(p, CV_MODELS, 14, "D")
    last = p.groupBy(ID).agg(F.max(DS).alias("_T"))
    from chronoweave.functions.timekeys import steps_between
    return fc.join(last, ID).withColumn(STEP, steps_between(F.col("_T"), F.col(DS), "D").cast("int")).drop("_T")


@register("L01_conformal_error", cte(**CV, **FUT) + """,
q as (select unique_id, model, step, quantile_cont(abs(y_hat - y), 0.8) as q80, quantile_cont(abs(y_hat - y), 0.95) as q95 from cv group by 1, 2, 3)
select f.unique_id, f.ds, f.step, f.model, round(f.y_hat, 6) as y_hat,
       round(f.y_hat - q80, 6) as lo_80, round(f.y_hat + q80, 6) as hi_80, round(f.y_hat - q95, 6) as lo_95, round(f.y_hat + q95, 6) as hi_95
from fut f left join q using (unique_id, model, step)""", ids=("L01", "L05", "M26"))
def l01(spark, sf):
    return r6(intervals.conformal_error(cv_frame(spark, sf), future_fc(spark, sf), (80, 95)))


@register("L02_conformal_distribution", cte(**CV, **FUT) + """,
d as (select unique_id, model, step, abs(y_hat - y) as d from cv union all select unique_id, model, step, -abs(y_hat - y) from cv),
q as (select unique_id, model, step, quantile_cont(d, 0.1) as l80, quantile_cont(d, 0.9) as h80,
             quantile_cont(d, 0.025) as l95, quantile_cont(d, 0.975) as h95 from d group by 1, 2, 3)
select f.unique_id, f.ds, f.step, f.model, round(f.y_hat, 6) as y_hat,
       round(f.y_hat + l80, 6) as lo_80, round(f.y_hat + h80, 6) as hi_80, round(f.y_hat + l95, 6) as lo_95, round(f.y_hat + h95, 6) as hi_95
from fut f left join q using (unique_id, model, step)""", ids=("L02",))
def l02(spark, sf):
    return r6(intervals.conformal_distribution(cv_frame(spark, sf), future_fc(spark, sf), (80, 95)))


HOLD_RES = dict(HOLD, res="select * from sc")


@register("L03_split_conformal", split_sql(**HOLD_RES, q="""
select unique_id, model,
  max(case when rk = least(n, ceil((n + 1) * 0.8)) then a end) as q80, max(case when rk = least(n, ceil((n + 1) * 0.95)) then a end) as q95
from (select unique_id, model, abs(y_hat - y) as a, row_number() over (partition by unique_id, model order by abs(y_hat - y)) as rk,
             count(*) over (partition by unique_id, model) as n from res) group by 1, 2""") + """
select fc.unique_id, fc.ds, fc.model, round(fc.y_hat, 6) as y_hat, round(y_hat - q80, 6) as lo_80, round(y_hat + q80, 6) as hi_80,
       round(y_hat - q95, 6) as lo_95, round(y_hat + q95, 6) as hi_95 from fc left join q using (unique_id, model)""", ids=("L03",))
def l03(spark, sf):
    tr, te, fc = holdout_fc(spark, sf)
    return r6(intervals.split_conformal(metrics.score_frame(fc, te), fc, (80, 95)))


@register("L04_normal_interval", split_sql(**HOLD_RES, s="select unique_id, model, stddev_samp(y - y_hat) as sd from res group by 1, 2") + f"""
select fc.unique_id, fc.ds, fc.model, round(fc.y_hat, 6) as y_hat, round(y_hat - {intervals.NORMAL_Z[80]!r} * sd, 6) as lo_80,
       round(y_hat + {intervals.NORMAL_Z[80]!r} * sd, 6) as hi_80, round(y_hat - {intervals.NORMAL_Z[95]!r} * sd, 6) as lo_95,
       round(y_hat + {intervals.NORMAL_Z[95]!r} * sd, 6) as hi_95 from fc left join s using (unique_id, model)""", ids=("L04",))
def l04(spark, sf):
    tr, te, fc = holdout_fc(spark, sf)
    return r6(intervals.normal_interval(metrics.score_frame(fc, te), fc, (80, 95)))


@register("L06_interval_coverage", cte(**CV) + """,
s as (select unique_id, model, stddev_samp(y - y_hat) as sd from cv group by 1, 2),
i as (select cv.*, y_hat - 1.959963984540054 * sd as lo, y_hat + 1.959963984540054 * sd as hi from cv join s using (unique_id, model))
select model, round(avg((y >= round(lo, 6) and y <= round(hi, 6))::double), 6) as coverage_95, round(avg(round(hi, 6) - round(lo, 6)), 6) as width_95
from i group by 1""", ids=("L06",))
def l06(spark, sf):
    cv = cv_frame(spark, sf)
    iv = intervals.normal_interval(cv, cv.drop(Y), (95,))
    return _coverage_cv(iv, cv)


def _coverage_cv(iv, cv):
    x = iv.join(cv.select(ID, "cutoff", DS, MODEL, Y), [ID, "cutoff", DS, MODEL])
    inside = ((F.col(Y) >= F.col("lo_95")) & (F.col(Y) <= F.col("hi_95"))).cast("double")
    return x.groupBy(MODEL).agg(F.round(F.avg(inside), 6).alias("coverage_95"),
                                F.round(F.avg(F.col("hi_95") - F.col("lo_95")), 6).alias("width_95"))


# ---- ensembles ----------------------------------------------------------------------

@register("O06_ensemble_mean_median", split_sql(**HOLD) + """
select unique_id, ds, round(avg(y_hat), 6) as y_hat, 'Ensemble_mean' as model from fc group by 1, 2
union all select unique_id, ds, round(median(y_hat), 6), 'Ensemble_median' from fc group by 1, 2""", ids=("O06",))
def o06(spark, sf):
    _, _, fc = holdout_fc(spark, sf)
    return r6(ensemble.ensemble_average(fc, "mean").unionByName(ensemble.ensemble_average(fc, "median")))


@register("O07_ensemble_weighted_rank", split_sql(**HOLD) + """,
g as (select model, avg(y_hat - y) as bias, sqrt(avg((y_hat - y) * (y_hat - y))) as rmse from sc group by 1),
rw as (select model, rank() over (order by round(rmse, 9) desc)::double as rw from g),
wn as (select model, rw / sum(rw) over () as weight from rw)
select unique_id, ds, round(sum(weight * y_hat) / sum(weight), 6) as y_hat, 'Ensemble_weighted' as model
from fc join wn using (model) group by 1, 2""", ids=("O07", "F11"))
def o07(spark, sf):
    tr, te, fc = holdout_fc(spark, sf)
    sc = metrics.score_frame(fc, te)
    g = sc.groupBy(MODEL).agg(F.round(F.sqrt(F.avg((F.col(YHAT) - F.col(Y)) ** 2)), 9).alias("rmse"))
    return r6(ensemble.ensemble_weighted(fc, ensemble.rank_loadings(g, "rmse")))


@register("O07_ensemble_fixed_loadings", split_sql(**HOLD) + """,
wn(model, weight) as (values ('SeasonalNaive', 5.0), ('WindowAverage', 3.0), ('Naive', 1.0))
select unique_id, ds, round(sum(weight * y_hat) / sum(weight), 6) as y_hat, 'Ensemble_weighted' as model
from fc join wn using (model) group by 1, 2""", ids=("O07",))
def o07f(spark, sf):
    _, _, fc = holdout_fc(spark, sf)
    return r6(ensemble.ensemble_weighted(fc, {"SeasonalNaive": 5.0, "WindowAverage": 3.0, "Naive": 1.0}))


@register("O08_select_by_rank", split_sql(**HOLD) + """,
g as (select model, sqrt(avg((y_hat - y) * (y_hat - y))) as rmse from sc group by 1),
r as (select model, row_number() over (order by round(rmse, 9), model) as rk from g)
select fc.unique_id, fc.ds, round(avg(fc.y_hat), 6) as y_hat, 'Ensemble_top2' as model
from fc join r using (model) where r.rk in (1, 2) group by 1, 2""", ids=("O08", "O12"))
def o08(spark, sf):
    tr, te, fc = holdout_fc(spark, sf)
    g = metrics.score_frame(fc, te).groupBy(MODEL).agg(F.round(F.sqrt(F.avg((F.col(YHAT) - F.col(Y)) ** 2)), 9).alias("rmse"))
    keep = ensemble.select_by_rank(g, "rmse", ranks=[1, 2])
    members = fc.join(F.broadcast(keep.select(MODEL)), MODEL)  # model list: bounded
    return r6(ensemble.ensemble_average(members, "mean", name="Ensemble_top2"))
