"""Further queries: actual-and-prediction and residual tables (K18, I07), user functions
(U01-U08), GESD outliers (J06), out-of-fold tables and stacks (O09-O12), feature sets and
splines in global models (N01, N11), sequential search (P02-P04), accuracy pairs (K11)."""

import functools

from pyspark.sql import functions as F

from chronoweave.functions import calendar, transforms
from chronoweave.operators import aggregate, anomaly, backtest, baselines, diagnostics, ensemble, metrics, ml, outliers, regression, search, smoothing, windows
from chronoweave.operators.baselines import MODEL, YHAT
from chronoweave.panel import DS, ID, Y
from chronoweave.plans import workflow
from chronoweave.plans.catalog_ml import ml_split
from chronoweave.plans.catalog_models import CV, H, HOLD, cv_frame, fc_sql, holdout, holdout_fc, padded_daily, r6, split_sql
from chronoweave.plans.registry import register
from chronoweave.plans.sqlpanels import ORDERS_DAILY, cte, padded
from chronoweave.session import cut_lineage
from chronoweave.sources import panels


@register("K18_actual_and_prediction", split_sql(**HOLD) + """
select unique_id, ds, 'actual' as key, 'ACTUAL' as model, round(y, 6) as value from p
union all select unique_id, ds, 'prediction', model, round(y_hat, 6) from fc""", ids=("K18",))
def k18(spark, sf):
    tr, te, fc = holdout_fc(spark, sf)
    actual = tr.unionByName(te).select(ID, DS, F.lit("actual").alias("key"), F.lit("ACTUAL").alias(MODEL), F.round(Y, 6).alias("value"))
    return actual.unionByName(fc.select(ID, DS, F.lit("prediction").alias("key"), MODEL, F.round(YHAT, 6).alias("value")))


@register("I07_residual_table", split_sql(**HOLD) + """
select unique_id, ds, model, round(y, 6) as y, round(y_hat, 6) as y_hat, round(y - y_hat, 6) as residual from sc""", ids=("I07",))
def i07_table(spark, sf):
    _, te, fc = holdout_fc(spark, sf)
    return metrics.score_frame(fc, te).select(ID, DS, MODEL, F.round(Y, 6).alias(Y), F.round(YHAT, 6).alias(YHAT),
                                              F.round(F.col(Y) - F.col(YHAT), 6).alias("residual"))


def half_week_mean(hist):
    """Next value: half the mean of the last seven values, half the value a week before."""
    week = F.slice(hist, -7, 7)
    return F.aggregate(week, F.lit(0.0), lambda a, v: a + v) / 14 + F.element_at(hist, -7) / 2


@register("U05_recursive_user_function", "with recursive " + split_sql().strip()[len("with "):] + """
, f as (
  select unique_id, max(ds) as T, 0 as s, list(y order by ds)[-7:] as hist from tr group by 1
  union all
  select unique_id, T, s + 1, list_append(hist, list_sum(hist[-7:]) / 14 + hist[-7] / 2)[-7:] from f where s < 28)
select unique_id, T + to_days(s::int) as ds, 'user' as model, round(hist[-1], 6) as y_hat from f where s > 0""", ids=("U05", "O01"))
def u05(spark, sf):
    tr, _ = holdout(spark, sf)
    return r6(regression.recursive_apply(tr, H, 7, half_week_mean, "D", name="user"))


@register("J06_gesd_outliers", None, ids=("J06",))
def j06(spark, sf):
    """GESD on the remainder of the median (Twitter) decomposition."""
    d = anomaly.median_decomposition(padded_daily(spark, sf).select(ID, DS, Y), Y, 7, 91, "D")
    return outliers.gesd(d.select(ID, DS, Y, "remainder"), "remainder").withColumn("remainder", F.round("remainder", 6))


@register("H02_weekend_feature", cte(p=padded(ORDERS_DAILY)) + """
select unique_id, ds, y, (isodow(ds) >= 6)::int as is_weekend from p""", ids=("H02", "U06"))
def h02(spark, sf):
    return padded_daily(spark, sf).select(ID, DS, Y).withColumn("is_weekend", calendar.is_weekend(F.col(DS)))


@register("E09_transform_columns", cte(o=ORDERS_DAILY) + """
select unique_id, ds, round(ln(1 + y), 6) as y, round(ln(1 + rev), 6) as rev from o""", ids=("E09", "U01"))
def e09(spark, sf):
    o = panels.orders_daily(spark, sf).select(ID, DS, Y, "rev")
    return transforms.transform_columns(o, [Y, "rev"], lambda c: F.round(F.log1p(c), 6))


@register("O12_relabel_models", split_sql(**HOLD) + """
select unique_id, ds, case model when 'Naive' then 'last' when 'WindowAverage' then 'week' else model end as model,
       round(y_hat, 6) as y_hat from fc""", ids=("O12",))
def o12(spark, sf):
    _, _, fc = holdout_fc(spark, sf)
    return r6(ensemble.relabel(fc, {"Naive": "last", "WindowAverage": "week"}))


# ---- out-of-fold tables, stacks, sets of features ------------------------------------

@register("O09_out_of_fold_table", cte(**CV) + """
select unique_id, cutoff, ds, any_value(y) as y, max(y_hat) filter (model = 'Naive') as "Naive",
       max(y_hat) filter (model = 'HistoricAverage') as "HistoricAverage" from cv group by 1, 2, 3""", ids=("O09",))
def o09(spark, sf):
    return ensemble.out_of_fold(cv_frame(spark, sf), ["Naive", "HistoricAverage"])


def _stack_inputs(spark, sf):
    members = [baselines.naive, baselines.historic_average, baselines.window_average, baselines.seasonal_naive]
    names = ["Naive", "HistoricAverage", "WindowAverage", "SeasonalNaive"]
    p = cut_lineage(padded_daily(spark, sf).select(ID, DS, Y))
    oof = cut_lineage(ensemble.out_of_fold(backtest.cross_validation(p, members, 14, 6, 14, "D"), names))
    fut = backtest.forecast(p, members, 14, "D").groupBy(ID, DS).pivot(MODEL, names).agg(F.first(YHAT))
    return oof, cut_lineage(fut), names


META = ("LinearRegression", "ElasticNet", "RandomForest", "GBM")


@register("O10_meta_learners", None, ids=("O10",))
def o10_meta(spark, sf):
    """Linear, elastic net, random forest and boosted meta-learners on the out-of-fold table."""
    oof, fut, names = _stack_inputs(spark, sf)
    zoo = ml.estimators()
    out = [ml.pipeline(names, zoo[m]).fit(oof).transform(fut).select(ID, DS, F.lit(f"Stack_{m}").alias(MODEL), YHAT) for m in META]
    return r6(functools.reduce(lambda a, b: a.unionByName(b), out))


@register("O11_two_level_stack", None, ids=("O11",))
def o11(spark, sf):
    """Second level: meta-learners fitted on the older half of the folds predict the newer
    half; a linear model on those predictions combines them; the meta-learners are then
    refitted on all folds and the combination applied to their forecasts."""
    oof, fut, names = _stack_inputs(spark, sf)
    zoo = ml.estimators()
    metas = ("LinearRegression", "ElasticNet", "GBM")
    order = oof.withColumn("_c", F.unix_seconds(F.col("cutoff").cast("timestamp")))
    middle = order.agg(F.avg("_c")).first()[0]
    old, new = order.where(F.col("_c") <= middle), order.where(F.col("_c") > middle)

    def level_one(train, score, extra):
        x = score
        for m in metas:
            p = ml.pipeline(names, zoo[m]).fit(train)
            x = p.transform(x).withColumnRenamed(YHAT, m).drop("features")
        return x.select(ID, DS, *extra, *metas)

    top = ml.pipeline(list(metas), zoo["LinearRegression"]).fit(cut_lineage(level_one(old, new, [Y])))
    return r6(top.transform(level_one(oof, fut, [])).select(ID, DS, F.lit("Stack_two_levels").alias(MODEL), YHAT))


def _sets_query(kind):
    def q(spark, sf):
        tr, te, _ = ml_split(spark, sf)
        feats = [c for c in workflow.feature_sets(tr)[kind]]
        fc, _ = ml.fit_predict(tr, te, feats, {f"LinearRegression_{kind}": ml.estimators()["LinearRegression"]})
        return r6(fc)
    return q


register("N01_linear_regression_base", None, ids=("N01", "H10"))(_sets_query("base"))
register("N01_linear_regression_spline", None, ids=("N01", "H10"))(_sets_query("spline"))


@register("N11_gam_splines", None, ids=("N11",))
def n11(spark, sf):
    """Additive model: B-splines of time, Fourier terms and weekday dummies with a ridge
    penalty, one smooth set shared by all series plus a series effect."""
    tr, te, _ = ml_split(spark, sf)
    feats = [c for c in tr.columns if c.startswith(("bspline_", "ds_wday_lbl_")) or "_sin" in c or "_cos" in c]
    fc, _ = ml.fit_predict(tr, te, feats, {"GAM": ml.estimators()["Ridge"]}, id_dummies=True)
    return r6(fc)


@register("M11_seasonal_es_optimised", None, ids=("M11",))
def m11_opt(spark, sf):
    tr, _ = holdout(spark, sf)
    return r6(smoothing.seasonal_es(tr, H, 7, None))


# ---- search ---------------------------------------------------------------------------

def _ses_study():
    init = lambda q: lambda tr, h, freq="D", id_cols=ID: smoothing.ses(tr, h, q["alpha"], freq, id_cols, name="SES")
    return search.Study(search.narrowing({"alpha": (0.05, 0.95)}), init)


FOLDS = search.Folds(h=14, n_windows=3, step=14)


@register("P03_sequential_search", None, ids=("P03", "P04", "U07"))
def p03(spark, sf):
    """Trials of a sequential search (space, init and fit are user functions)."""
    p = cut_lineage(padded_daily(spark, sf).select(ID, DS, Y))
    trials = _ses_study().run(p, FOLDS, 6)
    best = min(trials, key=lambda t: (t.score, t.number)).number
    return spark.createDataFrame([(t.number, t.params["alpha"], round(t.score, 6), int(t.number == best)) for t in trials],
                                 "trial int, alpha double, rmse double, is_best int")


@register("P02_finalised_forecast", None, ids=("P02", "M26"))
def p02_final(spark, sf):
    """The best of a search refitted on all data."""
    p = cut_lineage(padded_daily(spark, sf).select(ID, DS, Y))
    study = _ses_study()
    return r6(study.refit(p, FOLDS, study.run(p, FOLDS, 5)))


# ---- accuracy pair, labels, user functions --------------------------------------------

@register("K11_cv_and_holdout_accuracy", cte(**CV) + """
select 'cv' as type, unique_id, model, round(avg(abs(y_hat - y)), 6) as mae, round(sqrt(avg((y_hat - y) * (y_hat - y))), 6) as rmse from cv group by 2, 3
union all
select 'last window', unique_id, model, round(avg(abs(y_hat - y)), 6), round(sqrt(avg((y_hat - y) * (y_hat - y))), 6)
from cv where cutoff = (select max(c.cutoff) from cv c where c.unique_id = cv.unique_id) group by 2, 3""", ids=("K11",))
def k11(spark, sf):
    """Accuracy over all windows next to that of the newest window."""
    cv = cv_frame(spark, sf)
    last = cv.groupBy(ID).agg(F.max("cutoff").alias("cutoff"))
    pair = cv.withColumn("type", F.lit("cv")).unionByName(cv.join(last, [ID, "cutoff"]).select(cv.columns).withColumn("type", F.lit("last window")))
    return metrics.point_metrics(pair, by=["type", ID, MODEL]).select("type", ID, MODEL, "mae", "rmse")


@register("C06_labels_right_join", cte(o=ORDERS_DAILY) + """
, l as (select unique_id, case when avg(y) > 1.5 then 'busy' else 'quiet' end as label from o group by 1)
select o.unique_id, o.ds, o.y, l.label from l right join o using (unique_id)""", ids=("C06",))
def c06(spark, sf):
    o = panels.orders_daily(spark, sf).select(ID, DS, Y)
    labels = o.groupBy(ID).agg(F.when(F.avg(Y) > 1.5, "busy").otherwise("quiet").alias("label"))
    return labels.join(o, ID, "right").select(ID, DS, Y, "label")


@register("U02_user_bucket_function", cte(o=ORDERS_DAILY) + """
select unique_id, date_trunc('month', ds) as ds, round((max(y) - min(y)) / (max(y) + min(y)), 6) as y from o group by 1, 2""", ids=("U02", "D07"))
def u02(spark, sf):
    contrast = lambda c: (F.max(c) - F.min(c)) / (F.max(c) + F.min(c))
    return aggregate.summarize_by_time(panels.orders_daily(spark, sf), DS, Y, "M", contrast, by=[ID], digits=6)


@register("U04_user_series_features", cte(o=ORDERS_DAILY) + """
select unique_id, round(avg(y), 6) as my_mean, round(sum(y * y) / sum(y), 6) as my_weighted_mean from o group by 1""", ids=("U04", "I08"))
def u04(spark, sf):
    user = {"my_mean": lambda c: F.avg(c), "my_weighted_mean": lambda c: F.sum(c * c) / F.sum(c)}
    return diagnostics.user_features(panels.orders_daily(spark, sf), user).select(ID, *[F.round(n, 6).alias(n) for n in user])


@register("U08_series_table_function", cte(o=ORDERS_DAILY) + """
, s as (select unique_id, count(*) as n, min(y) as lo, max(y) as hi, avg(y) as mean from o group by 1)
select unique_id, unnest(['min', 'mean', 'max']) as term, round(unnest([lo, mean, hi]), 6) as estimate, n from s""", ids=("U08",))
def u08(spark, sf):
    def rows(s):
        return F.array(*[F.struct(F.lit(t).alias("term"), F.round(s[c], 6).alias("estimate"), s["n"].alias("n"))
                         for t, c in (("min", "lo"), ("mean", "mean"), ("max", "hi"))])
    fit = {"n": F.count(F.lit(1)), "lo": F.min(Y), "hi": F.max(Y), "mean": F.avg(Y)}
    return diagnostics.series_table(panels.orders_daily(spark, sf), fit, rows)


@register("E08_scaled_forecast_inverted", split_sql(src="select unique_id, 6 - r as ph, y as v from rr where r < 7") +
          fc_sql("SeasonalNaive", "v", join="join src on src.unique_id = hz.unique_id and src.ph = (hz.s - 1) % 7"), ids=("E08",))
def e08(spark, sf):
    """A model between a per-series scaler and its inverse."""
    tr, _ = holdout(spark, sf)
    scaled = lambda t, h, **kw: baselines.seasonal_naive(t, h, 7, **kw)
    return r6(transforms.scaled_forecast(tr, H, scaled, "D"))


@register("F10_ewm_on_lagged_column", cte(p=padded(ORDERS_DAILY)) + """
, l as (select unique_id, ds, y, lag(y, 56) over w as v, row_number() over w as i from p window w as (partition by unique_id order by ds))
select a.unique_id, a.ds, any_value(a.y) as y, any_value(a.v) as y_lag_56,
       round(sum(pow(0.9, a.i - b.i) * b.v) / sum(case when b.v is not null then pow(0.9, a.i - b.i) end), 6) as y_lag_56_ewm_mean_alpha_0_1,
       round(sum(pow(0.7, a.i - b.i) * b.v) / sum(case when b.v is not null then pow(0.7, a.i - b.i) end), 6) as y_lag_56_ewm_mean_alpha_0_3
from l a join l b on a.unique_id = b.unique_id and b.i between a.i - 400 and a.i group by a.unique_id, a.ds""", ids=("F10", "F08"))
def f10_ewm(spark, sf):
    x = windows.augment_lags(padded_daily(spark, sf).select(ID, DS, Y), Y, [56], freq="D")
    return windows.augment_ewm(x, "y_lag_56", [0.1, 0.3], freq="D", digits=6)
