"""Queries for statistical models (M01-M23), backtests (K02) and accuracy."""

from pyspark.sql import functions as F

from chronoweave.operators import backtest, baselines, metrics, smoothing, splits, timegrid
from chronoweave.operators.baselines import MODEL, YHAT
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.registry import register
from chronoweave.plans.sqlpanels import CUSTOMER_MONTHLY, NATION_MONTHLY, ORDERS_DAILY, cte, padded
from chronoweave.sources import panels

H = 28


def padded_daily(spark, sf):
    return timegrid.pad_by_time(panels.orders_daily(spark, sf).select(ID, DS, Y), "D", fill={Y: 0.0})


def holdout(spark, sf, h=H):
    s = splits.time_series_split(padded_daily(spark, sf), h, "D")
    return (s.where(F.col("set") == "train").select(ID, DS, Y), s.where(F.col("set") == "test").select(ID, DS, Y))


def intermittent(spark, sf):
    return timegrid.common_grid(panels.customer_monthly(spark, sf).select(ID, DS, Y), "M", fill={Y: 0.0})


def r6(df):
    return df.withColumn(YHAT, F.round(YHAT, 6))


SPLIT = dict(
    p=padded(ORDERS_DAILY),
    lt="select unique_id, max(ds) as T from p group by 1",
    tr="select p.* from p join lt using (unique_id) where p.ds <= lt.T - interval 28 day",
    te="select p.* from p join lt using (unique_id) where p.ds > lt.T - interval 28 day",
    tt="select unique_id, max(ds) as T, count(*) as n, arg_max(y, ds) as last_y, arg_min(y, ds) as first_y, avg(y) as mean_y from tr group by 1",
    hz="select unique_id, T, n, s, T + to_days(s::int) as ds from tt cross join range(1, 29) r(s)",
    rr="select tr.*, datediff('day', tr.ds, tt.T) as r from tr join tt using (unique_id)",
)


def split_sql(**more):
    return cte(**SPLIT, **more)


def fc_sql(model: str, value: str, src: str = "hz", join: str = "", rnd: bool = True) -> str:
    v = f"round({value}, 6)" if rnd else value
    return f"select {src}.unique_id, {src}.ds, '{model}' as model, {v} as y_hat from {src} {join}"


# ---- benchmarks -------------------------------------------------------------------

@register("M01_naive", split_sql() + fc_sql("Naive", "last_y", join="join tt using (unique_id)"), ids=("M01", "K01"))
def m01(spark, sf):
    tr, _ = holdout(spark, sf)
    return r6(baselines.naive(tr, H))


@register("M02_seasonal_naive", split_sql(src="select unique_id, 6 - r as ph, y as v from rr where r < 7") +
          fc_sql("SeasonalNaive", "v", join="join src on src.unique_id = hz.unique_id and src.ph = (hz.s - 1) % 7"), ids=("M02",))
def m02(spark, sf):
    tr, _ = holdout(spark, sf)
    return r6(baselines.seasonal_naive(tr, H, 7))


@register("M03_historic_average", split_sql() + fc_sql("HistoricAverage", "mean_y", join="join tt using (unique_id)"), ids=("M03",))
def m03(spark, sf):
    tr, _ = holdout(spark, sf)
    return r6(baselines.historic_average(tr, H))


@register("M04_random_walk_drift", split_sql() +
          fc_sql("RWD", "tt.last_y + hz.s * (tt.last_y - tt.first_y) / (tt.n - 1)", join="join tt using (unique_id)"), ids=("M04",))
def m04(spark, sf):
    tr, _ = holdout(spark, sf)
    return r6(baselines.random_walk_drift(tr, H))


@register("M05_window_average", split_sql(w="select unique_id, avg(y) as v from rr where r < 7 group by 1") +
          fc_sql("WindowAverage", "v", join="join w using (unique_id)"), ids=("M05",))
def m05(spark, sf):
    tr, _ = holdout(spark, sf)
    return r6(baselines.window_average(tr, H, 7))


@register("M05_window_median", split_sql(w="select unique_id, median(y) as v from rr where r < 7 group by 1") +
          fc_sql("WindowMedian", "v", join="join w using (unique_id)"), ids=("M05",))
def m05m(spark, sf):
    tr, _ = holdout(spark, sf)
    return r6(baselines.window_median(tr, H, 7))


@register("M05_weighted_mean", split_sql(
    w="select unique_id, sum(case r when 0 then 0.6 when 1 then 0.3 else 0.1 end * y) as v from rr where r < 3 group by 1") +
          fc_sql("WeightedMean", "v", join="join w using (unique_id)"), ids=("M05",))
def m05w(spark, sf):
    tr, _ = holdout(spark, sf)
    return r6(baselines.weighted_mean(tr, H, (0.1, 0.3, 0.6)))


@register("M06_seasonal_window_average", split_sql(
    w="select unique_id, (6 - r % 7 + 7) % 7 as ph, avg(y) as v from rr where r < 56 group by 1, 2") +
          fc_sql("SeasonalWindowAverage", "v", join="join w on w.unique_id = hz.unique_id and w.ph = (hz.s - 1) % 7"), ids=("M06",))
def m06(spark, sf):
    tr, _ = holdout(spark, sf)
    return r6(baselines.seasonal_window_average(tr, H, 7, 8))


# ---- exponential smoothing ---------------------------------------------------------

def ses_fold(a: float, src: str = "ys") -> str:
    return f"list_reduce({src}, lambda acc, x: acc * {1 - a!r} + {a!r} * x, {src}[1])"


@register("M09_ses", split_sql(l=f"select unique_id, {ses_fold(0.7, 'list(y order by ds)')} as v from tr group by 1") +
          fc_sql("SES", "v", join="join l using (unique_id)"), ids=("M09",))
def m09(spark, sf):
    tr, _ = holdout(spark, sf)
    return r6(smoothing.ses(tr, H, 0.7))


_GRID = ", ".join(f"({a}::double)" for a in smoothing.ALPHA_GRID)


def ses_grid_sql(src: str, keys: str, value: str = "y") -> str:
    """Per key and alpha: SSE of one-step fits and final level by a sequential fold."""
    return f"""
    select {keys}, g.a as alpha,
      list_reduce(ys[2:], lambda acc, x: {{'l': acc.l * (1 - g.a) + g.a * x, 's': acc.s + (x - acc.l) * (x - acc.l)}},
                  {{'l': ys[1], 's': 0.0}}) as st
    from (select {keys}, list({value} order by ds) as ys from {src} group by all) q, (values {_GRID}) g(a)"""


def best_sql(src: str, keys: str) -> str:
    return f"""select {keys}, alpha, level from (
      select {keys}, alpha, st.l as level, row_number() over (partition by {keys} order by coalesce(st.s, 0), alpha) as rk from {src}) where rk = 1"""


@register("M10_ses_optimized", split_sql(g=ses_grid_sql("tr", "unique_id"), b=best_sql("g", "unique_id")) +
          fc_sql("SESOpt", "level", join="join b using (unique_id)"), ids=("M10",))
def m10(spark, sf):
    tr, _ = holdout(spark, sf)
    return r6(smoothing.ses_optimized(tr, H))


@register("M11_seasonal_es", split_sql(
    sub="""select unique_id, 6 - r % 7 as ph, list(y order by ds) as ys from rr join tt using (unique_id)
           where r < (tt.n // 7) * 7 group by 1, 2""",
    l=f"select unique_id, ph, {ses_fold(0.7)} as v from sub") +
          fc_sql("SeasonalES", "v", join="join l on l.unique_id = hz.unique_id and l.ph = (hz.s - 1) % 7"), ids=("M11",))
def m11(spark, sf):
    tr, _ = holdout(spark, sf)
    return r6(smoothing.seasonal_es(tr, H, 7, 0.7))


def nation_padded(spark, sf):
    return timegrid.pad_by_time(panels.nation_monthly(spark, sf).select(ID, DS, Y), "M", fill={Y: 0.0})


@register("M15_theta", cte(d=padded(NATION_MONTHLY, step="1 month"),
                           q="select unique_id, ds, y, row_number() over (partition by unique_id order by ds) - 1 as pos from d",
                           l=f"""select unique_id, max(ds) as T, count(*) as n, regr_slope(y, pos) as b0,
                                 {ses_fold(0.5, 'list(y order by ds)')} as lvl from q group by 1""",
                           hz="select unique_id, T, n, b0, lvl, s, T + to_months(s::int) as ds from l cross join range(1, 7) r(s)") +
          fc_sql("Theta", "lvl + coalesce(b0, 0) / 2 * (s - 1 + 1 / 0.5 - pow(0.5, n) / 0.5)"), ids=("M15",))
def m15(spark, sf):
    d = nation_padded(spark, sf)
    return r6(smoothing.theta(d, 6, 0.5, "M"))


@register("M15_optimized_theta", None, ids=("M15",))
def m15o(spark, sf):
    d = nation_padded(spark, sf)
    return r6(smoothing.theta(d, 6, None, "M"))


# ---- intermittent demand -----------------------------------------------------------

INTERMITTENT = dict(
    c=f"""select i.unique_id, g.ds, coalesce(d.y, 0) as y
          from (select distinct unique_id from ({CUSTOMER_MONTHLY})) i
          cross join (select unnest(generate_series(min(ds), max(ds), interval 1 month)) as ds from ({CUSTOMER_MONTHLY})) g
          left join ({CUSTOMER_MONTHLY}) d on d.unique_id = i.unique_id and d.ds = g.ds""",
    pc="select *, row_number() over (partition by unique_id order by ds) - 1 as pos from c",
    dm="select unique_id, ds, y, (pos - coalesce(lag(pos) over (partition by unique_id order by ds), -1))::double as itv from pc where y <> 0",
    ct="select unique_id, max(ds) as T from c group by 1",
    hz="select unique_id, T, s, T + to_months(s::int) as ds from ct cross join range(1, 7) r(s)",
)


@register("M21_croston_classic", cte(**INTERMITTENT,
                                     l=f"select unique_id, {ses_fold(0.1, 'list(y order by ds)')} as z, {ses_fold(0.1, 'list(itv order by ds)')} as p from dm group by 1") +
          fc_sql("CrostonClassic", "coalesce(z / p, 0)", join="left join l using (unique_id)"), ids=("M21",))
def m21(spark, sf):
    return r6(smoothing.croston(intermittent(spark, sf), 6, "classic", freq="M"))


@register("M21_croston_sba", cte(**INTERMITTENT,
                                 l=f"select unique_id, {ses_fold(0.1, 'list(y order by ds)')} as z, {ses_fold(0.1, 'list(itv order by ds)')} as p from dm group by 1") +
          fc_sql("CrostonSBA", "coalesce(0.95 * z / p, 0)", join="left join l using (unique_id)"), ids=("M21",))
def m21s(spark, sf):
    return r6(smoothing.croston(intermittent(spark, sf), 6, "sba", freq="M"))


@register("M22_tsb", cte(**INTERMITTENT,
                         pp=f"select unique_id, {ses_fold(0.2, 'list((y <> 0)::double order by ds)')} as p from c group by 1",
                         zz=f"select unique_id, {ses_fold(0.2, 'list(y order by ds)')} as z from dm group by 1") +
          fc_sql("TSB", "coalesce(p * z, 0)", join="join pp using (unique_id) left join zz using (unique_id)"), ids=("M22",))
def m22(spark, sf):
    return r6(smoothing.tsb(intermittent(spark, sf), 6, 0.2, 0.2, "M"))


@register("M21_croston_optimized", None, ids=("M21",))
def m21o(spark, sf):
    return r6(smoothing.croston(intermittent(spark, sf), 6, "optimized", freq="M"))


@register("M23_adida", None, ids=("M23",))
def m23a(spark, sf):
    return r6(smoothing.adida(intermittent(spark, sf), 6, "M"))


@register("M23_imapa", None, ids=("M23",))
def m23i(spark, sf):
    return r6(smoothing.imapa(intermittent(spark, sf), 6, "M"))


# ---- backtests and accuracy ---------------------------------------------------------

CV = dict(
    p=padded(ORDERS_DAILY),
    lt="select unique_id, max(ds) as T from p group by 1",
    cut="select unique_id, T - to_days((14 + i * 14)::int) as cutoff from lt cross join range(0, 3) r(i)",
    trn="select c.unique_id, c.cutoff, p.ds, p.y from cut c join p on p.unique_id = c.unique_id and p.ds <= c.cutoff",
    tst="""select c.unique_id, c.cutoff, p.ds, p.y from cut c join p on p.unique_id = c.unique_id
           and p.ds > c.cutoff and p.ds <= c.cutoff + interval 14 day""",
    st="select unique_id, cutoff, arg_max(y, ds) as last_y, avg(y) as mean_y from trn group by 1, 2",
    fc="""select unique_id, cutoff, cutoff + to_days(s::int) as ds, s as step, 'Naive' as model, last_y as y_hat from st cross join range(1, 15) r(s)
          union all
          select unique_id, cutoff, cutoff + to_days(s::int), s, 'HistoricAverage', mean_y from st cross join range(1, 15) r(s)""",
    cv="""select fc.unique_id, fc.cutoff, fc.ds, fc.model, round(fc.y_hat, 6) as y_hat, tst.y, fc.step::int as step
          from fc join tst using (unique_id, cutoff, ds)""",
)

CV_MODELS = [baselines.naive, baselines.historic_average]


def cv_frame(spark, sf):
    return r6(backtest.cross_validation(padded_daily(spark, sf), CV_MODELS, 14, 3, 14, "D"))


@register("K02_cross_validation", cte(**CV) + " select * from cv", ids=("K02", "K05", "C08", "C12"))
def k02(spark, sf):
    return cv_frame(spark, sf)


METRICS_SQL = """
select unique_id, model, round(avg(y_hat - y), 6) as bias, round(avg(abs(y_hat - y)), 6) as mae,
       round(avg(abs(y_hat - y) / case when y <> 0 then abs(y) end), 6) as mape,
       round(avg((y_hat - y) * (y_hat - y)), 6) as mse, round(sqrt(avg((y_hat - y) * (y_hat - y))), 6) as rmse
from cv group by 1, 2"""


@register("K06_cv_point_metrics", cte(**CV) + METRICS_SQL, ids=("K06", "K11"))
def k06(spark, sf):
    return metrics.point_metrics(cv_frame(spark, sf))


def holdout_fc(spark, sf):
    tr, te = holdout(spark, sf)
    fc = baselines.naive(tr, H).unionByName(baselines.seasonal_naive(tr, H, 7)).unionByName(baselines.window_average(tr, H, 7))
    return tr, te, fc


HOLD = dict(
    src="select unique_id, 6 - r as ph, y as v from rr where r < 7",
    w="select unique_id, avg(y) as v from rr where r < 7 group by 1",
    fc=fc_sql("Naive", "last_y", join="join tt using (unique_id)", rnd=False) + " union all " +
       fc_sql("SeasonalNaive", "v", join="join src on src.unique_id = hz.unique_id and src.ph = (hz.s - 1) % 7", rnd=False) +
       " union all " + fc_sql("WindowAverage", "v", join="join w using (unique_id)", rnd=False),
    sc="select fc.*, te.y from fc join te using (unique_id, ds)",
)


@register("K07_r_metrics", split_sql(**HOLD, d1="""select unique_id, avg(abs(y - lag1)) as scale_mae from
          (select unique_id, y, lag(y) over (partition by unique_id order by ds) as lag1 from tr) where lag1 is not null group by 1""") + """
select unique_id, model, round(avg(abs(y_hat - y)), 6) as mae,
       round(avg(abs(y_hat - y) / case when y <> 0 then abs(y) end) * 100, 6) as mape,
       round(avg(abs(y_hat - y)) / any_value(scale_mae), 6) as mase,
       round(avg(abs(y_hat - y) / nullif((abs(y) + abs(y_hat)) / 2, 0)) * 100, 6) as smape,
       round(sqrt(avg((y_hat - y) * (y_hat - y))), 6) as rmse, round(pow(corr(y, y_hat), 2), 6) as rsq
from sc left join d1 using (unique_id) group by 1, 2""", ids=("K07",))
def k07(spark, sf):
    tr, te, fc = holdout_fc(spark, sf)
    return metrics.r_metrics(metrics.score_frame(fc, te), metrics.naive_scale(tr, 1))


@register("K08_scaled_metrics", split_sql(**HOLD, d7="""select unique_id, avg(abs(y - l7)) as sm, avg((y - l7) * (y - l7)) as sq from
          (select unique_id, y, lag(y, 7) over (partition by unique_id order by ds) as l7 from tr) where l7 is not null group by 1""") + """
select unique_id, model, round(sqrt(avg((y_hat - y) * (y_hat - y)) / any_value(sq)), 6) as rmsse,
       round(avg(abs(y_hat - y)) / any_value(sm), 6) as mase,
       round(avg(2 * abs(y_hat - y) / nullif(abs(y) + abs(y_hat), 0)) * 100, 6) as smape
from sc left join d7 using (unique_id) group by 1, 2""", ids=("K08",))
def k08(spark, sf):
    tr, te, fc = holdout_fc(spark, sf)
    return metrics.scaled_metrics(metrics.score_frame(fc, te), metrics.naive_scale(tr, 7))


PM = """pm as (select unique_id, model, avg(abs(y_hat - y)) as mae, sqrt(avg((y_hat - y) * (y_hat - y))) as rmse from sc group by 1, 2)"""


def _pm(spark, sf):
    tr, te, fc = holdout_fc(spark, sf)
    return metrics.point_metrics(metrics.score_frame(fc, te), digits=9).select(ID, MODEL, "mae", "rmse")


@register("K10_accuracy_global", split_sql(**HOLD) + ", " + PM + """
select model, round(avg(mae), 6) as mae, round(avg(rmse), 6) as rmse from pm group by 1""", ids=("K10",))
def k10(spark, sf):
    return _pm(spark, sf).groupBy(MODEL).agg(F.round(F.avg("mae"), 6).alias("mae"), F.round(F.avg("rmse"), 6).alias("rmse"))


@register("K13_best_model_per_series", split_sql(**HOLD) + ", " + PM + """
select unique_id, model, round(rmse, 6) as rmse from (select *, rank() over (partition by unique_id order by round(rmse, 9)) as rk from pm) where rk = 1""",
          ids=("K12", "K13", "F11"))
def k13(spark, sf):
    return metrics.best_model(_pm(spark, sf), "rmse", by=[ID]).select(ID, MODEL, F.round("rmse", 6).alias("rmse"))


@register("K13_best_model_forecast", split_sql(**HOLD) + ", " + PM + """,
b as (select unique_id, model from (select *, rank() over (partition by unique_id order by round(rmse, 9)) as rk from pm) where rk = 1)
select fc.unique_id, fc.ds, fc.model, round(fc.y_hat, 6) as y_hat from fc join b using (unique_id, model)""", ids=("K13", "O05"))
def k13f(spark, sf):
    tr, te, fc = holdout_fc(spark, sf)
    best = metrics.best_model(metrics.point_metrics(metrics.score_frame(fc, te), digits=9), "rmse", by=[ID])
    return r6(fc.join(best.select(ID, MODEL), [ID, MODEL]))


@register("K14_accuracy_flags", split_sql(**HOLD) + ", " + PM + """,
g as (select model, avg(mae) as mae, avg(rmse) as rmse from pm group by 1)
select model, round(mae, 6) as mae, round(rmse, 6) as rmse,
  (round(mae, 9) = min(round(mae, 9)) over ())::int as is_best_mae, (round(mae, 9) = max(round(mae, 9)) over ())::int as is_worst_mae,
  (round(rmse, 9) = min(round(rmse, 9)) over ())::int as is_best_rmse, (round(rmse, 9) = max(round(rmse, 9)) over ())::int as is_worst_rmse
from g""", ids=("K14",))
def k14(spark, sf):
    g = _pm(spark, sf).groupBy(MODEL).agg(F.round(F.avg("mae"), 9).alias("mae"), F.round(F.avg("rmse"), 9).alias("rmse"))
    out = metrics.accuracy_flags(g, ["mae", "rmse"])
    return out.withColumns({"mae": F.round("mae", 6), "rmse": F.round("rmse", 6)})


@register("K15_leaderboard", split_sql(**HOLD) + ", " + PM + """,
g as (select model, avg(rmse) as rmse from pm group by 1)
select model, round(rmse, 6) as rmse, rank() over (order by round(rmse, 9)) as rank from g""", ids=("K15",))
def k15(spark, sf):
    g = _pm(spark, sf).groupBy(MODEL).agg(F.round(F.avg("rmse"), 9).alias("rmse"))
    return metrics.leaderboard(g, "rmse").withColumn("rmse", F.round("rmse", 6))


@register("M12_holt", split_sql(l="""select unique_id, list_reduce(list(y order by ds)[2:],
        lambda acc, x: {'l': 0.3 * x + 0.7 * (acc.l + acc.b), 'b': 0.1 * (0.3 * x + 0.7 * (acc.l + acc.b) - acc.l) + 0.9 * acc.b},
        {'l': list(y order by ds)[1], 'b': list(y order by ds)[2] - list(y order by ds)[1]}) as st from tr group by 1""") +
          fc_sql("Holt", "st.l + hz.s * st.b", join="join l using (unique_id)"), ids=("M12",))
def m12(spark, sf):
    tr, _ = holdout(spark, sf)
    return r6(smoothing.holt(tr, H, 0.3, 0.1))


@register("M24_thief_two_level", split_sql(
    ld=f"select unique_id, {ses_fold(0.3, 'list(y order by ds)')} as ld from tr group by 1",
    wk="""select unique_id, r // 7 as bk, sum(y) as y, min(ds) as ds from rr join tt using (unique_id)
          where r // 7 < tt.n // 7 group by 1, 2""",
    lw=f"select unique_id, {ses_fold(0.3, 'list(y order by ds)')} as lw from wk group by 1") +
          fc_sql("THIEF", "ld + coalesce((lw - 7 * ld) / 14.0, 0)", join="join ld using (unique_id) left join lw using (unique_id)"),
          ids=("M24", "D13"))
def m24(spark, sf):
    tr, _ = holdout(spark, sf)
    return r6(smoothing.thief(tr, H, 7, 0.3))


@register("M13_holt_winters_additive", None, ids=("M13",))
def m13(spark, sf):
    from chronoweave.operators import statespace
    tr, _ = holdout(spark, sf)
    return r6(statespace.ets_additive(tr, H, 0.3, 0.1, 0.1, 7))


@register("M14_auto_ets", None, ids=("M14",))
def m14(spark, sf):
    from chronoweave.operators import statespace
    tr, _ = holdout(spark, sf)
    return r6(statespace.auto_ets(tr, H, 7))


@register("M18_mstl_forecast", None, ids=("M18",))
def m18(spark, sf):
    tr, _ = holdout(spark, sf)
    return r6(smoothing.mstl_forecast(tr, H, (7, 30), 0.3))


@register("M16_sarima_two_stage", None, ids=("M16",))
def m16(spark, sf):
    from chronoweave.operators import arima
    tr, _ = holdout(spark, sf)
    return r6(arima.sarima(tr, H, 7, (1, 1, 1, 1)))


@register("M17_auto_arima", None, ids=("M17",))
def m17(spark, sf):
    from chronoweave.operators import arima
    tr, _ = holdout(spark, sf)
    return r6(arima.sarima(tr, H, 7, None, diffs=None))
