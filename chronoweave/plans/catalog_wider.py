"""Queries that widen earlier ones: every calendar feature, all detectors together, own seasons and horizons, refitted winners,
parameter designs."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.operators import aggregate, anomaly, backtest, baselines, detectors, metrics, neighbours, search, smoothing
from chronoweave.operators.baselines import MODEL, YHAT
from chronoweave.panel import DS, ID, Y, floor_time
from chronoweave.plans.catalog_models import H, HOLD, PM, holdout_fc, padded_daily, r6, split_sql
from chronoweave.plans.registry import register
from chronoweave.plans.sqlpanels import ORDERS_DAILY, cte
from chronoweave.sources import panels

CALENDAR = {"wday": "isodow(ds)", "week": "weekofyear(ds)", "month": "month(ds)", "quarter": "quarter(ds)", "year": "year(ds)"}


@register("D11_seasonal_diagnostics_calendar", cte(h=ORDERS_DAILY) + ", l as (" + " union all ".join(
    f"select unique_id, '{k}' as feature, {e}::int as level, y from h" for k, e in CALENDAR.items()) + """)
select unique_id, feature, level, count(*) as n, quantile_cont(y, 0.25) as q1, quantile_cont(y, 0.5) as median,
       quantile_cont(y, 0.75) as q3, round(avg(y), 6) as mean from l group by 1, 2, 3""", ids=("D11",))
def d11(spark, sf):
    return aggregate.seasonal_diagnostics(panels.orders_daily(spark, sf), Y, tuple(CALENDAR))


@register("J09_all_detectors", None, ids=("J09", "J07", "J08"))
def j09(spark, sf):
    """Seven detectors side by side with their plain and rank-weighted scores."""
    p = padded_daily(spark, sf)
    sd = detectors.sd_ewma(p, Y)
    parts = [anomaly.anomalize(p, Y, 7, 91, 0.05, 0.2, "twitter", freq="D").select(ID, DS, Y, F.col("anomaly").alias("anomaly_twitter")),
             anomaly.ts_clean(p, Y, 7, 3.0, freq="D", method="stl", robust=1).select(ID, DS, F.col("outlier").alias("anomaly_stl")),
             detectors.probabilistic_ewma(p, Y).select(ID, DS, "anomaly_pewma"),
             sd.select(ID, DS, "anomaly_sd", "anomaly_two_stage"),
             neighbours.conformal_neighbours(p, Y).select(ID, DS, "anomaly_knn"),
             neighbours.neighbour_gaps(p, Y).select(ID, DS, "anomaly_nn")]
    flags = reduce(lambda a, b: a.join(b, [ID, DS]), parts)
    return anomaly.ensemble_score(flags, [c for c in flags.columns if c.startswith("anomaly_")])


#: frequency of a series -> its season and horizon
PERIODS = {"D": (7, 14), "W": (52, 13), "M": (12, 18)}
_UNITS = {"D": "day", "W": "week", "M": "month"}
OWN = cte(o=ORDERS_DAILY) + ", x as (" + " union all ".join(
    f"select unique_id || '|{f}' as unique_id, date_trunc('{_UNITS[f]}', ds) as ds, sum(y) as y, {m} as season, {h} as horizon from o group by 1, 2"
    for f, (m, h) in PERIODS.items()) + """),
r as (select *, row_number() over (partition by unique_id order by ds) as i, count(*) over (partition by unique_id) - horizon as n from x),
tr as (select * from r where i <= n),
sc as (select a.unique_id, avg(abs(a.y - b.y)) as sm, avg((a.y - b.y) * (a.y - b.y)) as sq from tr a join tr b on a.unique_id = b.unique_id and b.i = a.i - a.season group by 1),
fc as (select t.unique_id, 'Naive' as model, t.y, l.y as y_hat from r t join tr l on l.unique_id = t.unique_id and l.i = l.n where t.i > t.n
       union all select t.unique_id, 'SeasonalNaive', t.y, l.y from r t join tr l on l.unique_id = t.unique_id and l.i = t.n - t.season + 1 + (t.i - t.n - 1) % t.season where t.i > t.n)
select unique_id, model, round(sqrt(avg((y_hat - y) * (y_hat - y)) / any_value(sq)), 6) as rmsse, round(avg(abs(y_hat - y)) / any_value(sm), 6) as mase,
       round(avg(2 * abs(y_hat - y) / nullif(abs(y) + abs(y_hat), 0)) * 100, 6) as smape
from fc left join sc using (unique_id) group by 1, 2"""


def mixed_frequencies(spark, sf) -> DataFrame:
    """Daily, weekly and monthly order counts as series with their own season and horizon."""
    o = panels.orders_daily(spark, sf)
    parts = [o.groupBy(F.concat_ws("|", F.col(ID), F.lit(f)).alias(ID), floor_time(F.col(DS), f).alias(DS)).agg(F.sum(Y).alias(Y))
             .withColumns({"season": F.lit(m), "horizon": F.lit(h)}) for f, (m, h) in PERIODS.items()]
    return reduce(DataFrame.unionByName, parts)


@register("K08_own_season_and_horizon", OWN, ids=("K08",))
def k08(spark, sf):
    x = metrics.own_horizon_split(mixed_frequencies(spark, sf))
    tr, te = x.where("step <= 0"), x.where("step > 0")
    last = tr.groupBy(ID).agg(F.max_by(Y, DS).alias("last"))
    naive = te.join(last, ID).select(ID, F.lit("Naive").alias(MODEL), Y, F.col("last").alias(YHAT))
    # the training row one season before the step, counted on from the last season
    source = tr.select(ID, F.col("step").alias("from"), F.col(Y).alias(YHAT))
    back = F.pmod(F.col("step") - 1, F.col("season")) - F.col("season") + 1
    seasonal = te.withColumn("from", back.cast("long")).join(source, [ID, "from"]).select(ID, F.lit("SeasonalNaive").alias(MODEL), Y, YHAT)
    return metrics.scaled_metrics(naive.unionByName(seasonal), metrics.naive_scale_by_season(tr))


@register("O05_refit_best_per_series", split_sql(**HOLD) + ", " + PM + """,
b as (select unique_id, model from (select *, rank() over (partition by unique_id order by round(rmse, 9)) as rk from pm) where rk = 1),
f as (select unique_id, max(ds) as T, arg_max(y, ds) as last_y from p group by 1),
r2 as (select p.*, datediff('day', p.ds, f.T) as r from p join f using (unique_id)),
wa as (select unique_id, avg(y) as v from r2 where r < 7 group by 1),
z as (select unique_id, T, last_y, s, T + to_days(s::int) as ds from f cross join range(1, 29) q(s)),
all_fc as (select unique_id, ds, 'Naive' as model, last_y as y_hat from z
           union all select z.unique_id, z.ds, 'SeasonalNaive', r2.y from z join r2 on r2.unique_id = z.unique_id and r2.r = 6 - (z.s - 1) % 7
           union all select z.unique_id, z.ds, 'WindowAverage', v from z join wa using (unique_id))
select unique_id, ds, model, round(y_hat, 6) as y_hat from all_fc join b using (unique_id, model)""", ids=("O05", "K13", "M26"))
def o05(spark, sf):
    """The model that was best on the holdout, refitted on all rows, out-of-sample."""
    _, te, fc = holdout_fc(spark, sf)
    best = metrics.best_model(metrics.point_metrics(metrics.score_frame(fc, te), digits=9), "rmse", by=[ID]).select(ID, MODEL)
    p = padded_daily(spark, sf)
    ahead = baselines.naive(p, H).unionByName(baselines.seasonal_naive(p, H, 7)).unionByName(baselines.window_average(p, H, 7))
    return r6(ahead.join(best, [ID, MODEL]).select(ID, DS, MODEL, YHAT))


@register("P01_max_entropy_grid", None, ids=("P01", "P02"))
def p01(spark, sf):
    """A maximum-entropy design over a log-scaled alpha and an integer season, every set scored on backtest windows."""
    sets = search.design("max_entropy", {"alpha": search.Range(0.02, 0.9, log=True), "season": search.Range(5, 9, integer=True)}, 8)
    models = [(lambda s: (lambda tr, h, freq="D", id_cols=ID: smoothing.seasonal_es(tr, h, s["season"], s["alpha"], freq, id_cols)
                          .withColumn(MODEL, F.lit(f"{s['season']}|{s['alpha']:.6f}"))))(s) for s in sets]
    cv = backtest.cross_validation(padded_daily(spark, sf), models, 14, 2, 14, "D")
    m = metrics.leaderboard(metrics.point_metrics(cv, by=[MODEL]), "rmse")
    return m.withColumn("season", F.split(MODEL, "\\|")[0].cast("int")).withColumn("alpha", F.split(MODEL, "\\|")[1].cast("double"))
