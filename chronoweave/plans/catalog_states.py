"""Queries for fitted state models: ETS (M13, M14), ARIMA with regressors (M16, M17, M26), temporal hierarchies."""

from pyspark.sql import functions as F

from chronoweave.operators import ets, hierarchy, sarimax, smoothing
from chronoweave.operators.baselines import YHAT
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.catalog_models import H, holdout, nation_padded, padded_daily, r6, ses_fold
from chronoweave.plans.registry import register
from chronoweave.plans.sqlpanels import NATION_MONTHLY, cte, padded


def r4(df):
    return df.withColumn(YHAT, F.round(YHAT, 4))


@register("M13_holt_winters_fitted", None, ids=("M13",))
def m13(spark, sf):
    tr, _ = holdout(spark, sf)
    return r4(ets.holt_winters(tr, H, 7))


@register("M14_auto_ets_aicc", None, ids=("M14",))
def m14(spark, sf):
    tr, _ = holdout(spark, sf)
    return r4(ets.auto_ets(tr, H, 7))


REGRESSORS = [f"{f}{k}" for k in (1, 2) for f in ("sin", "cos")] + ["month_end"]


def with_regressors(df):
    """Yearly Fourier terms and a month-end event."""
    day = F.datediff(DS, F.lit("1970-01-01").cast("date")).cast("double")
    cols = {f"{f}{k}": getattr(F, f)(F.lit(2 * 3.141592653589793 * k / 365.25) * day) for k in (1, 2) for f in ("sin", "cos")}
    return df.withColumns(cols).withColumn("month_end", (F.last_day(DS) == F.to_date(DS)).cast("double"))


@register("M16_sarimax_regressors", None, ids=("M16", "M26"))
def m16(spark, sf):
    tr, te = holdout(spark, sf)
    return r4(sarimax.sarimax(with_regressors(tr), H, (1, 1, 1), (1, 1, 1), 7, REGRESSORS, with_regressors(te.select(ID, DS)), passes=6))


@register("M17_auto_arima_tests", None, ids=("M17",))
def m17(spark, sf):
    tr, _ = holdout(spark, sf)
    return r4(sarimax.auto_arima(tr, H, 7, (2, 2, 1, 1), passes=4))


@register("M26_refit_future_regressors", None, ids=("M26",))
def m26(spark, sf):
    """Refit on all data, out-of-sample steps with the regressors known for them."""
    p = padded_daily(spark, sf)
    end = p.groupBy(ID).agg(F.max(DS).alias("last"))
    ahead = end.select(ID, F.explode(F.sequence(F.lit(1), F.lit(14))).alias("s"), "last").select(ID, F.timestamp_add("DAY", F.col("s"), F.col("last")).alias(DS))
    return r4(sarimax.sarimax(with_regressors(p), 14, (1, 0, 1), (0, 1, 1), 7, REGRESSORS, with_regressors(ahead), passes=5))


UNIT = 100_000.0
LEVELS = ", ".join(str(k) for k in hierarchy.divisors(12))
WEIGHTS = ", ".join(f"({i}, {k}, {j}, {w!r})" for i, k, j, w in hierarchy.weights(12))


@register("M24_temporal_hierarchy", cte(d=padded(NATION_MONTHLY, step="1 month"), w=f"select * from (values {WEIGHTS}) t(i, k, j, w)") + f""",
r as (select unique_id, ds, y / {UNIT} as y, row_number() over (partition by unique_id order by ds desc) - 1 as r, count(*) over (partition by unique_id) as n from d),
lv as (select unique_id, k, r // k as b, sum(y) as y from r cross join (select unnest([{LEVELS}]) as k) where r < n // 12 * 12 group by 1, 2, 3),
fc as (select unique_id, k, {ses_fold(0.3, "list(y order by b desc)")} as f from lv group by 1, 2),
bt as (select unique_id, i, sum(w * f) as f from fc join w using (k) group by 1, 2),
lk as (select unnest([{LEVELS}]) as k)
select unique_id, k::int as k, i // k as step, round(sum(f), 4) as y_hat, 'THIEF' as model from bt cross join lk group by 1, 2, 3""", ids=("M24", "D13"))
def m24(spark, sf):
    d = nation_padded(spark, sf).withColumn(Y, F.col(Y) / UNIT)
    model = lambda p, h, freq, id_cols: smoothing.ses(p, h, 0.3, freq, id_cols)
    return r4(hierarchy.temporal_hierarchy(d, 12, model, 12, "M", all_levels=True))


@register("M24_temporal_hierarchy_ets", None, ids=("M24", "M14"))
def m24e(spark, sf):
    model = lambda p, h, freq, id_cols: ets.auto_ets(p, h, 12, ("ANN", "AAN", "AAdN"), 3, freq, id_cols)
    return hierarchy.temporal_hierarchy(nation_padded(spark, sf), 12, model, 12, "M").withColumn(YHAT, F.round(YHAT, 2))
