"""Queries for diagnostics."""

from pyspark.sql import functions as F

from chronoweave.functions.calendar import calendar_column
from chronoweave.operators import diagnostics as dg
from chronoweave.operators import timegrid
from chronoweave.panel import DS, ID, Y
from chronoweave.plans import ols
from chronoweave.plans.catalog_grid import HOURLY_GAPS, hourly_gaps
from chronoweave.plans.registry import register
from chronoweave.plans.sqlpanels import NATION_MONTHLY, ORDERS_DAILY, cte, padded
from chronoweave.sources import panels

P = cte(p=padded(ORDERS_DAILY))
W = "over (partition by unique_id order by ds)"


def padded_daily(spark, sf, cols=(Y,)):
    return timegrid.pad_by_time(panels.orders_daily(spark, sf).select(ID, DS, *cols), "D", fill={c: 0.0 for c in cols})


@register("A06_series_diagnostics", cte(d=ORDERS_DAILY) + f""",
g as (select unique_id, ds, datediff('day', lag(ds) {W}, ds) as gap from d)
select unique_id, count(*) as n, min(ds) as start, max(ds) as "end", min(gap) as gap_min,
       quantile_cont(gap, 0.5) as gap_median, max(gap) as gap_max from g group by 1""", ids=("A06",))
def a06(spark, sf):
    return dg.series_diagnostics(panels.orders_daily(spark, sf))


@register("A07_missingness", cte(h=HOURLY_GAPS) + """
select 'unique_id' as "column", count_if(unique_id is null) as n_missing, round(100.0 * count_if(unique_id is null) / count(*), 6) as pct_missing from h
union all select 'ds', count_if(ds is null), round(100.0 * count_if(ds is null) / count(*), 6) from h
union all select 'y', count_if(y is null), round(100.0 * count_if(y is null) / count(*), 6) from h""", ids=("A07",))
def a07(spark, sf):
    return dg.missingness(hourly_gaps(spark, sf))


def _acf_sql(L: int) -> str:
    lags = ", ".join(f"lag(c, {k}) {W} as l{k}" for k in range(1, L + 1))
    sums = ", ".join(f"sum(c * l{k}) as s{k}" for k in range(1, L + 1))
    rows = " union all ".join(f"select unique_id, {k} as lag, round(coalesce(s{k}, 0) / s0, 6) as acf, round(1.96 / sqrt(n), 6) as bound from s"
                              for k in range(1, L + 1))
    return P + f""",
c as (select p.unique_id, p.ds, p.y - m.m as c from p join (select unique_id, avg(y) m from p group by 1) m using (unique_id)),
l as (select unique_id, ds, c, {lags} from c),
s as (select unique_id, count(*) as n, sum(c * c) as s0, {sums} from l group by 1)
select unique_id, 0 as lag, 1.0 as acf, round(1.96 / sqrt(n), 6) as bound from s union all {rows}"""


@register("I01_acf", _acf_sql(28), ids=("I01",))
def i01(spark, sf):
    return dg.acf(padded_daily(spark, sf), Y, 28, freq="D")


@register("I02_pacf", None, ids=("I02",))
def i02(spark, sf):
    return dg.pacf(dg.acf(padded_daily(spark, sf), Y, 28, freq="D"))


def _ccf_sql(L: int) -> str:
    lags = ", ".join(f"lag(cx, {k}) {W} as l{k}" for k in range(1, L + 1))
    sums = ", ".join(f"sum(cy * l{k}) as s{k}" for k in range(1, L + 1))
    rows = " union all ".join(f"select unique_id, 'rev' as regressor, {k} as lag, round(coalesce(s{k}, 0) / sqrt(syy * sxx), 6) as ccf from s"
                              for k in range(1, L + 1))
    pr = padded(ORDERS_DAILY, cols="y,rev")
    return cte(p=pr) + f""",
c as (select p.unique_id, p.ds, p.y - m.my as cy, p.rev - m.mr as cx
      from p join (select unique_id, avg(y) my, avg(rev) mr from p group by 1) m using (unique_id)),
l as (select unique_id, ds, cy, cx, {lags} from c),
s as (select unique_id, sum(cy * cy) syy, sum(cx * cx) sxx, sum(cy * cx) s0, {sums} from l group by 1)
select unique_id, 'rev' as regressor, 0 as lag, round(s0 / sqrt(syy * sxx), 6) as ccf from s union all {rows}"""


@register("I03_ccf", _ccf_sql(14), ids=("I03",))
def i03(spark, sf):
    return dg.ccf(padded_daily(spark, sf, (Y, "rev")), Y, ["rev"], 14, freq="D")


@register("I05_classical_decomposition", P + f""",
t as (select *, row_number() {W} - 1 as pos,
        case when count(y) over (partition by unique_id order by ds rows between 3 preceding and 3 following) = 7
             then avg(y) over (partition by unique_id order by ds rows between 3 preceding and 3 following) end as trend from p),
s as (select unique_id, pos % 7 as ph, avg(y - trend) as s from t group by 1, 2),
s2 as (select unique_id, ph, s - avg(s) over (partition by unique_id) as season from s)
select t.unique_id, t.ds, t.y, round(trend, 6) as trend, round(season, 6) as season, round(y - trend - season, 6) as remainder
from t join s2 on t.unique_id = s2.unique_id and t.pos % 7 = s2.ph""", ids=("I05",))
def i05(spark, sf):
    return dg.classical_decomposition(padded_daily(spark, sf), Y, 7, freq="D")


@register("I06_trend_regression", P + """,
q as (select *, epoch(ds) / 86400.0 as t from p)
select unique_id, round(regr_slope(y, t), 6) as slope, round(regr_intercept(y, t), 6) as intercept,
       round(regr_r2(y, t), 6) as r2 from q group by 1""", ids=("I06",))
def i06(spark, sf):
    q = padded_daily(spark, sf).withColumn("t", calendar_column(F.col(DS), "index_num") / 86400.0)
    return q.groupBy(ID).agg(F.round(F.regr_slope(Y, "t"), 6).alias("slope"), F.round(F.regr_intercept(Y, "t"), 6).alias("intercept"),
                             F.round(F.regr_r2(Y, "t"), 6).alias("r2"))


def regression_design(df):
    """``trend + wday + month`` design: a day counter plus weekday and month dummies."""
    x = df.withColumn("trend", F.datediff(F.to_date(DS), F.lit("1970-01-01").cast("date")).cast("double"))
    feats = ["trend"]
    for d in range(2, 8):
        x = x.withColumn(f"wday_{d}", (calendar_column(F.col(DS), "wday") == d).cast("double"))
        feats.append(f"wday_{d}")
    for m in range(2, 13):
        x = x.withColumn(f"month_{m}", (F.month(DS) == m).cast("double"))
        feats.append(f"month_{m}")
    return x, feats


@register("I06_regression_fitted", None, ids=("I06", "M07"))
def i06f(spark, sf):
    x, feats = regression_design(padded_daily(spark, sf))
    coefs, design = ols.fit_ols(x, [ID], feats, Y)
    return ols.predict(x, coefs, [ID], design, "fitted").select(ID, DS, Y, F.round("fitted", 6).alias("fitted"))


@register("I08_series_features", cte(d=NATION_MONTHLY) + f""",
c as (select d.unique_id, d.ds, d.y, d.y - m.m as c from d join (select unique_id, avg(y) m from d group by 1) m using (unique_id)),
l as (select *, lag(c, 1) {W} as l1 from c)
select unique_id, count(*) as n, round(avg(y), 4) as mean, round(stddev_samp(y), 4) as sd,
       round(sum(c * l1) / sum(c * c), 6) as acf1 from l group by 1""", ids=("I08", "U04"))
def i08(spark, sf):
    d = panels.nation_monthly(spark, sf)
    feats = d.groupBy(ID).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(Y), 4).alias("mean"), F.round(F.stddev_samp(Y), 4).alias("sd"))
    a = dg.acf(d, Y, 1, freq="M").where(F.col("lag") == 1).select(ID, F.col("acf").alias("acf1"))
    return feats.join(a, ID)


@register("I04_loess_smoother", None, ids=("I04",))
def i04(spark, sf):
    return dg.loess(padded_daily(spark, sf), Y, 91, 1, freq="D")


@register("M18_mstl_decomposition", None, ids=("M18", "I05"))
def m18d(spark, sf):
    return dg.mstl(padded_daily(spark, sf), Y, (7, 30), freq="D")
