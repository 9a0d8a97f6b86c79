"""Queries for time-bucketed aggregation (D01-D13) and value counts."""

from pyspark.sql import functions as F

from chronoweave.operators import aggregate as agg
from chronoweave.operators import timegrid
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.registry import register
from chronoweave.plans.sqlpanels import EVENTS_HOURLY, ORDERS_DAILY, cte, padded
from chronoweave.sources import panels
from chronoweave.sources.tables import read_table

TWO_WEEK = "(timestamp '1970-01-05' + to_days(cast(14 * floor(datediff('day', date '1970-01-05', {c}) / 14) as integer)))"


@register("D01_summarize_daily_sum", """
select date_trunc('day', o_orderdate) as ds, round(sum(o_totalprice), 4) as o_totalprice
from orders group by 1""", ids=("D01",))
def d01(spark, sf):
    return agg.summarize_by_time(read_table(spark, sf, "orders"), "o_orderdate", "o_totalprice", "D", "sum", digits=4)


@register("D02_count_daily", """
select date_trunc('day', o_orderdate) as ds, count(*) as n from orders group by 1""", ids=("D02",))
def d02(spark, sf):
    return agg.count_by_time(read_table(spark, sf, "orders"), "o_orderdate", "D")


@register("D03_summarize_by_group", """
select o_orderpriority, date_trunc('day', o_orderdate) as ds, round(sum(o_totalprice), 4) as o_totalprice
from orders group by 1, 2""", ids=("D03",))
def d03(spark, sf):
    return agg.summarize_by_time(read_table(spark, sf, "orders"), "o_orderdate", "o_totalprice", "D", "sum",
                                 by=["o_orderpriority"], digits=4)


@register("D04_weekly_count", """
select date_trunc('week', l_shipdate) as ds, count(*) as n from lineitem group by 1""", ids=("D04",))
def d04w(spark, sf):
    return agg.count_by_time(read_table(spark, sf, "lineitem"), "l_shipdate", "W")


@register("D04_monthly_sum", """
select l_returnflag, date_trunc('month', l_shipdate) as ds, round(sum(l_extendedprice), 4) as l_extendedprice
from lineitem group by 1, 2""", ids=("D04",))
def d04m(spark, sf):
    return agg.summarize_by_time(read_table(spark, sf, "lineitem"), "l_shipdate", "l_extendedprice", "M", "sum",
                                 by=["l_returnflag"], digits=4)


@register("D05_weekly_mean_std_median", """
select date_trunc('week', l_shipdate) as ds, round(avg(l_quantity), 6) as l_quantity_mean,
       round(stddev_samp(l_quantity), 6) as l_quantity_std, round(quantile_cont(l_quantity, 0.5), 6) as l_quantity_median
from lineitem group by 1""", ids=("D05",))
def d05(spark, sf):
    return agg.summarize_by_time(read_table(spark, sf, "lineitem"), "l_shipdate", "l_quantity", "W",
                                 ["mean", "std", "median"], digits=6)


@register("D06_daily_sum_many_columns", """
select date_trunc('day', l_shipdate) as ds, round(sum(l_quantity), 4) as l_quantity,
       round(sum(l_extendedprice), 4) as l_extendedprice, round(sum(l_discount), 4) as l_discount
from lineitem group by 1""", ids=("D06",))
def d06(spark, sf):
    return agg.summarize_by_time(read_table(spark, sf, "lineitem"), "l_shipdate",
                                 ["l_quantity", "l_extendedprice", "l_discount"], "D", "sum", digits=4)


@register("D07_apply_by_time_2w", f"""
select {TWO_WEEK.format(c='l_shipdate')} as ds,
       round(sum(l_extendedprice), 4) as l_extendedprice_sum, round(avg(l_extendedprice), 4) as l_extendedprice_mean,
       round(max(l_extendedprice), 4) as l_extendedprice_max
from lineitem group by 1""", ids=("D07", "U02"))
def d07(spark, sf):
    return agg.summarize_by_time(read_table(spark, sf, "lineitem"), "l_shipdate", "l_extendedprice", "2W",
                                 ["sum", "mean", "max"], digits=4)


@register("D08_mutate_by_time_monthly_mean", cte(d=ORDERS_DAILY) + """
select d.unique_id, d.ds, d.y, round(m.y_mean, 6) as y_mean
from d join (select unique_id, date_trunc('month', ds) as b, avg(y) as y_mean from d group by 1, 2) m
  on d.unique_id = m.unique_id and date_trunc('month', d.ds) = m.b""", ids=("D08",))
def d08(spark, sf):
    x = agg.mutate_by_time(panels.orders_daily(spark, sf).select(ID, DS, Y), Y, "M", "mean")
    return x.withColumn("y_mean", F.round("y_mean", 6))


@register("D09_weekly_spread_to_daily", cte(d=ORDERS_DAILY) + """,
w as (select unique_id, date_trunc('week', ds) as ds, sum(y) as y from d group by 1, 2)
select unique_id, unnest(generate_series(ds, ds + interval 6 day, interval 1 day)) as ds, round(y / 7.0, 6) as y from w""",
          ids=("D09",))
def d09(spark, sf):
    d = panels.orders_daily(spark, sf)
    weekly = agg.summarize_by_time(d, DS, Y, "W", "sum", by=[ID])
    return agg.spread_to_daily(weekly).withColumn(Y, F.round(Y, 6))


@register("D10_boxplot_monthly", cte(p=padded(ORDERS_DAILY)) + """,
s as (select unique_id, date_trunc('month', ds) as ds, min(y) as ymin, quantile_cont(y, 0.25) as q1,
             quantile_cont(y, 0.5) as median, quantile_cont(y, 0.75) as q3, max(y) as ymax
      from p group by 1, 2),
o as (select s.unique_id, s.ds, count(*) as n_outliers from p join s
        on p.unique_id = s.unique_id and date_trunc('month', p.ds) = s.ds
      where p.y < s.q1 - 1.5 * (s.q3 - s.q1) or p.y > s.q3 + 1.5 * (s.q3 - s.q1) group by 1, 2)
select s.*, coalesce(o.n_outliers, 0) as n_outliers from s left join o using (unique_id, ds)""", ids=("D10",))
def d10(spark, sf):
    p = timegrid.pad_by_time(panels.orders_daily(spark, sf).select(ID, DS, Y), "D", fill={Y: 0.0})
    return agg.boxplot_stats(p, Y, "M", by=[ID])


@register("D11_seasonal_diagnostics", cte(h=EVENTS_HOURLY) + """,
l as (select unique_id, 'hour' as feature, hour(ds)::int as level, y from h
      union all select unique_id, 'wday', isodow(ds)::int, y from h)
select unique_id, feature, level, count(*) as n, quantile_cont(y, 0.25) as q1, quantile_cont(y, 0.5) as median,
       quantile_cont(y, 0.75) as q3, round(avg(y), 6) as mean
from l group by 1, 2, 3""", ids=("D11",))
def d11(spark, sf):
    return agg.seasonal_diagnostics(panels.events_hourly(spark, sf), Y, ("hour", "wday"))


@register("D12_value_counts", """
select o_orderstatus, o_orderpriority, count(*) as n from orders group by 1, 2""", ids=("D12", "B26"))
def d12(spark, sf):
    return agg.value_counts(read_table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@register("D13_temporal_hierarchy", cte(d=ORDERS_DAILY) + f"""
select unique_id, date_trunc('day', ds) as ds, sum(y) as y, 'D' as level from d group by 1, 2
union all select unique_id, date_trunc('week', ds), sum(y), 'W' from d group by 1, 2
union all select unique_id, {TWO_WEEK.format(c='ds')}, sum(y), '2W' from d group by 1, 2
union all select unique_id, date_trunc('month', ds), sum(y), 'M' from d group by 1, 2
union all select unique_id, date_trunc('quarter', ds), sum(y), 'Q' from d group by 1, 2
union all select unique_id, date_trunc('year', ds), sum(y), 'Y' from d group by 1, 2""", ids=("D13",))
def d13(spark, sf):
    return agg.temporal_hierarchy(panels.orders_daily(spark, sf).select(ID, DS, Y))
