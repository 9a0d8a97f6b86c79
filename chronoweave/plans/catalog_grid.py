"""Queries for time grids (G01-G06) and gap filling."""

from pyspark.sql import functions as F

from chronoweave.operators import fill, timegrid
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.registry import register
from chronoweave.plans.sqlpanels import EVENTS_DAILY, EVENTS_HOURLY, NATION_MONTHLY, ORDERS_DAILY, cte, padded
from chronoweave.sources import panels

HOURLY_GAPS = f"""
select g.unique_id, g.ds, d.y
from (select unique_id, unnest(generate_series(min(ds), max(ds), interval 1 hour)) as ds
      from ({EVENTS_HOURLY}) s group by unique_id) g
left join ({EVENTS_HOURLY}) d using (unique_id, ds)"""


def hourly_gaps(spark, sf):
    return timegrid.pad_by_time(panels.events_hourly(spark, sf).select(ID, DS, Y), "H")


@register("G01_pad_by_time_daily", padded(ORDERS_DAILY), ids=("G01", "B12"))
def g01(spark, sf):
    return timegrid.pad_by_time(panels.orders_daily(spark, sf).select(ID, DS, Y), "D", fill={Y: 0.0})


@register("G01_pad_by_time_hourly_nulls", HOURLY_GAPS, ids=("G01",))
def g01h(spark, sf):
    return hourly_gaps(spark, sf)


@register("G01_pad_by_time_start_date", f"""
select g.unique_id, g.ds, coalesce(d.y, 0) as y
from (select unique_id, unnest(generate_series(timestamp '1994-12-25', max(ds), interval 1 day)) as ds
      from ({ORDERS_DAILY}) s group by unique_id) g
left join ({ORDERS_DAILY}) d using (unique_id, ds)""", ids=("G01",))
def g01s(spark, sf):
    return timegrid.pad_by_time(panels.orders_daily(spark, sf).select(ID, DS, Y), "D", start="1994-12-25", fill={Y: 0.0})


@register("G02_common_grid", f"""
select g.unique_id, g.ds, coalesce(d.y, 0) as y
from (select i.unique_id, unnest(generate_series(b.lo, b.hi, interval 1 day)) as ds
      from (select distinct unique_id from ({EVENTS_DAILY})) i,
           (select min(ds) lo, max(ds) hi from ({EVENTS_DAILY})) b) g
left join ({EVENTS_DAILY}) d using (unique_id, ds)""", ids=("G02",))
def g02(spark, sf):
    return timegrid.common_grid(panels.events_daily(spark, sf).select(ID, DS, Y), "D", fill={Y: 0.0})


@register("G03_future_frame_bind", cte(p=padded(ORDERS_DAILY)) + """
select unique_id, ds, y from p
union all
select unique_id, unnest(generate_series(max(ds) + interval 1 day, max(ds) + interval 14 day, interval 1 day)), null
from p group by unique_id""", ids=("G03",))
def g03(spark, sf):
    p = timegrid.pad_by_time(panels.orders_daily(spark, sf).select(ID, DS, Y), "D", fill={Y: 0.0})
    return timegrid.future_frame(p, 14, "D")


@register("G04_extend_monthly", cte(d=NATION_MONTHLY) + """
select unique_id, ds, round(y, 4) as y from d
union all
select unique_id, unnest(generate_series(max(ds) + interval 1 month, max(ds) + interval 6 month, interval 1 month)), null
from d group by unique_id""", ids=("G04", "G03"))
def g04(spark, sf):
    d = panels.nation_monthly(spark, sf).select(ID, DS, F.round(Y, 4).alias(Y))
    return timegrid.future_frame(d, timegrid.future_length("6 months", "M"), "M")


@register("G05_nest_split", cte(d=EVENTS_DAILY) + """,
x as (select unique_id, ds, y from d
      union all select unique_id, unnest(generate_series(max(ds) + interval 1 day, max(ds) + interval 7 day, interval 1 day)), null
      from d group by unique_id)
select unique_id, ds, y,
       case when y is null then 'future'
            when row_number() over (partition by unique_id, y is null order by ds desc) <= 7 then 'test'
            else 'train' end as set
from x""", ids=("G05",))
def g05(spark, sf):
    d = panels.events_daily(spark, sf).select(ID, DS, Y)
    return timegrid.nest_split(timegrid.future_frame(d, 7, "D"), 7)


@register("G06_make_future_dataframe", cte(d=ORDERS_DAILY) + """
select unique_id, unnest(generate_series(max(ds) + interval 1 day, max(ds) + interval 28 day, interval 1 day)) as ds
from d group by unique_id""", ids=("G06",))
def g06(spark, sf):
    return timegrid.future_frame(panels.orders_daily(spark, sf).select(ID, DS, Y), 28, "D", bind=False)


@register("B13_forward_fill", cte(h=HOURLY_GAPS) + """
select unique_id, ds, last_value(y ignore nulls) over (partition by unique_id order by ds
       rows between unbounded preceding and current row) as y from h""", ids=("B13",))
def b13f(spark, sf):
    return fill.fill_direction(hourly_gaps(spark, sf), Y, "forward", freq="H")


@register("B13_backward_fill", cte(h=HOURLY_GAPS) + """
select unique_id, ds, first_value(y ignore nulls) over (partition by unique_id order by ds
       rows between current row and unbounded following) as y from h""", ids=("B13",))
def b13b(spark, sf):
    return fill.fill_direction(hourly_gaps(spark, sf), Y, "backward", freq="H")


_INTERP = """
i as (select *, row_number() over (partition by unique_id order by ds) as idx from {src}),
n as (select *,
        last_value(case when {v} is not null then idx end ignore nulls) over w1 as pi,
        last_value({v} ignore nulls) over w1 as pv,
        first_value(case when {v} is not null then idx end ignore nulls) over w2 as ni,
        first_value({v} ignore nulls) over w2 as nv
      from i window w1 as (partition by unique_id order by ds rows between unbounded preceding and current row),
                    w2 as (partition by unique_id order by ds rows between current row and unbounded following))"""


@register("B14_interpolate_linear", cte(h=HOURLY_GAPS) + "," + _INTERP.format(src="h", v="y") + """
select unique_id, ds, round(case when y is not null then y when ni is null then pv
                                 else pv + (nv - pv) * (idx - pi) / (ni - pi) end, 6) as y from n""", ids=("B14",))
def b14(spark, sf):
    return fill.interpolate_linear(hourly_gaps(spark, sf), Y, freq="H").withColumn(Y, F.round(Y, 6))


@register("B15_impute_seasonal", cte(h=HOURLY_GAPS) + """,
p as (select *, (row_number() over (partition by unique_id order by ds) - 1) % 24 as ph from h),
m as (select unique_id, ph, avg(y) as pm from p group by 1, 2),
a as (select p.unique_id, p.ds, p.y - m.pm as ya, m.pm from p join m using (unique_id, ph)),""" +
          _INTERP.format(src="a", v="ya") + """
select unique_id, ds, round(case when ya is not null then ya when ni is null then pv
                                 else pv + (nv - pv) * (idx - pi) / (ni - pi) end + pm, 6) as y from n""", ids=("B15",))
def b15(spark, sf):
    return fill.impute_seasonal(hourly_gaps(spark, sf), Y, 24, freq="H").withColumn(Y, F.round(Y, 6))
