"""Queries for scans, parsing, reshaping, cleaning, joins and split utilities
(A01-A08, B01-B30, C01-C11, K01, K03, K04, K09, K16, K17)."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoweave.functions import calendar
from chronoweave.functions.timekeys import add_offset, add_steps, steps_between
from chronoweave.operators import aggregate, baselines, reshape, splits, timegrid, windows
from chronoweave.operators.baselines import MODEL, YHAT
from chronoweave.panel import DS, ID, Y, as_ntz
from chronoweave.plans.catalog_models import HOLD, holdout_fc, padded_daily, split_sql
from chronoweave.plans.registry import register
from chronoweave.plans.sqlpanels import (EVENT_CALENDAR, EVENTS_DAILY, EVENTS_HOURLY, NATION_MONTHLY, ORDERS_DAILY, SHIP_DAILY,
                                         cte, padded)
from chronoweave.sources import panels
from chronoweave.sources.tables import read_table

P = cte(p=padded(ORDERS_DAILY))
W = "over (partition by unique_id order by ds)"


@register("A01_typed_scan", """
select event_id as id, event_type, ts as event_date from events""", ids=("A01",))
def a01(spark, sf):
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                           T.StructField("event_type", T.StringType())])
    e = spark.read.schema(schema).parquet(f"{sf}/events.parquet")
    return e.select(F.col("event_id").alias("id"), "event_type", F.col("ts").alias("event_date"))


@register("A02_hour_key_roundtrip", """
select strftime(ts, '%Y%m%d%H') as date_hour, strptime(strftime(ts, '%Y%m%d%H'), '%Y%m%d%H') as ds, count(*) as n
from events group by 1, 2""", ids=("A02",))
def a02(spark, sf):
    e = read_table(spark, sf, "events").withColumn("date_hour", F.date_format("ts", "yyyyMMddHH"))
    return e.groupBy("date_hour").agg(F.count(F.lit(1)).alias("n")).withColumn(
        DS, F.to_timestamp_ntz(F.col("date_hour"), F.lit("yyyyMMddHH")))


@register("A03_multi_format_parse", """
with s as (select event_id, case when event_id % 2 = 0 then strftime(ts, '%Y-%m-%d %H:%M:%S') else strftime(ts, '%d-%m-%Y %H:%M') end as txt from events)
select event_id, txt, coalesce(try_strptime(txt, '%Y-%m-%d %H:%M:%S'), try_strptime(txt, '%d-%m-%Y %H:%M')) as ds from s""", ids=("A03",))
def a03(spark, sf):
    e = read_table(spark, sf, "events")
    txt = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format("ts", "dd-MM-yyyy HH:mm"))
    s = e.select("event_id", txt.alias("txt"))
    parsed = F.coalesce(F.try_to_timestamp(F.col("txt"), F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(F.col("txt"), F.lit("dd-MM-yyyy HH:mm")))
    return s.withColumn(DS, parsed.cast("timestamp_ntz"))


@register("A04_row_bind_by_name", cte(o=ORDERS_DAILY, s=SHIP_DAILY) + """
select unique_id, ds, y, rev, null::double as qty from o
union all select unique_id, ds, null, null, y from s""", ids=("A04", "C09"))
def a04(spark, sf):
    o = panels.orders_daily(spark, sf)
    s = panels.ship_daily(spark, sf).withColumnRenamed(Y, "qty")
    return o.unionByName(s, allowMissingColumns=True)


@register("A08_sample_quarter_series", """
select r_name as unique_id, date_trunc('quarter', q0) + to_months((3 * (k - 1))::int) as ds, k::double as y
from (select r_name, min(o_orderdate) as q0 from orders join customer on o_custkey = c_custkey
      join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1) b, range(1, 21) t(k)""",
          ids=("A08",))
def a08(spark, sf):
    o = read_table(spark, sf, "orders").select("o_custkey", "o_orderdate")
    c = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, sf, "region").select("r_regionkey", "r_name")
    b = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
          .groupBy(F.col("r_name").alias(ID)).agg(F.min("o_orderdate").alias("q0")))
    g = b.select(ID, F.posexplode(F.sequence(as_ntz(F.date_trunc("quarter", "q0")),
                                              add_steps(as_ntz(F.date_trunc("quarter", "q0")), 19, "Q"),
                                              F.expr("INTERVAL 3 months"))).alias("k", DS))
    return g.select(ID, DS, (F.col("k") + 1).cast("double").alias(Y))


@register("B01_select_columns_regex", P + """
select unique_id, ds, y, year(ds)::int as ds_year, month(ds)::int as ds_month from p""", ids=("B01", "H10"))
def b01(spark, sf):
    x = calendar.augment_timeseries_signature(padded_daily(spark, sf), features=("year", "month", "wday", "yday"))
    return reshape.select_columns(x, r"^ds_(year|month)$")


@register("B02_pivot_models_wide", split_sql(**HOLD) + """
select unique_id, ds, round(max(case when model = 'Naive' then y_hat end), 6) as "Naive",
       round(max(case when model = 'SeasonalNaive' then y_hat end), 6) as "SeasonalNaive",
       round(max(case when model = 'WindowAverage' then y_hat end), 6) as "WindowAverage" from fc group by 1, 2""", ids=("B02", "B06", "C04", "C10"))
def b02(spark, sf):
    _, _, fc = holdout_fc(spark, sf)
    wide = reshape.pivot_wider(fc.withColumn(YHAT, F.round(YHAT, 6)), [ID, DS], MODEL, YHAT, ["Naive", "SeasonalNaive", "WindowAverage"])
    return wide.select(ID, DS, *reshape.model_columns(wide))


@register("B03_mutate_rename_drop", cte(d=ORDERS_DAILY) + """
select unique_id as series, ds as date, y as orders, round(rev / y, 4) as avg_ticket from d""", ids=("B03", "B19"))
def b03(spark, sf):
    d = panels.orders_daily(spark, sf)
    d = d.withColumns({"avg_ticket": F.round(F.col("rev") / F.col(Y), 4)}).drop("rev")
    return d.withColumnsRenamed({ID: "series", DS: "date", Y: "orders"})


@register("B04_reindex_missing_as_null", cte(d=ORDERS_DAILY) + """
select unique_id, ds, null as event, y, null as y_lag_56 from d""", ids=("B04",))
def b04(spark, sf):
    return reshape.reindex(panels.orders_daily(spark, sf), [ID, DS, "event", Y, "y_lag_56"])


@register("B05_melt", P + """
select unique_id, ds, 'ds_month' as variable, month(ds)::int as value from p
union all select unique_id, ds, 'ds_wday', isodow(ds)::int from p""", ids=("B05",))
def b05(spark, sf):
    x = calendar.augment_timeseries_signature(padded_daily(spark, sf), features=("month", "wday")).drop(Y)
    return reshape.melt(x, [ID, DS], ["ds_month", "ds_wday"])


@register("B06_pivot_wider_hourly", cte(h=EVENTS_HOURLY) + """
select ds, max(case when unique_id = 'view' then y end) as "view", max(case when unique_id = 'click' then y end) as click,
       max(case when unique_id = 'purchase' then y end) as purchase, max(case when unique_id = 'signup' then y end) as signup,
       max(case when unique_id = 'error' then y end) as "error" from h group by 1""", ids=("B06",))
def b06(spark, sf):
    return reshape.pivot_wider(panels.events_hourly(spark, sf), [DS], ID, Y, ["view", "click", "purchase", "signup", "error"])


@register("B07_filter_by_time_partial_bounds", cte(d=ORDERS_DAILY) + """
select * from d where ds >= timestamp '1997-12-01' and ds < timestamp '1999-01-01'""", ids=("B07",))
def b07(spark, sf):
    return reshape.filter_by_time(panels.orders_daily(spark, sf), "1997-12", "1998")


@register("B08_between_time_flag", P + """
select unique_id, ds, y, (ds >= timestamp '1998-03-01' and ds < timestamp '1998-04-01')::int as in_window from p""", ids=("B08", "B11"))
def b08(spark, sf):
    return padded_daily(spark, sf).withColumn("in_window", reshape.between_time(F.col(DS), "1998-03", "1998-03").cast("int"))


@register("B09_time_offsets", """
select o_orderkey, o_orderdate + interval 28 day as plus_4_weeks, o_orderdate + interval 1 month as plus_1_month,
       o_orderdate - interval 1 year as minus_1_year from orders""", ids=("B09",))
def b09(spark, sf):
    o = read_table(spark, sf, "orders")
    return o.select("o_orderkey", add_offset(F.col("o_orderdate"), "4 weeks").alias("plus_4_weeks"),
                    add_offset(F.col("o_orderdate"), "1 month").alias("plus_1_month"),
                    add_offset(F.col("o_orderdate"), "-1 year").alias("minus_1_year"))


@register("B10_offset_by_period", """
select o_orderkey, case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'month' else 'day' end as period,
       case when o_orderpriority in ('1-URGENT', '2-HIGH') then o_orderdate + to_months(3) else o_orderdate + to_days(3) end as ds
from orders""", ids=("B10",))
def b10(spark, sf):
    o = read_table(spark, sf, "orders")
    monthly = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return o.select("o_orderkey", F.when(monthly, "month").otherwise("day").alias("period"),
                    F.when(monthly, add_steps(F.col("o_orderdate"), 3, "M")).otherwise(add_steps(F.col("o_orderdate"), 3, "D")).alias(DS))


@register("B16_drop_null_rows", P + f"""
select * from (select unique_id, ds, y, lag(y, 7) {W} as y_lag_7 from p) where y_lag_7 is not null""", ids=("B16", "H14"))
def b16(spark, sf):
    return windows.augment_lags(padded_daily(spark, sf), Y, [7]).dropna(subset=["y_lag_7"])


@register("B17_tail_per_series", P + """
select unique_id, ds, y from (select *, row_number() over (partition by unique_id order by ds desc) as r from p) where r <= 7""", ids=("B17",))
def b17(spark, sf):
    return reshape.tail_per_series(padded_daily(spark, sf), 7)


@register("B17_head_per_series", P + """
select unique_id, ds, y from (select *, row_number() over (partition by unique_id order by ds) as r from p) where r <= 7""", ids=("B17",))
def b17h(spark, sf):
    return reshape.head_per_series(padded_daily(spark, sf), 7)


@register("B18_future_rows", P + """
select unique_id, unnest(generate_series(max(ds) + interval 1 day, max(ds) + interval 14 day, interval 1 day)) as ds, null::double as y
from p group by 1""", ids=("B18", "G03"))
def b18(spark, sf):
    x = timegrid.future_frame(padded_daily(spark, sf), 14)
    return x.where(F.col(Y).isNull())


@register("B20_lump_levels", cte(d=ORDERS_DAILY) + """
select case when unique_id = '1-URGENT' then unique_id else 'other' end as unique_id, ds, sum(y) as y from d group by 1, 2""",
          ids=("B20", "D03"))
def b20(spark, sf):
    d = panels.orders_daily(spark, sf).withColumn(ID, reshape.lump_levels(F.col(ID), ["1-URGENT"], "other"))
    return d.groupBy(ID, DS).agg(F.sum(Y).alias(Y))


@register("B21_century_repair", """
with s as (select o_orderkey, strftime(o_orderdate, '%d-%m-%y %H:%M') as txt from orders),
t as (select o_orderkey, txt, strptime(txt, '%d-%m-%y %H:%M') as d0 from s)
select o_orderkey, txt, case when year(d0) > 2019 then d0 - interval 100 year else d0 end as ds from t""", ids=("B21", "A03"))
def b21(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd-MM-yy HH:mm").alias("txt"))
    return o.withColumn(DS, reshape.century_repair(F.col("txt")))


@register("B22_wide_positions_to_index", cte(n=NATION_MONTHLY) + """,
w as (select unique_id, 'V' || (row_number() over (partition by unique_id order by ds) + 1)::varchar as col, y from n)
select unique_id, (replace(col, 'V', '')::int - 1) as idx, round(y, 4) as y from w""", ids=("B22", "B05"))
def b22(spark, sf):
    n = panels.nation_monthly(spark, sf)
    from chronoweave.operators.windows import row_index
    w = row_index(n.select(ID, DS, Y)).withColumn("col", F.concat(F.lit("V"), (F.col("row_index") + 1).cast("string")))
    return w.select(ID, reshape.strip_prefix_index(F.col("col"), "V", -1).alias("idx"), F.round(Y, 4).alias(Y))


@register("B23_text_flags", """
select event_id, (props like '%"k": 1%')::int as k_starts_1, regexp_matches(props, '"k": [0-9]{2}') as two_digit from events""", ids=("B23",))
def b23(spark, sf):
    e = read_table(spark, sf, "events")
    return e.select("event_id", F.col("props").contains('"k": 1').cast("int").alias("k_starts_1"),
                    F.col("props").rlike('"k": [0-9]{2}').alias("two_digit"))


@register("B24_seeded_series_sample", None, ids=("B24",))
def b24(spark, sf):
    c = read_table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias(ID), "c_mktsegment")
    return reshape.sample_series(c, "c_mktsegment", 3, seed=123)


@register("B25_to_intermittent", None, ids=("B25",))
def b25(spark, sf):
    return reshape.to_intermittent(padded_daily(spark, sf), 0.9, seed=1992)


@register("B27_sort_mixed", cte(d=ORDERS_DAILY) + "select * from d order by unique_id asc, ds desc", ids=("B27",))
def b27(spark, sf):
    return panels.orders_daily(spark, sf).orderBy(F.col(ID).asc(), F.col(DS).desc())


@register("B28_rename_drop_by_pattern", split_sql(**HOLD) + """
select unique_id, ds, round(max(case when model = 'Naive' then y_hat end), 6) as "Naive",
       round(max(case when model = 'SeasonalNaive' then y_hat end), 6) as "SeasonalNaive" from fc group by 1, 2""", ids=("B28",))
def b28(spark, sf):
    _, _, fc = holdout_fc(spark, sf)
    x = fc.withColumn(MODEL, F.concat(F.col(MODEL), F.lit("-median")))
    wide = reshape.pivot_wider(x.withColumn(YHAT, F.round(YHAT, 6)), [ID, DS], MODEL, YHAT,
                               ["Naive-median", "SeasonalNaive-median", "WindowAverage-median"])
    return reshape.rename_by_pattern(reshape.drop_by_pattern(wide, "^WindowAverage"), r"-median$", "")


@register("B29_nest_unnest_roundtrip", cte(d=ORDERS_DAILY) + "select unique_id, ds, y from d", ids=("B29",))
def b29(spark, sf):
    d = panels.orders_daily(spark, sf).select(ID, DS, Y)
    nested = d.groupBy(ID, F.date_trunc("month", DS).alias("_m")).agg(F.array_sort(F.collect_list(F.struct(DS, Y))).alias("data"))
    return nested.select(ID, F.inline("data"))


@register("B30_query_filter", cte(d=ORDERS_DAILY) + "select * from d where y > 4 and unique_id <> '5-LOW'", ids=("B30",))
def b30(spark, sf):
    return panels.orders_daily(spark, sf).where("y > 4 and unique_id <> '5-LOW'")


@register("C01_left_join_fill", cte(d=ORDERS_DAILY) + """,
s as (select date_trunc('day', l_shipdate) as date, sum(l_quantity) as shipped from lineitem group by 1)
select d.unique_id, d.ds, d.y, coalesce(s.shipped, 0) as shipped from d left join s on d.ds = s.date""", ids=("C01",))
def c01(spark, sf):
    s = read_table(spark, sf, "lineitem").groupBy(as_ntz(F.to_date("l_shipdate")).alias("date")).agg(F.sum("l_quantity").alias("shipped"))
    return reshape.left_join_fill(panels.orders_daily(spark, sf).select(ID, DS, Y), s, DS, "date", {"shipped": 0.0})


@register("C02_event_calendar_join", cte(d=EVENTS_DAILY, cal=EVENT_CALENDAR) + """
select d.unique_id, d.ds, d.y, coalesce(cal.event, 0) as event from d left join cal using (ds)""", ids=("C02",))
def c02(spark, sf):
    d = panels.events_daily(spark, sf).select(ID, DS, Y)
    return d.join(panels.event_calendar(spark, sf), DS, "left").fillna({"event": 0})


@register("C03_regressor_join_lag", P + f""",
s as (select date_trunc('day', l_shipdate) as ds, sum(l_quantity) as shipped from lineitem group by 1),
j as (select p.unique_id, p.ds, p.y, coalesce(s.shipped, 0) as shipped from p left join s using (ds))
select *, lag(shipped, 1) {W} as shipped_lag_1, lag(shipped, 7) {W} as shipped_lag_7 from j""", ids=("C03",))
def c03(spark, sf):
    s = read_table(spark, sf, "lineitem").groupBy(as_ntz(F.to_date("l_shipdate")).alias(DS)).agg(F.sum("l_quantity").alias("shipped"))
    j = padded_daily(spark, sf).join(s, DS, "left").fillna({"shipped": 0.0})
    return windows.augment_lags(j, "shipped", [1, 7])


@register("C05_test_offset_by_train_length", P + """,
lt as (select unique_id, max(ds) as T from p group by 1),
s as (select p.*, case when p.ds <= lt.T - interval 28 day then 'train' else 'test' end as set from p join lt using (unique_id)),
n as (select unique_id, count(*) as n_train from s where set = 'train' group by 1)
select s.unique_id, s.ds, n.n_train + row_number() over (partition by s.unique_id order by s.ds) as idx
from s join n using (unique_id) where set = 'test'""", ids=("C05",))
def c05(spark, sf):
    s = splits.time_series_split(padded_daily(spark, sf), 28)
    n = s.where(F.col("set") == "train").groupBy(ID).agg(F.count(F.lit(1)).alias("n_train"))
    from chronoweave.operators.windows import row_index
    t = row_index(s.where(F.col("set") == "test").select(ID, DS))
    return t.join(n, ID).select(ID, DS, (F.col("n_train") + F.col("row_index")).alias("idx"))


@register("C07_semi_join", """
select o_orderkey, o_custkey, o_totalprice from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')""",
          ids=("C07",))
def c07(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = read_table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return reshape.semi_join(o, c, ["o_custkey"])


@register("C11_intersect_days", cte(o=ORDERS_DAILY, s=SHIP_DAILY) + "select ds from o intersect select ds from s", ids=("C11",))
def c11(spark, sf):
    return panels.orders_daily(spark, sf).select(DS).intersect(panels.ship_daily(spark, sf).select(DS))


@register("K03_sliding_cv_plan", P + """,
lt as (select unique_id, max(ds) as T from p group by 1),
cut as (select unique_id, i, T - to_days((14 + i * 7)::int) as cutoff from lt cross join range(0, 4) r(i))
select c.unique_id, c.cutoff, p.ds, case when p.ds <= c.cutoff then 'train' else 'test' end as set
from cut c join p on p.unique_id = c.unique_id and p.ds > c.cutoff - interval 90 day and p.ds <= c.cutoff + interval 14 day""", ids=("K03", "K05"))
def k03(spark, sf):
    w = splits.backtest_windows(padded_daily(spark, sf), 14, 4, 7, "D", initial=90)
    return w.select(ID, "cutoff", DS, "set")


@register("K04_vfold", None, ids=("K04",))
def k04(spark, sf):
    return splits.vfold(padded_daily(spark, sf), 5, seed=123).groupBy(ID, "fold").count()


WIDE = """
w as (select ds, max(case when unique_id = 'view' then y end) as view, max(case when unique_id = 'click' then y end) as click,
             max(case when unique_id = 'purchase' then y end) as purchase, max(case when unique_id = 'signup' then y end) as signup,
             max(case when unique_id = 'error' then y end) as err from h group by 1)"""


@register("K09_wind_style_score", cte(h=EVENTS_HOURLY) + "," + WIDE + """,
j as (select a.*, f.view as f_view, f.click as f_click, f.purchase as f_purchase, f.signup as f_signup, f.err as f_err
      from w a join w f on f.ds = a.ds - interval 48 hour),
s as (select sqrt(sum((f_view - view) * (f_view - view))) as view, sqrt(sum((f_click - click) * (f_click - click))) as click,
             sqrt(sum((f_purchase - purchase) * (f_purchase - purchase))) as purchase, sqrt(sum((f_signup - signup) * (f_signup - signup))) as signup,
             sqrt(sum((f_err - err) * (f_err - err))) as err from j)
select round(view, 6) as view, round(click, 6) as click, round(purchase, 6) as purchase, round(signup, 6) as signup, round(err, 6) as err,
       round((view + click + purchase + signup + err) / 5, 6) as score from s""", ids=("K09",))
def k09(spark, sf):
    cols = ["view", "click", "purchase", "signup", "error"]
    w = reshape.pivot_wider(panels.events_hourly(spark, sf), [DS], ID, Y, cols).withColumnRenamed("error", "err")
    cols = ["view", "click", "purchase", "signup", "err"]
    f = w.select(add_steps(F.col(DS), 48, "H").alias(DS), *[F.col(c).alias(f"f_{c}") for c in cols])
    j = w.join(f, DS)
    s = j.agg(*[F.sqrt(F.sum((F.col(f"f_{c}") - F.col(c)) ** 2)).alias(c) for c in cols])
    return s.select(*[F.round(c, 6).alias(c) for c in cols], F.round(sum(F.col(c) for c in cols) / len(cols), 6).alias("score"))


@register("K16_block_evaluation", cte(h=EVENTS_HOURLY) + """
select unique_id, ds, y,
  ((datediff('hour', timestamp '2024-01-01 01:00:00', ds) % 168 + 168) % 168 < 48
   or (datediff('hour', timestamp '2024-01-04 13:00:00', ds) % 168 + 168) % 168 < 48)::int as in_eval_block from h""", ids=("K16",))
def k16(spark, sf):
    h = panels.events_hourly(spark, sf).select(ID, DS, Y)
    blk = None
    for anchor in ("2024-01-01 01:00:00", "2024-01-04 13:00:00"):
        c = F.pmod(F.timestamp_diff("HOUR", F.lit(anchor).cast("timestamp_ntz"), F.col(DS)), F.lit(168)) < 48
        blk = c if blk is None else (blk | c)
    return h.withColumn("in_eval_block", blk.cast("int"))


@register("K17_issue_lead_forecasts", cte(h=EVENTS_HOURLY) + """,
iss as (select unique_id, ds as issue, y from h where hour(ds) in (0, 12)),
f as (select unique_id, issue, hors, issue + to_hours(hors::int) as ds, y as y_hat from iss, range(1, 49) r(hors))
select unique_id, ds, max(issue) as issue, arg_max(y_hat, issue) as y_hat, arg_max(hors, issue)::int as hors from f group by 1, 2""",
          ids=("K17",))
def k17(spark, sf):
    h = panels.events_hourly(spark, sf).select(ID, DS, Y)
    iss = h.where(F.hour(DS).isin(0, 12)).select(ID, F.col(DS).alias("issue"), F.col(Y).alias(YHAT))
    f = iss.withColumn("hors", F.explode(F.sequence(F.lit(1), F.lit(48)))).withColumn(DS, add_steps(F.col("issue"), F.col("hors"), "H"))
    return f.groupBy(ID, DS).agg(F.max("issue").alias("issue"), F.max_by(YHAT, "issue").alias(YHAT), F.max_by("hors", "issue").alias("hors"))
