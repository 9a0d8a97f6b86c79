"""Queries for feature engineering."""

import math

from pyspark.sql import functions as F

from chronoweave.functions import basis, calendar, holidays
from chronoweave.operators import timegrid
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.registry import register
from chronoweave.plans.sqlpanels import ORDERS_DAILY, cte, padded
from chronoweave.sources import panels

P = cte(p=padded(ORDERS_DAILY))


def padded_daily(spark, sf):
    return timegrid.pad_by_time(panels.orders_daily(spark, sf).select(ID, DS, Y), "D", fill={Y: 0.0})


_SIG_SQL = {
    "index_num": "epoch(ds)::bigint",
    "year": "year(ds)::int",
    "year_iso": "isoyear(ds)::int",
    "yearstart": "(month(ds) = 1 and day(ds) = 1)::int",
    "yearend": "(month(ds) = 12 and day(ds) = 31)::int",
    "leapyear": "(dayofyear(make_date(year(ds)::bigint, 12, 31)) = 366)::int",
    "half": "case when month(ds) <= 6 then 1 else 2 end::int",
    "quarter": "quarter(ds)::int",
    "quarteryear": "year(ds)::varchar || 'Q' || quarter(ds)::varchar",
    "quarterstart": "(ds::date = date_trunc('quarter', ds)::date)::int",
    "quarterend": "(ds::date = (date_trunc('quarter', ds) + interval 3 month - interval 1 day)::date)::int",
    "month": "month(ds)::int",
    "month_lbl": "monthname(ds)",
    "monthstart": "(day(ds) = 1)::int",
    "monthend": "(ds::date = last_day(ds))::int",
    "yweek": "weekofyear(ds)::int",
    "mweek": "((day(ds) - 1) // 7 + 1)::int",
    "wday": "isodow(ds)::int",
    "wday_lbl": "dayname(ds)",
    "mday": "day(ds)::int",
    "qday": "(datediff('day', date_trunc('quarter', ds), ds) + 1)::int",
    "yday": "dayofyear(ds)::int",
    "weekend": "(isodow(ds) >= 6)::int",
    "hour": "hour(ds)::int",
    "minute": "minute(ds)::int",
    "second": "second(ds)::int",
    "msecond": "(epoch_ms(ds) % 1000)::int",
    "nsecond": "((epoch_us(ds) % 1000000) * 1000)::int",
    "am_pm": "case when hour(ds) < 12 then 'am' else 'pm' end",
}


@register("H01_timeseries_signature", P + "select unique_id, ds, y, " +
          ", ".join(f"{v} as ds_{k}" for k, v in _SIG_SQL.items()) + " from p", ids=("H01", "H02", "U06"))
def h01(spark, sf):
    return calendar.augment_timeseries_signature(padded_daily(spark, sf))


_FIXED = ", ".join(f"('{n.replace(chr(39), chr(39) * 2)}', {m}, {d}, {s})" for n, m, d, s in holidays.FIXED_DATE_HOLIDAYS)
_WEEKDAY = ", ".join(f"('{n.replace(chr(39), chr(39) * 2)}', {m}, {wd}, {nth}, {s})" for n, m, wd, nth, s in holidays.WEEKDAY_HOLIDAYS)

HOLIDAY_SQL = f""",
yrs as (select unnest(range(min(year(ds))::int - 1, max(year(ds))::int + 2)) as yr from p),
fx(name, m, d, since) as (values {_FIXED}),
wk(name, m, wd, nth, since) as (values {_WEEKDAY}),
h as (select make_date(yr, m, d) as hd, name from yrs, fx where yr >= since
      union all
      select case isodow(make_date(yr, m, d)) when 6 then make_date(yr, m, d) - 1 else make_date(yr, m, d) + 1 end,
             name || ' (observed)' from yrs, fx where yr >= since and isodow(make_date(yr, m, d)) in (6, 7)
      union all
      select case when nth > 0 then make_date(yr, m, 1) + ((wd - isodow(make_date(yr, m, 1)) + 7) % 7 + 7 * (nth - 1))::int
                  else last_day(make_date(yr, m, 1)) - ((isodow(last_day(make_date(yr, m, 1))) - wd + 7) % 7)::int end,
             name from yrs, wk where yr >= since),
hh as (select hd, string_agg(name, ', ' order by name) as holiday_name from h group by hd)"""


@register("H03_holiday_signature", P + HOLIDAY_SQL + """
select p.unique_id, p.ds, p.y, hh.holiday_name,
       (hh.holiday_name is not null)::int as is_holiday,
       (exists (select 1 from hh b where b.hd = p.ds::date + 1))::int as before_holiday,
       (exists (select 1 from hh a where a.hd = p.ds::date - 1))::int as after_holiday
from p left join hh on hh.hd = p.ds::date""", ids=("H03",))
def h03(spark, sf):
    return holidays.augment_holiday_signature(padded_daily(spark, sf))


def _fourier_sql(periods, K):
    out = []
    for per in periods:
        for k in range(1, K + 1):
            arg = f"{2 * math.pi * k / per!r} * floor(epoch(ds) / 86400)"
            out.append(f"round(sin({arg}), 6) as ds_sin_{per:g}_{k}".replace(".", "_", 0))
            out.append(f"round(cos({arg}), 6) as ds_cos_{per:g}_{k}")
    return ", ".join(out)


@register("H04_fourier_terms", P + "select unique_id, ds, y, " + _fourier_sql((7, 365), 2) + " from p", ids=("H04",))
def h04(spark, sf):
    return basis.augment_fourier(padded_daily(spark, sf), DS, (7, 365), 2, "D", digits=6)


def _bspline_sql(n_inner: int, degree: int) -> str:
    """Cox-de Boor recursion written out in SQL over knots t1..tN from a one-row CTE ``k``."""
    n = 2 * (degree + 1) + n_inner
    t = [f"k.t{i + 1}" for i in range(n)]
    x = "x"
    base = []
    for i in range(n - 1):
        base.append(f"(case when ({x} >= {t[i]} and {x} < {t[i+1]}) or ({x} = {t[-1]} and {t[i+1]} = {t[-1]} and {t[i]} < {t[-1]}) "
                    f"then 1.0 else 0.0 end)")
    cur = base
    for p in range(1, degree + 1):
        nxt = []
        for i in range(n - p - 1):
            a = f"coalesce(({x} - {t[i]}) / nullif({t[i+p]} - {t[i]}, 0) * {cur[i]}, 0)"
            b = f"coalesce(({t[i+p+1]} - {x}) / nullif({t[i+p+1]} - {t[i+1]}, 0) * {cur[i+1]}, 0)"
            nxt.append(f"({a} + {b})")
        cur = nxt
    return ", ".join(f"round({c}, 6) as bspline_{j}_degree_{degree}" for j, c in enumerate(cur[1:], start=1))


def _knots_sql(n_inner: int, degree: int, src: str, col: str) -> str:
    qs = [f"quantile_cont({col}, {(i + 1) / (n_inner + 1)!r})::double" for i in range(n_inner)]
    ts = [f"min({col})::double"] * (degree + 1) + qs + [f"max({col})::double"] * (degree + 1)
    return "select " + ", ".join(f"{v} as t{i + 1}" for i, v in enumerate(ts)) + f" from {src}"


@register("H05_bsplines", P + ", q as (select *, epoch(ds)::bigint as ds_index_num from p), k as (" +
          _knots_sql(2, 3, "q", "ds_index_num") + ")" +
          " select q.unique_id, q.ds, q.y, q.ds_index_num, " + _bspline_sql(2, 3).replace("x", "q.ds_index_num::double").replace("eq.ds_index_num::doublep", "exp") +
          " from q, k", ids=("H05",))
def h05(spark, sf):
    p = padded_daily(spark, sf).withColumn("ds_index_num", calendar.calendar_column(F.col(DS), "index_num"))
    return basis.augment_bsplines(p, "ds_index_num", 5, 3, digits=6)


def _ns_sql(deg_free: int, src: str, col: str) -> str:
    n_inner = deg_free - 1
    K = n_inner + 2
    qs = [f"quantile_cont({col}, {(i + 1) / (n_inner + 1)!r})::double" for i in range(n_inner)]
    ks = [f"min({col})::double"] + qs + [f"max({col})::double"]
    kn = "select " + ", ".join(f"{v} as z{i}" for i, v in enumerate(ks)) + f" from {src}"
    x = f"(({col}::double - k.z0) / (k.z{K-1} - k.z0))"
    z = [f"((k.z{i} - k.z0) / (k.z{K-1} - k.z0))" for i in range(K)]

    def d(i):
        return (f"((pow(greatest({x} - {z[i]}, 0), 3) - pow(greatest({x} - {z[K-1]}, 0), 3)) / nullif({z[K-1]} - {z[i]}, 0))")
    cols = [x] + [f"({d(i)} - {d(K-2)})" for i in range(0, K - 2)]
    sel = ", ".join(f"round({c}, 6) as ns_{j}" for j, c in enumerate(cols[:deg_free], start=1))
    return kn, sel


_NS_K, _NS_SEL = _ns_sql(3, "q", "ds_index_num")


@register("H06_natural_spline", P + ", q as (select *, epoch(ds)::bigint as ds_index_num from p), k as (" + _NS_K + ")" +
          " select q.unique_id, q.ds, q.y, q.ds_index_num, " + _NS_SEL + " from q, k", ids=("H06",))
def h06(spark, sf):
    p = padded_daily(spark, sf).withColumn("ds_index_num", calendar.calendar_column(F.col(DS), "index_num"))
    return basis.augment_natural_spline(p, "ds_index_num", 3, digits=6)


MONTHS = ["April", "August", "December", "February", "January", "July", "June", "March", "May", "November", "October", "September"]
DAYS = ["Friday", "Monday", "Saturday", "Sunday", "Thursday", "Tuesday", "Wednesday"]


@register("H07_one_hot", P + ", q as (select *, monthname(ds) as m, dayname(ds) as w from p) select unique_id, ds, y, " +
          ", ".join([f"(m = '{v}')::int as ds_month_lbl_{v}" for v in MONTHS[1:]] +
                    [f"(w = '{v}')::int as ds_wday_lbl_{v}" for v in DAYS[1:]]) + " from q", ids=("H07",))
def h07(spark, sf):
    x = calendar.augment_timeseries_signature(padded_daily(spark, sf), features=("month_lbl", "wday_lbl"))
    x = calendar.one_hot(x, "ds_month_lbl", MONTHS, drop_first=True)
    x = calendar.one_hot(x, "ds_wday_lbl", DAYS, drop_first=True)
    return x.drop("ds_month_lbl", "ds_wday_lbl")


@register("H08_interactions", P + """
select unique_id, ds, y, isodow(ds)::int as ds_wday, ((day(ds) - 1) // 7 + 1 = 2)::int as ds_mweek_2,
       (isodow(ds)::int * ((day(ds) - 1) // 7 + 1 = 2)::int) as inter_ds_wday__ds_mweek_2 from p""", ids=("H08",))
def h08(spark, sf):
    x = calendar.augment_timeseries_signature(padded_daily(spark, sf), features=("wday", "mweek"))
    x = x.withColumn("ds_mweek_2", (F.col("ds_mweek") == 2).cast("int")).drop("ds_mweek")
    return calendar.interactions(x, [("ds_wday", "ds_mweek_2")])


@register("H09_wavelet_features", None, ids=("H09",))
def h09(spark, sf):
    from chronoweave.operators import windows
    return windows.augment_wavelet(padded_daily(spark, sf), Y, (2, 4, 8), freq="D", digits=6)
