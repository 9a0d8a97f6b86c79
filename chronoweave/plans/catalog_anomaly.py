"""Queries for anomaly detection and cleaning."""

from pyspark.sql import functions as F

from chronoweave.operators import anomaly, timegrid
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.catalog_grid import _INTERP
from chronoweave.plans.catalog_models import padded_daily
from chronoweave.plans.registry import register
from chronoweave.plans.sqlpanels import ORDERS_DAILY, cte, padded
from chronoweave.sources import panels

P = cte(p=padded(ORDERS_DAILY))
W = "over (partition by unique_id order by ds)"

FENCE = """,
q as (select unique_id, quantile_cont(remainder, 0.25) as q1, quantile_cont(remainder, 0.75) as q3, count(remainder) as n from d group by 1),
f as (select d.*, q1 - 3.0 * (q3 - q1) as l1, q3 + 3.0 * (q3 - q1) as l2, n from d join q using (unique_id)),
g as (select *, greatest(remainder - l2, l1 - remainder, 0) as dist from f),
r as (select unique_id, ds, row_number() over (partition by unique_id order by dist desc, ds) as rk from g where dist > 0),
a as (select g.*, (dist > 0 and rk <= floor(n * 0.2))::int as anomaly from g left join r using (unique_id, ds))
select unique_id, ds, y, round(trend, 6) as trend, round(season, 6) as season, round(remainder, 6) as remainder,
       round(l1, 6) as remainder_l1, round(l2, 6) as remainder_l2, anomaly,
       round(trend + season + l1, 6) as recomposed_l1, round(trend + season + l2, 6) as recomposed_l2,
       round(case when anomaly = 1 then least(greatest(y, trend + season + l1), trend + season + l2) else y end, 6) as observed_clean
from a"""

TWITTER = P + f""",
t as (select *, row_number() {W} - 1 as pos,
        median(y) over (partition by unique_id order by ds rows between 45 preceding and 45 following) as trend from p),
s as (select unique_id, pos % 7 as ph, quantile_cont(y - trend, 0.5) as season from t group by 1, 2),
d as (select t.*, s.season, y - trend - s.season as remainder from t join s on t.unique_id = s.unique_id and t.pos % 7 = s.ph)"""

CLASSICAL = P + f""",
t as (select *, row_number() {W} - 1 as pos,
        round(case when count(y) over (partition by unique_id order by ds rows between 3 preceding and 3 following) = 7
             then avg(y) over (partition by unique_id order by ds rows between 3 preceding and 3 following) end, 12) as trend from p),
s as (select unique_id, pos % 7 as ph, avg(y - trend) as s from t group by 1, 2),
s2 as (select unique_id, ph, round(s - avg(s) over (partition by unique_id), 12) as season from s),
d as (select t.*, s2.season, round(y - trend - s2.season, 12) as remainder from t join s2 on t.unique_id = s2.unique_id and t.pos % 7 = s2.ph)"""


@register("J01_anomalize", TWITTER + FENCE, ids=("J01",))
def j01(spark, sf):
    return anomaly.anomalize(padded_daily(spark, sf), Y, 7, 91, 0.05, 0.2, "twitter", freq="D")


#: revenue with a narrow fence (factor 1) and a cap of 2 %: flags, the cap and cleaning all take effect
NARROW = (TWITTER + FENCE).replace(padded(ORDERS_DAILY), padded(ORDERS_DAILY.replace("count(*)::double as y, sum(o_totalprice) as rev", "round(sum(o_totalprice) / 1000, 2) as y"))) \
    .replace("3.0 * (q3 - q1)", "1.0 * (q3 - q1)").replace("floor(n * 0.2)", "floor(n * 0.02)")


@register("J01_anomalize_narrow_fence", NARROW, ids=("J01",))
def j01n(spark, sf):
    d = panels.orders_daily(spark, sf).select(ID, DS, F.round(F.col("rev") / 1000, 2).alias(Y))
    return anomaly.anomalize(timegrid.pad_by_time(d, "D", fill={Y: 0.0}), Y, 7, 91, 0.15, 0.02, "twitter", freq="D")


@register("J02_anomaly_diagnostics_classical", CLASSICAL + FENCE, ids=("J02",))
def j02(spark, sf):
    return anomaly.anomalize(padded_daily(spark, sf), Y, 7, 91, 0.05, 0.2, "classical", freq="D")


CLEAN = CLASSICAL + """,
q as (select unique_id, quantile_cont(remainder, 0.25) as q1, quantile_cont(remainder, 0.75) as q3 from d group by 1),
o as (select d.unique_id, d.ds, d.y as orig, coalesce(remainder < q1 - 3.0 * (q3 - q1) or remainder > q3 + 3.0 * (q3 - q1), false)::int as outlier
      from d join q using (unique_id)),
m as (select unique_id, ds, orig, outlier, case when outlier = 1 then null else orig end as v from o),
ph as (select *, (row_number() over (partition by unique_id order by ds) - 1) % 7 as ph from m),
pm as (select unique_id, ph, avg(v) as pm from ph group by 1, 2),
aa as (select ph.unique_id, ph.ds, ph.orig, ph.outlier, ph.v - pm.pm as ya, pm.pm from ph join pm using (unique_id, ph)),""" + \
    _INTERP.format(src="aa", v="ya") + """
select unique_id, ds, orig as y, outlier, {clean} as y_clean from n"""

_FILLED = "round(case when ya is not null then ya when ni is null then pv else pv + (nv - pv) * (idx - pi) / (ni - pi) end + pm, 6)"


@register("J03_ts_clean", CLEAN.format(clean=_FILLED), ids=("J03", "J05", "B15"))
def j03(spark, sf):
    return anomaly.ts_clean(padded_daily(spark, sf), Y, 7, 3.0, freq="D")


@register("J04_targeted_clean", CLEAN.format(
    clean=f"case when ds >= timestamp '1998-01-01' and ds < timestamp '2000-01-01' then {_FILLED} else orig end"), ids=("J04", "B08"))
def j04(spark, sf):
    return anomaly.ts_clean(padded_daily(spark, sf), Y, 7, 3.0, freq="D", within=("1998", "1999"))


@register("J07_sd_ewma_detector", None, ids=("J07",))
def j07(spark, sf):
    return anomaly.ewma_detector(padded_daily(spark, sf), Y, 0.2, 3.0, freq="D")


@register("J09_detector_ensemble", None, ids=("J09", "C11"))
def j09(spark, sf):
    a = anomaly.anomalize(padded_daily(spark, sf), Y, 7, 91, 0.05, 0.2, "twitter", freq="D").select(ID, DS, Y, F.col("anomaly").alias("anomaly_twitter"))
    b = anomaly.ts_clean(padded_daily(spark, sf), Y, 7, 3.0, freq="D").select(ID, DS, F.col("outlier").alias("anomaly_tsoutliers"))
    c = anomaly.ewma_detector(padded_daily(spark, sf), Y, 0.2, 3.0, freq="D").select(ID, DS, "anomaly_ewma")
    flags = a.join(b, [ID, DS]).join(c, [ID, DS])
    return anomaly.ensemble_score(flags, ["anomaly_twitter", "anomaly_tsoutliers", "anomaly_ewma"])
