"""Queries for control-chart detectors (J07) and LOESS decomposition."""

from chronoweave.operators import anomaly, detectors, smoothing, stl
from chronoweave.panel import Y
from chronoweave.plans.catalog_models import H, holdout, padded_daily, r6
from chronoweave.plans.registry import register
from chronoweave.plans.sqlpanels import ORDERS_DAILY, padded

ROWS = f"""with recursive x as (
  select unique_id, ds, y, row_number() over (partition by unique_id order by ds) as t,
         floor(0.15 * least(count(*) over (partition by unique_id), 5000)) as n from ({padded(ORDERS_DAILY)})),"""

PEWMA = ROWS + """
r as (
  select unique_id, ds, y, t, n, y as m0, 0.0::double as s0, 0 as f, y as m, 0.0::double as v from x where t = 1
  union all
  select unique_id, ds, y, t, n, m, sqrt(v), (t > n and abs(d) > 3 * sqrt(v))::int, m + (1 - a) * d, a * (v + (1 - a) * d * d) from (
    select x.*, r.m, r.v, x.y - r.m as d,
           case when x.t <= x.n then 1 - 1 / x.t::double
                else 0.8 * (1 - 0.3 * exp(-case when r.v > 0 then (x.y - r.m) ** 2 / r.v else 0 end / 2) / sqrt(2 * pi())) end as a
    from r join x on x.unique_id = r.unique_id and x.t = r.t + 1))
select unique_id, ds, y, round(m0, 6) as pewma_mean, round(s0, 6) as pewma_sd, f as anomaly_pewma from r"""

SD_EWMA = ROWS + """
z0 as (select unique_id, avg(y) as z from x where t <= n group by 1),
g as (select unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])::double as lam),
tr as (
  select unique_id, 0::bigint as t, lam, z, 0.0::double as sse from z0 cross join g
  union all
  select tr.unique_id, x.t, lam, z + lam * (x.y - z), sse + (x.y - z) ** 2 from tr join x on x.unique_id = tr.unique_id and x.t = tr.t + 1 and x.t <= x.n),
fit as (select unique_id, arg_min(lam, (sse, lam)) as lam, min(sse) / any_value(t) as s
        from (select tr.* from tr join (select unique_id, any_value(n) as n from x group by 1) e on tr.unique_id = e.unique_id and tr.t = e.n) group by 1),
r as (
  select f.unique_id, 0::bigint as t, lam, 0.0::double as zp, 0.0::double as sp, 0 as f, z0.z, f.s as v from fit f join z0 using (unique_id)
  union all
  select x.unique_id, x.t, lam, r.z, sqrt(r.v), (x.t > x.n and abs(x.y - r.z) > 3 * sqrt(r.v))::int, r.z + lam * (x.y - r.z),
         0.1 * (x.y - r.z) * (x.y - r.z) + (1 - 0.1) * r.v from r join x on x.unique_id = r.unique_id and x.t = r.t + 1),
w as (select unique_id, ds, y, t, min(y) over a as lo_a, max(y) over a as hi_a, min(y) over b as lo_b, max(y) over b as hi_b, count(*) over a as na, count(*) over b as nb
      from x window b as (partition by unique_id order by t rows between 5 preceding and 1 preceding),
                    a as (partition by unique_id order by t rows between current row and 4 following))
-- of at most five against five values only fully separated ones, three or more on the shorter side, reach the 5 % level
select unique_id, ds, y, lam as ewma_lambda, round(zp, 6) as ewma_mean, round(sp, 6) as ewma_sd, f as anomaly_sd,
       (f = 1 and (lo_a > hi_b or hi_a < lo_b) and least(na, nb) >= 3)::int as anomaly_two_stage
from r join w using (unique_id, t)"""


@register("J07_probabilistic_ewma", PEWMA, ids=("J07",))
def j07p(spark, sf):
    return detectors.probabilistic_ewma(padded_daily(spark, sf), Y)


@register("J07_two_stage_sd_ewma", SD_EWMA, ids=("J07",))
def j07t(spark, sf):
    return detectors.sd_ewma(padded_daily(spark, sf), Y)


@register("I05_stl_decomposition", None, ids=("I05",))
def i05(spark, sf):
    return stl.stl(padded_daily(spark, sf), Y, 7, 7, inner=2, outer=2, freq="D")


@register("J02_anomaly_diagnostics_stl", None, ids=("J02",))
def j02(spark, sf):
    return anomaly.anomalize(padded_daily(spark, sf), Y, 7, iqr_alpha=0.05, max_anomalies=0.2, method="stl", freq="D")


@register("J03_ts_clean_stl", None, ids=("J03", "J05"))
def j03(spark, sf):
    return anomaly.ts_clean(padded_daily(spark, sf), Y, 7, 3.0, freq="D", method="stl")


@register("M18_mstl_loess_forecast", None, ids=("M18",))
def m18(spark, sf):
    tr, _ = holdout(spark, sf)
    return r6(smoothing.mstl_forecast(tr, H, (7, 30), None, method="loess", name="MSTLLoess"))
