"""Queries for dynamic theta models."""

from pyspark.sql import functions as F

from chronoweave.operators import theta
from chronoweave.operators.baselines import YHAT
from chronoweave.panel import Y
from chronoweave.plans.catalog_models import nation_padded
from chronoweave.plans.registry import register
from chronoweave.plans.sqlpanels import NATION_MONTHLY, padded

#: revenue in units of 100,000, so that six digits are well inside double precision
UNIT = 100_000.0


def theta_sql(model: str, w: str) -> str:
    """The state recursion of the model, row by row, for every smoothing constant; ``w`` is 1 - 1/theta."""
    return f"""with recursive
q as (select unique_id, ds, y / {UNIT} as y, row_number() over (partition by unique_id order by ds) as t from ({padded(NATION_MONTHLY, step="1 month")})),
ab as (select unique_id, t, mean, slope, mean - (t + 1) / 2.0 * slope as icept from (
         select unique_id, t, avg(y) over o as mean, case when t = 1 then 0.0 else regr_slope(y, t) over o end as slope
         from q window o as (partition by unique_id order by t rows unbounded preceding))),
g as (select i * 0.05 as a from range(1, 20) r(i)),
lv as (select unique_id, t, y, a::double as a, a::double * y as l from q cross join g where t = 1
       union all select q.unique_id, q.t, q.y, lv.a, lv.a * q.y + (1 - lv.a) * lv.l from lv join q on q.unique_id = lv.unique_id and q.t = lv.t + 1),
e as (select n.unique_id, n.a, n.y - p.l as e, pow(1 - n.a, n.t - 1) as f1, pow(1 - n.a, n.t - 1) * k.icept + (1 - pow(1 - n.a, n.t)) / n.a * k.slope as f2
      from lv n join lv p on p.unique_id = n.unique_id and p.a = n.a and p.t = n.t - 1 join ab k on k.unique_id = n.unique_id and k.t = n.t - 1),
s as (select unique_id, a, sum(e * e) as ee, sum(e * f1) as e1, sum(e * f2) as e2, sum(f1 * f1) as f11, sum(f1 * f2) as f12, sum(f2 * f2) as f22 from e group by 1, 2),
ww as (select *, {w} as w from s),
ll as (select *, (e1 - w * f12) / f11 as l0 from ww),
sse as (select *, ee - 2 * l0 * e1 - 2 * w * e2 + l0 * l0 * f11 + 2 * l0 * w * f12 + w * w * f22 as sse from ll),
best as (select unique_id, arg_min(struct_pack(a := a, l0 := l0, w := w), (sse, a)) as b from sse group by 1),
fin as (select q.unique_id, max(q.t) as n, max(q.ds) as last from q group by 1),
fc as (
  select f.unique_id, f.last, 0::bigint as s, f.n as t, b.a, b.w, lv.l + b.l0 * pow(1 - b.a, f.n) as level, k.mean, k.slope, k.icept, 0.0::double as mu
  from fin f join best using (unique_id) join lv on lv.unique_id = f.unique_id and lv.t = f.n and abs(lv.a - b.a) < 1e-9 join ab k on k.unique_id = f.unique_id and k.t = f.n
  union all
  select unique_id, last, s + 1, t + 1, a, w, a * m + (1 - a) * level, (t * mean + m) / (t + 1), ((t - 1) * slope + 6.0 / (t + 1) * (m - mean)) / (t + 2),
         (t * mean + m) / (t + 1) - (t + 2) / 2.0 * ((t - 1) * slope + 6.0 / (t + 1) * (m - mean)) / (t + 2), m
  from (select *, level + w * (pow(1 - a, t) * icept + (1 - pow(1 - a, t + 1)) / a * slope) as m from fc where s < 6))
select unique_id, last + to_months(s::int) as ds, '{model}' as model, round(mu, 4) as y_hat from fc where s > 0"""


OPTIMIZED = "least(greatest(case when f11 * f22 - f12 * f12 > 1e-12 * f11 * f22 then (f11 * e2 - f12 * e1) / (f11 * f22 - f12 * f12) else 0 end, 0), 0.9999)"


def _run(spark, sf, optimize):
    d = nation_padded(spark, sf).withColumn(Y, F.col(Y) / UNIT)
    return theta.dynamic_theta(d, 6, optimize, freq="M").withColumn(YHAT, F.round(YHAT, 4))


@register("M15_dynamic_theta", theta_sql("DynamicTheta", "0.5"), ids=("M15",))
def m15d(spark, sf):
    return _run(spark, sf, False)


@register("M15_dynamic_optimized_theta", theta_sql("DynamicOptimizedTheta", OPTIMIZED), ids=("M15",))
def m15do(spark, sf):
    return _run(spark, sf, True)


@register("M15_dynamic_theta_seasonal", None, ids=("M15",))
def m15s(spark, sf):
    return theta.dynamic_theta(nation_padded(spark, sf), 12, True, 12, freq="M").withColumn(YHAT, F.round(YHAT, 2))
