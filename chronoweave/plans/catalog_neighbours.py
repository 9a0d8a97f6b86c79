"""Queries for neighbour methods: anomaly scores (J08) and regression."""

from pyspark.sql import functions as F

from chronoweave.operators import knn, neighbours, windows
from chronoweave.operators.splits import time_series_split
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.catalog_models import H, padded_daily, r6
from chronoweave.plans.registry import register
from chronoweave.plans.sqlpanels import ORDERS_DAILY, cte, padded
from chronoweave.sources import panels

GAPS = cte(d=f"select unique_id, ds, rev as y from ({ORDERS_DAILY})") + """,
r as (select *, row_number() over (partition by unique_id order by y, ds) as i, count(*) over (partition by unique_id) as n,
        max(y) over (partition by unique_id) - min(y) over (partition by unique_id) as width from d),
nb as (select a.unique_id, a.i, abs(b.y - a.y) as dist, a.n,
         row_number() over (partition by a.unique_id, a.i order by abs(b.y - a.y)) as j
       from r a join r b on a.unique_id = b.unique_id and a.i <> b.i
         and b.i between a.i - least(a.n - 1, greatest(1, floor(0.1 * a.n))) and a.i + least(a.n - 1, greatest(1, floor(0.1 * a.n)))),
st as (select unique_id, i, dist, j, dist - coalesce(lag(dist) over (partition by unique_id, i order by j), 0) as step
       from nb where j <= least(n - 1, greatest(1, floor(0.1 * n)))),
sc as (select unique_id, i, arg_max(dist, (step, -j)) as s from st group by 1, 2),
x as (select r.unique_id, r.ds, r.y, r.n, coalesce(case when width > 0 then s / width else s end, 0) as s,
        greatest(least(floor(0.15 * least(n, 5000)), floor(n / 4)), 2) as tail from r left join sc using (unique_id, i)),
o as (select *, row_number() over w as p, s - coalesce(lag(s) over w, s) as gap, lag(s) over w as below from x window w as (partition by unique_id order by s, ds)),
g as (select a.unique_id, a.p, sum((a.p - b.p + 1) / (a.tail - 1) * b.gap) as mean
      from o a join o b on a.unique_id = b.unique_id and b.p between a.p - a.tail + 1 and a.p - 1 group by 1, 2),
t as (select o.unique_id, min(o.below) as bound from o left join g using (unique_id, p)
      where p >= greatest(floor(n * 0.95), 1) + 1 and gap > ln(20) * coalesce(mean, 0) group by 1)
select unique_id, ds, y, round(s, 9) as nn_score, coalesce(s > bound, false)::int as anomaly_nn from x left join t using (unique_id)"""


@register("J08_neighbour_gaps", GAPS, ids=("J08",))
def j08(spark, sf):
    d = panels.orders_daily(spark, sf).select(ID, DS, F.col("rev").alias(Y))
    return neighbours.neighbour_gaps(d, Y, share=0.1, alpha=0.05, p=0.05, digits=9)


@register("J08_conformal_neighbours", None, ids=("J08",))
def j08c(spark, sf):
    return neighbours.conformal_neighbours(padded_daily(spark, sf), Y, share=0.1, lags=19, threshold=0.95, digits=6)


LAGS = (56, 63, 70, 77)
KNN = cte(p=padded(ORDERS_DAILY)) + f""",
f as (select *, {", ".join(f"lag(y, {k}) over (partition by unique_id order by ds) as l{k}" for k in LAGS)},
        isodow(ds) as wd, max(ds) over (partition by unique_id) - interval {H} day as cut from p),
tr as (select * from f where ds <= cut and l{LAGS[-1]} is not null),
te as (select * from f where ds > cut),
d as (select te.unique_id, te.ds, tr.y, row_number() over (partition by te.unique_id, te.ds order by
        {" + ".join(f"(te.l{k} - tr.l{k}) ** 2" for k in LAGS)} + (te.wd - tr.wd) ** 2, tr.unique_id, tr.ds) as j from te cross join tr)
select unique_id, ds, 'KNN' || k as model, round(avg(y), 6) as y_hat from d cross join (select unnest([15, 50]) as k) where j <= k group by 1, 2, 3"""


@register("N07_knn_regression", KNN, ids=("N07",))
def n07(spark, sf):
    x = windows.augment_lags(padded_daily(spark, sf), Y, LAGS, freq="D").withColumn("wd", F.weekday(DS) + 1)
    s = time_series_split(x, H, "D")
    feats = [*[f"{Y}_lag_{k}" for k in LAGS], "wd"]
    return r6(knn.knn_regression(s.where("set = 'train'"), s.where("set = 'test'"), feats, ks=(15, 50)))
