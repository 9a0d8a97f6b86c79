"""Queries for value transforms."""

from pyspark.sql import functions as F

from chronoweave.functions import transforms as tf
from chronoweave.operators import timegrid
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.registry import register
from chronoweave.plans.sqlpanels import ORDERS_DAILY, cte, padded
from chronoweave.sources import panels

P = cte(p=padded(ORDERS_DAILY))


def padded_daily(spark, sf):
    return timegrid.pad_by_time(panels.orders_daily(spark, sf).select(ID, DS, Y), "D", fill={Y: 0.0})


def r6(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@register("E01_log_transforms", P + """
select unique_id, ds, y, round(case when y > 0 then ln(y) end, 6) as log_y, round(ln(1 + y), 6) as log1p_y,
       round(exp(ln(1 + y)) - 1, 6) as y_roundtrip from p""", ids=("E01",))
def e01(spark, sf):
    p = padded_daily(spark, sf)
    x = p.withColumns({"log_y": tf.safe_log(F.col(Y)), "log1p_y": tf.safe_log1p(F.col(Y))})
    x = x.withColumn("y_roundtrip", F.expm1("log1p_y"))
    return r6(x, "log_y", "log1p_y", "y_roundtrip")


@register("E02_boxcox_fixed_lambda", P + """
select unique_id, ds, y, round((pow(y + 1, 0.5) - 1) / 0.5, 6) as y_bc,
       round(pow(((pow(y + 1, 0.5) - 1) / 0.5) * 0.5 + 1, 2) - 1, 6) as y_back from p""", ids=("E02",))
def e02(spark, sf):
    x = padded_daily(spark, sf).withColumn("y_bc", tf.boxcox(F.col(Y), 0.5))
    x = x.withColumn("y_back", tf.inv_boxcox(F.col("y_bc"), 0.5))
    return r6(x, "y_bc", "y_back")


_GRID = ", ".join(f"({lam}::double)" for lam in tf.LAMBDA_GRID)


@register("E02_boxcox_auto_lambda", P + f""",
g(lam) as (values {_GRID}),
z as (select unique_id, lam, case when lam = 0 then ln(y + 1) else (pow(y + 1, lam) - 1) / lam end as z, ln(y + 1) as l
      from p, g),
s as (select unique_id, lam, count(*) as n, sum(l) as sl, var_pop(z) as v from z group by 1, 2)
select unique_id, arg_max(lam, -n / 2 * ln(v) + (lam - 1) * sl) as lambda from s group by 1""", ids=("E02",))
def e02a(spark, sf):
    return tf.boxcox_lambda(padded_daily(spark, sf))


@register("E03_min_max", P + """
select p.unique_id, ds, round((y - mn) / (mx - mn), 6) as y
from p join (select unique_id, min(y) mn, max(y) mx from p group by 1) s using (unique_id)""", ids=("E03",))
def e03(spark, sf):
    x, _ = tf.min_max(padded_daily(spark, sf))
    return r6(x, Y)


@register("E04_standardize_population", P + """
select p.unique_id, ds, round((y - m) / s, 6) as y
from p join (select unique_id, avg(y) m, stddev_pop(y) s from p group by 1) t using (unique_id)""", ids=("E04", "E08"))
def e04(spark, sf):
    x, _ = tf.standardize(padded_daily(spark, sf))
    return r6(x, Y)


@register("E04_standardize_global_sample", P + """
select unique_id, ds, round((y - (select avg(y) from p)) / (select stddev_samp(y) from p), 6) as y from p""",
          ids=("E04", "E08"))
def e04g(spark, sf):
    x, _ = tf.standardize(padded_daily(spark, sf), by=(), ddof=1)
    return r6(x, Y)


@register("E05_log_interval_params", P + """
select unique_id, 0.0 as lower_bound, round(max(y) * 1.10, 6) as upper_bound, 1.0 as offset from p group by 1""",
          ids=("E05",))
def e05p(spark, sf):
    _, params = tf.log_interval(padded_daily(spark, sf))
    return r6(params, "upper_bound")


@register("E05_log_interval", P + """
select p.unique_id, ds, round(case when (y + 1) / (ub - (y + 1)) > 0 then ln((y + 1) / (ub - (y + 1))) end, 6) as y
from p join (select unique_id, max(y) * 1.10 as ub from p group by 1) b using (unique_id)""", ids=("E05",))
def e05(spark, sf):
    x, _ = tf.log_interval(padded_daily(spark, sf))
    return r6(x, Y)


@register("E06_deseasonalize_weekday", P + """
select p.unique_id, p.ds, p.y, round(p.y - m.pm, 6) as y_deseason
from p join (select unique_id, isodow(ds) as ph, avg(y) as pm from p group by 1, 2) m
  on p.unique_id = m.unique_id and isodow(p.ds) = m.ph""", ids=("E06",))
def e06(spark, sf):
    return r6(tf.deseasonalize(padded_daily(spark, sf)), "y_deseason")


@register("E07_back_transform_roundtrip", P + """,
b as (select unique_id, max(y) * 1.10 as ub from p group by 1),
li as (select p.unique_id, p.ds, p.y as y0, case when (p.y + 1) / (b.ub - (p.y + 1)) > 0 then ln((p.y + 1) / (b.ub - (p.y + 1))) end as y1, b.ub
           from p join b using (unique_id)),
st as (select unique_id, avg(y1) m, stddev_pop(y1) s from li group by 1),
z as (select li.*, (y1 - m) / s as y2, m, s from li join st using (unique_id))
select unique_id, ds, round(y2, 6) as y_transformed,
       round(ub * exp(y2 * s + m) / (1 + exp(y2 * s + m)) - 1, 6) as y_back from z""", ids=("E07", "E05", "E04"))
def e07(spark, sf):
    p = padded_daily(spark, sf)
    li, lp = tf.log_interval(p)
    st, sp = tf.standardize(li)
    back = tf.back_transform(st.withColumn("y_back", F.col(Y)), ["y_back"], sp, lp)
    return r6(back.withColumnRenamed(Y, "y_transformed").select(ID, DS, "y_transformed", "y_back"), "y_transformed", "y_back")


@register("E10_normalize_train_only", P + """,
tr as (select * from p where ds < timestamp '2000-01-01')
select unique_id, ds, round((y - (select avg(y) from tr)) / (select stddev_samp(y) from tr), 6) as y from p""",
          ids=("E10", "E09"))
def e10(spark, sf):
    p = padded_daily(spark, sf)
    x = tf.normalize_features(p, [Y], p.where(F.col(DS) < F.lit("2000-01-01").cast("timestamp_ntz")))
    return r6(x, Y)
