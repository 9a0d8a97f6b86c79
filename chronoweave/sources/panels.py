"""Adapters from the star-schema test tables to canonical panels.

Each adapter is one ``groupBy`` on ``(series key, time bucket)``: a hash aggregate with a
map-side partial step, so a hot series key (say a third of all orders) is pre-reduced in
every task before the shuffle and never lands whole in one task.

The matching DuckDB text for each adapter lives in :mod:`chronoweave.plans.sqlpanels`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.functions.aggs import global_quantiles

from chronoweave.panel import DS, ID, Y, as_ntz
from chronoweave.sources.tables import read_table


def day(c):
    return as_ntz(F.to_date(c))


def orders_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id = order priority, ds = order day, y = number of orders, rev = revenue."""
    o = read_table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderpriority").alias(ID), day(F.col("o_orderdate")).alias(DS))
             .agg(F.count(F.lit(1)).cast("double").alias(Y), F.sum("o_totalprice").alias("rev")))


def ship_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id = returnflag||linestatus, ds = ship day, y = shipped quantity."""
    li = read_table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.concat("l_returnflag", "l_linestatus").alias(ID), day(F.col("l_shipdate")).alias(DS))
              .agg(F.sum("l_quantity").alias(Y)))


def events_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id = event type, ds = hour, y = number of events, v = mean event value."""
    e = read_table(spark, sf_dir, "events")
    return (e.groupBy(F.col("event_type").alias(ID), as_ntz(F.date_trunc("hour", "ts")).alias(DS))
             .agg(F.count(F.lit(1)).cast("double").alias(Y), F.avg("value").alias("v")))


def events_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return (e.groupBy(F.col("event_type").alias(ID), day(F.col("ts")).alias(DS))
             .agg(F.count(F.lit(1)).cast("double").alias(Y), F.sum("value").alias("v")))


def nation_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id = customer nation name, ds = order month, y = revenue."""
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return (j.groupBy(F.col("n_name").alias(ID), as_ntz(F.date_trunc("month", "o_orderdate")).alias(DS))
             .agg(F.sum("o_totalprice").alias(Y), F.count(F.lit(1)).alias("n_orders")))


def customer_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id = customer key (as string), ds = order month, y = orders (sparse, intermittent)."""
    o = read_table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_custkey").cast("string").alias(ID), as_ntz(F.date_trunc("month", "o_orderdate")).alias(DS))
             .agg(F.count(F.lit(1)).cast("double").alias(Y)))


def event_calendar(spark: SparkSession, sf_dir: str, q: float = 0.99) -> DataFrame:
    """Days holding a ``signup`` event whose value exceeds the global q-quantile.

    The threshold is the exact interpolated quantile of all signup values.
    """
    e = read_table(spark, sf_dir, "events").where(F.col("event_type") == "signup")
    thr = F.lit(global_quantiles(e, "value", [q])[0])
    return (e.where(F.col("value") > thr)
             .select(day(F.col("ts")).alias(DS)).distinct().withColumn("event", F.lit(1)))
