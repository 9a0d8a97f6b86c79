"""Queries for the streaming extensions (T01-T03).  Each runs its stream over the
available files (``availableNow``); window queries add the windows still open at the end."""

from chronoweave.plans.registry import register
from chronoweave.plans.sqlpanels import EVENTS_HOURLY
from chronoweave.streaming import hourly


@register("T01_stream_hourly_counts", """
select event_type as unique_id, date_trunc('hour', ts) as ds, date_trunc('hour', ts) + interval 1 hour as ds_end,
       count(*)::double as y, round(sum(value), 6) as v from events group by 1, 2, 3""", ids=("T01", "D01"))
def t01(spark, sf):
    return hourly.all_windows(spark, sf, "1 hour")


@register("T02_stream_sliding_windows", """
with s as (select event_type, ts, value, unnest([date_trunc('hour', ts) - interval 1 hour, date_trunc('hour', ts)]) as ws from events)
select event_type as unique_id, ws as ds, ws + interval 2 hour as ds_end, count(*)::double as y, round(sum(value), 6) as v
from s group by 1, 2""", ids=("T02", "D07"))
def t02(spark, sf):
    return hourly.all_windows(spark, sf, "2 hours", "1 hour")


@register("T03_stream_ewma_detector", None, ids=("T03", "J07"))
def t03(spark, sf):
    return hourly.run_to_table(hourly.ewma_flags(hourly.events_stream(spark, sf)))
