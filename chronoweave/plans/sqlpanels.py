"""DuckDB texts of the panel adapters in :mod:`chronoweave.sources.panels`.

They are building blocks of the oracle queries, written independently of the Spark
code path (plain SQL over the pre-registered table views).
"""

ORDERS_DAILY = """
select o_orderpriority as unique_id, date_trunc('day', o_orderdate) as ds,
       count(*)::double as y, sum(o_totalprice) as rev
from orders group by 1, 2"""

SHIP_DAILY = """
select l_returnflag || l_linestatus as unique_id, date_trunc('day', l_shipdate) as ds,
       sum(l_quantity) as y
from lineitem group by 1, 2"""

EVENTS_HOURLY = """
select event_type as unique_id, date_trunc('hour', ts) as ds, count(*)::double as y, avg(value) as v
from events group by 1, 2"""

EVENTS_DAILY = """
select event_type as unique_id, date_trunc('day', ts) as ds, count(*)::double as y, sum(value) as v
from events group by 1, 2"""

NATION_MONTHLY = """
select n_name as unique_id, date_trunc('month', o_orderdate) as ds, sum(o_totalprice) as y, count(*) as n_orders
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
group by 1, 2"""

CUSTOMER_MONTHLY = """
select cast(o_custkey as varchar) as unique_id, date_trunc('month', o_orderdate) as ds, count(*)::double as y
from orders group by 1, 2"""

EVENT_CALENDAR = """
select distinct date_trunc('day', ts) as ds, 1 as event
from events
where event_type = 'signup'
  and value > (select quantile_cont(value, 0.99) from events where event_type = 'signup')"""


def padded(panel_sql: str, step: str = "1 day", fill: str = "0", cols: str = "y") -> str:
    """Per-series regular grid from first to last time, left-joined to the panel."""
    fills = ", ".join(f"coalesce(d.{c}, {fill}) as {c}" for c in cols.split(","))
    return f"""
select g.unique_id, g.ds, {fills}
from (select unique_id, unnest(generate_series(min(ds), max(ds), interval '{step}')) as ds
      from ({panel_sql}) s group by unique_id) g
left join ({panel_sql}) d using (unique_id, ds)"""


def cte(**parts: str) -> str:
    return "with " + ",\n".join(f"{k} as ({v})" for k, v in parts.items())
