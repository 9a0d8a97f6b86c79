"""Time arithmetic on ``timestamp_ntz`` keys, expressed as built-in Spark functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronoweave.panel import _split_freq

_UNIT = {"S": ("SECOND", 1), "min": ("MINUTE", 1), "H": ("HOUR", 1), "D": ("DAY", 1),
         "W": ("DAY", 7), "M": ("MONTH", 1), "Q": ("MONTH", 3), "Y": ("MONTH", 12)}


def add_steps(ts: Column, k: Column | int, freq: str = "D") -> Column:
    """``ts + k * freq`` (month-safe: month arithmetic clamps to month end)."""
    n, unit = _split_freq(freq)
    u, mult = _UNIT[unit]
    k = k if isinstance(k, Column) else F.lit(k)
    return F.timestamp_add(u, (k * (n * mult)).cast("long"), ts).cast("timestamp_ntz")


def steps_between(start: Column, end: Column, freq: str = "D") -> Column:
    """Whole ``freq`` steps from ``start`` to ``end`` (negative if end < start)."""
    n, unit = _split_freq(freq)
    u, mult = _UNIT[unit]
    d = F.timestamp_diff(u, start, end)
    return (d / F.lit(n * mult)).cast("long") if n * mult != 1 else d


_PARTIAL = re.compile(r"^(\d{4})(?:-(\d{1,2}))?(?:-(\d{1,2}))?(?:[ T](\d{1,2})(?::(\d{1,2}))?(?::(\d{1,2}))?)?$")


def expand_bound(text: str, end: bool) -> str:
    """Expand a partial time bound the way ``filter_by_time`` reads it.

    ``"2019"`` starts at 2019-01-01 00:00:00; as an *end* bound it covers the whole year,
    so the returned value is the first instant *after* it (used with ``<``).
    """
    m = _PARTIAL.match(text.strip())
    if not m:
        raise ValueError(f"cannot read time bound {text!r}")
    y, mo, d, h, mi, s = m.groups()
    parts = [int(y), int(mo or 1), int(d or 1), int(h or 0), int(mi or 0), int(s or 0)]
    if end:
        # bump the least significant given field by one unit
        given = sum(v is not None for v in (y, mo, d, h, mi, s))
        import datetime as _dt
        base = _dt.datetime(*parts)
        if given == 1:
            nxt = base.replace(year=base.year + 1)
        elif given == 2:
            nxt = base.replace(year=base.year + (base.month == 12), month=base.month % 12 + 1)
        elif given == 3:
            nxt = base + _dt.timedelta(days=1)
        elif given == 4:
            nxt = base + _dt.timedelta(hours=1)
        elif given == 5:
            nxt = base + _dt.timedelta(minutes=1)
        else:
            nxt = base + _dt.timedelta(seconds=1)
        return nxt.strftime("%Y-%m-%d %H:%M:%S")
    return "%04d-%02d-%02d %02d:%02d:%02d" % tuple(parts)


def ts_lit(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


_OFFSET = re.compile(r"^\s*(-?\d+)\s*(second|minute|hour|day|week|month|quarter|year)s?\s*$")


def add_offset(ts: Column, text: str) -> Column:
    """``ts %+time% "4 weeks"``: add a textual offset; months/quarters/years are month-safe."""
    m = _OFFSET.match(text.lower())
    if not m:
        raise ValueError(f"cannot read offset {text!r}")
    k, unit = int(m.group(1)), m.group(2)
    table = {"second": ("SECOND", 1), "minute": ("MINUTE", 1), "hour": ("HOUR", 1), "day": ("DAY", 1),
             "week": ("DAY", 7), "month": ("MONTH", 1), "quarter": ("MONTH", 3), "year": ("MONTH", 12)}
    u, mult = table[unit]
    return F.timestamp_add(u, F.lit(k * mult), ts).cast("timestamp_ntz")
