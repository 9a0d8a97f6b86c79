"""Canonical panel conventions.

A panel is a long table ``unique_id string, ds timestamp_ntz, y double`` plus optional
regressor / feature columns.  ``ds`` is always ``timestamp_ntz`` (midnight for daily and
coarser frequencies) so that every frequency shares one time type and one set of
interval expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID = "unique_id"
DS = "ds"
Y = "y"

# Frequency aliases accepted by the time operators and the Spark interval literal each
# one steps by.  "W" weeks start on Monday, "M"/"Q"/"Y" buckets start on the first day.
FREQ_INTERVAL = {
    "S": "1 second",
    "min": "1 minute",
    "H": "1 hour",
    "D": "1 day",
    "W": "7 days",
    "M": "1 month",
    "Q": "3 months",
    "Y": "1 year",
}

# date_trunc unit per frequency alias
FREQ_TRUNC = {
    "S": "second",
    "min": "minute",
    "H": "hour",
    "D": "day",
    "W": "week",
    "M": "month",
    "Q": "quarter",
    "Y": "year",
}


def freq_interval(freq: str) -> Column:
    """Interval literal for one step of ``freq`` (e.g. ``"D"`` -> ``INTERVAL 1 day``)."""
    n, unit = _split_freq(freq)
    base = FREQ_INTERVAL[unit]
    k, name = base.split(" ")
    return F.expr(f"INTERVAL {int(k) * n} {name}")


def _split_freq(freq: str) -> tuple[int, str]:
    digits = ""
    for ch in freq:
        if ch.isdigit():
            digits += ch
        else:
            break
    unit = freq[len(digits):]
    if unit not in FREQ_INTERVAL:
        raise ValueError(f"unsupported frequency {freq!r}")
    return (int(digits) if digits else 1), unit


def as_ntz(c: Column) -> Column:
    """Cast any date/timestamp column to ``timestamp_ntz``."""
    return c.cast("timestamp_ntz")


def floor_time(c: Column, freq: str) -> Column:
    """Floor a timestamp to the start of its ``freq`` bucket, keeping ``timestamp_ntz``.

    Single-unit frequencies use ``date_trunc`` (Monday weeks).  Multi-unit frequencies
    (``"2W"``, ``"14D"``, ``"6H"``) are aligned to the Unix epoch for sub-week units and
    to 1970-01-05 (a Monday) for weeks, so buckets are deterministic and pushdown-free
    of any data-dependent anchor.
    """
    n, unit = _split_freq(freq)
    if n == 1:
        return as_ntz(F.date_trunc(FREQ_TRUNC[unit], c))
    if unit in ("W", "D"):
        days = n * (7 if unit == "W" else 1)
        anchor = F.lit("1970-01-05" if unit == "W" else "1970-01-01").cast("date")
        d = F.to_date(c)
        k = F.floor(F.datediff(d, anchor) / F.lit(days))
        return as_ntz(F.date_add(anchor, (k * days).cast("int")))
    if unit in ("H", "min", "S"):
        secs = n * {"H": 3600, "min": 60, "S": 1}[unit]
        epoch = F.unix_seconds(c.cast("timestamp_ntz").cast("timestamp"))
        return as_ntz(F.timestamp_seconds(F.floor(epoch / secs) * secs))
    if unit in ("M", "Q", "Y"):
        months = n * {"M": 1, "Q": 3, "Y": 12}[unit]
        m = (F.year(c) - 1970) * 12 + F.month(c) - 1
        k = F.floor(m / months) * months
        return as_ntz(F.make_date((F.floor(k / 12) + 1970).cast("int"), (F.pmod(k, 12) + 1).cast("int"), F.lit(1)))
    raise ValueError(freq)


def require(df: DataFrame, *cols: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
