"""Calendar signature (H01), user date features (H02), one-hot and interactions.

All features are plain column expressions (codegen, no UDF).  ``wday`` is Monday=1 ..
Sunday=7 (Spark's ``dayofweek`` is Sunday=1, so it is not used).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIGNATURE = ("index_num", "year", "year_iso", "yearstart", "yearend", "leapyear", "half", "quarter",
             "quarteryear", "quarterstart", "quarterend", "month", "month_lbl", "monthstart", "monthend",
             "yweek", "mweek", "wday", "wday_lbl", "mday", "qday", "yday", "weekend", "hour", "minute",
             "second", "msecond", "nsecond", "am_pm")


#: one-hot columns are driver-side expressions; a column with more levels is refused
MAX_LEVELS = 1000


def _flag(c: Column) -> Column:
    return c.cast("int")


def _wday(d: Column) -> Column:
    return F.weekday(d) + 1


def _quarter_start(d: Column) -> Column:
    return F.make_date(F.year(d), (F.quarter(d) - 1) * 3 + 1, F.lit(1))


# feature -> function of (time, date); only the feature that is asked for is built
FEATURES: dict[str, Callable[[Column, Column], Column]] = {
    "index_num": lambda t, d: F.unix_seconds(t.cast("timestamp_ntz").cast("timestamp")),
    "year": lambda t, d: F.year(d),
    "year_iso": lambda t, d: F.extract(F.lit("YEAROFWEEK"), d),
    "yearstart": lambda t, d: _flag((F.month(d) == 1) & (F.dayofmonth(d) == 1)),
    "yearend": lambda t, d: _flag((F.month(d) == 12) & (F.dayofmonth(d) == 31)),
    "leapyear": lambda t, d: _flag(F.dayofyear(F.make_date(F.year(d), F.lit(12), F.lit(31))) == 366),
    "half": lambda t, d: F.when(F.month(d) <= 6, 1).otherwise(2),
    "quarter": lambda t, d: F.quarter(d),
    "quarteryear": lambda t, d: F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string")),
    "quarterstart": lambda t, d: _flag(d == _quarter_start(d)),
    "quarterend": lambda t, d: _flag(d == F.date_sub(F.add_months(_quarter_start(d), 3), 1)),
    "month": lambda t, d: F.month(d),
    "month_lbl": lambda t, d: F.date_format(d, "MMMM"),
    "monthstart": lambda t, d: _flag(F.dayofmonth(d) == 1),
    "monthend": lambda t, d: _flag(d == F.last_day(d)),
    "yweek": lambda t, d: F.weekofyear(d),
    "mweek": lambda t, d: F.floor((F.dayofmonth(d) - 1) / 7).cast("int") + 1,
    "wday": lambda t, d: _wday(d),
    "wday_lbl": lambda t, d: F.date_format(d, "EEEE"),
    "mday": lambda t, d: F.dayofmonth(d),
    "qday": lambda t, d: F.datediff(d, _quarter_start(d)) + 1,
    "yday": lambda t, d: F.dayofyear(d),
    "weekend": lambda t, d: _flag(_wday(d) >= 6),
    "week": lambda t, d: F.weekofyear(d),
    "hour": lambda t, d: F.hour(t),
    "minute": lambda t, d: F.minute(t),
    "second": lambda t, d: F.second(t),
    "msecond": lambda t, d: F.date_format(t, "SSS").cast("int"),
    "nsecond": lambda t, d: F.date_format(t, "SSSSSS").cast("int") * 1000,
    "am_pm": lambda t, d: F.when(F.hour(t) < 12, "am").otherwise("pm"),
}


def calendar_column(ds: Column, name: str) -> Column:
    if name not in FEATURES:
        raise ValueError(f"unknown calendar feature {name}")
    return FEATURES[name](ds, F.to_date(ds))


def augment_timeseries_signature(df: DataFrame, time_col: str = "ds", features: Sequence[str] = SIGNATURE,
                                 prefix: str | None = None) -> DataFrame:
    """Add ``<prefix>_<feature>`` calendar columns (prefix defaults to the time column)."""
    p = prefix or time_col
    return df.withColumns({f"{p}_{f}": calendar_column(F.col(time_col), f) for f in features})


def is_weekend(ds: Column) -> Column:
    """H02 / U06 example user feature."""
    return _flag(F.weekday(ds) >= 5)


def one_hot(df: DataFrame, col: str, levels: Sequence[str] | None = None, drop_first: bool = True,
            prefix: str | None = None) -> DataFrame:
    """0/1 indicator per level (sorted); ``drop_first`` drops the first level.

    Without ``levels`` the distinct levels are read first; they become columns, so more
    than ``MAX_LEVELS`` of them are an error."""
    if levels is None:
        levels = [r[0] for r in df.select(col).distinct().limit(MAX_LEVELS + 1).collect()]
        if len(levels) > MAX_LEVELS:
            raise ValueError(f"{col} has more than {MAX_LEVELS} levels; pass levels")
        levels = [x for x in levels if x is not None]
    levels = sorted(str(x) for x in levels)
    if drop_first:
        levels = levels[1:]
    p = prefix or col
    return df.withColumns({f"{p}_{lv}": (F.col(col).cast("string") == F.lit(lv)).cast("int") for lv in levels})


def interactions(df: DataFrame, pairs: Sequence[tuple[str, str]], prefix: str = "inter") -> DataFrame:
    """Products of column pairs named ``<prefix>_<a>__<b>``."""
    return df.withColumns({f"{prefix}_{a}__{b}": F.col(a) * F.col(b) for a, b in pairs})
