"""US federal holiday calendar (H03), generated per year from fixed-date and
n-th-weekday rules; a fixed-date holiday falling on a weekend adds an observed day
(Saturday -> Friday, Sunday -> Monday).

The table has at most a dozen rows per year of the data's span, so it is broadcast
(its size is bounded by the year range, not by the data)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rule set (name, month, day-of-month or (weekday Mon=1, nth; -1 = last), first year).
FIXED_DATE_HOLIDAYS = [
    ("New Year's Day", 1, 1, 1871),
    ("Juneteenth National Independence Day", 6, 19, 2021),
    ("Independence Day", 7, 4, 1871),
    ("Veterans Day", 11, 11, 1938),
    ("Christmas Day", 12, 25, 1871),
]
WEEKDAY_HOLIDAYS = [
    ("Martin Luther King Jr. Day", 1, 1, 3, 1986),
    ("Washington's Birthday", 2, 1, 3, 1971),
    ("Memorial Day", 5, 1, -1, 1971),
    ("Labor Day", 9, 1, 1, 1894),
    ("Columbus Day", 10, 1, 2, 1971),
    ("Thanksgiving", 11, 4, 4, 1942),
]


def _dow(d: Column) -> Column:
    return F.weekday(d) + 1  # Monday = 1


def _nth_weekday(year: Column, month: int, wd: int, nth: int) -> Column:
    if nth > 0:
        first = F.make_date(year, F.lit(month), F.lit(1))
        return F.date_add(first, (F.pmod(F.lit(wd) - _dow(first), F.lit(7)) + 7 * (nth - 1)).cast("int"))
    last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    return F.date_sub(last, F.pmod(_dow(last) - F.lit(wd), F.lit(7)).cast("int"))


def holiday_table(years: DataFrame) -> DataFrame:
    """``(holiday_date date, holiday_name string)`` for every year in ``years(year int)``:
    one projection of all rules per year, exploded (a single narrow stage)."""
    yr = F.col("year")
    items = []
    for name, m, d, since in FIXED_DATE_HOLIDAYS:
        day = F.make_date(yr, F.lit(m), F.lit(d))
        obs = F.when(_dow(day) == 6, F.date_sub(day, 1)).when(_dow(day) == 7, F.date_add(day, 1))
        items.append(F.struct(F.when(yr >= since, day).alias("holiday_date"), F.lit(name).alias("holiday_name")))
        items.append(F.struct(F.when(yr >= since, obs).alias("holiday_date"), F.lit(name + " (observed)").alias("holiday_name")))
    for name, m, wd, nth, since in WEEKDAY_HOLIDAYS:
        items.append(F.struct(F.when(yr >= since, _nth_weekday(yr, m, wd, nth)).alias("holiday_date"),
                              F.lit(name).alias("holiday_name")))
    return years.select(F.inline(F.array(*items))).where(F.col("holiday_date").isNotNull())


def augment_holiday_signature(df: DataFrame, time_col: str = "ds") -> DataFrame:
    """``is_holiday``, ``before_holiday``, ``after_holiday``, ``holiday_name``.

    The calendar covers the years that occur in the data and their neighbours: at most a
    dozen rows for each distinct year, so it is broadcast whatever the data size."""
    d = F.to_date(F.col(time_col))
    yrs = df.select(F.explode(F.array(F.year(d) - 1, F.year(d), F.year(d) + 1)).alias("year")).where("year is not null").distinct()
    hol = holiday_table(yrs)
    # one small table: each holiday marks its own day, the day before and the day after
    marks = hol.select(F.explode(F.array(
        F.struct(F.col("holiday_date").alias("_d"), F.col("holiday_name").alias("n"), F.lit(0).alias("b"), F.lit(0).alias("a")),
        F.struct(F.date_sub("holiday_date", 1).alias("_d"), F.lit(None).cast("string").alias("n"), F.lit(1).alias("b"), F.lit(0).alias("a")),
        F.struct(F.date_add("holiday_date", 1).alias("_d"), F.lit(None).cast("string").alias("n"), F.lit(0).alias("b"), F.lit(1).alias("a")),
    )).alias("m")).select("m.*")
    flags = marks.groupBy("_d").agg(
        F.array_join(F.array_sort(F.collect_set("n")), ", ").alias("holiday_name"),
        F.max("b").alias("before_holiday"), F.max("a").alias("after_holiday"))
    flags = flags.withColumn("holiday_name", F.when(F.col("holiday_name") != "", F.col("holiday_name")))
    x = df.withColumn("_d", d).join(F.broadcast(flags), "_d", "left")
    return (x.withColumn("is_holiday", F.col("holiday_name").isNotNull().cast("int"))
             .withColumn("before_holiday", F.coalesce("before_holiday", F.lit(0)))
             .withColumn("after_holiday", F.coalesce("after_holiday", F.lit(0)))
             .drop("_d"))
