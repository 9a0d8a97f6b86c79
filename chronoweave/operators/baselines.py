"""Benchmark forecasters (M01-M07) as aggregates over the tail of each training series.

Input: a training panel ``(*keys, ds, y)`` on a regular ``freq`` grid, where ``keys`` is
``[unique_id]`` or ``[unique_id, cutoff]`` for backtests.  Output: a long forecast table
``(*keys, ds, model, y_hat)`` for steps ``1..h`` after each key's last time.  Every model
is one partial aggregate per key (plus a join for seasonal phases), so a hot series is
reduced map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.timekeys import add_steps, steps_between
from chronoweave.panel import DS, ID, Y, freq_interval
from chronoweave.plans.series import _keys

MODEL = "model"
YHAT = "y_hat"
STEP = "step"


def last_times(train: DataFrame, keys: list[str]) -> DataFrame:
    return train.groupBy(*keys).agg(F.max(DS).alias("_T"))


def horizon(base: DataFrame, keys: list[str], h: int, freq: str) -> DataFrame:
    """Steps ``1..h`` after ``_T`` for each key: ``(*keys, step, ds, ...)``."""
    return (base.withColumn(STEP, F.explode(F.sequence(F.lit(1), F.lit(h))))
                .withColumn(DS, add_steps(F.col("_T"), F.col(STEP), freq)))


def _emit(df: DataFrame, keys: list[str], name: str, value: Column) -> DataFrame:
    return df.select(*keys, DS, F.lit(name).alias(MODEL), value.alias(YHAT))


def with_tail_index(train: DataFrame, keys: list[str], freq: str) -> DataFrame:
    """Add ``_T`` (last time of the key) and ``_r`` = steps before the last time (0 = last)."""
    return (train.join(last_times(train, keys), keys)
                 .withColumn("_r", steps_between(F.col(DS), F.col("_T"), freq)))


def naive(train: DataFrame, h: int, freq: str = "D", id_cols: str | Sequence[str] = ID) -> DataFrame:
    """Repeat the last observed value."""
    keys = _keys(id_cols)
    base = train.groupBy(*keys).agg(F.max(DS).alias("_T"), F.max_by(Y, DS).alias("_v"))
    return _emit(horizon(base, keys, h, freq), keys, "Naive", F.col("_v"))


def historic_average(train: DataFrame, h: int, freq: str = "D", id_cols: str | Sequence[str] = ID) -> DataFrame:
    """Mean of the whole history."""
    keys = _keys(id_cols)
    base = train.groupBy(*keys).agg(F.max(DS).alias("_T"), F.avg(Y).alias("_v"))
    return _emit(horizon(base, keys, h, freq), keys, "HistoricAverage", F.col("_v"))


def random_walk_drift(train: DataFrame, h: int, freq: str = "D", id_cols: str | Sequence[str] = ID) -> DataFrame:
    """Last value plus ``step * (last - first) / (n - 1)``."""
    keys = _keys(id_cols)
    base = train.groupBy(*keys).agg(F.max(DS).alias("_T"), F.max_by(Y, DS).alias("_l"),
                                    F.min_by(Y, DS).alias("_f"), F.count(F.lit(1)).alias("_n"))
    slope = F.try_divide(F.col("_l") - F.col("_f"), F.col("_n") - 1)
    return _emit(horizon(base, keys, h, freq), keys, "RWD", F.col("_l") + F.col(STEP) * F.coalesce(slope, F.lit(0.0)))


def window_average(train: DataFrame, h: int, window: int = 7, freq: str = "D",
                   id_cols: str | Sequence[str] = ID) -> DataFrame:
    """Mean of the last ``window`` steps."""
    keys = _keys(id_cols)
    t = with_tail_index(train, keys, freq).where(F.col("_r") < window)
    base = t.groupBy(*keys).agg(F.max("_T").alias("_T"), F.avg(Y).alias("_v"))
    return _emit(horizon(base, keys, h, freq), keys, "WindowAverage", F.col("_v"))


def window_median(train: DataFrame, h: int, window: int = 7, freq: str = "D",
                  id_cols: str | Sequence[str] = ID) -> DataFrame:
    """M05 (R ``window_forecast`` with median): median of the last ``window`` steps.
    The group is bounded by ``window`` rows, so the exact median is safe."""
    keys = _keys(id_cols)
    t = with_tail_index(train, keys, freq).where(F.col("_r") < window)
    base = t.groupBy(*keys).agg(F.max("_T").alias("_T"), F.median(Y).alias("_v"))
    return _emit(horizon(base, keys, h, freq), keys, "WindowMedian", F.col("_v"))


def weighted_mean(train: DataFrame, h: int, weights: Sequence[float] = (0.1, 0.3, 0.6), freq: str = "D",
                  id_cols: str | Sequence[str] = ID) -> DataFrame:
    """M05 (R weighted window): ``sum(w_i * y_i)`` over the last ``len(weights)`` steps,
    weights listed oldest first."""
    keys = _keys(id_cols)
    k = len(weights)
    t = with_tail_index(train, keys, freq).where(F.col("_r") < k)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.lit(k) - F.col("_r")).cast("int"))
    base = t.groupBy(*keys).agg(F.max("_T").alias("_T"), F.sum(w * F.col(Y)).alias("_v"))
    return _emit(horizon(base, keys, h, freq), keys, "WeightedMean", F.col("_v"))


def seasonal_naive(train: DataFrame, h: int, season: int = 7, freq: str = "D",
                   id_cols: str | Sequence[str] = ID) -> DataFrame:
    """Step ``s`` repeats the value one season before, ``y[T - m + ((s-1) mod m) + 1]``."""
    keys = _keys(id_cols)
    t = with_tail_index(train, keys, freq).where(F.col("_r") < season)
    src = t.select(*keys, "_T", (F.lit(season) - 1 - F.col("_r")).alias("_ph"), F.col(Y).alias("_v"))
    base = src.groupBy(*keys).agg(F.max("_T").alias("_T"))
    fut = horizon(base, keys, h, freq).withColumn("_ph", F.pmod(F.col(STEP) - 1, F.lit(season)))
    j = fut.join(src.drop("_T"), [*keys, "_ph"], "left")
    return _emit(j, keys, "SeasonalNaive", F.col("_v"))


def seasonal_window_average(train: DataFrame, h: int, season: int = 7, window: int = 8, freq: str = "D",
                            id_cols: str | Sequence[str] = ID) -> DataFrame:
    """Mean over the last ``window`` seasons of the value at the same phase."""
    keys = _keys(id_cols)
    t = with_tail_index(train, keys, freq).where(F.col("_r") < season * window)
    src = (t.withColumn("_ph", F.pmod(F.lit(season) - 1 - F.col("_r"), F.lit(season)))
             .groupBy(*keys, "_ph").agg(F.avg(Y).alias("_v")))
    base = t.groupBy(*keys).agg(F.max("_T").alias("_T"))
    fut = horizon(base, keys, h, freq).withColumn("_ph", F.pmod(F.col(STEP) - 1, F.lit(season)))
    return _emit(fut.join(src, [*keys, "_ph"], "left"), keys, "SeasonalWindowAverage", F.col("_v"))
