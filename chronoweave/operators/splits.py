"""Train/test splits and backtest windows.

Windows are produced per row: each row learns, from its series' last time, which
cutoffs it is training or test data for and is exploded once per such cutoff.  The
only join is with the per-series bounds table, so no step keys a shuffle on the series
id alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.timekeys import add_steps, steps_between
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.series import _keys

CUTOFF = "cutoff"


def time_series_split(df: DataFrame, assess: int, freq: str = "D", id_cols: str | Sequence[str] = ID,
                      set_col: str = "set") -> DataFrame:
    """Hold out the last ``assess`` steps of every series as ``test``; adds ``cutoff``."""
    keys = _keys(id_cols)
    last = df.groupBy(*keys).agg(F.max(DS).alias("_last"))
    cut = add_steps(F.col("_last"), -assess, freq)
    return (df.join(last, keys)
              .withColumn(CUTOFF, cut)
              .withColumn(set_col, F.when(F.col(DS) <= F.col(CUTOFF), "train").otherwise("test"))
              .drop("_last"))


def backtest_windows(df: DataFrame, h: int, n_windows: int = 1, step_size: int | None = None, freq: str = "D",
                     id_cols: str | Sequence[str] = ID, initial: int | None = None) -> DataFrame:
    """Expand a panel into ``n_windows`` backtest windows.

    Window ``i`` (0 = newest) has ``cutoff = last - (h + i*step_size)`` steps; its rows
    are ``ds <= cutoff`` (``set='train'``; only the last ``initial`` steps when sliding)
    and ``cutoff < ds <= cutoff + h`` (``set='test'``).  Output adds ``cutoff``, ``set``.
    """
    keys = _keys(id_cols)
    step_size = h if step_size is None else step_size
    last = df.groupBy(*keys).agg(F.max(DS).alias("_last"))
    x = df.join(last, keys).withColumn("_d", steps_between(F.col(DS), F.col("_last"), freq))
    # train of window i  <=>  d >= h + i*s (and d < h + i*s + initial when sliding)
    # test  of window i  <=>  h + i*s - h <= d < h + i*s  <=>  i*s <= d < i*s + h
    i_train_hi = F.least(F.lit(n_windows - 1), F.floor((F.col("_d") - h) / step_size))
    if initial is None:
        i_train_lo = F.lit(0)
    else:
        i_train_lo = F.greatest(F.lit(0), F.floor((F.col("_d") - h - initial) / step_size) + 1)
    i_test_hi = F.least(F.lit(n_windows - 1), F.floor(F.col("_d") / step_size))
    i_test_lo = F.greatest(F.lit(0), F.floor((F.col("_d") - h) / step_size) + 1)

    def rng(lo: Column, hi: Column, label: str) -> Column:
        return F.when(hi >= lo, F.transform(F.sequence(lo.cast("int"), hi.cast("int")),
                                            lambda i: F.struct(i.alias("i"), F.lit(label).alias("set"))))

    parts = F.concat(F.coalesce(rng(i_train_lo, i_train_hi, "train"), F.array()),
                     F.coalesce(rng(i_test_lo, i_test_hi, "test"), F.array()))
    e = x.withColumn("_w", F.explode(parts))
    cutoff = add_steps(F.col("_last"), -(F.lit(h) + F.col("_w.i") * step_size), freq)
    return (e.withColumn(CUTOFF, cutoff).withColumn("set", F.col("_w.set"))
             .drop("_w", "_d", "_last"))


def vfold(df: DataFrame, v: int = 5, seed: int = 123, id_cols: str | Sequence[str] = ID) -> DataFrame:
    """Deterministic random fold id in ``0..v-1`` from a hash of (series, time, seed)."""
    keys = _keys(id_cols)
    return df.withColumn("fold", F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.col(DS), F.lit(seed)), F.lit(v)).cast("int"))
