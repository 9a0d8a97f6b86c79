"""Filling and interpolation of gaps (B12-B15), per series in time order.

Forward/backward fills and interpolation use block carries
(:func:`chronoweave.plans.series.carry_last`), never a whole-series window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.panel import DS, ID, Y
from chronoweave.plans.series import DEFAULT_BLOCK_ROWS, POS, _keys, carry_last, positioned, with_positions


def fill_value(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Constant fill of selected columns."""
    return df.fillna(values)


def fill_direction(df: DataFrame, value_col: str = Y, direction: str = "forward",
                   freq: str | None = None, id_cols: str | Sequence[str] = ID, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Forward (``ffill``) or backward (``bfill``) fill; ``"both"`` = ffill then bfill."""
    keys = _keys(id_cols)
    x, _ = positioned(df, keys, freq)
    if direction in ("forward", "both"):
        x = carry_last(x, value_col, "_f", True, keys, block_rows=block_rows).withColumn(value_col, F.col("_f")).drop("_f")
    if direction in ("backward", "both"):
        x = carry_last(x, value_col, "_f", False, keys, block_rows=block_rows).withColumn(value_col, F.col("_f")).drop("_f")
    return x.drop(POS)


def _interpolate_positioned(x: DataFrame, value_col: str, keys: list[str], block_rows: int) -> DataFrame:
    pv = F.when(F.col(value_col).isNotNull(), F.struct(F.col(POS).alias("p"), F.col(value_col).alias("v")))
    x = x.withColumn("_pv", pv)
    x = carry_last(x, "_pv", "_prev", True, keys, block_rows=block_rows)
    x = carry_last(x, "_pv", "_next", False, keys, block_rows=block_rows)
    lin = F.col("_prev.v") + (F.col("_next.v") - F.col("_prev.v")) * \
        F.try_divide(F.col(POS) - F.col("_prev.p"), F.col("_next.p") - F.col("_prev.p"))
    filled = (F.when(F.col(value_col).isNotNull(), F.col(value_col))
               .when(F.col("_next").isNull(), F.col("_prev.v"))  # trailing gap: last value
               .otherwise(lin))                                   # leading gap stays NULL
    return x.withColumn(value_col, filled).drop("_pv", "_prev", "_next")


def interpolate_linear(df: DataFrame, value_col: str = Y, freq: str | None = None, id_cols: str | Sequence[str] = ID,
                       block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Pandas ``interpolate(method='linear')`` by position: gaps between two values
    are linear, trailing gaps repeat the last value, leading gaps stay NULL."""
    keys = _keys(id_cols)
    return _interpolate_positioned(positioned(df, keys, freq)[0], value_col, keys, block_rows).drop(POS)


def impute_seasonal(df: DataFrame, value_col: str = Y, period: int = 7, freq: str | None = None, id_cols: str | Sequence[str] = ID,
                    block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """B15 ``ts_impute_vec(period)``: remove the per-phase mean (phase = position mod
    period), interpolate linearly, add the phase mean back.  ``period <= 1`` is plain B14."""
    keys = _keys(id_cols)
    x, _ = positioned(df, keys, freq)
    if period <= 1:
        return _interpolate_positioned(x, value_col, keys, block_rows).drop(POS)
    x = x.withColumn("_ph", F.pmod(F.col(POS), F.lit(period)))
    means = x.groupBy(*keys, "_ph").agg(F.avg(value_col).alias("_pm"))
    x = x.join(means, [*keys, "_ph"], "left").withColumn(value_col, F.col(value_col) - F.col("_pm"))
    x = _interpolate_positioned(x, value_col, keys, block_rows)
    return x.withColumn(value_col, F.col(value_col) + F.col("_pm")).drop("_ph", "_pm", POS)
