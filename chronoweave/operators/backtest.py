"""Backtesting (K02, K05, K11, M26): windows x models as one Spark job.

Models are functions ``(train, h, freq, id_cols) -> forecasts``; training rows are keyed
by ``(unique_id, cutoff)`` so every window is an independent series for the model and
all windows and series are fitted by the same aggregates.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.operators.baselines import MODEL, STEP, YHAT
from chronoweave.operators.splits import CUTOFF, backtest_windows
from chronoweave.panel import DS, ID, Y

Model = Callable[..., DataFrame]


def cross_validation(panel: DataFrame, models: Mapping[str, Model] | Sequence[Model], h: int, n_windows: int = 1,
                     step_size: int | None = None, freq: str = "D", initial: int | None = None) -> DataFrame:
    """Long CV frame ``(unique_id, cutoff, ds, model, y_hat, y, step)``."""
    w = backtest_windows(panel.select(ID, DS, Y), h, n_windows, step_size, freq, initial=initial)
    train = w.where(F.col("set") == "train").select(ID, CUTOFF, DS, Y)
    test = w.where(F.col("set") == "test").select(ID, CUTOFF, DS, Y)
    fns = list(models.values()) if isinstance(models, Mapping) else list(models)
    fc = None
    for fn in fns:
        part = fn(train, h, freq=freq, id_cols=[ID, CUTOFF])
        fc = part if fc is None else fc.unionByName(part)
    from chronoweave.functions.timekeys import steps_between
    return (fc.join(test, [ID, CUTOFF, DS], "inner")
              .withColumn(STEP, steps_between(F.col(CUTOFF), F.col(DS), freq).cast("int")))


def forecast(panel: DataFrame, models: Mapping[str, Model] | Sequence[Model], h: int, freq: str = "D") -> DataFrame:
    """Refit on all history and forecast ``h`` steps: ``(unique_id, ds, model, y_hat)``."""
    fns = list(models.values()) if isinstance(models, Mapping) else list(models)
    out = None
    for fn in fns:
        part = fn(panel.select(ID, DS, Y), h, freq=freq, id_cols=[ID])
        out = part if out is None else out.unionByName(part)
    return out
