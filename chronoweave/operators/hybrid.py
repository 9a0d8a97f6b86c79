"""Residual-boosted hybrids (M25): a model per series first, then one global learner on what it left.

Stage one gives fitted values on the train rows and a forecast; stage two is any ``pyspark.ml``
regressor fitted on the residuals of all series at once with calendar features, which are known
for future rows.  The forecast is the sum.  Rows without a fitted value (the first lags of an
autoregression) train nothing; a series without stage-one coefficients keeps its forecast rows
with NULL values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.functions import calendar
from chronoweave.operators import ml, regression, windows
from chronoweave.operators.baselines import MODEL, YHAT
from chronoweave.panel import DS, ID, Y
from chronoweave.plans import ols
from chronoweave.session import cut_lineage

CALENDAR = ("month", "mday", "yday", "quarter", "mweek", "wday")


def ar_fitted(train: DataFrame, lags: Sequence[int] = (1, 7, 14, 30), freq: str = "D") -> DataFrame:
    """(unique_id, ds, y, fitted): one-step fitted values of :func:`regression.ar_fit`."""
    coefs, design = regression.ar_fit(train, lags, freq)
    x = windows.augment_lags(train.select(ID, DS, Y), Y, lags, freq=freq)
    return ols.predict(x, coefs, [ID], design, "fitted").select(ID, DS, Y, "fitted")


def boosted(fitted: DataFrame, forecast: DataFrame, estimator, features: Sequence[str] = CALENDAR, name: str = "Hybrid") -> DataFrame:
    """``forecast`` plus the residual that ``estimator`` expects from the calendar ``features``."""
    cols = [f"{DS}_{c}" for c in features]
    rest = fitted.select(ID, DS, (F.col(Y) - F.col("fitted")).alias(Y)).where(F.col(Y).isNotNull())
    # boosting passes over its input many times
    rest = cut_lineage(calendar.augment_timeseries_signature(rest, DS, features))
    model = ml.pipeline(cols, estimator).fit(rest)
    future = calendar.augment_timeseries_signature(forecast.select(ID, DS, F.col(YHAT).alias("_first")), DS, features)
    return model.transform(future).select(ID, DS, F.lit(name).alias(MODEL), (F.col("_first") + F.col(YHAT)).alias(YHAT))
