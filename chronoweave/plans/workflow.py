"""The feature workflow (H11): future rows, horizon-safe lags, rolling and EWM features
of the lag, Fourier terms, calendar signature, holidays, splines, interaction and
dummies -- one panel, positions computed once, every window keyed by (series, block)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.functions import basis, calendar, holidays
from chronoweave.operators import timegrid, windows
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.series import POS, regular_positions
from chronoweave.session import cut_lineage

H = 56
MONTHS = ["April", "August", "December", "February", "January", "July", "June", "March", "May", "November", "October", "September"]
DAYS = ["Friday", "Monday", "Saturday", "Sunday", "Thursday", "Tuesday", "Wednesday"]


def feature_workflow(panel: DataFrame, h: int = H, freq: str = "D") -> DataFrame:
    base = timegrid.future_frame(panel.select(ID, DS, Y), h, freq)
    x = base
    x = regular_positions(x, freq)
    x = windows.augment_lags(x, Y, [h], freq=freq)
    lag = f"y_lag_{h}"
    x = windows.augment_rolling(x, lag, [7, 28], "mean", freq=freq)
    x = windows.augment_ewm(x, lag, [0.1, 0.3], freq=freq)
    # the window stages above are the expensive part: store them before the column steps
    x = cut_lineage(x.drop(POS))
    x = basis.augment_fourier(x, DS, (7, 365), 2, freq)
    x = calendar.augment_timeseries_signature(x, DS, ("index_num", "year", "month", "month_lbl", "mweek", "wday", "wday_lbl",
                                                     "yday", "weekend", "quarter"))
    x = holidays.augment_holiday_signature(x).drop("holiday_name")
    knots_src = base.select(calendar.calendar_column(F.col(DS), "index_num").alias("ds_index_num"))
    x = basis.augment_bsplines(x, "ds_index_num", 5, 3, knots_from=knots_src)
    x = x.withColumn("ds_mweek_2", (F.col("ds_mweek") == 2).cast("int"))
    x = calendar.interactions(x, [("ds_wday", "ds_mweek_2")])
    x = calendar.one_hot(x, "ds_month_lbl", MONTHS, drop_first=True)
    x = calendar.one_hot(x, "ds_wday_lbl", DAYS, drop_first=True)
    return x.drop("ds_month_lbl", "ds_wday_lbl")


def feature_sets(df: DataFrame) -> dict[str, list[str]]:
    """Named feature sets -- ``base`` (no lag, no spline), ``spline`` (no lag),
    ``lag`` (no spline)."""
    skip = {ID, DS, Y}
    feats = [c for c in df.columns if c not in skip]
    is_lag = lambda c: c.startswith("y_lag_")
    is_spl = lambda c: c.startswith("bspline_")
    return {"base": [c for c in feats if not is_lag(c) and not is_spl(c)],
            "spline": [c for c in feats if not is_lag(c)],
            "lag": [c for c in feats if not is_spl(c)]}
