"""Accuracy metrics, model selection and leaderboards.

Forecasts are long ``(*keys, ds, model, y_hat)``; actuals ``(unique_id, ds, y)``.
Metrics are conditional aggregates grouped by ``(series, model)`` (optionally by
cutoff), so they are partial aggregates on any data size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.operators.baselines import MODEL, YHAT
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.series import _keys


def _err() -> Column:
    return F.col(YHAT) - F.col(Y)


def score_frame(forecasts: DataFrame, actuals: DataFrame, id_cols: str | Sequence[str] = ID) -> DataFrame:
    """Inner join of forecasts with actuals on ``(series, ds)``."""
    keys = _keys(id_cols)
    return forecasts.join(actuals.select(*keys, DS, Y), [*keys, DS], "inner")


def point_metrics(scored: DataFrame, by: Sequence[str] = (ID, MODEL), digits: int = 6) -> DataFrame:
    """bias = mean(y_hat - y), mae, mape = mean(|e|/|y|) (y = 0 skipped), mse, rmse."""
    e = _err()
    aggs = {
        "bias": F.avg(e),
        "mae": F.avg(F.abs(e)),
        "mape": F.avg(F.try_divide(F.abs(e), F.when(F.col(Y) != 0, F.abs(F.col(Y))))),
        "mse": F.avg(e * e),
        "rmse": F.sqrt(F.avg(e * e)),
    }
    return scored.groupBy(*by).agg(*[F.round(v, digits).alias(k) for k, v in aggs.items()])


def naive_scale(train: DataFrame, season: int = 1, id_cols: str | Sequence[str] = ID,
                freq: str = "D") -> DataFrame:
    """Mean absolute (and squared) seasonal difference of the training series, the MASE /
    RMSSE denominators.  Uses a self-join on ``ds - season`` instead of a whole-series window."""
    from chronoweave.functions.timekeys import add_steps
    keys = _keys(id_cols)
    prev = train.select(*keys, add_steps(F.col(DS), season, freq).alias(DS), F.col(Y).alias("_yp"))
    d = train.join(prev, [*keys, DS]).withColumn("_d", F.col(Y) - F.col("_yp"))
    return d.groupBy(*keys).agg(F.avg(F.abs("_d")).alias("scale_mae"), F.avg(F.col("_d") * F.col("_d")).alias("scale_mse"))


def naive_scale_by_season(train: DataFrame, season_col: str = "season", id_cols: str | Sequence[str] = ID) -> DataFrame:
    """:func:`naive_scale` where every series has its own season, in rows of the series (no calendar is needed, so series of
    any frequencies go together).  Each distinct season is one lag of the same block pass."""
    from chronoweave.plans.series import halo_window, with_positions
    keys = _keys(id_cols)
    seasons = sorted(r[0] for r in train.select(season_col).distinct().collect() if r[0] is not None)
    x = with_positions(train, keys)
    if not seasons:
        x = x.withColumn("_d", F.lit(None).cast("double"))
    else:
        x = halo_window(x, max(seasons), 0, lambda w: {f"_s{m}": F.lag(Y, m).over(w) for m in seasons}, keys)
        x = x.withColumn("_d", F.col(Y) - F.coalesce(*[F.when(F.col(season_col) == m, F.col(f"_s{m}")) for m in seasons]))
    return x.groupBy(*keys).agg(F.avg(F.abs("_d")).alias("scale_mae"), F.avg(F.col("_d") * F.col("_d")).alias("scale_mse"))


def own_horizon_split(panel: DataFrame, horizon_col: str = "horizon", id_cols: str | Sequence[str] = ID) -> DataFrame:
    """``panel`` with ``step``, a row's place in its series' own horizon: 1 .. horizon for the last rows (the test set),
    0 and less before (the training set)."""
    from chronoweave.plans.series import POS, with_positions
    keys = _keys(id_cols)
    x = with_positions(panel, keys)
    last = x.groupBy(*keys).agg(F.max(POS).alias("_last"))
    return x.join(last, keys).withColumn("step", F.col(POS) - F.col("_last") + F.col(horizon_col)).drop(POS, "_last")


def r_metrics(scored: DataFrame, scale: DataFrame, by: Sequence[str] = (ID, MODEL), digits: int = 6) -> DataFrame:
    """Mae, mape (%), mase, smape (%), rmse, rsq = squared Pearson correlation."""
    keys = [k for k in by if k != MODEL]
    e = _err()
    g = scored.join(scale, keys, "left").groupBy(*by)
    return g.agg(
        F.round(F.avg(F.abs(e)), digits).alias("mae"),
        F.round(F.avg(F.try_divide(F.abs(e), F.when(F.col(Y) != 0, F.abs(F.col(Y))))) * 100, digits).alias("mape"),
        F.round(F.try_divide(F.avg(F.abs(e)), F.first("scale_mae")), digits).alias("mase"),
        F.round(F.avg(F.try_divide(F.abs(e), (F.abs(F.col(Y)) + F.abs(F.col(YHAT))) / 2)) * 100, digits).alias("smape"),
        F.round(F.sqrt(F.avg(e * e)), digits).alias("rmse"),
        # squared correlation from moments: a constant forecast gives NULL, not an error
        F.round(F.try_divide(F.pow(F.covar_pop(Y, YHAT), 2), F.var_pop(Y) * F.var_pop(YHAT)), digits).alias("rsq"),
    )


def scaled_metrics(scored: DataFrame, scale: DataFrame, by: Sequence[str] = (ID, MODEL), digits: int = 6) -> DataFrame:
    """RMSSE, MASE and sMAPE per series and method (seasonal-naive scale)."""
    keys = [k for k in by if k != MODEL]
    e = _err()
    return (scored.join(scale, keys, "left").groupBy(*by).agg(
        F.round(F.sqrt(F.try_divide(F.avg(e * e), F.first("scale_mse"))), digits).alias("rmsse"),
        F.round(F.try_divide(F.avg(F.abs(e)), F.first("scale_mae")), digits).alias("mase"),
        F.round(F.avg(F.try_divide(2 * F.abs(e), F.abs(F.col(Y)) + F.abs(F.col(YHAT)))) * 100, digits).alias("smape")))


LOWER_IS_BETTER = {"bias": False, "mae": True, "mape": True, "mse": True, "rmse": True, "smape": True,
                   "mase": True, "rmsse": True, "rsq": False}


def best_model(metrics: DataFrame, metric: str = "rmse", by: Sequence[str] = ()) -> DataFrame:
    """Best model by ``metric`` (globally or per ``by``), ties kept (``rank``).

    ``bias`` ranks by magnitude and ``rsq`` by the largest value."""
    if metric == "bias":
        order = F.abs(F.col(metric)).asc()
    elif LOWER_IS_BETTER.get(metric, True):
        order = F.col(metric).asc()
    else:
        order = F.col(metric).desc()
    w = Window.partitionBy(*by).orderBy(order) if by else Window.orderBy(order)
    return metrics.withColumn("_rk", F.rank().over(w)).where(F.col("_rk") == 1).drop("_rk")


def accuracy_flags(metrics: DataFrame, metric_cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``is_best_<m>`` / ``is_worst_<m>`` flags per metric column."""
    out = metrics
    for m in metric_cols:
        lo = F.min(m).over(Window.partitionBy(*by)) if by else F.min(m).over(Window.partitionBy())
        hi = F.max(m).over(Window.partitionBy(*by)) if by else F.max(m).over(Window.partitionBy())
        out = out.withColumn(f"is_best_{m}", (F.col(m) == lo).cast("int")).withColumn(f"is_worst_{m}", (F.col(m) == hi).cast("int"))
    return out


def leaderboard(metrics: DataFrame, metric: str = "rmse", by: Sequence[str] = ()) -> DataFrame:
    """Rank models by a metric (1 = best)."""
    order = F.col(metric).asc() if LOWER_IS_BETTER.get(metric, True) else F.col(metric).desc()
    w = Window.partitionBy(*by).orderBy(order) if by else Window.orderBy(order)
    return metrics.withColumn("rank", F.rank().over(w))
