"""Lags, differences, rolling and exponentially weighted features.

Every feature is evaluated per ``(series, block)`` through
:func:`chronoweave.plans.series.halo_window` (bounded frames) or the block scans
(expanding / exponential frames), so a single long series is split over many tasks.
Frames count rows, i.e. steps on a padded regular grid.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from chronoweave.panel import DS, ID, Y
from chronoweave.plans.series import (DEFAULT_BLOCK_ROWS, POS, _keys, decay_scan, halo_window, positioned,
                                      prefix_sums, with_positions)


def tag(a: float) -> str:
    """Parameter text usable in a column name: 0.1 -> ``0_1``."""
    return f"{a:g}".replace(".", "_").replace("-", "m")


def _positioned(df: DataFrame, keys: list[str], freq: str | None = None) -> tuple[DataFrame, bool]:
    """Positions from the regular grid (``freq`` given: no shuffle) or ranks (irregular)."""
    return positioned(df, keys, freq)


def _finish(df: DataFrame, added: bool) -> DataFrame:
    return df.drop(POS) if added else df


def _cols(c: str | Sequence[str]) -> list[str]:
    return [c] if isinstance(c, str) else list(c)


def augment_lags(df: DataFrame, value_cols: str | Sequence[str] = Y, lags: Sequence[int] = (1,),
                 freq: str | None = None, id_cols: str | Sequence[str] = ID, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``<col>_lag_<k>`` = value ``k`` rows earlier in the series."""
    keys = _keys(id_cols)
    x, added = _positioned(df, keys, freq)
    build = lambda w: {f"{c}_lag_{k}": F.lag(c, k).over(w) for c in _cols(value_cols) for k in lags}
    return _finish(halo_window(x, max(lags), 0, build, keys, block_rows=block_rows), added)


def augment_diffs(df: DataFrame, value_cols: str | Sequence[str] = Y, periods: Sequence[int] = (1,),
                  freq: str | None = None, id_cols: str | Sequence[str] = ID, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``<col>_diff_<p>`` = y - lag_p(y)."""
    keys = _keys(id_cols)
    x, added = _positioned(df, keys, freq)
    build = lambda w: {f"{c}_diff_{p}": F.col(c) - F.lag(c, p).over(w) for c in _cols(value_cols) for p in periods}
    return _finish(halo_window(x, max(periods), 0, build, keys, block_rows=block_rows), added)


def augment_pct_change(df: DataFrame, value_cols: str | Sequence[str] = Y, periods: Sequence[int] = (1,),
                       freq: str | None = None, id_cols: str | Sequence[str] = ID, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``<col>_pctchg_<p>`` = y / lag_p(y) - 1 (NULL where the lag is 0)."""
    keys = _keys(id_cols)
    x, added = _positioned(df, keys, freq)
    build = lambda w: {f"{c}_pctchg_{p}": F.try_divide(F.col(c), F.nullif(F.lag(c, p).over(w), F.lit(0))) - 1
                       for c in _cols(value_cols) for p in periods}
    return _finish(halo_window(x, max(periods), 0, build, keys, block_rows=block_rows), added)


ROLL_FUNCS: dict[str, Callable[[str], Column]] = {
    "mean": lambda c: F.avg(c), "sum": lambda c: F.sum(c), "std": lambda c: F.stddev_samp(c),
    "min": lambda c: F.min(c), "max": lambda c: F.max(c), "count": lambda c: F.count(c),
}


def _array_median(a: Column) -> Column:
    """Median of a numeric array (mean of the two middle values when the size is even)."""
    s = F.array_sort(F.filter(a, lambda v: v.isNotNull()))
    n = F.size(s)
    mid = F.element_at(s, (F.floor((n + 1) / 2)).cast("int"))
    mid2 = F.element_at(s, (F.floor(n / 2) + 1).cast("int"))
    return F.when(n == 0, F.lit(None)).when(n % 2 == 1, mid).otherwise((mid + mid2) / 2)


def _roll(fn: str, c: str, fw: WindowSpec) -> Column:
    # median has no frame-aware window form; the frame is bounded, so sort its values
    if fn == "median":
        return _array_median(F.collect_list(c).over(fw))
    return ROLL_FUNCS[fn](c).over(fw)


def frame_bounds(window: int, center: bool, shift: int = 0) -> tuple[int, int]:
    """ROWS frame ``[lo, hi]`` of a trailing or centred window (pandas: even centred windows
    reach ``w//2`` back and ``(w-1)//2`` ahead), shifted back by ``shift`` rows."""
    if center:
        return -(window // 2) - shift, (window - 1) // 2 - shift
    return -(window - 1) - shift, -shift


def augment_rolling(df: DataFrame, value_cols: str | Sequence[str] = Y, window: int | Sequence[int] = 7,
                    window_func: str | Sequence[str] = "mean", center: bool = False, partial: bool = False,
                    shift: int = 0, freq: str | None = None, id_cols: str | Sequence[str] = ID,
                    block_rows: int = DEFAULT_BLOCK_ROWS, digits: int | None = None) -> DataFrame:
    """``<col>_rolling_<func>_win_<w>`` over trailing or centred ROWS frames.

    Unless ``partial``, a value needs the whole frame inside the series (NULL at edges);
    ``shift`` moves the frame ``k`` rows back (lag-then-roll, horizon safe)."""
    keys = _keys(id_cols)
    x, added = _positioned(df, keys, freq)
    wins = [window] if isinstance(window, int) else list(window)
    funcs = [window_func] if isinstance(window_func, str) else list(window_func)
    frames = {w: frame_bounds(w, center, shift) for w in wins}
    back = max(-lo for lo, _ in frames.values())
    ahead = max(max(hi for _, hi in frames.values()), 0)

    post = {}  # median: the frame's values are collected once, the median is taken after

    def build(ws: WindowSpec) -> dict[str, Column]:
        out = {}
        for c in _cols(value_cols):
            for w in wins:
                lo, hi = frames[w]
                fw = ws.rowsBetween(lo, hi)
                n = F.count(c).over(fw)  # valid values, as pandas min_periods
                tag = f"_shift_{shift}" if shift else ""
                name_n = f"_n_{c}_{w}"
                out[name_n] = n
                for fn in funcs:
                    name = f"{c}_rolling_{fn}_win_{w}{tag}"
                    if fn == "median":
                        out[f"_arr_{name}"] = F.collect_list(c).over(fw)
                        v = _array_median(F.col(f"_arr_{name}"))
                    else:
                        v = ROLL_FUNCS[fn](c).over(fw)
                        out[f"_v_{name}"] = v
                        v = F.col(f"_v_{name}")
                    if not partial:
                        v = F.when(F.col(name_n) == w, v)
                    if digits is not None:
                        v = F.round(v, digits)
                    post[name] = v
        return out

    y = halo_window(x, back, ahead, build, keys, block_rows=block_rows)
    tmp = [c for c in y.columns if c.startswith(("_arr_", "_v_", "_n_"))]
    return _finish(y.withColumns(post).drop(*tmp), added)


def rolling_apply(df: DataFrame, value_col: str, window: int, fn: Callable[[Column], Column], name: str,
                  center: bool = False, freq: str | None = None, id_cols: str | Sequence[str] = ID,
                  block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """User function of the window's values (an array column, oldest first)."""
    keys = _keys(id_cols)
    x, added = _positioned(df, keys, freq)
    lo, hi = frame_bounds(window, center)

    def build(ws: WindowSpec) -> dict[str, Column]:
        fw = ws.rowsBetween(lo, hi)
        return {"_vals": F.collect_list(F.struct(F.col(POS).alias("p"), F.col(value_col).alias("v"))).over(fw)}

    y = halo_window(x, -lo, max(hi, 0), build, keys, block_rows=block_rows)
    y = y.withColumn("_arr", F.transform(F.array_sort("_vals"), lambda s: s["v"]))
    return _finish(y.withColumn(name, F.when(F.size("_arr") == window, fn(F.col("_arr")))).drop("_vals", "_arr"), added)


def augment_ewm(df: DataFrame, value_col: str = Y, alphas: Sequence[float] = (0.1,),
                freq: str | None = None, id_cols: str | Sequence[str] = ID, block_rows: int = DEFAULT_BLOCK_ROWS,
                digits: int | None = None) -> DataFrame:
    """pandas ``ewm(alpha, adjust=True).mean()``:
    ``sum_j (1-a)^(t-j) y_j / sum_j (1-a)^(t-j)`` over the rows ``j`` that have a value; NULL
    before the first value, carried over later NULLs."""
    keys = _keys(id_cols)
    x, added = _positioned(df, keys, freq)
    there = F.when(F.col(value_col).isNotNull(), F.lit(1.0)).otherwise(F.lit(0.0))
    specs = {f"_num{i}": (F.coalesce(F.col(value_col).cast("double"), F.lit(0.0)), 1.0 - a) for i, a in enumerate(alphas)}
    specs.update({f"_den{i}": (there, 1.0 - a) for i, a in enumerate(alphas)})
    x = decay_scan(x, specs, id_cols=keys, block_rows=block_rows)
    for i, a in enumerate(alphas):
        v = F.when(F.col(f"_den{i}") > 0, F.col(f"_num{i}") / F.col(f"_den{i}"))
        x = x.withColumn(f"{value_col}_ewm_mean_alpha_{tag(a)}", F.round(v, digits) if digits is not None else v).drop(f"_num{i}", f"_den{i}")
    return _finish(x, added)


def smoothed_level(df: DataFrame, value_col: str, alpha: float, out: str,
                   id_cols: str | Sequence[str] = ID, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Exponential smoothing level with the first value as the initial level:
    ``l_0 = y_0``, ``l_t = a*y_t + (1-a)*l_(t-1)`` (pandas ``adjust=False``); needs ``_pos``.
    The first row is found from the per-series minimum position (a small aggregate)."""
    keys = _keys(id_cols)
    first = df.groupBy(*keys).agg(F.min(POS).alias("_p0"))
    x = df.join(first, keys)
    v = F.when(F.col(POS) == F.col("_p0"), F.col(value_col)).otherwise(F.lit(alpha) * F.col(value_col))
    return decay_scan(x, v, 1.0 - alpha, out, id_cols, block_rows=block_rows).drop("_p0")


def lag_transforms(df: DataFrame, value_col: str = Y, lag: int = 1, rolling: Sequence[int] = (),
                   expanding: bool = False, ewm_alphas: Sequence[float] = (),
                   freq: str | None = None, id_cols: str | Sequence[str] = ID, block_rows: int = DEFAULT_BLOCK_ROWS,
                   digits: int | None = None) -> DataFrame:
    """transforms of ``lag_k(y)``: ``rolling_mean_lag<k>_window_size<w>`` (full windows
    only), ``expanding_mean_lag<k>``, ``exponentially_weighted_mean_lag<k>_alpha<a>``
    (``adjust=False`` recursion started at the first value)."""
    keys = _keys(id_cols)
    x, added = _positioned(df, keys, freq)
    rnd = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    if rolling:
        for w in rolling:
            x = augment_rolling(x, value_col, w, "mean", shift=lag, freq=freq, id_cols=keys, block_rows=block_rows)
            x = x.withColumnRenamed(f"{value_col}_rolling_mean_win_{w}_shift_{lag}", f"rolling_mean_lag{lag}_window_size{w}")
            x = x.withColumn(f"rolling_mean_lag{lag}_window_size{w}", rnd(F.col(f"rolling_mean_lag{lag}_window_size{w}")))
    if expanding:
        x = prefix_sums(x, {"_es": F.col(value_col), "_en": F.col(value_col).isNotNull().cast("long")},
                        keys, block_rows=block_rows, lag=lag)
        x = x.withColumn(f"expanding_mean_lag{lag}", rnd(F.try_divide(F.col("_es"), F.nullif(F.col("_en"), F.lit(0))))).drop("_es", "_en")
    for a in ewm_alphas:
        x = smoothed_level(x, value_col, a, "_lvl", keys, block_rows)
        name = f"exponentially_weighted_mean_lag{lag}_alpha{tag(a)}"
        x = halo_window(x, lag, 0, lambda w: {name: F.lag("_lvl", lag).over(w)}, keys, block_rows=block_rows).drop("_lvl")
        x = x.withColumn(name, rnd(F.col(name)))
    return _finish(x, added)


def rank_within(df: DataFrame, by: Sequence[str], order: Column, out: str = "rank", dense: bool = False) -> DataFrame:
    """``min_rank`` (ties share the lowest rank) within ``by`` groups."""
    w = Window.partitionBy(*by).orderBy(order)
    return df.withColumn(out, (F.dense_rank() if dense else F.rank()).over(w))


def top_n(df: DataFrame, by: Sequence[str], order: Column, n: int = 1, keep_ties: bool = True,
          split_col: str | None = DS, bucket_days: int = 31) -> DataFrame:
    """best ``n`` rows per group (``slice_min`` keeps ties -> ``rank``).

    Two phases so a large group is never ranked in one task: the top ``n`` of each
    (group, time bucket) first, then the top ``n`` among those candidates (a row in the
    group's top ``n`` is always in its bucket's top ``n``)."""
    rank = (lambda w: F.rank().over(w)) if keep_ties else (lambda w: F.row_number().over(w))
    x = df
    if split_col is not None:
        from chronoweave.plans.series import time_bucket
        x = x.withColumn("_tb", time_bucket(F.col(split_col), bucket_days))
        x = x.withColumn("_r", rank(Window.partitionBy(*by, "_tb").orderBy(order))).where(F.col("_r") <= n).drop("_r", "_tb")
    return x.withColumn("_r", rank(Window.partitionBy(*by).orderBy(order))).where(F.col("_r") <= n).drop("_r")


def row_index(df: DataFrame, id_cols: str | Sequence[str] = ID, out: str = "row_index", freq: str | None = None) -> DataFrame:
    """1-based ordinal position inside each series (regular grids: steps since the
    series start, from one small aggregate)."""
    keys = _keys(id_cols)
    if freq:
        from chronoweave.functions.timekeys import steps_between
        first = df.groupBy(*keys).agg(F.min(DS).alias("_t0"))
        return df.join(first, keys).withColumn(out, steps_between(F.col("_t0"), F.col(DS), freq) + 1).drop("_t0")
    return with_positions(df, keys).withColumn(out, F.col(POS) + 1).drop(POS)


def augment_wavelet(df: DataFrame, value_col: str = Y, scales: Sequence[int] = (2, 4, 8), width: float = 3.0,
                    freq: str | None = None, id_cols: str | Sequence[str] = ID, block_rows: int = DEFAULT_BLOCK_ROWS,
                    digits: int | None = None) -> DataFrame:
    """H09 (re-aimed): wavelet responses ``<col>_wavelet_morlet_scale_<s>`` = convolution of
    the series with the real Morlet kernel ``exp(-u^2/2) cos(5u) / sqrt(s)``, ``u = k/s``,
    over a centred window of ``|k| <= width*s`` rows (partial at the edges).  A bounded
    frame, so it runs in halo blocks; each row's frame is collected once."""
    import math
    keys = _keys(id_cols)
    x, added = _positioned(df, keys, freq)
    half = int(math.ceil(width * max(scales)))

    def build(ws: WindowSpec) -> dict[str, Column]:
        fw = ws.rowsBetween(-half, half)
        return {"_wv": F.collect_list(F.struct(F.col(POS).alias("p"), F.col(value_col).alias("v"))).over(fw)}

    y = halo_window(x, half, half, build, keys, block_rows=block_rows)
    cols = {}
    for s in scales:
        reach = int(math.ceil(width * s))

        def make_term(s: int, reach: int):
            def term(acc, e):
                k = (e["p"] - F.col(POS)).cast("double")
                u = k / F.lit(float(s))
                wgt = F.exp(-u * u / 2) * F.cos(F.lit(5.0) * u) / F.lit(math.sqrt(s))
                return acc + F.when(F.abs(k) <= reach, wgt * F.coalesce(e["v"], F.lit(0.0))).otherwise(F.lit(0.0))
            return term

        v = F.aggregate(F.col("_wv"), F.lit(0.0), make_term(s, reach))
        cols[f"{value_col}_wavelet_morlet_scale_{s}"] = F.round(v, digits) if digits is not None else v
    return _finish(y.withColumns(cols).drop("_wv"), added)
