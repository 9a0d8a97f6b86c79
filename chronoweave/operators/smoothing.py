"""Exponential smoothing family, theta and intermittent-demand models.

Simple exponential smoothing with the first value as initial level has the closed form
``l_last = b^(n-1) y_0 + a * sum_{j>=1} b^(n-1-j) y_j`` (b = 1 - a), i.e. one weighted sum
per series: a partial aggregate, so models are fitted without gathering a series
anywhere.  Parameter searches (SSE of one-step fits over an alpha grid) use the shared
block scan :func:`chronoweave.plans.series.decay_scan` for every grid value at once.

Input: training panel ``(*keys, ds, y)``; output: ``(*keys, ds, model, y_hat)``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.operators.baselines import MODEL, STEP, YHAT, horizon
from chronoweave.panel import DS, ID, Y
from chronoweave.functions.timekeys import steps_between
from chronoweave.plans.blocks import ARRAY_ROWS, BLOCK, _bounded
from chronoweave.plans.series import (EPOCH, POS, _keys, carry_last, decay_block, decay_carries, decay_scan, forward_scan, prefix_sums,
                                      regular_positions, with_positions)
from chronoweave.session import store

ALPHA_GRID = [round(0.05 * i, 2) for i in range(1, 20)]        # 0.05 .. 0.95
CROSTON_GRID = [round(0.1 + 0.01 * i, 2) for i in range(21)]     # 0.10 .. 0.30


def _positions(df: DataFrame, keys: list[str], freq: str | None = None) -> DataFrame:
    """Add ``_pos``, ``_n`` (rows in the key), ``_T`` (last time) and ``_r`` = rows after
    this one.  On a regular grid (``freq``) positions are epoch steps and ``_r`` is the
    step distance to ``_T``: one small aggregate and join, no ranking shuffle.  A key whose
    rows do not fill its grid is an error (pad it first): steps would not count rows."""
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(DS).alias("_t0"), F.max(DS).alias("_T"))
    if freq:
        regular = steps_between(F.col("_t0"), F.col("_T"), freq) + 1 == F.col("_n")
        gap = F.raise_error(F.concat(F.lit("irregular series, pad it by time first: "), F.to_json(F.struct(*keys)))).cast("long")
        n = n.withColumn("_n", F.when(regular, F.col("_n")).otherwise(gap))
    n = n.drop("_t0")
    if freq:
        return regular_positions(df, freq).join(n, keys).withColumn("_r", steps_between(F.col(DS), F.col("_T"), freq))
    return with_positions(df, keys).join(n, keys).withColumn("_r", F.col("_n") - 1 - F.col(POS))


def ses_weight(alpha: float | Column) -> Column:
    """Weight of each row in the final SES level (needs ``_r``, ``_n``)."""
    a = alpha if isinstance(alpha, Column) else F.lit(float(alpha))
    b = F.lit(1.0) - a
    return F.when(F.col("_r") == F.col("_n") - 1, F.pow(b, F.col("_r"))).otherwise(a * F.pow(b, F.col("_r")))


def ses_levels(df: DataFrame, keys: list[str], alphas: Sequence[float], value_col: str = Y) -> DataFrame:
    """Final SES level for each alpha: ``(*keys, _T, _n, level_<i>)`` (positioned input)."""
    return df.groupBy(*keys).agg(F.max("_T").alias("_T"), F.max("_n").alias("_n"),
                                 *[F.sum(ses_weight(a) * F.col(value_col)).alias(f"level_{i}") for i, a in enumerate(alphas)])


def ses_sse(df: DataFrame, keys: list[str], alphas: Sequence[float], value_col: str = Y) -> DataFrame:
    """Per key and alpha the SSE of one-step fits ``sum_{t>=1} (y_t - l_(t-1))^2`` and the
    final level; long ``(*keys, _T, alpha, sse, level)``.  ``l_(t-1) = (l_t - a y_t)/(1-a)``."""
    first = F.col("_r") == F.col("_n") - 1
    specs = {f"_lv{i}": (F.when(first, F.col(value_col)).otherwise(F.lit(a) * F.col(value_col)), 1.0 - a)
             for i, a in enumerate(alphas)}
    x = decay_scan(df, specs, id_cols=keys)
    aggs = [F.max("_T").alias("_T")]
    for i, a in enumerate(alphas):
        prev = (F.col(f"_lv{i}") - F.lit(a) * F.col(value_col)) / F.lit(1.0 - a)
        e = F.when(~first, F.col(value_col) - prev)
        aggs += [F.sum(e * e).alias(f"_sse{i}"), F.max_by(f"_lv{i}", POS).alias(f"_lev{i}")]
    s = x.groupBy(*keys).agg(*aggs)
    items = [F.struct(F.lit(a).alias("alpha"), F.col(f"_sse{i}").alias("sse"), F.col(f"_lev{i}").alias("level"))
             for i, a in enumerate(alphas)]
    return s.select(*keys, "_T", F.explode(F.array(*items)).alias("_e")).select(*keys, "_T", "_e.alpha", "_e.sse", "_e.level")


def best_alpha(long: DataFrame, keys: list[str]) -> DataFrame:
    """Smallest-SSE alpha per key (ties -> smaller alpha)."""
    return long.groupBy(*keys).agg(F.max("_T").alias("_T"),
                                   F.min_by(F.struct("alpha", "level"), F.struct(F.col("sse"), F.col("alpha"))).alias("_b")) \
               .select(*keys, "_T", F.col("_b.alpha").alias("alpha"), F.col("_b.level").alias("level"))


def _emit(base: DataFrame, keys: list[str], h: int, freq: str, name: str, value: Column) -> DataFrame:
    return horizon(base, keys, h, freq).select(*keys, DS, F.lit(name).alias(MODEL), value.alias(YHAT))


def ses(train: DataFrame, h: int, alpha: float = 0.7, freq: str = "D", id_cols: str | Sequence[str] = ID,
        name: str = "SES") -> DataFrame:
    """Simple exponential smoothing with fixed ``alpha``."""
    keys = _keys(id_cols)
    lv = ses_levels(_positions(train, keys, freq), keys, [alpha])
    return _emit(lv, keys, h, freq, name, F.col("level_0"))


def ses_optimized(train: DataFrame, h: int, freq: str = "D", id_cols: str | Sequence[str] = ID,
                  grid: Sequence[float] = ALPHA_GRID, name: str = "SESOpt") -> DataFrame:
    """SES with alpha chosen per series by one-step SSE over ``grid``."""
    keys = _keys(id_cols)
    b = best_alpha(ses_sse(_positions(train, keys, freq), keys, grid), keys)
    return _emit(b, keys, h, freq, name, F.col("level"))


def seasonal_es(train: DataFrame, h: int, season: int = 7, alpha: float | None = 0.7, freq: str = "D",
                id_cols: str | Sequence[str] = ID, grid: Sequence[float] = ALPHA_GRID) -> DataFrame:
    """SES on each seasonal sub-series (the last ``floor(n/m)`` full seasons); step s
    uses the sub-series holding the value one season before.  ``alpha=None`` optimises."""
    keys = _keys(id_cols)
    x = _positions(train, keys, freq)
    x = x.where(F.col("_r") < F.floor(F.col("_n") / season) * season)
    x = x.withColumn("_ph", F.lit(season) - 1 - F.pmod(F.col("_r"), F.lit(season)))
    sub = [*keys, "_ph"]
    # sub-series positions: every phase holds floor(n/m) rows spaced one season apart
    n_sub = F.floor(F.col("_n") / season)
    r_sub = F.floor(F.col("_r") / season)
    sx = x.withColumns({"_n": n_sub, "_r": r_sub}).withColumn(POS, F.col("_n") - 1 - F.col("_r"))
    if alpha is None:
        lv = best_alpha(ses_sse(sx, sub, grid), sub)
        name = "SeasESOpt"
    else:
        lv = ses_levels(sx, sub, [alpha]).withColumnRenamed("level_0", "level")
        name = "SeasonalES"
    base = train.groupBy(*keys).agg(F.max(DS).alias("_T"))
    fut = horizon(base, keys, h, freq).withColumn("_ph", F.pmod(F.col(STEP) - 1, F.lit(season)))
    return fut.join(lv.drop("_T"), sub, "left").select(*keys, DS, F.lit(name).alias(MODEL), F.col("level").alias(YHAT))


def theta(train: DataFrame, h: int, alpha: float | None = 0.5, freq: str = "D", id_cols: str | Sequence[str] = ID,
          grid: Sequence[float] = ALPHA_GRID) -> DataFrame:
    """Standard theta method (theta = 2): SES level plus half the OLS drift,
    ``l + b0/2 * (h - 1 + 1/a - (1-a)^n / a)``; ``alpha=None`` = OptimizedTheta (grid SSE)."""
    keys = _keys(id_cols)
    x = _positions(train, keys, freq)
    slope = x.groupBy(*keys).agg(F.regr_slope(Y, F.col(POS).cast("double")).alias("_b0"), F.max("_n").alias("_n"))
    if alpha is None:
        lv = best_alpha(ses_sse(x, keys, grid), keys)
        name = "OptimizedTheta"
    else:
        lv = ses_levels(x, keys, [alpha]).select(*keys, "_T", F.lit(alpha).alias("alpha"), F.col("level_0").alias("level"))
        name = "Theta"
    base = lv.join(slope, keys)
    a = F.col("alpha")
    drift = F.coalesce(F.col("_b0"), F.lit(0.0)) / 2 * (F.col(STEP) - 1 + 1 / a - F.pow(1 - a, F.col("_n")) / a)
    return _emit(base, keys, h, freq, name, F.col("level") + drift)


# ---- intermittent demand -----------------------------------------------------------

def _known(keys: list[str]) -> Column:
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return known


def _packed(train: DataFrame, keys: list[str], freq: str) -> tuple[DataFrame, DataFrame | None]:
    """``(packed, rest)``.  ``packed`` has one row ``(*keys, _T, _n, _nd, _at, _v)`` per series: its ``_nd`` demands' steps
    since the series start and their sizes, in order.  ``rest`` are the rows of the series that do not
    fit (more than two blocks of ``ARRAY_ROWS`` steps, or NULL values), None without such series.

    Zeros are counted where they are; only demands are shuffled, and stored once.  A NULL key has no demand."""
    x = regular_positions(train.select(*keys, DS, Y), freq).withColumn(BLOCK, F.floor(F.col(POS) / ARRAY_ROWS))
    demand = F.when((F.col(Y) != 0) & _known(keys), F.struct(F.col(POS).alias("p"), F.col(Y).cast("double").alias("y")))
    b = store(x.groupBy(*keys, BLOCK).agg(F.count(F.lit(1)).alias("_n"), F.count(Y).alias("_ny"), F.min(DS).alias("_t0"),
                                          F.max(DS).alias("_T"), F.collect_list(demand).alias("_d")))
    s = b.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.sum("_ny").alias("_ny"), F.min("_t0").alias("_t0"), F.max("_T").alias("_T"),
                             F.count(F.lit(1)).alias("_nb"), F.min_by("_d", BLOCK).alias("_d0"), F.max_by("_d", BLOCK).alias("_d1"))
    regular = ~_known(keys) | (steps_between(F.col("_t0"), F.col("_T"), freq) + 1 == F.col("_n"))
    gap = F.raise_error(F.concat(F.lit("irregular series, pad it by time first: "), F.to_json(F.struct(*keys)))).cast("long")
    s = s.withColumn("_n", F.when(regular, F.col("_n")).otherwise(gap))
    fits = ~_known(keys) | ((F.col("_nb") <= 2) & (F.col("_ny") == F.col("_n")))
    long = s.where(~fits).select(*keys)
    rest = None if long.isEmpty() else train.join(long, keys, "left_semi")
    first = steps_between(F.lit(EPOCH).cast("timestamp_ntz"), F.col("_t0"), freq)
    d = F.array_sort(F.when(F.col("_nb") == 1, F.col("_d0")).otherwise(F.concat("_d0", "_d1")))
    p = s.where(fits).select(*keys, "_T", "_n", d.alias("_d"), first.alias("_first"))
    return p.select(*keys, "_T", "_n", F.size("_d").alias("_nd"), F.transform("_d", lambda e: e["p"] - F.col("_first")).alias("_at"),
                    F.transform("_d", lambda e: e["y"]).alias("_v")), rest


def _with_rest(packed: DataFrame, rest: DataFrame | None, rows: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return packed if rest is None else packed.unionByName(rows(rest))


def _intervals(at: str) -> Column:
    """Steps since the previous demand; the first counts from one step before the series start."""
    return F.transform(at, lambda e, i: (e - F.when(i == 0, F.lit(-1).cast("long")).otherwise(F.get(at, i - 1))).cast("double"))


def _ses_level(values: Column, alpha: float) -> Column:
    """Final SES level of an array, NULL if it is empty."""
    return F.aggregate(F.slice(values, 2, F.size(values)), F.get(values, 0), lambda level, v: level * (1.0 - alpha) + v * alpha)


#: series searched together in a task
SEARCH_ROWS = 1024


def _search_plan(spark: SparkSession, grid: Sequence[float]) -> tuple:
    """Alphas in rising order with the powers and carries of :func:`decay_scan` (the same doubles: Spark's own powers)."""
    grid = sorted(grid)
    betas = [1.0 - a for a in grid]
    length = decay_block(betas)
    length = min(length, 2 * ARRAY_ROWS)
    t = spark.range(length).coalesce(1).select(F.array(*[F.pow(F.lit(b), -F.col("id")) for b in betas]), F.array(*[F.pow(F.lit(b), F.col("id")) for b in betas]))
    rows = t.collect()
    return np.array(grid), np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), [decay_carries(b, length) for b in betas]


def _ses_search(v: np.ndarray, size: np.ndarray, plan: tuple) -> np.ndarray:
    """Level of the smallest-SSE alpha of each column of ``v`` (steps x series, ``size`` steps each, longest first).

    Step for step the arithmetic of :func:`ses_sse`, so that both settle near-ties alike."""
    grid, down, up, carries = plan
    a, b = grid[:, None], (1.0 - grid)[:, None]
    level, sse, total, start = (np.zeros((len(grid), v.shape[1])) for _ in range(4))
    live = np.searchsorted(-size, -np.arange(len(v)))
    sums: list[np.ndarray] = []
    for j in range(len(v)):
        o = j % len(down)
        if j and o == 0:
            sums.insert(0, total)
            total = np.zeros_like(total)
            start = np.array([sum((f * s[i] for f, s in zip(fs, sums)), np.zeros(v.shape[1])) for i, fs in enumerate(carries)])
        n = live[j]
        y = v[j, :n]
        ay = a * y if j else np.broadcast_to(y, (len(grid), n))
        total[:, :n] += down[o][:, None] * ay
        now = up[o][:, None] * (start[:, :n] + total[:, :n])
        level[:, :n] = now
        if j:
            e = y - (now - ay) / b
            sse[:, :n] += e * e
    pick = np.where(np.isnan(sse), np.inf, sse).argmin(axis=0)
    return level[pick, np.arange(v.shape[1])]


def _ragged(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and their offsets."""
    at = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]], at - at[0]


def _map_packed(packed: DataFrame, keys: list[str], out: Sequence[str], fn: Callable[..., Sequence[np.ndarray]],
                scalars: Sequence[str] = ()) -> DataFrame:
    """Rows ``(*keys, _T, *out)``: ``fn(row, at, v, **scalars)`` gets the demands of up to ``SEARCH_ROWS`` series, ``row``
    numbering them, and returns arrays of doubles with a value per series (NaN from no value is NULL)."""
    kinds = {f.name: f.dataType.simpleString() for f in packed.schema}
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in [*keys, "_T"]] + [f"`{o}` double" for o in out])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, SEARCH_ROWS):
                b = whole.slice(i, SEARCH_ROWS)
                (at, off), (v, _) = _ragged(b.column("_at")), _ragged(b.column("_v"))
                row = np.repeat(np.arange(b.num_rows), np.diff(off))
                got = fn(row, at, v, *[b.column(s).to_numpy(zero_copy_only=False) for s in scalars], b.num_rows)
                yield pa.RecordBatch.from_arrays([b.column(k) for k in [*keys, "_T"]] + [pa.array(g, pa.float64()) for g in got], [*keys, "_T", *out])

    return _bounded(packed.select(*keys, "_T", "_at", "_v", *scalars)).mapInArrow(work, schema)


def _search_demands(plan: tuple) -> Callable[..., Sequence[pa.Array]]:
    def levels(row: np.ndarray, at: np.ndarray, v: np.ndarray, count: int) -> list[pa.Array]:
        size = np.bincount(row, minlength=count)
        order = np.argsort(-size, kind="stable")
        place = np.empty(count, np.int64)
        place[order] = np.arange(count)
        j = np.arange(len(row)) - (np.cumsum(size) - size)[row]
        gaps = at - np.where(j == 0, -1, np.concatenate([[0], at[:-1]])) if len(at) else at
        out = []
        for values in (v, gaps.astype(float)):
            m = np.zeros((size.max(initial=0), count))
            m[j, place[row]] = values
            out.append(pa.array(_ses_search(m, size[order], plan)[place], mask=size == 0))
        return out
    return levels


def _search_buckets(plan: tuple, all_levels: bool) -> Callable[..., Sequence[np.ndarray]]:
    """Mean over the levels ``k`` (``all_levels``: and all below) of the searched SES level of the sums of ``k`` steps, over ``k``."""
    def levels(row: np.ndarray, at: np.ndarray, v: np.ndarray, n: np.ndarray, k: np.ndarray, count: int) -> list[np.ndarray]:
        total = np.zeros(count)
        order = np.argsort(-n, kind="stable")
        for level in range(1, k.max() + 1) if all_levels else np.unique(k):
            sel = order[(k[order] >= level) if all_levels else (k[order] == level)]
            place = np.full(count, -1)
            place[sel] = np.arange(len(sel))
            size = n[sel] // level
            bucket = at // level
            use = (place[row] >= 0) & (bucket < (n // level)[row])
            m = np.bincount(bucket[use] * len(sel) + place[row[use]], weights=v[use], minlength=int(size[0]) * len(sel))
            total[sel] += _ses_search(m.reshape(-1, len(sel)), size, plan) / level
        return [total / k if all_levels else total]
    return levels


def _demand_rows(train: DataFrame, keys: list[str], freq: str | None) -> DataFrame:
    """Non-zero rows with ``interval`` = steps since the previous demand (the first demand
    counts from one step before the series start) and, for SES over the demands,
    ``_pos``/``_n``/``_r`` numbered among the demand rows.  Built from a block carry of
    the previous demand position and a block prefix count, never a per-series window."""
    x = _positions(train, keys, freq)
    x = x.withColumn("_p0", F.col(POS) - (F.col("_n") - 1 - F.col("_r")))  # first position of the series
    x = x.withColumn("_dp", F.when(F.col(Y) != 0, F.col(POS)))
    x = forward_scan(x, last={"_prevd": "_dp"}, sums={"_rk": (F.col(Y) != 0).cast("long")}, id_cols=keys)
    d = x.where(F.col(Y) != 0)
    nd = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nd"))
    d = (d.withColumn("interval", (F.col(POS) - F.coalesce(F.col("_prevd"), F.col("_p0") - 1)).cast("double"))
          .drop("_n", "_r", POS).join(nd, keys)
          .withColumn(POS, F.col("_rk") - 1).withColumnRenamed("_nd", "_n")
          .withColumn("_r", F.col("_n") - 1 - F.col(POS)))
    return d.drop("_dp", "_prevd", "_rk", "_p0")


def croston(train: DataFrame, h: int, variant: str = "classic", alpha: float = 0.1, freq: str = "D",
            id_cols: str | Sequence[str] = ID) -> DataFrame:
    """Croston ``classic`` (SES a=0.1 on sizes and intervals, forecast size/interval),
    ``sba`` (times 1 - a/2) or ``optimized`` (each SES alpha by SSE on 0.10..0.30)."""
    keys = _keys(id_cols)
    packed, rest = _packed(train, keys, freq)
    if variant == "optimized":
        lv = _map_packed(packed, keys, ["_z", "_p"], _search_demands(_search_plan(train.sparkSession, CROSTON_GRID)))
        factor, name = 1.0, "CrostonOptimized"
    else:
        lv = packed.withColumn("_iv", _intervals("_at")).select(*keys, "_T", _ses_level(F.col("_v"), alpha).alias("_z"),
                                                                _ses_level(F.col("_iv"), alpha).alias("_p"))
        factor, name = (1.0 - alpha / 2, "CrostonSBA") if variant == "sba" else (1.0, "CrostonClassic")
    out = _emit(lv, keys, h, freq, name, F.coalesce(F.lit(factor) * F.col("_z") / F.col("_p"), F.lit(0.0)))
    return _with_rest(out, rest, lambda x: _croston_rows(x, h, variant, alpha, freq, keys))


def _croston_rows(train: DataFrame, h: int, variant: str, alpha: float, freq: str, keys: list[str]) -> DataFrame:
    """:func:`croston` by row plans, for series of any length."""
    last = train.groupBy(*keys).agg(F.max(DS).alias("_T"))
    dp = _demand_rows(train, keys, freq)
    if variant == "optimized":
        z = best_alpha(ses_sse(dp, keys, CROSTON_GRID, Y), keys).select(*keys, F.col("level").alias("_z"))
        p = best_alpha(ses_sse(dp, keys, CROSTON_GRID, "interval"), keys).select(*keys, F.col("level").alias("_p"))
        lv = z.join(p, keys)
        factor, name = 1.0, "CrostonOptimized"
    else:
        lv = dp.groupBy(*keys).agg(F.sum(ses_weight(alpha) * F.col(Y)).alias("_z"),
                                   F.sum(ses_weight(alpha) * F.col("interval")).alias("_p"))
        factor, name = (1.0 - alpha / 2, "CrostonSBA") if variant == "sba" else (1.0, "CrostonClassic")
    base = last.join(lv, keys, "left")
    return _emit(base, keys, h, freq, name, F.coalesce(F.lit(factor) * F.col("_z") / F.col("_p"), F.lit(0.0)))


def tsb(train: DataFrame, h: int, alpha_d: float = 0.2, alpha_p: float = 0.2, freq: str = "D",
        id_cols: str | Sequence[str] = ID) -> DataFrame:
    """Teunter-Syntetos-Babai: SES(alpha_p) of the demand indicator over all rows times
    SES(alpha_d) of the demand sizes."""
    keys = _keys(id_cols)
    packed, rest = _packed(train, keys, freq)
    after = lambda e: (F.col("_n") - 1 - e).cast("double")
    weight = lambda e: F.pow(F.lit(1.0 - alpha_p), after(e)) * F.when(e == 0, F.lit(1.0)).otherwise(F.lit(float(alpha_p)))
    lv = packed.where(_known(keys)).select(*keys, "_T", F.aggregate("_at", F.lit(0.0), lambda p, e: p + weight(e)).alias("_p"),
                                           _ses_level(F.col("_v"), alpha_d).alias("_z"))
    out = _emit(lv, keys, h, freq, "TSB", F.coalesce(F.col("_p") * F.col("_z"), F.lit(0.0)))
    return _with_rest(out, rest, lambda x: _tsb_rows(x, h, alpha_d, alpha_p, freq, keys))


def _tsb_rows(train: DataFrame, h: int, alpha_d: float, alpha_p: float, freq: str, keys: list[str]) -> DataFrame:
    """:func:`tsb` by row plans, for series of any length."""
    allp = _positions(train, keys, freq)
    p = allp.groupBy(*keys).agg(F.max("_T").alias("_T"),
                                F.sum(ses_weight(alpha_p) * (F.col(Y) != 0).cast("double")).alias("_p"))
    d = _demand_rows(train, keys, freq)
    z = d.groupBy(*keys).agg(F.sum(ses_weight(alpha_d) * F.col(Y)).alias("_z"))
    base = p.join(z, keys, "left")
    return _emit(base, keys, h, freq, "TSB", F.coalesce(F.col("_p") * F.col("_z"), F.lit(0.0)))


def _agg_level(train: DataFrame, keys: list[str], freq: str | None = None) -> DataFrame:
    """ADIDA aggregation level: mean demand interval rounded half-to-even."""
    d = _demand_rows(train, keys, freq).groupBy(*keys).agg(F.bround(F.avg("interval"), 0).cast("int").alias("_k"))
    # a series without demand has level 1 (its sums are zero at any level)
    return train.select(*keys).distinct().join(d, keys, "left").withColumn("_k", F.coalesce("_k", F.lit(1)))


def _aggregated(train: DataFrame, h: int, freq: str, keys: list[str], grid: Sequence[float], name: str,
                rows: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """ADIDA (IMAPA: the mean over all levels up to its own) of packed series."""
    if not all(0.0 < a < 1.0 for a in grid):
        return rows(train)
    packed, rest = _packed(train, keys, freq)
    # the intervals of a series sum up to its last demand's step, counted from 1
    k = F.when(F.col("_nd") > 0, F.bround((F.get("_at", F.col("_nd") - 1) + 1) / F.col("_nd"), 0).cast("int")).otherwise(F.lit(1))
    lv = _map_packed(packed.where(_known(keys)).withColumn("_k", k), keys, [YHAT], _search_buckets(_search_plan(train.sparkSession, grid), name == "IMAPA"), ["_n", "_k"])
    return _with_rest(_emit(lv, keys, h, freq, name, F.col(YHAT)), rest, rows)


def adida(train: DataFrame, h: int, freq: str = "D", id_cols: str | Sequence[str] = ID,
          grid: Sequence[float] = ALPHA_GRID, levels: DataFrame | None = None, name: str = "ADIDA") -> DataFrame:
    """M23 ADIDA: sum non-overlapping buckets of ``k`` = mean interval steps (from the
    series start, the incomplete last bucket dropped), optimised SES on the bucket sums,
    forecast = level / k per step."""
    keys = _keys(id_cols)
    if levels is not None:
        return _adida_rows(train, h, freq, keys, grid, levels, name)
    return _aggregated(train, h, freq, keys, grid, name, lambda x: _adida_rows(x, h, freq, keys, grid, None, name))


def _adida_rows(train: DataFrame, h: int, freq: str, keys: list[str], grid: Sequence[float], levels: DataFrame | None, name: str) -> DataFrame:
    """:func:`adida` by row plans, for series of any length."""
    k = levels if levels is not None else _agg_level(train, keys, freq)
    x = _positions(train, keys, freq).join(k, keys).where(F.col("_k") >= 1)
    since_start = F.col("_n") - 1 - F.col("_r")
    x = x.withColumn("_bk", F.floor(since_start / F.col("_k"))).where(F.col("_bk") < F.floor(F.col("_n") / F.col("_k")))
    b = x.groupBy(*keys, "_bk").agg(F.sum(Y).alias(Y), F.max("_k").alias("_k"), F.max("_T").alias("_T"),
                                    F.max(F.floor(F.col("_n") / F.col("_k"))).alias("_n"))
    # bucket series: dense positions 0..nb-1
    bp = b.withColumn(POS, F.col("_bk").cast("long")).withColumn("_r", F.col("_n") - 1 - F.col(POS))
    lv = best_alpha(ses_sse(bp, keys, grid), keys).drop("_T")
    # a series shorter than its level has no bucket and a NULL forecast
    base = train.groupBy(*keys).agg(F.max(DS).alias("_T")).join(lv, keys, "left").join(k, keys)
    return _emit(base, keys, h, freq, name, F.col("level") / F.col("_k"))


def imapa(train: DataFrame, h: int, freq: str = "D", id_cols: str | Sequence[str] = ID,
          grid: Sequence[float] = ALPHA_GRID) -> DataFrame:
    """M23 IMAPA: mean of the ADIDA forecasts at every level 1..k (k = mean interval).  A
    series without demand forecasts 0."""
    keys = _keys(id_cols)
    return _aggregated(train, h, freq, keys, grid, "IMAPA", lambda x: _imapa_rows(x, h, freq, keys, grid))


def _imapa_rows(train: DataFrame, h: int, freq: str, keys: list[str], grid: Sequence[float]) -> DataFrame:
    """:func:`imapa` by row plans, for series of any length."""
    k = _agg_level(train, keys, freq)
    lv = k.select(*keys, F.explode(F.sequence(F.lit(1), F.greatest(F.col("_k"), F.lit(1)))).alias("_k"))
    lv = lv.withColumn("_lvl", F.col("_k"))
    fc = _adida_rows(train.join(lv.select(*keys, "_lvl"), keys), h, freq, [*keys, "_lvl"], grid, lv, "IMAPA")
    return fc.groupBy(*keys, DS, MODEL).agg(F.avg(YHAT).alias(YHAT))


# ---- Holt's linear trend ------------------------------------------------------------

def _power_coeffs(alpha: float, beta: float):
    """For Holt's transition matrix A (state = level, trend) return a function mapping a
    column ``r`` to ``(a_r, b_r)`` with ``A^r = a_r A + b_r I`` (Cayley-Hamilton), using
    the eigenvalues of A: real distinct, repeated or complex."""
    tr = 2.0 - alpha - alpha * beta
    det = 1.0 - alpha
    disc = tr * tr - 4.0 * det

    def a_of(r: Column) -> Column:
        if disc > 1e-14:
            l1, l2 = (tr + math.sqrt(disc)) / 2, (tr - math.sqrt(disc)) / 2
            return (F.pow(F.lit(l1), r) - F.pow(F.lit(l2), r)) / F.lit(l1 - l2)
        if disc < -1e-14:
            rho, theta = math.sqrt(det), math.acos(tr / (2 * math.sqrt(det)))
            return F.pow(F.lit(rho), r - 1) * F.sin(r * F.lit(theta)) / F.lit(math.sin(theta))
        lam = tr / 2
        return r * F.pow(F.lit(lam), r - 1)

    def coeffs(r: Column) -> tuple[Column, Column]:
        a_r = F.when(r == 0, F.lit(0.0)).otherwise(a_of(r))
        a_rm1 = F.when(r <= 1, F.lit(0.0)).otherwise(a_of(r - 1))
        b_r = F.when(r == 0, F.lit(1.0)).otherwise(-det * a_rm1)
        return a_r, b_r

    A = ((1 - alpha, 1 - alpha), (-alpha * beta, 1 - alpha * beta))
    c = (alpha, alpha * beta)
    return coeffs, A, c


def holt(train: DataFrame, h: int, alpha: float = 0.3, beta: float = 0.1, freq: str = "D",
         id_cols: str | Sequence[str] = ID, name: str = "Holt") -> DataFrame:
    """M12 Holt's linear method, ``l_0 = y_0``, ``b_0 = y_1 - y_0``; forecast ``l + s*b``.

    The final state ``A^(n-1) s_0 + sum_(j>=1) A^(n-1-j) c y_j`` is one weighted aggregate
    per series: the weights ``A^r c`` have a closed form in ``r`` (Cayley-Hamilton)."""
    keys = _keys(id_cols)
    coeffs, A, c = _power_coeffs(alpha, beta)
    Ac = (A[0][0] * c[0] + A[0][1] * c[1], A[1][0] * c[0] + A[1][1] * c[1])
    x = _positions(train, keys, freq)
    a_r, b_r = coeffs(F.col("_r"))
    wl = a_r * Ac[0] + b_r * c[0]
    wb = a_r * Ac[1] + b_r * c[1]
    first = F.col("_r") == F.col("_n") - 1
    second = F.col("_r") == F.col("_n") - 2
    agg = x.groupBy(*keys).agg(
        F.max("_T").alias("_T"), F.max("_n").alias("_n"),
        F.sum(F.when(~first, wl * F.col(Y))).alias("_sl"), F.sum(F.when(~first, wb * F.col(Y))).alias("_sb"),
        F.max(F.when(first, F.col(Y))).alias("_y0"), F.max(F.when(second, F.col(Y))).alias("_y1"))
    # A^(n-1) s_0 with s_0 = (y0, y1 - y0)
    an, bn = coeffs(F.col("_n") - 1)
    l0, b0 = F.col("_y0"), F.coalesce(F.col("_y1") - F.col("_y0"), F.lit(0.0))
    init_l = an * (A[0][0] * l0 + A[0][1] * b0) + bn * l0
    init_b = an * (A[1][0] * l0 + A[1][1] * b0) + bn * b0
    base = agg.withColumn("_l", init_l + F.coalesce(F.col("_sl"), F.lit(0.0))).withColumn("_b", init_b + F.coalesce(F.col("_sb"), F.lit(0.0)))
    return _emit(base, keys, h, freq, name, F.col("_l") + F.col(STEP) * F.col("_b"))


# ---- temporal hierarchy -------------------------------------------------------------

def thief(train: DataFrame, h: int, season: int = 7, alpha: float = 0.3, freq: str = "D",
          id_cols: str | Sequence[str] = ID) -> DataFrame:
    """M24 temporal-hierarchy forecast (two levels: the base frequency and its seasonal
    aggregate).  SES forecasts at both levels are reconciled by weighted least squares
    with structural weights (variance proportional to the periods aggregated): for each
    future season block, ``b_i = d_i + (w - sum d) / (2m)``."""
    keys = _keys(id_cols)
    x = _positions(train, keys, freq)
    daily = ses_levels(x, keys, [alpha]).select(*keys, "_T", F.col("level_0").alias("_ld"))
    # seasonal blocks counted back from the last time; the incomplete oldest block is dropped
    blk = x.withColumn("_bk", F.floor(F.col("_r") / season)).where(F.col("_bk") < F.floor(F.col("_n") / season))
    wk = blk.groupBy(*keys, "_bk").agg(F.sum(Y).alias(Y), F.max(F.floor(F.col("_n") / season)).alias("_n"))
    wk = wk.withColumn("_r", F.col("_bk")).withColumn(POS, F.col("_n") - 1 - F.col("_r")).withColumn("_T", F.lit(None))
    weekly = ses_levels(wk, keys, [alpha]).select(*keys, F.col("level_0").alias("_lw"))
    base = daily.join(weekly, keys, "left")
    rec = F.col("_ld") + F.coalesce((F.col("_lw") - season * F.col("_ld")) / (2.0 * season), F.lit(0.0))
    return _emit(base, keys, h, freq, "THIEF", rec)


def mstl_forecast(train: DataFrame, h: int, periods: Sequence[int] = (7, 30), alpha: float | None = 0.3, freq: str = "D",
                  id_cols: str | Sequence[str] = ID, method: str = "classical", name: str = "MSTL") -> DataFrame:
    """Multiple seasonal decomposition (``method`` 'classical' or 'loess'); the seasonally adjusted
    series is forecast by SES (``alpha=None`` optimises), each seasonal component by its seasonal naive; the
    forecasts are summed."""
    from chronoweave.operators import diagnostics, stl
    from chronoweave.operators.baselines import seasonal_naive
    keys = _keys(id_cols)
    mstl = stl.mstl if method == "loess" else diagnostics.mstl
    d = mstl(train, Y, periods, freq=freq, id_cols=keys, digits=12)
    seas = sum((F.col(f"seasonal_{p}") for p in periods), F.lit(0.0))
    adj = d.select(*keys, DS, (F.col(Y) - seas).alias(Y))
    level = ses_optimized(adj, h, freq, keys) if alpha is None else ses(adj, h, alpha, freq, keys)
    fc = level.select(*keys, DS, F.col(YHAT).alias("_f"))
    for p in periods:
        sp = seasonal_naive(d.select(*keys, DS, F.col(f"seasonal_{p}").alias(Y)), h, p, freq, keys)
        fc = fc.join(sp.select(*keys, DS, F.col(YHAT).alias(f"_s{p}")), [*keys, DS])
    total = F.col("_f") + sum((F.col(f"_s{p}") for p in periods), F.lit(0.0))
    return fc.select(*keys, DS, F.lit(name).alias(MODEL), total.alias(YHAT))
