"""Seasonal ARIMA with regressors by conditional least squares.

On the differenced scale w_t = z_t'b + n_t with phi(B) Phi(B^m) n_t = theta(B) Theta(B^m) e_t.  The innovations e_t
and their derivatives in all parameters are linear recursions whose state is a few values; blocks of
time run them in parallel (:func:`chronoweave.plans.blocks.fold_summaries`) and return e'e, J'e and J'J, which add up to
the normal equations of a damped Gauss-Newton step for each series.  A pass serves all series, all
candidate orders and several damping factors at once; between passes there is one small row per
(series, candidate).

Differencing is chosen by tests: a seasonal difference where the season of an STL decomposition is strong, ordinary ones
while the KPSS statistic rejects a constant level.  Both statistics are aggregates over block scans.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.timekeys import add_steps, steps_between
from chronoweave.operators.baselines import MODEL, YHAT
from chronoweave.operators.stl import stl
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.blocks import ARRAY_ROWS, BLOCK, _bounded, fold_summaries, gather
from chronoweave.plans.series import POS, _keys, halo_window, positioned, prefix_sums
from chronoweave.session import store

#: damping factors tried in a pass, as multiples of a candidate's present one
TRIALS = (0.1, 10.0)
#: 5 % point of the KPSS statistic for a constant level
KPSS_LEVEL = 0.463
#: share of the detrended variance above which a season counts as strong
SEASON_STRENGTH = 0.64


@dataclass(frozen=True)
class Order:
    """(p, q)(P, Q)[m] on the differenced scale."""

    p: int
    q: int
    P: int
    Q: int
    m: int

    @property
    def back(self) -> int:
        return self.p + self.m * self.P

    @property
    def memory(self) -> int:
        return self.q + self.m * self.Q

    @property
    def size(self) -> int:
        return self.p + self.P + self.q + self.Q

    def split(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """phi, Phi, theta, Theta."""
        return tuple(np.split(x, np.cumsum([self.p, self.P, self.q])))


def polynomial(short: np.ndarray, long: np.ndarray, m: int, sign: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coefficients of (1 + sign sum short_i B^i), (1 + sign sum long_j B^(mj)) and of their product."""
    a = np.r_[1.0, sign * short]
    b = np.zeros(len(long) * m + 1)
    b[0] = 1.0
    if len(long):
        b[m::m] = sign * long
    return a, b, np.convolve(a, b)


def innovations(order: Order, x: np.ndarray, w: np.ndarray, z: np.ndarray, state: np.ndarray, pos: np.ndarray, skip: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(e, J, end state) on consecutive rows: innovations, their derivatives in the parameters ``x`` (regression
    coefficients first), and what the next block needs.  Before row ``skip`` of a series both are 0."""
    k, r, n = len(x), z.shape[1], len(w)
    R, S = order.back, order.memory
    wl, zl, el, jl = np.split(state, np.cumsum([R, R * r, S]))
    we, ze = np.r_[wl, w], np.concatenate([zl.reshape(R, r), z])
    phi, Phi, theta, Theta = order.split(x[r:])
    a, A, ar = polynomial(phi, Phi, order.m, -1.0)
    b, B, ma = polynomial(theta, Theta, order.m, 1.0)
    live = (pos >= skip).astype(float)
    ne = we - ze @ x[:r]

    def lagged(v: np.ndarray, poly: np.ndarray, reach: int, shift: int = 0) -> np.ndarray:
        """poly(B) v at the block's rows, ``shift`` rows back; v starts ``reach`` rows before them."""
        return np.convolve(v, poly)[reach - shift:reach - shift + n]
    u = lagged(ne, ar, R) * live
    taps = [(j, c) for j, c in enumerate(ma[1:], 1) if c != 0.0]
    e = np.r_[el, np.zeros(n)]
    uv, lv = u.tolist(), live.tolist()
    ev = e.tolist()
    for t in range(n):
        if lv[t]:
            v = uv[t]
            for j, c in taps:
                v -= c * ev[S + t - j]
            ev[S + t] = v
    e = np.array(ev)
    src = np.empty((n, k))
    for i in range(r):
        src[:, i] = -lagged(ze[:, i], ar, R)
    at = r
    for i in range(order.p):
        src[:, at + i] = -lagged(ne, A, R, i + 1)
    at += order.p
    for i in range(order.P):
        src[:, at + i] = -lagged(ne, a, R, order.m * (i + 1))
    at += order.P
    for i in range(order.q):
        src[:, at + i] = -lagged(e, B, S, i + 1)
    at += order.q
    for i in range(order.Q):
        src[:, at + i] = -lagged(e, b, S, order.m * (i + 1))
    src *= live[:, None]
    J = np.concatenate([jl.reshape(S, k), src])
    if taps:
        for t in range(S, S + n):
            for j, c in taps:
                J[t] -= c * J[t - j]
            J[t] *= live[t - S]
    end = np.concatenate([we[len(we) - R:], ze[len(ze) - R:].ravel(), e[len(e) - S:], J[len(J) - S:].ravel()])
    return e[S:], J[S:], end


def difference_lags(d: int, D: int, m: int) -> np.ndarray:
    """Coefficients of (1 - B)^d (1 - B^m)^D."""
    out = np.array([1.0])
    for _ in range(d):
        out = np.convolve(out, [1.0, -1.0])
    for _ in range(D):
        out = np.convolve(out, np.r_[1.0, np.zeros(m - 1), -1.0])
    return out


def _difference(c: str, w, d: int, D: int, m: int) -> Column:
    terms = [F.lit(float(v)) * (F.lag(c, k).over(w) if k else F.col(c)) for k, v in enumerate(difference_lags(d, D, m)) if v]
    return sum(terms[1:], terms[0])


def kpss(df: DataFrame, value_col: str, id_cols: str | Sequence[str] = ID) -> DataFrame:
    """(keys, n, kpss): the KPSS statistic of a constant level on a regular grid, with Bartlett weights up to lag
    4 (n / 100)^(1/4).  NULL for a constant or empty series."""
    keys = _keys(id_cols)
    x = df.where(F.col(value_col).isNotNull())
    stat = x.groupBy(*keys).agg(F.avg(value_col).alias("_m"), F.count(F.lit(1)).alias("n"))
    longest = stat.agg(F.max("n")).first()[0] or 1
    most = max(1, int(4 * (longest / 100) ** 0.25))
    x = x.join(stat, keys).withColumn("_c", F.col(value_col) - F.col("_m"))
    x = prefix_sums(x, {"_s": F.col("_c")}, keys)
    x = halo_window(x, most, 0, lambda w: {f"_l{k}": F.lag("_c", k).over(w) for k in range(1, most + 1)}, keys)
    lag = F.floor(4 * F.pow(F.col("n") / 100, 0.25))
    g = x.groupBy(*keys).agg(F.first("n").alias("n"), F.sum(F.col("_s") * F.col("_s")).alias("_ss"), F.sum(F.col("_c") * F.col("_c")).alias("_g0"),
                             *[F.sum(F.col("_c") * F.col(f"_l{k}")).alias(f"_g{k}") for k in range(1, most + 1)])
    spread = F.col("_g0") + sum((F.when(k <= lag, 2 * (1 - F.lit(k) / (lag + 1)) * F.coalesce(f"_g{k}", F.lit(0.0))).otherwise(0.0)
                                 for k in range(1, most + 1)), F.lit(0.0))
    return g.select(*keys, "n", F.try_divide(F.col("_ss"), F.when(spread > 0, spread) * F.col("n")).alias("kpss"))


def choose_differences(train: DataFrame, m: int, freq: str, id_cols: str | Sequence[str] = ID, most: int = 2) -> DataFrame:
    """(keys, nd, ns): ns = 1 where the seasonal strength 1 - var(remainder) / var(season + remainder) of an STL decomposition
    exceeds 0.64, then nd = 0 .. ``most`` ordinary differences until KPSS does not reject a constant level."""
    keys = _keys(id_cols)
    if m > 1:
        dec = stl(train.select(*keys, DS, Y), Y, m, 2 * (m // 2) + 7, freq=freq, id_cols=keys, digits=None)
        strength = 1 - F.try_divide(F.var_samp("remainder"), F.var_samp(F.col("season") + F.col("remainder")))
        chosen = dec.groupBy(*keys).agg(F.coalesce((strength > SEASON_STRENGTH).cast("int"), F.lit(0)).alias("ns"))
    else:
        chosen = train.groupBy(*keys).agg(F.lit(0).alias("ns"))
    chosen = store(chosen.withColumn("nd", F.lit(0)))
    x = positioned(train.select(*keys, DS, Y), keys, freq)[0]
    for d in range(most):
        test = []
        for D in (0, 1) if m > 1 else (0,):
            now = halo_window(x, max(1, d + m * D), 0, lambda w, d=d, D=D: {"_w": _difference(Y, w, d, D, m)}, keys)
            part = chosen.where((F.col("nd") == d) & (F.col("ns") == D))
            test.append(kpss(now.join(part.select(*keys), keys, "left_semi"), "_w", keys))
        stat = test[0] if len(test) == 1 else test[0].unionByName(test[1])
        more = F.coalesce((F.col("kpss") > KPSS_LEVEL) & (F.col("nd") == d), F.lit(False))
        chosen = store(chosen.join(stat.select(*keys, "kpss"), keys, "left").withColumn("nd", F.col("nd") + more.cast("int")).drop("kpss"))
    return chosen


def _propose(order: Order, r: int, best: dict) -> list[list[float]]:
    """The next parameters to try: one damped Gauss-Newton step for every damping factor."""
    x, k = np.array(best["x"]), len(best["x"])
    jj, je = np.array(best["jj"]).reshape(k, k), np.array(best["je"])
    scale = np.where(np.diag(jj) > 0, np.diag(jj), 1.0)
    out = []
    for f in TRIALS:
        step = np.linalg.lstsq(jj + np.diag(scale * best["damp"] * f), -je, rcond=None)[0] if k else np.zeros(0)
        out.append((x + step).tolist())
    return out


def fit_sarimax(train: DataFrame, differences: DataFrame | tuple[int, int], orders: Sequence[tuple[int, int, int, int]], m: int = 7,
                regressors: Sequence[str] = (), constant: bool = True, passes: int = 8, freq: str = "D", id_cols: str | Sequence[str] = ID,
                block_rows: int = ARRAY_ROWS) -> DataFrame:
    """One row per series and order (p, q, P, Q): parameters ``x`` (regressors, then the constant where d + D <= 1, then phi, Phi, theta, Theta), ``sse``, ``rows`` that
    count, ``aicc``, the last ``state``, nd and ns (the differences).

    Series must be on a regular grid without NULLs, regressors as well.  Innovations before the longest order's reach are 0 and do not count, the
    same for all orders.  A series with fewer rows than an order needs keeps that order's start parameters (zeros) with an infinite criterion."""
    keys = _keys(id_cols)
    specs = [Order(p, q, P, Q, m) for p, q, P, Q in orders]
    skip = max(o.back for o in specs)
    x = positioned(train.select(*keys, DS, F.col(Y).cast("double").alias(Y), *[F.col(c).cast("double").alias(c) for c in regressors]), keys, freq)[0]
    if isinstance(differences, tuple):
        differences = x.select(*keys).distinct().withColumns({"nd": F.lit(differences[0]), "ns": F.lit(differences[1])})
    differences = store(differences.select(*keys, F.col("nd").cast("int").alias("nd"), F.col("ns").cast("int").alias("ns")))
    kinds = sorted({(r["nd"], r["ns"]) for r in differences.select("nd", "ns").distinct().collect()}) or [(0, 0)]
    parts = []
    for d, D in kinds:
        now = x.join(differences.where((F.col("nd") == d) & (F.col("ns") == D)), keys)
        cols = {"_w": Y, **{f"_z{i}": c for i, c in enumerate(regressors)}}
        now = halo_window(now, max(1, d + m * D), 0, lambda w, d=d, D=D: {o: _difference(c, w, d, D, m) for o, c in cols.items()}, keys)
        parts.append(now.where("_w is not null").withColumn("_one", F.lit(1.0 if constant and d + D <= 1 else 0.0)))
    w = parts[0]
    for p in parts[1:]:
        w = w.unionByName(p)
    w = w.join(w.groupBy(*keys).agg(F.min(POS).alias("_p0"), F.count(F.lit(1)).alias("_rows")), keys).withColumn(POS, F.col(POS) - F.col("_p0"))
    zs = [*[f"_z{i}" for i in range(len(regressors))], *(["_one"] if constant else [])]
    r = len(zs)
    blocks = store(gather(w, ["_w", *zs], keys, POS, max(block_rows, 1), scalars=["_rows"]))
    head = ", ".join(f"`{k}` {blocks.schema[k].dataType.simpleString()}" for k in keys)

    def init(_c: int, _x: list[float], _rows: int) -> np.ndarray:
        o = specs[_c]
        return np.zeros(o.back * (1 + r) + o.memory * (1 + r + o.size))

    def measure(p, state, wv, *rest, _c, _x, _rows):
        o, par = specs[_c], np.array(_x)
        with np.errstate(all="ignore"):
            e, J, end = innovations(o, par, wv, np.array(rest).T.reshape(len(wv), r), state, p, skip)
            if not (np.isfinite(e).all() and np.isfinite(J).all()):  # the candidate is not invertible
                return np.full(1 + len(par) + len(par) ** 2, 1e300), np.zeros(len(end))
            return np.concatenate([[e @ e], J.T @ e, (J.T @ J).ravel()]), end

    # one row per series and candidate: the best parameters so far with their normal equations, and what to try next
    start = F.array(*[F.struct(F.lit(i).alias("_c"), F.array(F.array(*[F.lit(0.0)] * r, *[F.lit(0.1)] * o.size).cast("array<double>")).alias("next")) for i, o in enumerate(specs)])
    nothing = F.lit(None).cast("array<double>")
    best = blocks.select(*keys).distinct().select(*keys, F.inline(start)).select(
        *keys, "_c", nothing.alias("x"), F.lit(None).cast("double").alias("sse"), nothing.alias("je"), nothing.alias("jj"), F.lit(1e-2).alias("damp"),
        nothing.alias("state"), "next")
    fields = list(_ARROW)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Keep the best of the trials and the parameters before them, and say what to try next."""
        for b in batches:
            out = []
            for row in b.to_pylist():
                now, improved = {k: row[k] for k in fields}, False
                for t in row["t"]:
                    s = np.sum(np.array(t["_parts"]), axis=0)
                    if now["x"] is None or s[0] < now["sse"]:
                        k = len(row["next"][t["_i"]])
                        damp = row["damp"] * (1.0 if row["x"] is None else TRIALS[t["_i"]])
                        now.update(x=row["next"][t["_i"]], sse=float(s[0]), je=s[1:1 + k].tolist(), jj=s[1 + k:].tolist(), damp=min(max(damp, 1e-9), 1e9), state=t["_end"])
                        improved = True
                if not improved:
                    now["damp"] = min(now["damp"] * 50, 1e9)
                now["next"] = _propose(specs[now["_c"]], r, now)
                out.append(now)
            yield pa.RecordBatch.from_arrays([b.column(k) for k in keys] + [pa.array([o[n] for o in out], t) for n, t in _ARROW.items()], [*keys, *fields])

    schema = f"{head}, _c int, x array<double>, sse double, je array<double>, jj array<double>, damp double, state array<double>, next array<array<double>>"
    for _ in range(passes + 1):
        trial = best.select(*keys, "_c", F.posexplode("next").alias("_i", "_x"))
        got = fold_summaries(blocks.join(trial, keys), measure, init, ["_w", *zs], [*keys, "_c", "_i"], ["_c", "_x", "_rows"])
        parts_of = F.transform(F.array_sort(F.collect_list(F.struct(BLOCK, "_sum"))), lambda s: s["_sum"])
        total = got.groupBy(*keys, "_c", "_i").agg(parts_of.alias("_parts"), F.max_by("_end", BLOCK).alias("_end"))
        tried = total.groupBy(*keys, "_c").agg(F.array_sort(F.collect_list(F.struct("_i", "_parts", "_end"))).alias("t")).join(best, [*keys, "_c"])
        best = store(_bounded(tried).mapInArrow(choose, schema))

    free = [o.size + r + 1 for o in specs]
    count = blocks.groupBy(*keys).agg(F.first("_rows").alias("_rows"))
    score = F.udf(lambda c, sse, n: criterion(sse, n - skip, free[c]), "double")
    table = F.array(*[F.struct(F.lit(o.p).alias("p"), F.lit(o.q).alias("q"), F.lit(o.P).alias("sp"), F.lit(o.Q).alias("sq")) for o in specs])
    return best.join(count, keys).join(differences, keys).select(
        *keys, F.element_at(table, F.col("_c") + 1).alias("order"), F.col("_c").alias("place"), "x", "sse", (F.col("_rows") - skip).alias("rows"),
        score("_c", "sse", "_rows").alias("aicc"), "state", "nd", "ns")


_ARROW = {"_c": pa.int32(), "x": pa.list_(pa.float64()), "sse": pa.float64(), "je": pa.list_(pa.float64()), "jj": pa.list_(pa.float64()),
          "damp": pa.float64(), "state": pa.list_(pa.float64()), "next": pa.list_(pa.list_(pa.float64()))}


def criterion(sse: float, n: int, free: int) -> float:
    """AICc of ``n`` innovations; infinite where they are too few."""
    if n - free - 1 <= 0 or sse >= 1e300:
        return math.inf
    return n * math.log(max(sse / n, 1e-300)) + 2 * free + 2 * free * (free + 1) / (n - free - 1)


def forecast_sarimax(fits: DataFrame, train: DataFrame, h: int, m: int = 7, regressors: Sequence[str] = (), future: DataFrame | None = None,
                     constant: bool = True, freq: str = "D", name: str = "SARIMAX", id_cols: str | Sequence[str] = ID) -> DataFrame:
    """(keys, ds, model, y_hat, order) for ``h`` steps; ``future`` holds the regressors of the steps (keys, ds).  A step without them, and a
    series that differencing leaves without rows, is forecast by the last value of its season (of the series, if it is shorter)."""
    keys = _keys(id_cols)
    reach = 2 + m
    ends = train.groupBy(*keys).agg(F.max(DS).alias("last"))
    tail = train.join(ends, keys).where(steps_between(F.col(DS), F.col("last"), freq) < reach).groupBy(*keys).agg(
        F.first("last").alias("last"), F.array_sort(F.collect_list(F.struct(DS, F.col(Y).cast("double").alias("y"),
                                                                            F.array(*[F.col(c).cast("double") for c in regressors]).cast("array<double>").alias("x")))).alias("tail"))
    base = tail.join(fits.select(*keys, "order", "x", "state", "nd", "ns"), keys, "left")
    if regressors:
        step = steps_between(F.col("last"), F.col(DS), freq)
        ahead = future.join(ends, keys).where(step.between(1, h)).groupBy(*keys).agg(
            F.array_sort(F.collect_list(F.struct(step.alias("s"), F.array(*[F.col(c).cast("double") for c in regressors]).alias("x")))).alias("ahead"))
        base = base.join(ahead, keys, "left")
    else:
        base = base.withColumn("ahead", F.array().cast("array<struct<s:bigint,x:array<double>>>"))
    kinds = {f.name: f.dataType.simpleString() for f in base.schema}
    r, g = len(regressors) + constant, len(regressors)

    def path(row: dict) -> list[float | None]:
        ys = [t["y"] for t in row["tail"]]
        o = row["order"]
        if o is None:
            return [ys[-m + s % m] if len(ys) >= m else ys[-1] for s in range(h)]
        order = Order(o["p"], o["q"], o["sp"], o["sq"], m)
        x, state = np.array(row["x"]), np.array(row["state"])
        phi, Phi, theta, Theta = order.split(x[r:])
        ar, ma = polynomial(phi, Phi, m, -1.0)[2], polynomial(theta, Theta, m, 1.0)[2]
        wl, zl, el, _ = np.split(state, np.cumsum([order.back, order.back * r, order.memory]))
        n = (wl - zl.reshape(order.back, r) @ x[:r]).tolist()
        e = el.tolist()
        delta = difference_lags(row["nd"], row["ns"], m)
        known = {a["s"]: a["x"] for a in row["ahead"] or []}
        xs = [t["x"] for t in row["tail"]]
        one = 1.0 if constant and row["nd"] + row["ns"] <= 1 else 0.0
        out: list[float | None] = []
        for s in range(1, h + 1):
            nt = -sum(c * n[-i] for i, c in enumerate(ar) if i) + sum(c * e[-j] for j, c in enumerate(ma) if j and j <= len(e))
            n.append(nt)
            e.append(0.0)
            xt = known.get(s, [] if g == 0 else None)
            xs.append(xt)
            z = [sum(c * xs[-1 - i][j] for i, c in enumerate(delta) if c) if xt is not None and all(v is not None for v in xs[-len(delta):]) else None for j in range(g)]
            if any(v is None for v in z):
                out.append(None)
                ys.append(ys[-m] if len(ys) >= m else ys[-1])
                continue
            w = nt + sum(b * v for b, v in zip(x[:g], z)) + (x[g] * one if constant else 0.0)
            ys.append(float(w - sum(c * ys[-i] for i, c in enumerate(delta) if i and c)))
            out.append(ys[-1])
        return out

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            text = [None if o["order"] is None else f"({o['order']['p']},{o['nd']},{o['order']['q']})({o['order']['sp']},{o['ns']},{o['order']['sq']})[{m}]" for o in rows]
            yield pa.RecordBatch.from_arrays([b.column(k) for k in keys] + [b.column("last"), pa.array(text, pa.string()), pa.array([path(o) for o in rows], pa.list_(pa.float64()))],
                                             [*keys, "last", "order", "path"])
    head = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    out = _bounded(base).mapInArrow(work, f"{head}, last {kinds['last']}, order string, path array<double>")
    out = out.select(*keys, "last", "order", F.posexplode("path").alias("_s", YHAT))
    return out.select(*keys, add_steps(F.col("last"), F.col("_s") + 1, freq).alias(DS), F.lit(name).alias(MODEL), YHAT, "order")


def sarimax(train: DataFrame, h: int, order: tuple[int, int, int] = (1, 1, 1), seasonal: tuple[int, int, int] = (1, 1, 1), m: int = 7,
            regressors: Sequence[str] = (), future: DataFrame | None = None, constant: bool = True, passes: int = 8, freq: str = "D",
            id_cols: str | Sequence[str] = ID) -> DataFrame:
    """SARIMA(p, d, q)(P, D, Q)[m], with regressors if given."""
    fits = fit_sarimax(train, (order[1], seasonal[1]), [(order[0], order[2], seasonal[0], seasonal[2])], m, regressors, constant, passes, freq, id_cols)
    return forecast_sarimax(fits, train, h, m, regressors, future, constant, freq, "SARIMAX" if regressors else "SARIMA", id_cols)


def auto_arima(train: DataFrame, h: int, m: int = 7, most: tuple[int, int, int, int] = (2, 2, 1, 1), regressors: Sequence[str] = (),
               future: DataFrame | None = None, constant: bool = True, passes: int = 6, freq: str = "D", id_cols: str | Sequence[str] = ID) -> DataFrame:
    """Differences by :func:`choose_differences`, then the order with the least AICc of all (p, q, P, Q) up to ``most`` (the first of equals)."""
    keys = _keys(id_cols)
    orders = list(itertools.product(*[range(v + 1) for v in most]))
    fits = fit_sarimax(train, choose_differences(train, m, freq, keys), orders, m, regressors, constant, passes, freq, keys)
    cols = [c for c in fits.columns if c not in keys]
    best = fits.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.struct("aicc", "place")).alias("b")).select(*keys, "b.*")
    return forecast_sarimax(best, train, h, m, regressors, future, constant, freq, "AutoARIMA", keys)
