"""Fitted exponential smoothing models chosen by AICc.

Models have additive errors, a trend that is absent, linear or damped, and a season that is absent or
additive.  With smoothing parameters fixed, the innovations are linear in the start state: a block of
rows, entered in state x, is left in state A x + c and adds E - 2 q'x + x'H x to the sum of
squares.  Such blocks compose like affine maps, so for a table of candidate parameters one pass over
the blocks of all series, and a composition of the blocks of each, give every candidate's exact least sum of
squares over its start state.

The search is the same for all series: a coarse grid, then rounds of a pattern around the best
candidate with halved steps.  One round is one pass for all series, all forms and all candidates.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.timekeys import add_steps
from chronoweave.operators.baselines import MODEL, YHAT
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.blocks import BLOCK, _bounded, gather
from chronoweave.plans.series import POS, _keys, positioned
from chronoweave.session import store

BLOCK_ROWS = 2048
#: blocks (or compositions of blocks) that one task composes
FAN = 64
LOW, HIGH = 0.01, 0.99
DAMPING = (0.8, 0.98)


@dataclass(frozen=True)
class Form:
    """A model form.  Parameters: alpha, beta / alpha and gamma / (1 - alpha) in (0, 1), phi in (0.8, 0.98)."""

    name: str
    trend: bool
    damped: bool
    seasonal: bool

    @property
    def width(self) -> int:
        return 1 + self.trend + self.seasonal + self.damped

    def size(self, season: int) -> int:
        """Entries of the state: level, slope, and the season's values, the next one first."""
        return 1 + self.trend + (season if self.seasonal else 0)

    def free(self, season: int) -> int:
        """Estimated numbers: parameters, start state (seasons sum to zero) and variance."""
        return self.width + 1 + self.trend + (season - 1 if self.seasonal else 0) + 1

    def parts(self, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """alpha, beta, gamma, phi of candidates (rows of ``theta``)."""
        alpha = theta[:, 0]
        at = 1
        beta, gamma, phi = np.zeros(len(theta)), np.zeros(len(theta)), np.ones(len(theta))
        if self.trend:
            beta = alpha * theta[:, at]
            at += 1
        if self.seasonal:
            gamma = (1 - alpha) * theta[:, at]
            at += 1
        if self.damped:
            phi = theta[:, at]
        return alpha, beta, gamma, phi

    def grid(self) -> np.ndarray:
        """The coarse grid."""
        axes = [(0.05, 0.2, 0.5, 0.8)] + [(0.05, 0.3)] * self.trend + [(0.05, 0.3)] * self.seasonal + [(0.85, 0.95)] * self.damped
        return np.array(list(itertools.product(*axes)))

    def around(self, theta: np.ndarray, step: float) -> np.ndarray:
        """The candidate and those one step off in any of its parameters, inside their ranges."""
        axes = []
        for i, v in enumerate(theta):
            last = self.damped and i == self.width - 1
            lo, hi = DAMPING if last else (LOW, HIGH)
            d = step * (hi - lo) / 2 if last else step
            axes.append([min(max(v + s * d, lo), hi) for s in (0, -1, 1)])
        return np.array(list(itertools.product(*axes)))


FORMS = {f.name: f for f in (Form("ANN", False, False, False), Form("AAN", True, False, False), Form("AAdN", True, True, False),
                             Form("ANA", False, False, True), Form("AAA", True, False, True), Form("AAdA", True, True, True))}


def transition(form: Form, theta: np.ndarray, season: int) -> np.ndarray:
    """(candidates, s, s): the matrix that takes a state to the next one, without the value's part."""
    alpha, beta, gamma, phi = form.parts(theta)
    k, s = len(theta), form.size(season)
    f, g, w = np.zeros((k, s, s)), np.zeros((k, s)), np.zeros((k, s))
    f[:, 0, 0], g[:, 0], w[:, 0] = 1, alpha, 1
    if form.trend:
        f[:, 0, 1], f[:, 1, 1], g[:, 1], w[:, 1] = phi, phi, beta, phi
    if form.seasonal:
        o = 1 + form.trend
        for i in range(season):
            f[:, o + (i - 1) % season, o + i] = 1
        g[:, s - 1], w[:, o] = gamma, 1
    return f - g[:, :, None] * w[:, None, :]


#: what a stretch of rows does to the state and adds to the sum of squares
Piece = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def block_piece(form: Form, theta: np.ndarray, season: int, y: np.ndarray) -> Piece:
    """(A, c, H, q, E) of every candidate on consecutive values."""
    alpha, beta, gamma, phi = form.parts(theta)
    k, s, n, o = len(theta), form.size(season), len(y), 1 + form.trend
    level, slope, seas = np.zeros(k), np.zeros(k), np.zeros((season, k))
    errors, rows = np.empty((n, k)), np.zeros((n, s, k))
    h = np.zeros((s, k))
    h[0] = 1
    if form.trend:
        h[1] = phi
    if form.seasonal:
        h[o] = 1
    w = h.copy()
    for t in range(n):
        base = level + phi * slope if form.trend else level
        e = y[t] - (base + seas[t % season] if form.seasonal else base)
        errors[t] = e
        level = base + alpha * e
        if form.trend:
            slope = phi * slope + beta * e
        rows[t] = h
        hg = h[0] * alpha
        if form.trend:
            hg = hg + h[1] * beta
        if form.seasonal:
            seas[t % season] += gamma * e
            hg = hg + h[s - 1] * gamma
        nxt = h.copy()
        if form.trend:
            nxt[1] = phi * (h[0] + h[1])
        if form.seasonal:
            nxt[o], nxt[o + 1:] = h[s - 1], h[o:s - 1]
        h = nxt - hg * w
    c = np.zeros((k, s))
    c[:, 0] = level
    if form.trend:
        c[:, 1] = slope
    if form.seasonal:
        c[:, o:] = np.roll(seas, -(n % season), axis=0).T
    by = rows.transpose(2, 0, 1)
    a = np.linalg.matrix_power(transition(form, theta, season), n)
    return a, c, by.transpose(0, 2, 1) @ by, np.einsum("kts,tk->ks", by, errors), (errors ** 2).sum(axis=0)


def compose(one: Piece, two: Piece) -> Piece:
    """The stretch ``one`` followed by ``two``."""
    a1, c1, h1, q1, e1 = one
    a2, c2, h2, q2, e2 = two
    t = a1.transpose(0, 2, 1)
    hc = np.einsum("kij,kj->ki", h2, c1)
    return (a2 @ a1, np.einsum("kij,kj->ki", a2, c1) + c2, h1 + t @ h2 @ a1, q1 + np.einsum("kij,kj->ki", t, q2 - hc),
            e1 + e2 - 2 * (q2 * c1).sum(axis=1) + (c1 * hc).sum(axis=1))


def least(piece: Piece) -> tuple[int, float, np.ndarray]:
    """(candidate, sum of squares, last state) of the best candidate, each with its least-squares start."""
    a, c, h, q, e = piece
    x = np.einsum("kij,kj->ki", np.linalg.pinv(h, rcond=1e-10, hermitian=True), q)
    sse = np.maximum(e - 2 * (q * x).sum(axis=1) + np.einsum("ki,kij,kj->k", x, h, x), 0.0)
    # of candidates that rounding cannot tell apart the first
    best = int(np.flatnonzero(sse <= sse.min() * (1 + 1e-9) + 1e-12 * e.min())[0])
    return best, float(sse[best]), a[best] @ x[best] + c[best]


def _flat(piece: Piece) -> list[float]:
    return np.concatenate([p.ravel() for p in piece]).tolist()


def _piece(flat: np.ndarray, k: int, s: int) -> Piece:
    cuts = np.cumsum([k * s * s, k * s, k * s * s, k * s])
    a, c, h, q, e = np.split(flat, cuts)
    return a.reshape(k, s, s), c.reshape(k, s), h.reshape(k, s, s), q.reshape(k, s), e


def aicc(sse: float, n: int, free: int, scale: float) -> float:
    """Corrected information criterion; a fit that is exact up to rounding counts as one, whatever its form."""
    if n - free - 1 <= 0:
        return math.inf
    return n * math.log(max(sse / n, 1e-20 * scale + 1e-300)) + 2 * free + 2 * free * (free + 1) / (n - free - 1)


def fit_ets(train: DataFrame, season: int = 7, forms: Sequence[str] = tuple(FORMS), rounds: int = 5, freq: str | None = None,
            id_cols: str | Sequence[str] = ID, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per series and form: ``theta`` (see :class:`Form`), ``sse``, ``aicc``, the last ``state``, ``n``, ``mean`` and the last time ``last``.

    Series must be on a regular grid without NULLs (pad first).  States are those of the series less its mean.  A form with as many
    estimated numbers as rows has an infinite criterion."""
    keys = _keys(id_cols)
    names = list(forms)
    if season < 2 and any(FORMS[f].seasonal for f in names):
        raise ValueError("a seasonal form needs a season of 2 or more")
    x = positioned(train.select(*keys, DS, F.col(Y).cast("double").alias("_y")), keys, freq)[0]
    stats = store(x.groupBy(*keys).agg(F.avg("_y").alias("mean"), F.count(F.lit(1)).alias("n"), F.max(DS).alias("last"), F.min(POS).alias("_p0"),
                                             F.avg(F.col("_y") * F.col("_y")).alias("_sq")))
    x = x.join(stats, keys).select(*keys, (F.col(POS) - F.col("_p0")).alias(POS), (F.col("_y") - F.col("mean")).alias("_v"))
    blocks = store(gather(x, ["_v"], keys, POS, block_rows).select(*keys, BLOCK, "_v"))
    longest = blocks.agg(F.max(BLOCK)).first()[0] or 0
    kinds = {f.name: f.dataType.simpleString() for f in blocks.schema}
    head = ", ".join(f"`{k}` {kinds[k]}" for k in keys)

    def candidates(form: Form, theta: list[float] | None, r: int) -> np.ndarray:
        return form.grid() if r == 0 else form.around(np.array(theta), 0.25 / 2 ** r)

    def rows_of(b: pa.RecordBatch, out: list[tuple], fields: list[str]) -> pa.RecordBatch:
        """A batch of the keys of row i and the values of every (i, *values)."""
        at = pa.array([o[0] for o in out], pa.int64())
        cols = list(zip(*[o[1:] for o in out])) or [()] * len(fields)
        kind = {"f": pa.int32(), "g": pa.int64(), "theta": pa.list_(pa.float64()), "flat": pa.list_(pa.float64()), "sse": pa.float64(), "state": pa.list_(pa.float64())}
        return pa.RecordBatch.from_arrays([b.column(k).take(at) for k in keys] + [pa.array(c, kind[f]) for c, f in zip(cols, fields)], [*keys, *fields])

    def measure(r: int):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(b.num_rows):
                    form = FORMS[names[b.column("f")[i].as_py()]]
                    theta = candidates(form, b.column("theta")[i].as_py(), r)
                    y = b.column("_v")[i].values.to_numpy(zero_copy_only=False)
                    yield rows_of(b, [(i, b.column("f")[i].as_py(), b.column("theta")[i].as_py(), b.column(BLOCK)[i].as_py(),
                                       _flat(block_piece(form, theta, season, y)))], ["f", "theta", "g", "flat"])
        return work

    def joined(r: int, choose: bool):
        """Compose the pieces of a group in order and, at the end, choose the best candidate."""
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                out = []
                for i in range(b.num_rows):
                    form = FORMS[names[b.column("f")[i].as_py()]]
                    theta = candidates(form, b.column("theta")[i].as_py(), r)
                    total = None
                    for p in b.column("pieces")[i].as_py():
                        piece = _piece(np.array(p["flat"]), len(theta), form.size(season))
                        total = piece if total is None else compose(total, piece)
                    if choose:
                        best, sse, state = least(total)
                        out.append((i, b.column("f")[i].as_py(), theta[best].tolist(), sse, state.tolist()))
                    else:
                        out.append((i, b.column("f")[i].as_py(), b.column("theta")[i].as_py(), b.column("h")[i].as_py(), _flat(total)))
                yield rows_of(b, out, ["f", "theta", "sse", "state"] if choose else ["f", "theta", "g", "flat"])
        return work

    best = stats.select(*keys, F.explode(F.array(*[F.lit(i) for i in range(len(names))])).alias("f"), F.array().cast("array<double>").alias("theta"))
    for r in range(rounds + 1):
        pieces = _bounded(blocks.join(best.select(*keys, "f", "theta"), keys)).mapInArrow(measure(r), f"{head}, f int, theta array<double>, g long, flat array<double>")
        span = longest + 1
        while True:
            group = pieces.groupBy(*keys, "f", "theta", F.floor(F.col("g") / FAN).alias("h")).agg(F.array_sort(F.collect_list(F.struct("g", "flat"))).alias("pieces"))
            span = -(-span // FAN)
            if span == 1:
                break
            pieces = _bounded(group).mapInArrow(joined(r, False), f"{head}, f int, theta array<double>, g long, flat array<double>")
        best = store(_bounded(group).mapInArrow(joined(r, True), f"{head}, f int, theta array<double>, sse double, state array<double>"))

    free = {i: FORMS[f].free(season) for i, f in enumerate(names)}
    score = F.udf(lambda f, sse, n, scale: aicc(sse, n, free[f], scale), "double")
    return best.join(stats, keys).select(*keys, F.element_at(F.array(*[F.lit(f) for f in names]), F.col("f") + 1).alias("form"), "theta", "sse",
                                         score("f", "sse", "n", "_sq").alias("aicc"), "state", "n", "mean", "last")


def forecast_ets(fits: DataFrame, h: int, season: int = 7, freq: str = "D", name: str | None = None, id_cols: str | Sequence[str] = ID) -> DataFrame:
    """(keys, ds, model, y_hat): ``h`` steps from the last states; the model is named ``name`` or by its form."""
    keys = _keys(id_cols)
    kinds = {f.name: f.dataType.simpleString() for f in fits.schema}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for form, theta, state, mean in zip(*(b.column(c).to_pylist() for c in ("form", "theta", "state", "mean"))):
                f = FORMS[form]
                phi, o = f.parts(np.array([theta]))[3][0], 1 + f.trend
                level, slope = state[0], state[1] if f.trend else 0.0
                path = []
                for s in range(h):
                    slope *= phi
                    level += slope
                    path.append(mean + level + (state[o + s % season] if f.seasonal else 0.0))
                out.append(path)
            yield pa.RecordBatch.from_arrays([b.column(k) for k in keys] + [b.column("form"), b.column("last"), pa.array(out, pa.list_(pa.float64()))],
                                             [*keys, "form", "last", "path"])
    head = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    out = _bounded(fits).mapInArrow(work, f"{head}, form string, last {kinds['last']}, path array<double>")
    out = out.select(*keys, "form", "last", F.posexplode("path").alias("_s", YHAT))
    return out.select(*keys, add_steps(F.col("last"), F.col("_s") + 1, freq).alias(DS), (F.lit(name) if name else F.col("form")).alias(MODEL), YHAT)


def best_form(fits: DataFrame, id_cols: str | Sequence[str] = ID, forms: Sequence[str] = tuple(FORMS)) -> DataFrame:
    """The row of each series with the least criterion (the earlier form of equals)."""
    keys = _keys(id_cols)
    place = F.array_position(F.array(*[F.lit(f) for f in forms]), F.col("form"))
    cols = [c for c in fits.columns if c not in keys]
    return fits.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.struct("aicc", place)).alias("_b")).select(*keys, "_b.*")


def auto_ets(train: DataFrame, h: int, season: int = 7, forms: Sequence[str] = tuple(FORMS), rounds: int = 5, freq: str = "D",
             id_cols: str | Sequence[str] = ID, name: str = "AutoETS") -> DataFrame:
    """Forecasts of the form with the least AICc of every series."""
    return forecast_ets(best_form(fit_ets(train, season, forms, rounds, freq, id_cols), id_cols, forms), h, season, freq, name, id_cols)


def holt_winters(train: DataFrame, h: int, season: int = 7, rounds: int = 5, freq: str = "D", id_cols: str | Sequence[str] = ID) -> DataFrame:
    """Additive Holt-Winters with fitted parameters."""
    return forecast_ets(fit_ets(train, season, ("AAA",), rounds, freq, id_cols), h, season, freq, "HoltWinters", id_cols)
