"""Sequential parameter search over backtests.

A :class:`Study` is configured by three user functions: ``space(trial, seen)`` proposes the
parameters of a trial, ``init(params)`` makes a model of them, and ``fit(model, panel, folds)``
returns its cross-validated forecasts.  Every trial is one Spark job over all series and
folds; what reaches the driver is its parameters and one score."""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Callable, Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from chronoweave.operators import backtest, metrics
from chronoweave.operators.baselines import MODEL

#: models whose forecasts depend on the order of the rows; others score rows on their own
SEQUENTIAL, ROW_WISE = "sequential", "row-wise"
TIME_CV, SHUFFLED_CV = "time", "shuffled"


def check_resampling(kind: str, resampling: str) -> None:
    """A sequential model may be evaluated on time-ordered folds only; a model that
    scores rows on their own may use either."""
    if kind not in (SEQUENTIAL, ROW_WISE) or resampling not in (TIME_CV, SHUFFLED_CV):
        raise ValueError(f"unknown model kind {kind!r} or resampling {resampling!r}")
    if kind == SEQUENTIAL and resampling != TIME_CV:
        raise ValueError("a sequential model needs time-ordered folds: shuffled folds train it on the future")


@dataclass(frozen=True)
class Range:
    """A parameter's range; on a log scale equal steps multiply, integers are rounded."""

    low: float
    high: float
    log: bool = False
    integer: bool = False

    def at(self, u: float) -> float:
        """The value at ``u`` in 0 .. 1."""
        if self.log:
            v = math.exp(math.log(self.low) + u * (math.log(self.high) - math.log(self.low)))
        else:
            v = self.low + u * (self.high - self.low)
        return int(min(max(round(v), math.ceil(self.low)), math.floor(self.high))) if self.integer else min(max(v, self.low), self.high)


def design(kind: str, space: Mapping[str, Range], size: int, seed: int = 123) -> list[dict]:
    """At most ``size`` different parameter sets: 'regular' (``size`` levels of each, all combinations), 'random',
    'latin_hypercube' (one value in each of ``size`` strata of every parameter) or 'max_entropy' (the sets of a large
    Latin hypercube whose correlation matrix under a Gaussian kernel has, step by step, the largest determinant: they spread as far as
    they can).  Sets that rounding makes equal are one."""
    rng, names = np.random.default_rng(seed), list(space)

    def hypercube(n: int) -> np.ndarray:
        return np.column_stack([(rng.permutation(n) + rng.random(n)) / n for _ in names]) if names else np.zeros((n, 0))
    if kind == "regular":
        steps = [i / (size - 1) for i in range(size)] if size > 1 else [0.5]
        unit = np.array(list(itertools.product(steps, repeat=len(names))))
    elif kind == "random":
        unit = rng.random((size, len(names)))
    elif kind == "latin_hypercube":
        unit = hypercube(size)
    elif kind == "max_entropy":
        pool = hypercube(max(20 * size, 200))
        near = np.exp(-((pool[:, None] - pool[None]) ** 2).sum(axis=2) / (2 * 0.25 ** 2))
        chosen: list[int] = []
        left, rows = np.diag(near).copy(), np.zeros((0, len(pool)))
        for _ in range(min(size, len(pool))):
            # the determinant grows by the variance that the chosen ones leave
            i = int(left.argmax())
            row = (near[i] - rows.T @ rows[:, i]) / math.sqrt(left[i])
            chosen.append(i)
            rows, left = np.r_[rows, row[None]], left - row ** 2
            left[i] = -1.0
        unit = pool[chosen]
    else:
        raise ValueError(f"unknown design {kind!r}")
    sets = [{n: space[n].at(float(u)) for n, u in zip(names, row)} for row in unit]
    return [dict(t) for t in dict.fromkeys(tuple(s.items()) for s in sets)]


@dataclass(frozen=True)
class Folds:
    h: int
    n_windows: int
    step: int
    freq: str = "D"
    resampling: str = TIME_CV


@dataclass(frozen=True)
class Trial:
    number: int
    params: Mapping[str, float]
    score: float


@dataclass
class Study:
    space: Callable[[int, list[Trial]], Mapping[str, float]]
    init: Callable[[Mapping[str, float]], Callable]
    fit: Callable[[Callable, DataFrame, Folds], DataFrame] | None = None
    kind: str = SEQUENTIAL
    metric: str = "rmse"

    def run(self, panel: DataFrame, folds: Folds, n_trials: int) -> list[Trial]:
        """The trials in order; later proposals see the earlier scores."""
        check_resampling(self.kind, folds.resampling)
        fit = self.fit or cross_validated
        seen: list[Trial] = []
        for i in range(n_trials):
            params = dict(self.space(i, list(seen)))
            scored = fit(self.init(params), panel, folds)
            score = metrics.point_metrics(scored, by=[MODEL]).first()[self.metric]
            seen.append(Trial(i, params, float("inf") if score is None else float(score)))
        return seen

    def refit(self, panel: DataFrame, folds: Folds, trials: list[Trial]) -> DataFrame:
        """Forecast of the best trial's model fitted on all data."""
        best = min(trials, key=lambda t: (t.score, t.number))
        return backtest.forecast(panel, [self.init(best.params)], folds.h, folds.freq)


def cross_validated(model: Callable, panel: DataFrame, folds: Folds) -> DataFrame:
    return backtest.cross_validation(panel, [model], folds.h, folds.n_windows, folds.step, folds.freq)


def narrowing(bounds: Mapping[str, tuple[float, float]], explore: int = 4, shrink: float = 0.5, seed: int = 123):
    """A search space: ``explore`` stratified draws of the whole ranges, then draws from
    ranges around the best trial that shrink with every further trial."""
    def propose(i: int, seen: list[Trial]) -> Mapping[str, float]:
        rng = random.Random(f"{seed}-{i}")
        out = {}
        for name, (lo, hi) in bounds.items():
            if i < explore:
                v = lo + (hi - lo) * (i + rng.random()) / explore
            else:
                at = min(seen, key=lambda t: (t.score, t.number)).params[name]
                half = (hi - lo) / 2 * shrink ** (i - explore + 1)
                v = min(hi, max(lo, at + half * (2 * rng.random() - 1)))
            out[name] = round(v, 4)
        return out
    return propose
