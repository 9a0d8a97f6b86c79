"""Multivariate adaptive regression splines (N06): forward selection of hinge pairs and backward deletion by GCV, from Gram matrices.

Candidates are products of a term already in the model with a pair max(0, x - t), max(0, t - x).  A pair's
gain follows from its products with the model's terms, with the target, and with itself, which are
sums over the rows.  A step is one pass that adds up only what is new: the last terms' products with all candidates, and the
candidates that the last terms made possible.  Nothing but these sums, of a size set by terms and
knots, reaches the driver; deletion needs no pass at all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.panel import Y
from chronoweave.plans.blocks import _bounded
from chronoweave.session import store

#: a hinge: feature index, knot, sign; a term is a tuple of hinges, the empty one is the constant
Hinge = tuple[int, float, int]
Term = tuple[Hinge, ...]
SUM_TASKS = 16


def sums(df: DataFrame, fold: Callable[[np.ndarray], np.ndarray], length: int, width: int) -> np.ndarray:
    """Sum over all rows of ``fold(matrix of rows)``, added up in tasks, then in a few of them, then here."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            for at in range(0, len(x), 2048):
                total += fold(x[at:at + 2048])
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["s"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for b in batches:
            if b.num_rows:
                total += b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, length).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["s"])
    rows = _bounded(df).mapInArrow(part, "s array<double>").repartition(SUM_TASKS).mapInArrow(add, "s array<double>").collect()
    return np.sum([r["s"] for r in rows], axis=0) if rows else np.zeros(length)


def values(terms: Sequence[Term], x: np.ndarray) -> np.ndarray:
    """Columns of the terms at rows of (scaled) features."""
    out = np.ones((len(x), len(terms)))
    for i, t in enumerate(terms):
        for f, knot, sign in t:
            out[:, i] *= np.maximum(sign * (x[:, f] - knot), 0.0)
    return out


@dataclass
class Mars:
    """A fitted model on scaled features (x - mean) / sd."""

    features: list[str]
    mean: np.ndarray
    sd: np.ndarray
    terms: list[Term]
    coef: np.ndarray
    gcv: float
    rss: float
    rows: int

    def column(self) -> Column:
        """The prediction as a column expression."""
        x = [(F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(s)) for c, m, s in zip(self.features, self.mean, self.sd)]
        out = F.lit(0.0)
        for t, c in zip(self.terms, self.coef):
            v = F.lit(float(c))
            for f, knot, sign in t:
                v = v * F.greatest(F.lit(float(sign)) * (x[f] - F.lit(float(knot))), F.lit(0.0))
            out = out + v
        return out

    def table(self) -> list[tuple[str, float]]:
        """(term, coefficient), hinges in the features' own units."""
        def text(t: Term) -> str:
            return " * ".join(f"h({self.features[f]} - {knot * self.sd[f] + self.mean[f]:.6g})" if s > 0 else
                              f"h({knot * self.sd[f] + self.mean[f]:.6g} - {self.features[f]})" for f, knot, s in t) or "(intercept)"
        return [(text(t), float(c)) for t, c in zip(self.terms, self.coef)]


def gcv(rss: float, n: int, terms: int, penalty: float) -> float:
    """Generalised cross-validation with ``penalty`` for each knot."""
    cost = terms + penalty * (terms - 1) / 2
    return rss / n / (1 - cost / n) ** 2 if cost < n else np.inf


def solve(gram: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Least squares from a Gram matrix whose columns are scaled to unit length first."""
    s = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
    return np.linalg.lstsq(gram / np.outer(s, s), by / s, rcond=1e-10)[0] / s


def fit_mars(train: DataFrame, features: Sequence[str], target: str = Y, max_terms: int = 11, degree: int = 1, knots: int = 20, penalty: float | None = None,
             least_gain: float = 1e-3) -> Mars | None:
    """Forward steps to at most ``max_terms`` terms of at most ``degree`` hinges, while a pair lowers the residual sum of squares by ``least_gain`` of the
    total; then terms are deleted one by one and the model with the least GCV is kept.

    Knots are the inner quantiles of each feature (a sketch: any knots do).  ``penalty`` is 2 for degree 1 and 3 beyond by
    default.  Rows with a NULL or NaN feature or target are left out; None without rows.  Equal gains go to the earlier
    candidate: parent, feature, knot."""
    k = len(features)
    penalty = (2.0 if degree == 1 else 3.0) if penalty is None else penalty
    cols = [F.col(c).cast("double") for c in [*features, target]]
    data = train.select(F.array(*cols).alias("x")).where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)))
    stat = data.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(k + 1)], *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(k + 1)],
                    *[F.percentile_approx(F.col("x")[i], [(j + 1) / (knots + 1) for j in range(knots)], 10_000).alias(f"q{i}") for i in range(k)]).first()
    n = stat["n"]
    if not n:
        return None
    mean = np.array([stat[f"m{i}"] for i in range(k + 1)])
    sd = np.array([stat[f"s{i}"] or 1.0 for i in range(k + 1)])
    at = [sorted(set(((np.array(stat[f"q{i}"]) - mean[i]) / sd[i]).tolist())) for i in range(k)]
    scaled = store(data.select(F.array(*[(F.col("x")[i] - F.lit(float(mean[i]))) / F.lit(float(sd[i])) for i in range(k)], F.col("x")[k] - F.lit(float(mean[k]))).alias("x")))

    def children(parent: Term) -> list[tuple[Term, Term]]:
        """The pairs that a term makes possible: a feature occurs once in a product."""
        if len(parent) >= degree:
            return []
        used = {h[0] for h in parent}
        return [((*parent, (f, t, 1)), (*parent, (f, t, -1))) for f in range(k) if f not in used for t in at[f]]

    terms: list[Term] = [()]
    pairs = children(())
    first = sums(scaled, lambda x: np.array([(x[:, -1] ** 2).sum(), x[:, -1].sum()]), 2, k + 1)
    total = float(first[0])
    gram, by = np.array([[float(n)]]), np.array([first[1]])
    cross = np.zeros((0, 0))           # terms x candidates
    own, target_by = np.zeros(0), np.zeros(0)
    fresh = [()]                        # terms whose products with the candidates are not known yet
    known = 0                           # candidates whose own sums are known
    while len(terms) + 2 <= max_terms and pairs:
        cand = [t for p in pairs for t in p]
        new, old_terms = cand[known:], terms[:len(terms) - len(fresh)]
        m, f, o = len(cand), len(fresh), len(old_terms)

        def fold(x: np.ndarray) -> np.ndarray:
            c = values(cand, x[:, :-1])
            late = c[:, known:]
            return np.concatenate([(values(fresh, x[:, :-1]).T @ c).ravel(), (values(old_terms, x[:, :-1]).T @ late).ravel(), (late ** 2).sum(axis=0), late.T @ x[:, -1]])
        s = sums(scaled, fold, f * m + (o + 2) * len(new), k + 1)
        rows, rest = s[:f * m].reshape(f, m), s[f * m:]
        late = rest[:o * len(new)].reshape(o, len(new))
        cross = np.concatenate([np.concatenate([cross, late], axis=1) if o else np.zeros((0, m)), rows])
        own, target_by = np.r_[own, rest[o * len(new):(o + 1) * len(new)]], np.r_[target_by, rest[(o + 1) * len(new):]]
        known = m
        # what is left of candidates and target outside the model's span; a pair's columns never overlap
        weights = np.column_stack([solve(gram, cross[:, i]) for i in range(m)])
        left = own - (cross * weights).sum(axis=0)
        resid = target_by - weights.T @ by
        inner = -(cross[:, 0::2] * weights[:, 1::2]).sum(axis=0)
        a, b, u, v = left[0::2], left[1::2], resid[0::2], resid[1::2]
        single = lambda r, q, w: np.where(q > 1e-9 * np.maximum(w, 1e-300), r ** 2 / np.where(q > 0, q, 1.0), 0.0)
        det = a * b - inner ** 2
        both = np.where(det > 1e-9 * np.maximum(a * b, 1e-300), (u * u * b - 2 * u * v * inner + v * v * a) / np.where(det > 0, det, 1.0), 0.0)
        one, two = single(u, a, own[0::2]), single(v, b, own[1::2])
        # with its feature in the model already, a pair adds one direction only: one hinge of it will do
        apart = (a > 1e-9 * own[0::2]) & (b > 1e-9 * own[1::2]) & (det > 1e-9 * a * b)
        gain = np.where(apart, both, np.maximum(one, two))
        pick = int(np.flatnonzero(gain >= gain.max() * (1 - 1e-9))[0])
        if gain[pick] < least_gain * total or total <= 0:
            break
        chosen = [2 * pick, 2 * pick + 1] if apart[pick] else [2 * pick if one[pick] >= two[pick] * (1 - 1e-9) else 2 * pick + 1]
        for j in chosen:
            # products with the terms before; the two hinges of a pair have none with each other
            col = cross[:, j]
            g = np.zeros((len(gram) + 1, len(gram) + 1))
            g[:-1, :-1] = gram
            g[-1, :len(col)] = g[:len(col), -1] = col
            g[-1, -1] = own[j]
            gram, by = g, np.r_[by, target_by[j]]
        fresh = [cand[j] for j in chosen]
        terms = [*terms, *fresh]
        pairs = [*pairs, *[c for t in fresh for c in children(t)]]
    return _prune(list(features), mean, sd, terms, gram, by, total, n, penalty)


def _prune(features: list[str], mean: np.ndarray, sd: np.ndarray, terms: list[Term], gram: np.ndarray, by: np.ndarray, total: float, n: int, penalty: float) -> Mars:
    """Delete the term that costs least, one after the other, and keep the best model by GCV (the smaller of equals)."""
    def rss(keep: list[int]) -> float:
        g, b = gram[np.ix_(keep, keep)], by[keep]
        c = solve(g, b)
        return max(total - 2 * c @ b + c @ g @ c, 0.0)
    keep = list(range(len(terms)))
    best = (gcv(rss(keep), n, len(keep), penalty), keep)
    while len(keep) > 1:
        trials = [[j for j in keep if j != d] for d in keep[1:]]
        costs = [rss(t) for t in trials]
        keep = trials[int(np.flatnonzero(np.array(costs) <= min(costs) * (1 + 1e-9))[0])]
        score = gcv(rss(keep), n, len(keep), penalty)
        if score <= best[0]:
            best = (score, keep)
    score, keep = best
    coef = solve(gram[np.ix_(keep, keep)], by[keep])
    coef[0] += mean[-1]  # the target was centred
    return Mars(features, mean[:-1], sd[:-1], [terms[j] for j in keep], coef, float(score), rss(keep), n)
