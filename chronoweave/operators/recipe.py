"""Recipes (H12, H13, E10): feature steps whose parameters are learned on the train rows of a panel
and applied to any other rows.

A recipe is a list of :class:`Step`; :func:`prep` learns them one after another, each on the train
rows as the steps before left them, and returns a :class:`Prepared` recipe: the steps and what they
learned, all plain values (means, knots, levels, constants), so it is saved as one JSON text and
baked anywhere.  Learning is aggregates only; a step's parameters have a bounded number of values
(a step that would learn more than ``MAX_LEVELS`` levels is an error).

Steps that choose or mend training rows (``filter``, ``clean``, and ``naomit`` unless told
otherwise) are skipped when new rows are baked, so no row that shall be forecast is lost.

=========== ==================================================== ==============================
kind        options                                              learned
=========== ==================================================== ==============================
filter      condition                                            -
clean       period, factor                                       -
log1p       columns                                              -
normalize   columns                                              mean, sample sd
signature   features                                             -
fourier     periods, order                                       -
spline      column, df                                           knots (ends, exact quantiles)
dummy       column, drop_first                                   levels of the rows left
interact    left, right                                          the pairs
lag         columns, lags                                        -
slidify     column, window, function                             -
naomit      columns                                              the columns
remove      columns                                              the columns
role        columns, role                                        the columns
=========== ==================================================== ==============================

``columns``, ``left`` and ``right`` are regular expressions that a whole column name must match.
Steps over a series (``clean``, ``lag``, ``slidify``) need a regular grid and run over halo
blocks; new rows are baked with the history they need in front (``history`` of :func:`bake`).

Undefined values stay NULL: a column that is constant in the train rows is centred only, a level
that the train rows lack gets 0 in every dummy, and a NULL level NULL.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.functions.aggs import global_quantiles
from chronoweave.functions.basis import augment_fourier
from chronoweave.functions.calendar import augment_timeseries_signature, interactions, one_hot
from chronoweave.functions.transforms import safe_log1p
from chronoweave.operators import anomaly, windows
from chronoweave.panel import DS, ID, Y
from chronoweave.sources.files import Artifacts, load_artifacts, save_artifacts

MAX_LEVELS = 1000


@dataclass(frozen=True)
class Step:
    kind: str
    options: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Prepared:
    """A learned recipe: ``learned[i]`` are the parameters of ``steps[i]``."""

    steps: tuple[Step, ...]
    learned: tuple[dict[str, Any], ...]
    freq: str = "D"

    def columns_of(self, role: str) -> list[str]:
        return [c for s, got in zip(self.steps, self.learned) if s.kind == "role" and s.options["role"] == role for c in got["columns"]]


def step(kind: str, **options) -> Step:
    if kind not in STEPS:
        raise ValueError(f"unknown recipe step {kind}")
    return Step(kind, options)


def _matching(df: DataFrame, pattern: str, keep: Sequence[str] = (ID, DS)) -> list[str]:
    return [c for c in df.columns if re.fullmatch(pattern, c) and c not in keep]


def _natural_spline(column: str, knots: Sequence[float]) -> dict[str, Column]:
    """Truncated-power natural spline of ``len(knots) - 1`` columns, linear beyond the end knots."""
    lo, hi = knots[0], knots[-1]
    span = (hi - lo) or 1.0
    z = [(k - lo) / span for k in knots]
    x = (F.col(column).cast("double") - F.lit(lo)) / F.lit(span)

    def cube(k: float) -> Column:
        return F.pow(F.greatest(x - F.lit(k), F.lit(0.0)), F.lit(3.0))

    def bend(k: int) -> Column:
        return (cube(z[k]) - cube(z[-1])) / F.lit((z[-1] - z[k]) or 1.0)

    cols = [x] + [bend(k) - bend(len(z) - 2) for k in range(len(z) - 2)]
    return {f"{column}_ns_{i}": c for i, c in enumerate(cols, 1)}


# ---- what each step learns: (train rows, options) -> plain values ---------------------

def _learn_moments(df: DataFrame, o: dict) -> dict:
    cols = _matching(df, o["columns"])
    if not cols:
        return {"moments": {}}
    row = df.agg(*[f(F.col(f"`{c}`").cast("double")).alias(f"{n}{i}") for i, c in enumerate(cols)
                   for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    return {"moments": {c: [row[f"m{i}"], row[f"s{i}"]] for i, c in enumerate(cols)}}


def _learn_knots(df: DataFrame, o: dict) -> dict:
    inner = o["df"] - 1
    ends = df.agg(F.min(o["column"]).cast("double"), F.max(o["column"]).cast("double")).first()
    if ends[0] is None:
        raise ValueError(f"no value of {o['column']} to learn knots from")
    return {"knots": [ends[0], *(global_quantiles(df, o["column"], [(i + 1) / (inner + 1) for i in range(inner)]) if inner else []), ends[1]]}


def _learn_levels(df: DataFrame, o: dict) -> dict:
    got = [r[0] for r in df.select(F.col(o["column"]).cast("string")).where(F.col(o["column"]).isNotNull()).distinct().limit(MAX_LEVELS + 1).collect()]
    if len(got) > MAX_LEVELS:
        raise ValueError(f"{o['column']} has more than {MAX_LEVELS} levels")
    return {"levels": sorted(got)}


def _learn_columns(df: DataFrame, o: dict) -> dict:
    return {"columns": _matching(df, o["columns"], keep=())}


def _learn_pairs(df: DataFrame, o: dict) -> dict:
    left, right = _matching(df, o["left"]), _matching(df, o["right"])
    return {"pairs": [[a, b] for a in left for b in right if a != b]}


def _nothing(df: DataFrame, o: dict) -> dict:
    return {}


# ---- what each step does: (rows, options, learned, freq) -> rows ------------------------

def _normalize(df: DataFrame, o: dict, got: dict, freq: str) -> DataFrame:
    return df.withColumns({c: (F.col(f"`{c}`") - F.lit(m)) / F.lit(s if s else 1.0) for c, (m, s) in got["moments"].items()})


def _clean(df: DataFrame, o: dict, got: dict, freq: str) -> DataFrame:
    clean = anomaly.ts_clean(df.select(ID, DS, Y), Y, o.get("period", 7), o.get("factor", 3.0), freq=freq)
    return df.drop(Y).join(clean.select(ID, DS, F.col("y_clean").alias(Y)), [ID, DS])


def _log1p(df: DataFrame, o: dict, got: dict, freq: str) -> DataFrame:
    return df.withColumns({c: safe_log1p(F.col(f"`{c}`").cast("double")) for c in got["columns"]})


def _slidify(df: DataFrame, o: dict, got: dict, freq: str) -> DataFrame:
    return windows.augment_rolling(df, o["column"], o["window"], o.get("function", "mean"), center=o.get("center", True),
                                   partial=o.get("partial", True), freq=freq)


STEPS: dict[str, tuple[Callable[[DataFrame, dict], dict], Callable[[DataFrame, dict, dict, str], DataFrame], bool]] = {
    # kind: (learn, bake, skipped when new rows are baked)
    "filter": (_nothing, lambda df, o, got, freq: df.where(o["condition"]), True),
    "clean": (_nothing, _clean, True),
    "log1p": (_learn_columns, _log1p, False),
    "normalize": (_learn_moments, _normalize, False),
    "signature": (_nothing, lambda df, o, got, freq: augment_timeseries_signature(df, DS, o["features"]), False),
    "fourier": (_nothing, lambda df, o, got, freq: augment_fourier(df, DS, o["periods"], o.get("order", 1), freq), False),
    "spline": (_learn_knots, lambda df, o, got, freq: df.withColumns(_natural_spline(o["column"], got["knots"])), False),
    "dummy": (_learn_levels, lambda df, o, got, freq: one_hot(df, o["column"], got["levels"], o.get("drop_first", True)), False),
    "interact": (_learn_pairs, lambda df, o, got, freq: interactions(df, [tuple(p) for p in got["pairs"]]), False),
    "lag": (_learn_columns, lambda df, o, got, freq: windows.augment_lags(df, got["columns"], o["lags"], freq=freq), False),
    "slidify": (_nothing, _slidify, False),
    "naomit": (_learn_columns, lambda df, o, got, freq: df.dropna(subset=got["columns"]), True),
    "remove": (_learn_columns, lambda df, o, got, freq: df.drop(*got["columns"]), False),
    "role": (_learn_columns, lambda df, o, got, freq: df, False),
}


def prep(steps: Sequence[Step], train: DataFrame, freq: str = "D") -> tuple[Prepared, DataFrame]:
    """Learn the steps on ``train``; returns the prepared recipe and the baked train rows."""
    learned = []
    for s in steps:
        learn, apply, _ = STEPS[s.kind]
        got = learn(train, s.options)
        learned.append(got)
        train = apply(train, s.options, got, freq)
    return Prepared(tuple(steps), tuple(learned), freq), train


def bake(prepared: Prepared, rows: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Apply a prepared recipe to new rows.  ``history`` are earlier rows of the same series that
    lags and windows may look at; they go through the same steps and are left out of the result."""
    mark = "__recipe_new"
    x = rows.withColumn(mark, F.lit(True))
    if history is not None:
        x = x.unionByName(history.withColumn(mark, F.lit(False)), allowMissingColumns=True)
    for s, got in zip(prepared.steps, prepared.learned):
        _, apply, skipped = STEPS[s.kind]
        if not s.options.get("skip", skipped):
            x = apply(x, s.options, got, prepared.freq)
    return x.where(mark).drop(mark)


def predictors(prepared: Prepared, baked: DataFrame, outcome: str = Y) -> list[str]:
    """Numeric columns of a baked table that have no other role: what a model may be fitted on."""
    other = {ID, DS, outcome, *[c for s, got in zip(prepared.steps, prepared.learned) if s.kind == "role" for c in got["columns"]]}
    return [n for n, t in baked.dtypes if n not in other and t in ("double", "float", "int", "bigint", "smallint", "tinyint")]


def save(spark: SparkSession, path: str, prepared: Prepared) -> None:
    """Write the recipe and what it learned as one JSON text."""
    save_artifacts(spark, path, Artifacts(params={"recipe": json.dumps(asdict(prepared))}))


def load(spark: SparkSession, path: str) -> Prepared:
    raw = json.loads(load_artifacts(spark, path).params["recipe"])
    return Prepared(tuple(Step(s["kind"], s["options"]) for s in raw["steps"]), tuple(raw["learned"]), raw["freq"])
