"""Quality rules with a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements and one long
whose bit *i* is set when rule *i* fails.  A policy is a versioned mask (rules that reject)
plus a bound on the number of other failures; applying another version, or asking what a
version would keep without one of its rules, reads the ledger only and never the texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import bounded_batches, slices, text_column

SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_chars", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_upper", "n_letters", "n_digits", "n_long_words")
_UPPER, _LETTER, _DIGIT = re.compile(r"[A-ZÀ-ÖØ-Þ]+"), re.compile(r"[^\W\d_]+"), re.compile(r"[0-9]+")


def measure(text: str) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``.

    Words are maximal runs of bytes other than the six ASCII white-space characters."""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes.split() cuts at exactly these six
    n = len(words)
    spaces = sum(map(text.count, SPACES))
    repeated = 0
    if n >= 3:
        grams = list(zip(words, words[1:], words[2:]))
        seen = Counter(grams)
        if len(seen) < n - 2:
            end = 0  # words before this position are counted
            for i, g in enumerate(grams):
                if seen[g] > 1:
                    repeated += i + 3 - max(i, end)
                    end = i + 3
    lines = [x for x in text.split("\n") if x.strip("".join(SPACES))]
    return (len(text), n, len(text) - spaces, sum(map(text.count, SYMBOLS)), len(lines),
            len(lines) - len(set(lines)), repeated, sum(map(len, _UPPER.findall(text))),
            sum(map(len, _LETTER.findall(text))), sum(map(len, _DIGIT.findall(text))),
            sum(len(w) > 64 for w in words))


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Column


def rules() -> list[Rule]:
    """The rules; a rule's place in this list is its bit and never changes."""
    n, c = F.col, F.lit
    return [
        Rule("too_few_words", n("n_words") < 50),
        Rule("repeated_trigrams", 100 * n("n_repeat_words") > 50 * n("n_words")),
        Rule("symbols", n("n_symbols") * 4 > n("n_words")),
        Rule("duplicate_lines", n("n_dup_lines") * 10 > n("n_lines") * 6),
        Rule("upper_case", n("n_upper") * 10 > n("n_letters") * 6),
        Rule("few_letters", n("n_letters") * 10 < n("word_chars") * 5),
        Rule("digits", n("n_digits") * 10 > n("word_chars") * 3),
        Rule("short_words", n("word_chars") < n("n_words") * 2),
        Rule("long_words", n("word_chars") > n("n_words") * 20),
        Rule("unbroken_words", n("n_long_words") * 20 > n("n_words")),
        Rule("repeated_some", 100 * n("n_repeat_words") > 30 * n("n_words")),
        Rule("no_text", n("n_words") == c(0)),
    ]


@dataclass(frozen=True)
class Policy:
    """Reject on any failed rule in ``reject``, or on more than ``spare`` failures in ``count``."""
    version: str
    reject: tuple[str, ...]
    count: tuple[str, ...] = ()
    spare: int = 0


BASE = ("too_few_words", "repeated_trigrams")
POLICIES = {
    "v1": Policy("v1", BASE),
    "v2": Policy("v2", (*BASE, "symbols", "duplicate_lines", "upper_case", "few_letters", "digits",
                        "unbroken_words", "no_text"),
                 ("short_words", "long_words", "repeated_some"), 1),
}


def mask(names: tuple[str, ...]) -> int:
    bits = {r.name: 1 << i for i, r in enumerate(rules())}
    return sum(bits[x] for x in names)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, kept columns, measurements, failures long) for every row, in one pass over the texts.

    A null text measures as the empty text.  Empty tables give an empty ledger; repeated
    rows each have their row.  ``keep`` names columns of ``docs`` that travel along (names
    of measurements among them are replaced by a prefix ``doc_``)."""
    carried = [F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *[F.col(k).alias(f"_doc_{k}") for k in keep]]
    thin = bounded_batches(docs).select(*carried)
    kept = [f for f in thin.schema.fields if f.name != "_text"]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], *[f"{m} long" for m in MEASURES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            got = [measure(t) for t in text_column(b, "_text")]
            cols = list(zip(*got)) if got else [()] * len(MEASURES)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(f.name) for f in kept], *[pa.array(c, pa.int64()) for c in cols]],
                names=[*[f.name for f in kept], *MEASURES])

    measured = thin.mapInArrow(run, schema)
    failures = sum((F.when(r.fails, F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(rules())), F.lit(0))
    return measured.select(
        *([] if id_col in keep else [F.col("_id").alias(id_col)]),
        *[F.col(f"_doc_{k}").alias(f"doc_{k}" if k in MEASURES else k) for k in keep],
        *MEASURES, failures.cast("long").alias("failures"))


def verdict(policy: Policy, failures: Column | None = None) -> Column:
    """True where the policy keeps a document; reads the bits only."""
    bits = F.col("failures") if failures is None else failures
    return (bits.bitwiseAND(F.lit(mask(policy.reject))) == 0) & \
        (F.bit_count(bits.bitwiseAND(F.lit(mask(policy.count)))) <= F.lit(policy.spare))


def ablations(led: DataFrame, policy: Policy) -> DataFrame:
    """For every rule: documents that fail it, that fail only it, and that the policy keeps
    with the rule left out.  One partial aggregate per distinct failure mask (at most
    2^rules rows), then bit operations over those masks."""
    masks = led.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))
    names = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit"))
                      for i, r in enumerate(rules())])
    each = masks.select("failures", "n", F.explode(names).alias("r")).select("failures", "n", "r.*")
    without = F.col("failures").bitwiseAND(F.bitwise_not("bit"))
    has = F.col("failures").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule", "bit").agg(
        F.sum(F.when(has, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("failures") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
        F.sum(F.when(verdict(policy), F.col("n")).otherwise(0)).alias("n_kept"),
        F.sum(F.when(verdict(policy, without), F.col("n")).otherwise(0)).alias("n_kept_without"),
        F.bit_or(F.when(has, F.col("failures")).otherwise(F.lit(0).cast("long"))).alias("failed_with"))
