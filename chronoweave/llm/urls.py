"""URL filter: rules first, then naive Bayes over segmented host names.

Host names are runs of letters without spaces ("cheappills").  A unigram Viterbi search
splits every run into its most probable words; a multinomial naive Bayes model then scores
the words of the host and the tokens of the path.

* Word counts come from all pages: the words of the rendered text (:mod:`chronoweave.llm.html`)
  and of URL paths.  A word is a run of letters of any script, so accents leave no scraps.  Host
  names are left out, in URLs and where the text mentions them: a name written without spaces
  would else be a word of the dictionary and never be split.  The ``seeds`` are words in any case.
* What no word explains (``www``, top domains, made-up names) competes as an unknown word whose
  length and letters are as likely as in the dictionary (:class:`UnknownWords`), and every further
  word of a name has a price, so a chain of scraps is not cheaper than the whole.
* Every distinct run of letters in a host is split once: its substrings are joined with the
  word counts, so the dictionary is never broadcast, and the search runs over the few
  substrings that are words.
* The classifier is fitted on a documented, bounded sample of labelled rows
  (``train_rows`` per class, smallest hashes first); labels are distant: a host with one of
  the given ``seeds`` among its words is a block example, any other an allow example.  The seeds
  themselves are left out of the fit, since they made the labels: what is learned are the words
  that keep them company.  A seed in a host counts with the fixed odds ``seed_odds``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import bounded_batches, materialize, slices, text_column
from chronoweave.llm.html import parse, render

MAX_WORD = 20  # letters of the longest dictionary word that is tried
MAX_LABEL = 63  # a longer run of letters is no host label (DNS) and stays one unknown word
NUMBER = "#"
SEED_SHARE = 1e-4  # a seed counts as at least one occurrence, and as this share of all words
MORE_WORDS = 0.1  # probability that a name goes on after a word
#: host names (with the scheme or without) in a text in lower case
_HOST = re.compile(r"://[^\s/?#<]*|(?<![a-z0-9-])[a-z0-9-]++(?:\.[a-z0-9-]++)+")
_LETTERS = re.compile(r"[^\W\d_]+")
_LATIN = re.compile(r"[a-z]+")
#: different words a worker counts before it passes the counts on, and rows of one batch of them
COUNTED_WORDS, OUTPUT_ROWS = 150_000, 10_000
#: words whose presence in a host marks a training example of the block class
SEEDS = ("adult", "bets", "casino", "cheap", "farm", "free", "pills", "porn", "spam", "track", "ads", "viagra", "win", "xxx")
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class HostRule(NamedTuple):
    verdict: str
    host: str
    path: str


RULES = (HostRule("allow", "org", "/"), HostRule("block", "example.org", "/es/"), HostRule("block", "example.org", "/en/1"),
         HostRule("allow", "com", "/fr/"), HostRule("block", "com", "/de/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UP, _LOW)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[HostRule], field: str) -> Column:
    """Verdict or name of the longest fitting rule, null without one."""
    out = None
    for r in sorted(rules, key=lambda r: -len(r.host + r.path)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.lit(r.verdict if field == "verdict" else r.host + r.path)
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("string")


class UnknownWords(NamedTuple):
    """Probability of a word the dictionary lacks: the share of words seen once, times that of
    its length, times that of its letters, all over the different words and smoothed by one."""
    share: float
    lengths: tuple[float, ...]  # by length from 1, the last for all beyond
    letters: dict[str, float]

    @classmethod
    def fit(cls, once: int, total: int, lengths: dict[int, int], letters: dict[str, int]) -> UnknownWords:
        n, k = sum(lengths.values()) + MAX_LABEL, sum(letters.get(c, 0) for c in _LOW) + len(_LOW)
        return cls((once + 1) / (total + 2), tuple((lengths.get(i, 0) + 1) / n for i in range(1, MAX_LABEL + 1)),
                   {c: (letters.get(c, 0) + 1) / k for c in _LOW})

    def log(self, word: str) -> float:
        return (math.log(self.share) + math.log(self.lengths[min(len(word), len(self.lengths)) - 1])
                + math.fsum(math.log(self.letters[c]) for c in word))


def segment(label: str, known: dict[tuple[int, int], int], total: int, unknown: Callable[[str], float] | None = None,
            more: float = 0.0) -> list[str]:
    """Most probable split of ``label``; ``known`` has the counts of its substrings that are
    words, by (start, length).  ``unknown`` is the log-probability of an unknown word (without
    it 1/(N 10^n) for n letters), ``more`` that of every further word; of equally probable
    splits the one with the longest last word wins."""
    n = len(label)
    if n > MAX_LABEL:
        return [label]
    best, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
    log_total = math.log(max(total, 1) + 1)
    unknown = unknown or (lambda w: -log_total - len(w) * math.log(10))
    for end in range(1, n + 1):
        for start in range(end):
            c = known.get((start, end - start), 0)
            p = (math.log(c) - log_total if c else unknown(label[start:end])) + (more if start else 0.0)
            if best[start] + p > best[end] + 1e-12:
                best[end], back[end] = best[start] + p, start
    out = []
    while n:
        out.append(label[back[n]:n])
        n = back[n]
    return out[::-1]


class NaiveBayes:
    """Multinomial naive Bayes with add-one smoothing and equal class priors.  With ``balance``
    the counts of the larger class are scaled to the total of the smaller one: a token that
    neither class has is then no evidence.  ``given`` are fixed weights of tokens that are not
    learned (they are left out of the counts)."""

    def __init__(self, rows: Iterable[tuple[bool, Sequence[str]]], balance: bool = False, given: dict[str, float] | None = None):
        given = given or {}
        counts = {True: Counter(), False: Counter()}
        for block, tokens in rows:
            counts[block].update(t for t in tokens if t not in given)
        if balance and counts[True] and counts[False]:
            least = min(c.total() for c in counts.values())
            counts = {k: Counter({t: n * least / c.total() for t, n in c.items()}) for k, c in counts.items()}
        vocabulary = {*counts[True], *counts[False]}
        size = len(vocabulary) + 1
        den = {c: math.log(sum(counts[c].values()) + size) for c in counts}
        self.unknown = den[False] - den[True]
        self.weight = {t: math.log(counts[True][t] + 1) - math.log(counts[False][t] + 1) + self.unknown for t in vocabulary}
        if not counts[True] or not counts[False]:  # one class only: no evidence either way
            self.unknown, self.weight = 0.0, {}
        self.weight |= given

    def score(self, tokens: Iterable[str]) -> float:
        """log P(tokens | block) - log P(tokens | allow)."""
        return math.fsum(self.weight.get(t, self.unknown) for t in tokens)


def path_tokens(path: Column) -> Column:
    """Lower-case runs of letters of the path; a run of digits is one common token."""
    return F.transform(F.regexp_extract_all(F.lower(path), F.lit(r"\p{L}+|[0-9]+"), F.lit(0)),
                       lambda t: F.when(t.rlike("^[0-9]"), F.lit(NUMBER)).otherwise(t))


def host_labels(host: Column) -> Column:
    return F.regexp_extract_all(host, F.lit("[a-z]+"), F.lit(0))


def page_words(url: str, html: str) -> list[str]:
    """Words of a-z, in lower case, in the URL after its host and in the rendered text without host names."""
    rest = url.partition("://")[2] if "://" in url else url
    path = re.sub(r"^[^/?#]*", "", rest) if "://" in url else rest
    text = _HOST.sub(" ", render(parse(html))[0].lower())
    return [w for w in _LETTERS.findall(f"{path.lower()} {text}") if _LATIN.fullmatch(w)]


def word_counts(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(w, c) of :func:`page_words` over all pages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def counted() -> Iterator[pa.RecordBatch]:
            words = list(counts)
            for at in range(0, len(words), OUTPUT_ROWS):
                some = words[at:at + OUTPUT_ROWS]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([counts[w] for w in some], pa.int64())], names=["w", "c"])
            counts.clear()

        for b in slices(batches, 200):
            for url, html in zip(text_column(b, "_url"), text_column(b, "_html")):
                counts.update(page_words(url, html))
                if len(counts) > COUNTED_WORDS:
                    yield from counted()
        yield from counted()

    thin = bounded_batches(pages).select(F.col(url_col).alias("_url"), F.col(html_col).alias("_html"))
    return thin.mapInArrow(run, "w string, c long").groupBy("w").agg(F.sum("c").alias("c"))


def unknown_words(counts: DataFrame, total: int) -> UnknownWords:
    """The model of unknown words for a dictionary (three aggregates of at most 63 rows)."""
    once = counts.where("c = 1").count()
    lengths = counts.groupBy(F.least(F.length("w"), F.lit(MAX_LABEL)).alias("n")).count().collect()
    letters = counts.select(F.explode(F.split("w", "")).alias("x")).where(F.col("x") != "").groupBy("x").count().collect()
    return UnknownWords.fit(once, total, {r["n"]: r["count"] for r in lengths}, {r["x"]: r["count"] for r in letters})


def with_seeds(counts: DataFrame, total: int, seeds: Sequence[str]) -> DataFrame:
    """``counts`` in which every seed is a word."""
    least = F.lit(max(1, math.ceil(SEED_SHARE * total))).cast("long")
    given = counts.sparkSession.createDataFrame([(w,) for w in sorted(set(seeds))], "w string").select("w", least.alias("c"))
    return counts.unionByName(given).groupBy("w").agg(F.max("c").alias("c"))


def split_hosts(hosts: DataFrame, counts: DataFrame, total: int, unknown: UnknownWords) -> DataFrame:
    """(host, host_words) for a table of distinct hosts."""
    more = math.log(MORE_WORDS)
    labels = hosts.select(F.explode(host_labels(F.col("host"))).alias("label")).distinct()
    n = F.length("label")
    sub = F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), n - i)),
        lambda k: F.struct(i.alias("at"), k.alias("len"), F.substr("label", i + 1, k).alias("w")))))
    subs = labels.where(n <= MAX_LABEL).select("label", F.explode(sub).alias("s")).select("label", "s.*")
    known = subs.join(counts, "w").groupBy("label").agg(F.collect_list(F.struct("at", "len", "c")).alias("known"))

    @F.pandas_udf("array<string>")
    def split(label, known):
        return label.__class__([segment(x, {(r["at"], r["len"]): r["c"] for r in (k if k is not None else ())}, total, unknown.log, more)
                                for x, k in zip(label, known)], dtype=object)

    words = labels.join(known, "label", "left").select("label", split("label", "known").alias("words"))
    each = hosts.select("host", F.posexplode_outer(host_labels(F.col("host"))).alias("at", "label"))
    return each.join(words, "label", "left").groupBy("host").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "words"))),
                              lambda x: F.coalesce(x["words"], F.array().cast("array<string>")))).alias("host_words"))


def filter_urls(pages: DataFrame, rules: Sequence[HostRule] = RULES, seeds: Sequence[str] = SEEDS, train_rows: int = 20_000,
                seed_odds: float = 20.0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, host, path, rule, verdict, host_words, score) for every page.

    The score is the log-odds of blocking: those of the classes over all labelled rows, plus the
    model's.  A rule's verdict wins; without one a page is blocked if its score is above 0.  Null
    urls, urls without ``://`` and an empty table are defined: no host, no path, no tokens, the
    odds of the classes (at most even, so allowed).  Repeated rows and null ids keep a row each."""
    host, path = host_and_path(F.col(url_col))
    thin = bounded_batches(pages).select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    hosts = materialize(thin.groupBy("host").count().select("host"), "url-hosts")
    counts = materialize(word_counts(pages, url_col, html_col), "url-words")
    total = counts.agg(F.sum("c")).first()[0] or 0
    split = materialize(split_hosts(hosts, with_seeds(counts, total, seeds), total, unknown_words(counts, total)), "url-split")

    # a word in a path is another feature than the same word in a host
    at_path = F.transform(path_tokens(F.col("path")), lambda t: F.concat(F.lit("/"), t))
    rows = materialize(thin.join(split, "host", "left").withColumn("path_words", at_path), "url-rows")
    block = F.arrays_overlap("host_words", F.array(*[F.lit(s) for s in seeds])) if seeds else F.lit(False)
    order = F.xxhash64("host", "path", "id")
    label = rows.select(F.coalesce(block, F.lit(False)).alias("block"), F.concat(F.coalesce("host_words", F.array().cast("array<string>")), "path_words").alias("t"),
                        order.alias("o"), "host", "path")
    sizes = {r["block"]: r["count"] for r in label.groupBy("block").count().collect()}
    sample = []
    for b in (True, False):  # at most train_rows rows of each class reach the driver
        share = min(1.0, 2 * train_rows / max(sizes.get(b, 0), 1))  # twice as many are drawn by hash, the smallest hashes stay
        drawn = label.where((F.col("block") == b) & (F.pmod("o", F.lit(1 << 30)) <= int(share * (1 << 30))))
        sample += drawn.orderBy("o", "host", "path").limit(train_rows).select("block", "t").collect()
    prior = min(0.0, math.log(sizes.get(True, 0) + 1) - math.log(sizes.get(False, 0) + 1))
    model = NaiveBayes(((r.block, r.t) for r in sample), balance=True, given={w: math.log(seed_odds) for w in seeds})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            got = [prior + model.score([*(h or ()), *(p or ())]) for h, p in
                   zip(b.column("host_words").to_pylist(), b.column("path_words").to_pylist())]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("id", "host", "path", "host_words")], pa.array(got, pa.float64())],
                                             names=["id", "host", "path", "host_words", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"id {kind}, host string, path string, host_words array<string>, score double")
    h, p = F.col("host"), F.col("path")
    return scored.select(
        F.col("id").alias(id_col), "host", "path", rule_for(h, p, rules, "name").alias("rule"),
        F.coalesce(rule_for(h, p, rules, "verdict"), F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"),
        F.array_join("host_words", " ").alias("host_words"), "score")
