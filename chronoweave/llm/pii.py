"""Information-theoretic sanitisation.

Personal data found by fixed patterns (email, ip, card, phone) are the protected entities.
Corpus co-occurrence then estimates how strongly the words around a mention reveal its
entity.  ``n_t`` are the occurrences of a term in the corpus and ``n_te`` those within
``window`` words of a mention of the entity; copies of one surrounding count once in both.
``n_e`` is the sum of ``n_te`` over the terms and ``N`` the number of word places.  A few
occurrences prove little, so ``contexts`` further ones away from the entity are assumed:

    P(e | t) = n_te / (n_t + contexts),    IC(e) = log2(N / n_e),
    disclosure(t, e) = 1 + log2 P(e | t) / IC(e)  =  PMI / IC,

which nears 1 for a term that often stands near the entity and never elsewhere.  No entity is
too rare to be scored: IC is largest for those.  A term is generalised from ``generalise_at``
on and removed from ``remove_at`` on, wherever it stands in a text that mentions the entity.

Scale.  One pass over the texts writes document rows, the words near mentions, all words of
texts with a mention and the word counts of each batch; the rest are partial aggregates and
joins.  Words are joined with the disclosing terms first: such a term is rare and has few
entities, so the join is linear in the words, where terms by texts of an entity are not.  No group of one entity is ever gathered.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from chronoweave.llm.common import bounded_batches, materialize, slices, small_side, text_column

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only start where a run of digits starts, so the look-behind changes nothing
# but the time spent on long runs of digits
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")
_WORD = re.compile(r"\w+")
#: different words a worker counts before it passes the counts on
COUNTED_WORDS = 150_000
#: rows of one batch of counts (most of its columns are null, but take their width)
OUTPUT_ROWS = 10_000
#: disclosing (entity, term) pairs up to which they are broadcast
BROADCAST_TERMS = 100_000


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``local@domain.tld`` found from the @ signs: the local part is the run of
    its characters before the sign, cut at the end of the match before."""
    end, at = 0, text.find("@")
    floor = 0
    while at >= 0:
        before = text[max(end, floor):at]
        start = at - (len(before) - len(before.rstrip(_LOCAL)))
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            end = m.end()
            yield start, end
        floor = at + 1
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def find_base(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all base spans, by kind and then start."""
    out = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        d = _NOT_DIGITS.sub("", m.group())
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGITS.sub("", m.group())) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def entity(kind: int, value: str) -> str:
    """What two mentions of the same thing have in common."""
    return f"{KINDS[kind]}:{_NOT_DIGITS.sub('', value) if kind > 1 else value.lower()}"


def words_outside(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, str]]:
    """(start, end, word) of the words outside base spans."""
    taken = sorted((s, e) for _, s, e in base)
    words, k = [], 0
    for m in _WORD.finditer(text):
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        if k == len(taken) or m.end() <= taken[k][0]:
            words.append((m.start(), m.end(), m.group()))
    return words


def near_mentions(text: str, base: list[tuple[int, int, int]], window: int, words: list[tuple[int, int, str]] | None = None):
    """Words outside base spans: their counts, and (entity, term, context, start, end) of
    those within ``window`` words of a mention.  The context is a hash of the window."""
    words = words_outside(text, base) if words is None else words
    starts = [w[0] for w in words]
    from bisect import bisect_left
    seen, near = set(), []
    for kind, s, e in base:
        who = entity(kind, text[s:e])
        at = bisect_left(starts, s)
        around = words[max(0, at - window):at + window]
        mark = " ".join(w[2] for w in around).encode("utf-8", "surrogatepass")
        ctx = int.from_bytes(hashlib.blake2b(mark, digest_size=8).digest(), "little", signed=True)
        for a, b, w in around:
            if (who, a) not in seen:
                seen.add((who, a))
                near.append((who, w.lower(), ctx, a, b))
    return Counter(w[2] for w in words), near


_SCAN = ("row_kind byte, k1 long, k2 long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
         "base_spans string, entity string, term string, ctx long, start long, end long, n long")
_COLS = [c.split(" ")[0] for c in _SCAN.split(", ")]


def scan(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """One pass over the texts: document rows (row_kind 0), words near mentions (1), the
    word counts of each batch (2) and all words of texts with a mention (3)."""
    thin = bounded_batches(docs).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *row_key(id_col, text_col))
    kind = thin.schema["_id"].dataType.simpleString()
    id_type = to_arrow_type(thin.schema["_id"].dataType)
    types = {"base_sha256": pa.string(), "base_spans": pa.string(), "entity": pa.string(), "term": pa.string()}

    def part(which: int, n: int, given: dict[str, pa.Array]) -> pa.RecordBatch:
        cols = {"_id": pa.nulls(n, id_type), "row_kind": pa.array([which] * n, pa.int8())} | given
        return pa.RecordBatch.from_arrays(
            [cols[c] if c in cols else pa.nulls(n, types.get(c, pa.int64())) for c in ["_id", *_COLS]], names=["_id", *_COLS])

    def counted(counts: Counter) -> Iterator[pa.RecordBatch]:
        low: Counter = Counter()
        for w, c in counts.items():
            low[w.lower()] += c
        counts.clear()
        words = list(low)
        for at in range(0, len(words), OUTPUT_ROWS):
            some = words[at:at + OUTPUT_ROWS]
            yield part(2, len(some), {"term": pa.array(some, pa.string()), "n": pa.array([low[w] for w in some], pa.int64())})

    def placed(places: list, k1: pa.Array, k2: pa.Array) -> pa.RecordBatch:
        own, term, start, end = zip(*places)
        own = pa.array(own, pa.int64())
        return part(3, len(places), {"k1": k1.take(own), "k2": k2.take(own), "term": pa.array(term, pa.string()),
                                     "start": pa.array(start, pa.int64()), "end": pa.array(end, pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in slices(batches):
            doc, near, owner, places = [], [], [], []
            k1, k2 = b.column("k1"), b.column("k2")
            for i, t in enumerate(text_column(b, "_text")):
                base = find_base(t)
                if base:
                    words = words_outside(t, base)
                    c, found = near_mentions(t, base, window, words)
                    counts.update(c)
                    near += found
                    owner += [i] * len(found)
                    for s, e, w in words:
                        places.append((i, w.lower(), s, e))
                        if len(places) >= OUTPUT_ROWS:
                            yield placed(places, k1, k2)
                            places = []
                else:
                    counts.update(_WORD.findall(t))
                spans = ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in base)
                n = [0, 0, 0, 0]
                for k, _, _ in base:
                    n[k] += 1
                doc.append((*n, hashlib.sha256(spans.encode()).hexdigest(), spans))
            if places:
                yield placed(places, k1, k2)
            e = list(zip(*doc))
            yield part(0, len(doc), {"_id": b.column("_id"), "k1": k1, "k2": k2, **{
                c: pa.array(e[j], pa.string() if j > 3 else pa.int64())
                for j, c in enumerate(("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base_spans"))}})
            if near:
                own, e = pa.array(owner, pa.int64()), list(zip(*near))
                yield part(1, len(near), {"k1": k1.take(own), "k2": k2.take(own), **{
                    c: pa.array(e[j], pa.string() if j < 2 else pa.int64())
                    for j, c in enumerate(("entity", "term", "ctx", "start", "end"))}})
            if len(counts) > COUNTED_WORDS:
                yield from counted(counts)
        if counts:
            yield from counted(counts)

    return thin.mapInArrow(run, f"_id {kind}, {_SCAN}")


def row_key(id_col: str, text_col: str):
    """Two longs that stand for (id, text); rows equal in both have equal spans."""
    return (F.xxhash64(id_col, text_col).alias("k1"),
            F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("k2"))


def disclosing(scanned: DataFrame, contexts: int, generalise_at: float, remove_at: float) -> DataFrame:
    """(entity, term, disclosure, action) of the terms that exceed a threshold."""
    near = scanned.where("row_kind = 1")
    places = scanned.where("row_kind = 2").groupBy("term").agg(F.sum("n").alias("n_t"))
    total = scanned.where("row_kind = 2").agg(F.sum("n")).first()[0] or 0
    pair = (near.groupBy("entity", "term", "ctx").agg(F.count(F.lit(1)).alias("c"))
            .groupBy("entity", "term").agg(F.sum("c").alias("n_all"), F.count(F.lit(1)).alias("n_te")))
    ent = pair.groupBy("entity").agg(F.sum("n_te").alias("n_e"))
    ic = F.log2(F.lit(float(total)) / F.col("n_e"))
    share = F.col("n_te") / (F.col("n_t") - F.col("n_all") + F.col("n_te") + F.lit(contexts))
    return (pair.join(ent, "entity").join(places, "term")
            .withColumn("disclosure", F.when(ic > 0, 1 + F.log2(share) / ic).otherwise(0.0))
            .where(F.col("disclosure") >= generalise_at)
            .select("entity", "term", "disclosure",
                    F.when(F.col("disclosure") >= remove_at, "remove").otherwise("generalise").alias("action")))


def sanitise_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 8, contexts: int = 3,
                   generalise_at: float = 0.85, remove_at: float = 0.97) -> DataFrame:
    """(id, k1, k2, n_email, n_ip, n_card, n_phone, base_sha256, base_spans, term_spans) for
    every row; ``term_spans`` is an array of (start, end, action) in order of start.

    A null text is the empty text; ids may be null; rows that repeat both id and text have
    equal spans; positions are code points, ends exclusive; an empty table gives an empty
    result; matches and texts of any length are handled in linear time."""
    scanned = materialize(scan(docs, id_col, text_col, window), "pii-scan")
    reveal = materialize(disclosing(scanned, contexts, generalise_at, remove_at), "pii-terms")
    mentions = scanned.where("row_kind = 1").select("k1", "k2", "entity").distinct()
    spans = (scanned.where("row_kind = 3").select("k1", "k2", "term", "start", "end")
             .join(small_side(reveal, BROADCAST_TERMS).select("entity", "term", "action"), "term")
             .join(mentions, ["k1", "k2", "entity"])
             .groupBy("k1", "k2", "start", "end").agg(F.max("action").alias("action"))  # remove beats generalise
             .groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("start", "end", "action"))).alias("term_spans")))
    none = F.array().cast("array<struct<start:bigint,end:bigint,action:string>>")
    return (scanned.where("row_kind = 0").select(F.col("_id").alias(id_col), *_COLS[1:9])
            .join(spans, ["k1", "k2"], "left").withColumn("term_spans", F.coalesce("term_spans", none)))


def span_list(base: str = "base_spans", terms: str = "term_spans"):
    """All spans as kind:start:end, base kinds first, comma-joined."""
    extra = F.transform(F.col(terms), lambda x: F.concat_ws(":", F.lit(TERM), x["start"].cast("string"), x["end"].cast("string")))
    return F.array_join(F.filter(F.concat(F.array(F.col(base)), extra), lambda x: x != ""), ",")


def redact(text: str, base: str, terms: list) -> str:
    """The sanitised text: base spans become [KIND], generalised terms their class ([WORD]
    or [NUMBER]), removed terms nothing.  Where spans of several kinds overlap they merge
    and the first named kind stands for all."""
    marks = []
    for i, s in enumerate(base.split(",") if base else []):
        k, a, b = s.split(":")
        marks.append((int(a), int(b), KINDS.index(k), f"[{k.upper()}]"))
    for t in terms:
        word = text[t["start"]:t["end"]]
        new = "" if t["action"] == "remove" else "[NUMBER]" if word.isdigit() else "[WORD]"
        marks.append((t["start"], t["end"], len(KINDS), new))
    marks.sort()
    merged: list[list] = []
    for a, b, rank, new in marks:
        if merged and a < merged[-1][1]:
            m = merged[-1]
            m[1] = max(m[1], b)
            if rank < m[2]:
                m[2], m[3] = rank, new
        else:
            merged.append([a, b, rank, new])
    out, at = [], 0
    for a, b, _, new in merged:
        out += [text[at:a], new]
        at = b
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with sanitised texts and all its columns; rows without spans keep their text
    (null included) as it is."""
    spans = sanitise_spans(docs, id_col, text_col, **options)
    spans = materialize(spans.where((F.col("base_spans") != "") | (F.size("term_spans") > 0))
                        .groupBy("k1", "k2").agg(F.first("base_spans").alias("base_spans"),
                                                 F.first("term_spans").alias("term_spans")), "pii-spans")
    names = docs.columns
    keyed = docs.select("*", *[c.alias(f"__corpus_{n}") for c, n in zip(row_key(id_col, text_col), ("k1", "k2"))])
    spans = spans.select(F.col("k1").alias("__corpus_k1"), F.col("k2").alias("__corpus_k2"), F.col("base_spans").alias("__corpus_base"),
                         F.col("term_spans").alias("__corpus_terms"))

    @F.pandas_udf("string")
    def new_text(text, base, terms):
        return text.__class__([redact(t, b, x) for t, b, x in zip(text, base, terms)], dtype=object)

    joined = keyed.join(small_side(spans, 200_000), ["__corpus_k1", "__corpus_k2"], "left")
    done = F.when(F.col("__corpus_base").isNull(), F.col(text_col)).otherwise(
        new_text(F.when(F.col("__corpus_base").isNotNull(), F.col(text_col)).otherwise(F.lit("")),
                 F.coalesce("__corpus_base", F.lit("")), F.coalesce("__corpus_terms", F.array().cast("array<struct<start:bigint,end:bigint,action:string>>"))))
    return joined.select(*[done.alias(c) if c == text_col else F.col(c) for c in names])
