"""Benchmark decontamination as a prefix-filtered set join (DataFrame functions only).

A *window* is ``window`` consecutive words of a benchmark item (all words of a shorter
item); a document word is hit if it lies in an occurrence of a window.  A window is a set of
five-word shingles (shorter only for windows of fewer words), each with its place:

1. the document scan keeps the shingles that some benchmark window has, with their places
   (a token outside that universe can never match);
2. shingles are ordered by rarity, which is their count over all documents.  Containment
   asks for all shingles of a window, so its prefix is one token, the rarest.  Only prefix
   tokens are joined with the documents' shingles;
3. a candidate start must leave room for the whole window (position and length bounds);
4. it is verified exactly: the document's shingles at the window's places must be the
   window's shingles in order.  Shingles are compared as texts, not as hashes.

Scale.  One pass over the texts; nothing that is shuffled grows with the clean text.  The
benchmark's shingles are broadcast up to a checked number of rows and joined by shuffle
beyond it.  Documents are the only groups, so a passage that a third of them share spreads
over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronoweave.llm.common import materialize, small_side

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHINGLE = 5
#: Rows of the benchmark's shingle and window tables up to which they are broadcast.
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    """Words of a text, A-Z in lower case; a null text has none."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def _slices(ws: Column, n: Column, k: Column | int) -> Column:
    """Array of (pos, k, s): the runs of ``k`` words, joined by a space."""
    k = F.lit(k) if isinstance(k, int) else k
    at = F.when(n >= k, F.sequence(F.lit(0), n - k)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.struct(i.alias("pos"), k.alias("k"), F.array_join(F.slice(ws, i + 1, k), " ").alias("s")))


def windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(wid, len, shingles, items): distinct windows with the ids of the items that have them."""
    item = benchmark.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("ws")) \
        .withColumn("n", F.size("ws")).where("n > 0").withColumn("len", F.least("n", F.lit(window)))
    each = item.select("item", "len", F.explode(_slices(F.col("ws"), F.col("n"), F.col("len"))["s"]).alias("w"))
    dist = each.groupBy("w", "len").agg(F.collect_set("item").alias("items"))
    ws = F.split("w", " ")
    k = F.least("len", F.lit(SHINGLE))
    return materialize(dist.select(F.monotonically_increasing_id().alias("wid"), "len", "items",
                                   _slices(ws, F.col("len"), k)["s"].alias("shingles")), "bench-windows")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """(id, n_words, n_hit, n_items, items array<string>, occurrences) for every row of
    ``docs``: hit words, and the items with occurring windows, sorted as strings.

    Null and empty texts have no words and items without words no windows.  Items that share
    a window all count; an item without an id hits words but is not listed.  Rows that
    repeat an id are told apart.  Empty tables on either side give no hits.  ``carry`` adds
    expressions over ``docs`` to the result."""
    carry = carry or {}
    win = windows(benchmark, item_id_col, item_text_col, window)
    tokens = materialize(win.select(F.explode("shingles").alias("s")).distinct()
                         .select(F.monotonically_increasing_id().alias("sid"), "s"), "bench-shingles")
    sizes = sorted(r[0] for r in win.select(F.least("len", F.lit(SHINGLE)).alias("k")).distinct().collect()) or [SHINGLE]

    base = docs.select(F.col(id_col).alias("id"), F.struct(F.lit(0).alias("_"), *[c.alias(k) for k, c in carry.items()]).alias("more"),
                       F.monotonically_increasing_id().alias("rid"), words(F.col(text_col)).alias("ws")) \
        .withColumn("n_words", F.size("ws"))
    arrays = [_slices(F.col("ws"), F.col("n_words"), k) for k in sizes]
    grams = base.select("id", "more", "rid", "n_words", F.explode_outer(F.concat(*arrays) if len(arrays) > 1 else arrays[0]).alias("g")) \
        .select("id", "more", "rid", "n_words", "g.*")
    first = F.col("pos").isNull() | ((F.col("pos") == 0) & (F.col("k") == sizes[0]))
    hits = materialize(
        grams.join(small_side(tokens, BROADCAST_ROWS), "s", "left")
        .withColumn("first", first).where(F.col("first") | F.col("sid").isNotNull())
        .select("id", "more", "rid", "n_words", "first", "pos", "k", "sid"), "bench-hits")

    rows = hits.where("first").select("id", "more", "rid", "n_words")
    found = hits.where("sid is not null").select("rid", "n_words", "pos", "k", "sid")

    # the rarest shingle of every window all of whose shingles occur somewhere
    rarity = found.groupBy("sid").agg(F.count(F.lit(1)).alias("df"))
    placed = win.select("wid", "len", F.posexplode("shingles").alias("off", "s")) \
        .join(tokens, "s").join(rarity, "sid")
    prefix = materialize(
        placed.groupBy("wid", "len")
        .agg(F.min_by(F.struct("sid", "off"), F.struct("df", "sid", "off")).alias("p"),
             F.sort_array(F.collect_list(F.struct("off", "sid"))).alias("o"))
        .where(F.size("o") == F.col("len") - F.least("len", F.lit(SHINGLE)) + 1)
        .select("wid", "len", F.col("p.sid").alias("sid"), F.col("p.off").alias("off"), F.col("o.sid").alias("sids")), "bench-prefix")

    reach = window - SHINGLE if window > SHINGLE else 0
    near = W.partitionBy("rid", "k").orderBy("pos").rangeBetween(-reach, reach)
    around = found.withColumn("around", F.collect_list(F.struct("pos", "sid")).over(near))
    start = F.col("pos") - F.col("off")
    same = F.transform(F.filter("around", lambda x: (x["pos"] >= F.col("start")) & (x["pos"] < F.col("start") + F.size("sids"))),
                       lambda x: x["sid"]) == F.col("sids")
    verified = (around.join(small_side(prefix, BROADCAST_ROWS), "sid").withColumn("start", start)
                .where((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n_words")))
                .where(same).select("rid", "start", "len", "wid"))
    verified = materialize(verified, "bench-verified")

    ends = W.partitionBy("rid").orderBy("start", "len").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.max(F.col("start") + F.col("len")).over(ends), F.lit(0))
    covered = verified.select("rid", "start", "len").distinct() \
        .withColumn("new", F.greatest(F.lit(0), F.col("start") + F.col("len") - F.greatest("start", before))) \
        .groupBy("rid").agg(F.sum("new").alias("n_hit"), F.count(F.lit(1)).alias("occurrences"))
    items = verified.select("rid", "wid").distinct().join(win.select("wid", "items"), "wid") \
        .select("rid", F.explode("items").alias("item")).groupBy("rid").agg(F.array_sort(F.collect_set("item")).alias("items"))
    none = F.array().cast("array<string>")
    return (rows.join(covered, "rid", "left").join(items, "rid", "left")
            .select(F.col("id").alias(id_col), F.col("n_words").cast("long").alias("n_words"),
                    F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items", none).alias("items"),
                    F.coalesce("occurrences", F.lit(0)).cast("long").alias("occurrences"),
                    *[F.col(f"more.{k}").alias(k) for k in carry]))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
                      item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) without the rows whose text has a hit word."""
    key = {"__corpus_t1": F.xxhash64(text_col), "__corpus_t2": F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))}
    found = decontaminate(docs, benchmark, window, id_col, text_col, item_id_col, item_text_col, carry=key)
    bad = materialize(found.where("n_hit > 0").select("__corpus_t1", "__corpus_t2").distinct(), "bench-dropped")
    return docs.withColumns(key).join(small_side(bad, 200_000), ["__corpus_t1", "__corpus_t2"], "left_anti").select(*docs.columns)
