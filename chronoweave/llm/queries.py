"""The thin queries that apply the corpus operators to the tables, with their oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.llm import bpe, decontam, html, jaccard, langid, packing, pii, quality, sharding, suffix, treap, urls, whiten
from chronoweave.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


@query("op1_vector_bin_sharding")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.pack_shards(table(spark, sf_dir, "documents"), shards=24, overhead=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                      F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "tokens")


@query("op2_information_theoretic_pii")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.sanitise_spans(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", pii.span_list().alias("spans"))


OP3_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS w
       FROM (SELECT item, ws, least(len(ws), 10) AS n, unnest(generate_series(1, len(ws) - least(len(ws), 10) + 1)) AS i
             FROM b WHERE len(ws) > 0)),
dw AS (SELECT rid, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w
       FROM (SELECT rid, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i
             FROM d, (SELECT DISTINCT n FROM bw) WHERE len(ws) >= n)),
o AS (SELECT rid, dw.n, i, item FROM dw JOIN bw ON dw.w = bw.w AND dw.n = bw.n),
h AS (SELECT rid, count(DISTINCT p) AS n_hit FROM
        (SELECT rid, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT rid, n, i FROM o)) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT rid, item FROM o) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN t USING (rid)
"""


@query("op3_prefix_filtered_decontamination", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, i, ws[i] AS w, CASE WHEN i + 2 <= len(ws) THEN ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] END AS g
      FROM (SELECT rid, ws, unnest(generate_series(1, len(ws))) AS i
            FROM (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d))),
r AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (
        SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM (
          SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM w WHERE g IS NOT NULL) WHERE c > 1) GROUP BY rid),
l AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (SELECT rid, count(*) AS n_words, sum(length(w)) AS word_chars,
             count(CASE WHEN strlen(w) > 64 THEN 1 END) AS n_long FROM w GROUP BY rid),
a AS (SELECT d.doc_id, coalesce(m.n_words, 0) AS n_words, coalesce(m.word_chars, 0)::BIGINT AS word_chars,
             coalesce(m.n_long, 0) AS n_long,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(l.n_lines, 0) AS n_lines, coalesce(l.n_dup_lines, 0) AS n_dup_lines,
             coalesce(r.n_repeat_words, 0) AS n_repeat_words,
             length(regexp_replace(text, '[^A-ZÀ-ÖØ-Þ]', '', 'g')) AS n_upper,
             length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS n_letters,
             length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits
      FROM d LEFT JOIN m USING (rid) LEFT JOIN l USING (rid) LEFT JOIN r USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (n_symbols * 4 > n_words) AND NOT (n_dup_lines * 10 > n_lines * 6)
       AND NOT (n_upper * 10 > n_letters * 6) AND NOT (n_letters * 10 < word_chars * 5)
       AND NOT (n_digits * 10 > word_chars * 3) AND NOT (n_long * 20 > n_words)
       AND ((word_chars < n_words * 2)::INT + (word_chars > n_words * 20)::INT
            + (100 * n_repeat_words > 30 * n_words)::INT) <= 1 AS kept
FROM b
"""


@query("op4_quality_rule_ledger", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality.ledger(table(spark, sf_dir, "documents"))
    base = F.col("failures").bitwiseAND(F.lit(quality.mask(quality.BASE))) != 0
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      base.alias("base_failed"), (~base & quality.verdict(quality.POLICIES["v2"])).alias("kept"))


@query("op5_segmented_host_filter")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"))


@query("op6_pair_merge_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


@query("op7_layout_aware_html")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


@query("op8_two_stage_suffix_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"), length=100).drop("kept")


@query("op9_chosen_path_jaccard")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), threshold=0.8)


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                  public_tokenizers.path("byte_bpe_50k.tiktoken"), size=1024, end_id=2)


@query("op11_byte_network_language")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.fit_and_identify(table(spark, sf_dir, "documents"))


@query("op12_lanczos_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(table(spark, sf_dir, "embeddings"), count=4, scale=256.0)


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
g AS (SELECT count(*) AS nn, sum(len(ts))::BIGINT AS l FROM d WHERE len(ts) > 0),
q AS (SELECT row_number() OVER () AS qid, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS ts FROM benchmark),
qt AS (SELECT qid, item_id, unnest(ts) AS t FROM q),
p AS (SELECT rid, doc_id, n, t, count(*) AS tf FROM (SELECT rid, doc_id, len(ts) AS n, unnest(ts) AS t FROM d)
      WHERE t IN (SELECT t FROM qt) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT t, count(*) AS df FROM p GROUP BY t), g),
s AS (SELECT qid, item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nn) // l))))::BIGINT AS score
      FROM p JOIN w USING (t) JOIN qt USING (t), g GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 10
"""


@query("op13_k2_treap_search", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treap.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)
