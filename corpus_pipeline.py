"""The corpus pipeline: quality rules, near-duplicate join, benchmark decontamination,
sanitisation and sequence packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's ``docs``.  All but the last keep the columns of
``documents``; the last returns one row per packed piece.

* ``quality``: documents that the rule policy rejects go.
* ``near_duplicates``: of each group of equal or similar texts the smallest id stays.
* ``decontaminate``: documents with a word in an occurrence of a benchmark window go.
* ``sanitise``: personal data and the terms that disclose it are masked in the texts.
* ``pack``: token sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.llm import decontam, jaccard, packing, pii
from chronoweave.llm import quality as rules
from chronoweave.llm.common import materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the current policy keeps; the texts travel with the ledger, so one pass does."""
    names = docs.columns
    kept = rules.ledger(docs, keep=tuple(names)).where(rules.verdict(rules.POLICIES["v2"]))
    return kept.select(*[F.col(f"doc_{c}" if c in rules.MEASURES else c).alias(c) for c in names])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs, threshold=0.8)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.sanitise(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                  size=1024, end_id=2)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("sanitise", sanitise), ("pack", pack)]
#: the near-duplicate join and the packing search have no SQL form; tests hold every stage
#: against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
