"""Shards by vector bin packing.

Every group of equal texts is a vector (bytes, tokens, rows); it goes to the shard where the
dot product of that vector with the shard's residual capacity is highest, so bytes, tokens
and rows stay balanced together.

Scale.  The greedy rule is sequential, so it runs at two levels:

* *heavy* groups have at least ``1/heavy_parts`` of a shard's capacity in some dimension.
  By that definition there are at most ``3 * shards * heavy_parts`` of them whatever the
  size of the corpus; they are packed first, largest first, and stay whole wherever a shard
  has room for them.  Only a group that no shard has room for is split, by a hash of the row,
  into parts of about a sixteenth of a shard, which are packed after the whole ones.
* *light* groups are dealt by hash into cells of about ``cell_groups`` groups; every cell
  packs its groups into its own share of the residual capacities.  Light groups are small
  against a shard and a cell ends within one small group of its share, so the shares add
  up to balanced shards.

Slots are counts per (shard, block of rows), a prefix over that small table, and a row
number inside each block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronoweave.llm.common import materialize

DIMS = ("bytes", "tokens", "rows")


def dot_product_fit(items: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """Shard of every item.  ``items`` (n, 3) and ``residual`` (shards, 3) are fractions of
    the same totals; large items first, ties to the lowest shard; ``residual`` is used up."""
    out = np.zeros(len(items), np.int32)
    left = residual.copy()
    for i in np.argsort(-items.max(axis=1), kind="stable"):
        s = int(np.argmax(left @ items[i]))
        left[s] -= items[i]
        out[i] = s
    return out


def whole_fit(items: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """Shard of every item by the same rule among the shards with room for it in every
    dimension, -1 for an item that no shard has room for."""
    out = np.full(len(items), -1, np.int32)
    left = residual.copy()
    for i in np.argsort(-items.max(axis=1), kind="stable"):
        score = np.where((left >= items[i] - 1e-12).all(axis=1), left @ items[i], -np.inf)
        s = int(np.argmax(score))
        if score[s] > -np.inf:
            left[s] -= items[i]
            out[i] = s
    return out


def pack_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 24,
                overhead: int = 8, tokens: Column | None = None, heavy_parts: int = 64,
                cell_groups: int = 5_000, block_rows: int = 10_000) -> DataFrame:
    """(id, size, text_crc32, tokens, shard, slot) for every row of ``docs``.

    ``size`` is the UTF-8 bytes of the text plus ``overhead``; ``tokens`` defaults to the
    number of white-space separated words.  A null text has no bytes and no tokens and
    forms one group with the other null texts; repeated rows are ordinary copies; null ids
    and columns beyond the two named are allowed; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    tok = tokens if tokens is not None else F.regexp_count(text, F.lit(r"\S+"))
    thin = materialize(docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"),
        F.coalesce(tok, F.lit(0)).cast("long").alias("tok"),
        F.when(text.isNull(), F.lit(0)).otherwise(F.xxhash64(text)).alias("h")), "shard-rows")

    # a group of equal texts: 64-bit hash, CRC-32, size and token count agree
    key = ["h", "crc", "size", "tok"]
    groups = materialize(
        thin.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).select(
            *key, "n", (F.col("n") * F.col("size")).alias("bytes"),
            (F.col("n") * F.col("tok")).alias("tokens"), F.col("n").alias("rows")), "shard-groups")
    t = groups.agg(*[F.sum(d).alias(d) for d in DIMS], F.count(F.lit(1)).alias("g")).first()
    total = np.maximum(np.array([float(t[d] or 0) for d in DIMS]), 1.0)
    n_rows, n_groups = int(t["rows"] or 0), int(t["g"])
    capacity = total / shards
    share = F.greatest(*[F.col(d) / F.lit(float(c)) for d, c in zip(DIMS, capacity)])
    groups = groups.withColumn("share", share)

    # heavy groups: at most 3 * shards * heavy_parts rows
    heavy = groups.where(F.col("share") >= 1.0 / heavy_parts)
    h = heavy.select(*key, *DIMS, "n", "share").toPandas().sort_values(key, ignore_index=True)
    h["g"] = np.arange(len(h))
    residual = np.full((shards, 3), 1.0 / shards)
    vec = h[list(DIMS)].to_numpy(float).reshape(-1, 3) / total
    h["shard"] = whole_fit(vec, residual)
    whole = h["shard"].to_numpy() >= 0
    np.subtract.at(residual, h["shard"].to_numpy()[whole], vec[whole])
    h["parts"] = np.where(whole, 1, np.minimum(h["n"], np.ceil(h["share"] * 16))).astype(int)
    h_schema = "h long, crc long, size long, tok long, parts int, g int"
    part = F.pmod(F.xxhash64("id", "crc"), F.col("parts")).cast("int")
    split = h[h.parts > 1]
    pieces = h[~whole & (h.parts == 1)][["g", *DIMS]].assign(part=0)
    if len(split):
        cut = spark.createDataFrame(split[[*key, "parts", "g"]], h_schema)
        measured = (thin.join(F.broadcast(cut), key).groupBy("g", part.alias("part"))
                    .agg(F.sum("size").alias("bytes"), F.sum("tok").alias("tokens"),
                         F.count(F.lit(1)).alias("rows")).toPandas())
        pieces = pd.concat([pieces, measured], ignore_index=True)
    pieces = pieces.sort_values(["g", "part"], ignore_index=True)
    vec = pieces[list(DIMS)].to_numpy(float).reshape(-1, 3) / total
    pieces["shard"] = dot_product_fit(vec, residual)
    np.subtract.at(residual, pieces["shard"].to_numpy(), vec)
    residual = np.maximum(residual, 0)
    pieces = pd.concat([pieces, h[whole][["g", "shard"]].assign(part=0)], ignore_index=True)
    to = pd.DataFrame({"shard": pieces["shard"].to_numpy(int)}).groupby(pieces["g"].to_numpy())["shard"]
    by_part = {int(g): dict(zip(pieces.loc[x.index, "part"].astype(int), x.astype(int))) for g, x in to}
    heavy_to = [(int(r.h), int(r.crc), int(r.size_), int(r.tok), int(r.parts),
                 [by_part[int(r.g)].get(p) for p in range(int(r.parts))])
                for r in h.rename(columns={"size": "size_"}).itertuples()]
    heavy_to = spark.createDataFrame(heavy_to, "h long, crc long, size long, tok long, parts int, to array<int>")

    # light groups: cells
    light = groups.where(F.col("share") < 1.0 / heavy_parts)
    cells = max(1, -(-n_groups // cell_groups))
    free = residual / np.maximum(residual.sum(axis=0), 1e-300)

    def pack_cell(pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf[list(DIMS)].to_numpy(float)
        order = np.lexsort([pdf[k].to_numpy() for k in reversed(key)])  # the same whatever the arrival order
        v = v[order] / np.maximum(v.sum(axis=0), 1.0)
        out = pdf.iloc[order][key].copy()
        out["light"] = dot_product_fit(v, free)
        return out

    placed = (light.withColumn("cell", F.pmod(F.xxhash64("h", "crc"), F.lit(cells)))
              .groupBy("cell").applyInPandas(pack_cell, "h long, crc long, size long, tok long, light int"))
    rows = materialize(
        thin.join(F.broadcast(heavy_to), key, "left").join(placed, key, "left")
        .select("id", "size", "crc", "tok",
                F.coalesce(F.get("to", part), F.col("light")).alias("shard")), "shard-placed")
    return numbered(rows, n_rows, block_rows).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
        F.col("tok").alias("tokens"), "shard", "slot")


def numbered(rows: DataFrame, n_rows: int, block_rows: int) -> DataFrame:
    """Add ``slot``: gapless from 0 in every shard, without one task per shard."""
    blocks = max(1, -(-n_rows // block_rows))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "crc"), F.lit(blocks)))
    before = W.partitionBy("shard").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "block").count().select(
        "shard", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    inside = W.partitionBy("shard", "block").orderBy("id", "crc", "size")
    return (rows.join(starts, ["shard", "block"])
            .withColumn("slot", F.col("start") + F.row_number().over(inside) - 1))
