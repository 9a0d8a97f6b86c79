"""Ranked lexical search with a K2-treap over the term x document grid.

*Index.*  Documents are taken in ranges of at most ``range_docs`` rows and ``range_bytes`` bytes of
text.  A range is a grid: its terms are the rows, its documents (by ascending id) the columns, and
a cell's value is the impact of the term in the document without the term's weight,
(10^9 tf) div (1000 tf + 8 m).  The grid is stored as a compressed quadtree: level by level, a
node keeps four bits for its non-empty quadrants and the largest impact in its square.
Children are found by counting bits, so no pointers are stored.  Rows are ordered by their
largest impact, so that terms that share a square have similar maxima.

*Search.*  For a query, every term has a path of nodes down its own row; the paths descend together
over halves of the document range.  The sum of weight x node maximum bounds the score of any
document in the half.  Halves wait in order of their bound; the best are opened first (some
dozens at a time, as arrays), and a half whose bound cannot reach the k best found so far
is never opened.  At single documents the bound is the score.  The k best of a query are kept
from range to range of a task, so later ranges are pruned by them.

Statistics.  N, L and every document frequency are counted over all documents; the index holds
every document and every term.

Scale.  One pass reads the texts, one builds the index (no shuffle, one task holds one range), and
a block of queries is one pass over the index: tasks send their k best of each query, ranked in
two steps.  Queries are taken in blocks of about ``block_terms`` terms; a block is what is sent to
the tasks.  Nothing is keyed by a term while scores are made, so a very frequent term is no hot key;
document frequencies are added up within tasks before they are shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronoweave.llm.common import bounded_batches, materialize, slices

PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: in UTF-8 the pattern's characters are the ASCII letters and digits and every byte from 128 on; A-Z go
#: to lower case, all others to a space
BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
NO_ID = np.iinfo(np.int64).max
#: halves of document ranges opened at a time
OPEN = 128


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a UTF-8 text, A-Z in lower case; a null text has none."""
    return text.translate(BYTES).split() if text else []


def damping(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """m of documents of ``n`` terms."""
    return 100 - 90 + (90 * n * docs) // total


def weight(df: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


# ---- the quadtree ---------------------------------------------------------------------------


def spread_bits(v: np.ndarray) -> np.ndarray:
    """Bits of 32-bit numbers moved to the even places of 64-bit ones."""
    v = v.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        v = (v | (v << np.uint64(shift))) & np.uint64(mask)
    return v


def build(rows: np.ndarray, cols: np.ndarray, values: np.ndarray) -> tuple[int, list[np.ndarray], list[np.ndarray]]:
    """(levels, masks, maxima) of the quadtree of distinct cells (row, col) with positive values.

    ``maxima[l]`` are the largest values of the nodes of level ``l`` in Morton order (level 0 is
    the whole grid, level ``levels`` the cells); ``masks[l]`` their non-empty quadrants."""
    side = int(max(rows.max(initial=0), cols.max(initial=0))) + 1
    levels = max(1, (side - 1).bit_length())
    code = (spread_bits(rows) << np.uint64(1)) | spread_bits(cols)
    order = np.argsort(code, kind="stable")
    code, top = code[order], values[order].astype(np.uint32)
    maxima, masks = [top], []
    for _ in range(levels):
        parent = code >> np.uint64(2)
        start = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
        bits = (np.uint8(1) << (code & np.uint64(3)).astype(np.uint8)).astype(np.uint8)
        masks.append(np.bitwise_or.reduceat(bits, start))
        top = np.maximum.reduceat(top, start)
        code = parent[start]
        maxima.append(top)
    return levels, masks[::-1], maxima[::-1]


_COUNT = np.array([bin(i).count("1") for i in range(16)], np.int32)


class Grid:
    """A range's quadtree, opened for searching.  Node -1 is the empty square: the last entry of
    every level stands for it."""

    def __init__(self, levels: int, masks: list[np.ndarray], maxima: list[np.ndarray], ids: np.ndarray, names: list[bytes]):
        self.levels, self.ids, self.names = levels, ids, names
        self.cells = len(maxima[-1]) if maxima else 0
        self.masks = [np.r_[m, np.uint8(0)] for m in masks]
        self.first = [np.r_[np.cumsum(_COUNT[m]) - _COUNT[m], 0].astype(np.int32) for m in masks]
        self.maxima = [np.r_[v, 0].astype(np.uint32) for v in maxima]

    def children(self, level: int, node: np.ndarray, row_half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of nodes in the given row halves, in the left and in the right half of the columns."""
        m, first = self.masks[level][node], self.first[level][node]
        left = row_half * 2
        below = _COUNT[m & ((1 << left) - 1)]
        has_left = (m >> left) & 1
        a = np.where(has_left, first + below, -1)
        b = np.where((m >> (left + 1)) & 1, first + below + has_left, -1)
        return a, b

    def bounds(self, level: int, node: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Sum of weight x maximum over the terms (second axis)."""
        # sums of weight x maximum stay below 2^53 (checked by the search), so doubles hold them exactly
        return self.maxima[level][node].astype(np.float64) @ weights


def search(grid: Grid, rows: np.ndarray, weights: np.ndarray, best: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
    """The k best (score, id), scores falling, ids rising among equals, of ``best`` and the grid.

    ``rows`` are the query's terms among the grid's rows, ``weights`` their weights."""
    live = weights > 0
    rows, weights = rows[live], weights[live]
    if len(rows) == 0 or grid.cells == 0:
        return best
    if float(grid.maxima[0][0]) * float(weights.sum()) >= 2.0 ** 53:
        raise ValueError("too many terms for exact scores in doubles")
    weights = weights.astype(np.float64)
    bits = ((rows[:, None] >> np.arange(grid.levels)[::-1]) & 1).astype(np.uint8)
    size = len(grid.ids)
    start = np.zeros((1, len(rows)), np.int32)
    wait: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {0: (grid.bounds(0, start, weights), np.zeros(1, np.int64), start)}
    while wait:
        floor, floor_id = best[-1] if len(best) == k else (0, NO_ID)
        level = max(wait, key=lambda v: int(wait[v][0].max()))
        bound, col, node = wait.pop(level)
        # a half is of use if it can beat the k-th best, or equal it with a smaller id
        shift = grid.levels - level
        use = (bound > floor) | ((bound == floor) & (grid.ids[np.minimum(col << shift, size - 1)] < floor_id))
        if not use.all():
            bound, col, node = bound[use], col[use], node[use]
        if len(bound) == 0:
            continue
        if len(bound) > OPEN:
            order = np.argpartition(-bound, OPEN - 1)
            rest = order[OPEN:]
            wait[level] = (bound[rest], col[rest], node[rest])
            order = order[:OPEN]
            bound, col, node = bound[order], col[order], node[order]
        if level == grid.levels:
            best = sorted(best + list(zip(bound.astype(np.int64).tolist(), grid.ids[col].tolist())), key=lambda x: (-x[0], x[1]))[:k]
            continue
        left, right = grid.children(level, node, bits[None, :, level])
        c = np.r_[col * 2, col * 2 + 1]
        n = np.concatenate([left, right])
        b = grid.bounds(level + 1, n, weights)
        keep = b > 0
        b, c, n = b[keep], c[keep], n[keep]
        if len(b):
            if level + 1 in wait:
                o = wait[level + 1]
                b, c, n = np.r_[o[0], b], np.r_[o[1], c], np.concatenate([o[2], n])
            wait[level + 1] = (b, c, n)
    return best


# ---- the index ------------------------------------------------------------------------------

FORWARD = "docs int, total long, ids array<long>, lengths array<int>, names binary, held binary, rows binary, tfs binary"
INDEX = "levels int, ids array<long>, names binary, df array<int>, mask_sizes array<int>, tree binary"


def pack(raw: bytes) -> bytes:
    """Compressed bytes behind their length."""
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], decompressed_size=int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)


def tree_bytes(masks: list[np.ndarray], maxima: list[np.ndarray]) -> bytes:
    """The quadtree as stored: all masks, the root's maximum, and below it what each maximum falls short of its parent's."""
    short = [np.repeat(up, _COUNT[m]) - v for m, up, v in zip(masks, maxima[:-1], maxima[1:])]
    return pack(b"".join(m.tobytes() for m in masks) + np.concatenate([maxima[0], *short]).astype(np.uint32).tobytes())


def open_tree(packed: bytes, sizes: list[int]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(masks, maxima) of stored quadtrees; ``sizes`` are the numbers of inner nodes of the levels."""
    # every node but the root is a child: a level is as large as its parents' masks say, the last one is the cells
    inner, raw = sum(sizes), unpack(packed)
    flat, values = np.frombuffer(raw, np.uint8, inner), np.frombuffer(raw[inner:], np.uint32)
    masks, maxima, at, low = [], [values[:1]], 0, 1
    for n in sizes:
        m = flat[at:at + n]
        at += n
        below = np.repeat(maxima[-1], _COUNT[m])
        masks.append(m)
        maxima.append(below - values[low:low + len(below)])
        low += len(below)
    return masks, maxima


class Range:
    """The documents of a range as they are read: ids, lengths, and for every document its terms' numbers in
    the range's lexicon with their frequencies.  Texts and their words are not kept."""

    def __init__(self):
        self.lexicon: dict[bytes, int] = {}
        self.ids: list[int] = []
        self.lengths: list[int] = []
        self.rows: list[np.ndarray] = []
        self.tfs: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, text: bytes | None) -> None:
        words = terms(text)
        if not words:
            return
        counts = Counter(words)
        number = self.lexicon.setdefault
        # a new term gets the next number
        self.rows.append(np.fromiter([number(t, len(self.lexicon)) for t in counts], np.int32, len(counts)))
        self.tfs.append(np.fromiter(counts.values(), np.int32, len(counts)))
        self.ids.append(NO_ID if doc_id is None else doc_id)
        self.lengths.append(len(words))
        self.size += len(text)

    def batch(self) -> pa.RecordBatch:
        held = np.array([len(r) for r in self.rows], np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array([len(self.ids)], pa.int32()), pa.array([sum(self.lengths)], pa.int64()), pa.array([self.ids], pa.list_(pa.int64())),
             pa.array([self.lengths], pa.list_(pa.int32())), pa.array([b"\n".join(self.lexicon)]), pa.array([pack(held.tobytes())]),
             pa.array([pack(np.concatenate(self.rows).tobytes())]), pa.array([pack(np.concatenate(self.tfs).tobytes())])],
            ["docs", "total", "ids", "lengths", "names", "held", "rows", "tfs"])


def _grid(ids: np.ndarray, lengths: np.ndarray, names: list[bytes], held: np.ndarray, r: np.ndarray, tf: np.ndarray, docs: int,
          total: int) -> pa.RecordBatch:
    """A range's row of the index."""
    order = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    m = 8 * damping(lengths.astype(np.int64), docs, total)
    value = (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + np.repeat(m, held))
    df = np.bincount(r, minlength=len(names))
    largest = np.zeros(len(names), np.int64)
    np.maximum.at(largest, r, value)
    rank = np.argsort(-largest, kind="stable")
    row = np.empty(len(names), np.int64)
    row[rank] = np.arange(len(names))
    levels, masks, maxima = build(row[r], np.repeat(place, held), value)
    return pa.RecordBatch.from_arrays(
        [pa.array([levels], pa.int32()), pa.array([ids[order].tolist()], pa.list_(pa.int64())),
         pa.array([b"\n".join(names[i] for i in rank)]), pa.array([df[rank].tolist()], pa.list_(pa.int32())),
         pa.array([[len(m) for m in masks]], pa.list_(pa.int32())), pa.array([tree_bytes(masks, maxima)])],
        ["levels", "ids", "names", "df", "mask_sizes", "tree"])


def open_range(row: dict) -> Grid:
    """The quadtree of an index row."""
    masks, maxima = open_tree(row["tree"], row["mask_sizes"])
    names = row["names"].split(b"\n") if row["names"] else []
    return Grid(row["levels"], masks, maxima, np.array(row["ids"], np.int64), names)


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_docs: int = 8192,
          range_bytes: int = 8 << 20) -> tuple[DataFrame, int, int]:
    """(index table, N, L) of all rows of ``docs``.  A null text has no terms; documents without terms
    are in no grid.  A null id counts as the largest; rows that repeat an id are documents each.

    Texts are read once: the ranges are stored as term numbers and frequencies, N and L are added up from them, and
    the quadtrees, whose impacts need N and L, are built from the stored ranges."""
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Range()
        for b in slices(batches, 256):
            for i, t in zip(b.column("id").to_pylist(), b.column("text").to_pylist()):
                held.add(i, t)
                if len(held.ids) >= range_docs or held.size >= range_bytes:
                    yield held.batch()
                    held = Range()
        if held.ids:
            yield held.batch()

    forward = materialize(bounded_batches(base).mapInArrow(read, FORWARD), "treap-forward")
    s = forward.agg(F.sum("docs").alias("docs"), F.sum("total").alias("total")).first()
    n_docs, total = int(s["docs"] or 0), int(s["total"] or 0)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            row = {c: b.column(c)[0] for c in ("names", "held", "rows", "tfs")}
            ids, lengths = (b.column(c).flatten().to_numpy() for c in ("ids", "lengths"))
            ints = [np.frombuffer(unpack(row[c].as_py()), np.int32) for c in ("held", "rows", "tfs")]
            yield _grid(ids, lengths, row["names"].as_py().split(b"\n"), *ints, n_docs, total)

    return materialize(bounded_batches(forward.drop("docs", "total")).mapInArrow(grow, INDEX), "treap-index"), n_docs, total


def _frequencies(idx: DataFrame, wanted: set[bytes]) -> dict[bytes, int]:
    """Document frequencies of the wanted terms, added up within tasks first."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in slices(batches, 1):
            names = b.column("names")[0].as_py().split(b"\n")
            df = b.column("df").flatten().to_numpy(zero_copy_only=False)
            for i, t in enumerate(names):
                if t in wanted:
                    total[t] += int(df[i])
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["t", "df"])

    rows = idx.select("names", "df").mapInArrow(work, "t binary, df long").groupBy("t").agg(F.sum("df").alias("df")).collect()
    return {bytes(r["t"]): int(r["df"]) for r in rows}


def rank(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
         item_id_col: str = "item_id", item_text_col: str = "text", block_terms: int = 100_000, **ranges) -> DataFrame:
    """(item id, rank, id, score): the ``k`` highest-scoring documents of every row of ``queries``.

    Only scores above 0 count; equal scores go by ascending id, a null id last.  A query whose text
    is null or has no terms, or none that a document holds, gives no rows.  Rows that repeat an item
    id are ranked each for itself.  Empty tables on either side give no rows."""
    kind = queries.select(F.col(item_id_col)).schema[0].dataType.simpleString()
    asked = materialize(
        queries.select(F.col(item_id_col).alias("item"), F.monotonically_increasing_id().alias("qid"),
                       F.array_distinct(F.regexp_extract_all(F.translate(
                           F.coalesce(F.col(item_text_col).cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                           "abcdefghijklmnopqrstuvwxyz"), F.lit(PATTERN), F.lit(0))).alias("terms")).where(F.size("terms") > 0), "treap-queries")
    idx, n_docs, _ = index(docs, id_col, text_col, **ranges)
    count = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-count // block_terms)
    found = []
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == b).collect()
        if rows and n_docs:
            found.append(_block(idx, {r["qid"]: [t.encode() for t in r["terms"]] for r in rows}, n_docs, k))
    spark = docs.sparkSession
    hits = reduce(DataFrame.union, found) if found else spark.createDataFrame([], "qid long, score long, id long")
    order = W.partitionBy("qid").orderBy(F.desc("score"), F.asc("id"))
    top = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    out = top.join(asked.select("qid", "item"), "qid")
    return out.select(F.col("item").cast(kind).alias(item_id_col), F.col("rank").cast("int").alias("rank"),
                      F.when(F.col("id") != NO_ID, F.col("id")).alias(id_col), "score")


def _block(idx: DataFrame, queries: dict[int, list[bytes]], n_docs: int, k: int) -> DataFrame:
    """(qid, score, id): every task's k best of each query of a block."""
    df = _frequencies(idx, {t for q in queries.values() for t in q})
    weights = {t: weight(d, n_docs) for t, d in df.items()}
    lexicon = {t: i for i, t in enumerate(weights)}
    known = {q: np.array([lexicon[t] for t in ts if t in lexicon], np.int64) for q, ts in queries.items()}
    value = np.array(list(weights.values()), np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, int]]] = {q: [] for q in known}
        for b in slices(batches, 1):
            grid = open_range(b.to_pylist()[0])
            row = np.full(len(lexicon), -1, np.int64)
            for i, t in enumerate(grid.names):
                at = lexicon.get(t)
                if at is not None:
                    row[at] = i
            for q, ts in known.items():
                here = ts[row[ts] >= 0]
                best[q] = search(grid, row[here], value[here], best[q], k)
        out = [(q, s, i) for q, found in best.items() for s, i in found]
        cols = list(zip(*out)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["qid", "score", "id"])

    return idx.mapInArrow(work, "qid long, score long, id long")
