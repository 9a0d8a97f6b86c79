"""Best-fit packing of token sequences with swap-based local search.

A document's token ids are cut only if they do not fit one sequence: pieces of ``size``
tokens, the first one shorter.  Whole pieces are sequences of their own; the others are
packed by best fit, longest first, and then improved: documents move, or are exchanged
one-for-one or two-for-one, between underfull bins whenever that raises the sum of squared
fills, until bins run empty or the number of bins reaches the lower bound.

Scale.  Token ids never leave the scan: it emits lengths and checksums.  Pieces are dealt
by hash into cells of about ``cell_items``; a cell's packing ends within a bin or two of
its lower bound.  Bins that stay underfull give their pieces back, and those are dealt
again into fewer cells, so the waste of many cells meets and is packed away.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import bounded_batches, materialize, slices, text_column

_BEYOND_LATIN = re.compile("[^\x00-ɏ]")
#: the byte-level pre-tokenizer's public pattern, a fixed value of the vocabulary
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Ids of the ``tokenizers`` file ``json_path`` (add_special_tokens=False).  Latin texts
    without special strings go through the same vocabulary as ranks, which gives the same
    ids several times faster; all others through the tokenizers library itself."""

    def __init__(self, json_path: str, ranks_path: str | None):
        self.json_path = json_path
        self.full = self.fast = None
        if ranks_path:
            import tiktoken
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks_path, "rb"))}
            self.fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast is not None and "<|" not in text and not _BEYOND_LATIN.search(text):
            return self.fast.encode_ordinary(text)
        if self.full is None:  # loaded by the first text that needs it
            from tokenizers import Tokenizer
            self.full = Tokenizer.from_file(self.json_path)
        return self.full.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=4)
def encoder(json_path: str, ranks_path: str | None) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    return Encoder(json_path, ranks_path)


def cut_pieces(docs: DataFrame, json_path: str, ranks_path: str | None = None, size: int = 1024, end_id: int = 2,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, piece, start, length, ids_crc32): the pieces of every document."""
    thin = bounded_batches(docs).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = thin.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(json_path, ranks_path)
        for b in slices(batches):
            row, piece, start, length, crc = [], [], [], [], []
            for i, t in enumerate(text_column(b, "_text")):
                ids = np.array([*enc.ids(t), end_id], dtype="<u4")
                first = len(ids) % size or size
                cuts = [0, *range(first, len(ids) + 1, size)]
                for k, (s, e) in enumerate(zip(cuts, cuts[1:])):
                    row.append(i)
                    piece.append(k)
                    start.append(s)
                    length.append(e - s)
                    crc.append(zlib.crc32(ids[s:e].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [b.column("_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["_id", "piece", "start", "length", "ids_crc32"])

    return thin.mapInArrow(run, f"_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Best fit, longest first: bins as lists of item positions."""
    bins: list[list[int]] = []
    at: list[list[int]] = [[] for _ in range(size + 1)]  # bins by free room
    rooms: list[int] = []  # the free rooms that some bin has, in order
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        j = bisect_left(rooms, n)
        if j < len(rooms):
            room = rooms[j]
            b = at[room].pop()
            if not at[room]:
                rooms.pop(j)
        else:
            room, b = size, len(bins)
            bins.append([])
        bins[b].append(i)
        left = room - n
        if left:
            if not at[left]:
                insort(rooms, left)
            at[left].append(b)
    return bins


def _gifts(mine: np.ndarray, n: np.ndarray) -> list[tuple[int, ...]]:
    """The single documents and the pairs that a bin can give, one of each length or pair of lengths.

    Documents of equal length are as good as each other, and a bin of 1,024 tokens holds at most 44 different lengths, so
    this is every exchange, however many documents the bin has."""
    of: dict[int, list[int]] = {}
    for x in mine.tolist():
        of.setdefault(int(n[x]), []).append(x)
    first = [xs[0] for xs in of.values()]
    pairs = [(x, y) for i, x in enumerate(first) for y in first[i + 1:]] + [(xs[0], xs[1]) for xs in of.values() if len(xs) > 1]
    return [(x,) for x in first] + pairs


def local_search(bins: list[list[int]], lengths: np.ndarray, size: int) -> list[list[int]]:
    """Empty underfull bins, least filled first.

    For the documents of the bin at hand, every step takes the move, the one-for-one or the
    two-for-one exchange with another underfull bin that raises the sum of squared fills
    most.  Squared fill only rises, so the search ends; a bin that cannot be emptied keeps
    what it has.  It stops once the bins are as few as their total length allows."""
    fill = np.array([int(lengths[b].sum()) for b in bins], dtype=np.int64)
    lower = -(-int(fill.sum()) // size)
    full = [b for b, f in zip(bins, fill) if f == size]
    order = [i for i in np.argsort(fill, kind="stable").tolist() if fill[i] < size]
    part = [list(bins[i]) for i in order]
    fill = fill[order]
    count = len(bins)
    doc = np.array([d for b in part for d in b], dtype=np.int64)
    home = np.array([k for k, b in enumerate(part) for _ in b], dtype=np.int64)
    n = lengths[doc].astype(np.int64) if len(doc) else np.zeros(0, np.int64)
    for k in range(len(part)):
        if count <= lower:
            break
        while True:
            mine = np.flatnonzero(home == k)
            if len(mine) == 0:
                count -= 1
                fill[k] = -1
                break
            gap = np.where(fill < 0, -1, size - fill)
            gap[k] = -1
            best, step = 0, None
            for x in mine.tolist():  # move
                ok = gap >= n[x]
                if ok.any():
                    gain = np.where(ok, 2 * n[x] * (fill - fill[k]) + 2 * n[x] ** 2, -1)
                    c = int(np.argmax(gain))
                    if gain[c] > best:
                        best, step = int(gain[c]), ((x,), None, c)
            if step is None:
                room = gap[home]
                for xs in _gifts(mine, n):  # exchange for one document of another bin
                    d = sum(int(n[x]) for x in xs) - n
                    ok = (d > 0) & (d <= room)
                    if ok.any():
                        gain = np.where(ok, 2 * d * (fill[home] - fill[k]) + 2 * d * d, -1)
                        y = int(np.argmax(gain))
                        if gain[y] > best:
                            best, step = int(gain[y]), (xs, y, int(home[y]))
            if step is None:
                break
            xs, y, c = step
            moved = sum(int(n[x]) for x in xs) - (int(n[y]) if y is not None else 0)
            for x in xs:
                home[x] = c
            if y is not None:
                home[y] = k
            fill[c] += moved
            fill[k] -= moved
    out: list[list[int]] = [[] for _ in part]
    for d, h in zip(doc.tolist(), home.tolist()):
        out[h].append(d)
    return full + [b for b in out if b]


def _pack_cell(size: int, keep_from: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "tie"], ascending=[False, True], ignore_index=True)
        n = pdf["length"].to_numpy(np.int64)
        bins = local_search(best_fit(n, size), n, size)
        at = np.zeros(len(pdf), np.int64)
        off = np.zeros(len(pdf), np.int64)
        kept = np.zeros(len(pdf), bool)
        for k, b in enumerate(bins):
            used = 0
            for i in b:
                at[i], off[i] = k, used
                used += int(n[i])
            kept[b] = used >= keep_from
        return pdf.assign(bin=at, offset=off, kept=kept)
    return run


def pack(pieces: DataFrame, size: int = 1024, cell_items: int = 20_000, rounds: int = 2,
         underfull: float = 0.98) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of at most ``size``.

    Offsets are gapless from 0 in every sequence; ids of sequences are unique and otherwise
    arbitrary (negative for packed ones).  Ties and repeated rows are packed like any other;
    an empty table gives an empty result."""
    row = F.struct(*[F.col(c) for c in pieces.columns]).alias("row")
    rows = materialize(pieces.select(row, "length"), "pack-pieces")
    done = [rows.where(F.col("length") >= size).select(
        "row", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    left = rows.where(F.col("length") < size)
    for r in range(rounds):
        cells = -(-left.count() // cell_items)
        if cells == 0:
            break
        last = cells == 1 or r == rounds - 1
        # a row number in the hash spreads repeated rows over the cells, too
        dealt = left.withColumn("tie", F.xxhash64("row", F.monotonically_increasing_id(), F.lit(r))) \
            .withColumn("cell", F.pmod("tie", F.lit(cells)))
        schema = (f"row {dealt.schema['row'].dataType.simpleString()}, length long, tie long, cell long, "
                  "bin long, offset long, kept boolean")
        packed = materialize(dealt.groupBy("cell").applyInPandas(
            _pack_cell(size, 0 if last else int(size * underfull)), schema), f"pack-round{r}")
        code = (F.lit(r).cast("long") * (1 << 36) + F.col("cell")) * (1 << 20) + F.col("bin") + 1
        done.append(packed.where("kept").select("row", (-code).alias("sequence_id"), "offset"))
        left = packed.where("not kept").select("row", "length")
        if last:
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("row.*", "sequence_id", "offset")


def pack_documents(docs: DataFrame, json_path: str, ranks_path: str | None = None, size: int = 1024, end_id: int = 2,
                   id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per piece of every document: (id, piece, start, length, ids_crc32,
    sequence_id, offset).  A null text is the empty text, whose only id is ``end_id``."""
    return pack(cut_pieces(docs, json_path, ranks_path, size, end_id, id_col, text_col), size, **options) \
        .withColumnRenamed("_id", id_col)
