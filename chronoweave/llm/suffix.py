"""Removal of repeated byte strings with suffix arrays built by two-stage sorting.

Every byte covered by a string of ``length`` bytes (a *window*) that also starts earlier
(smaller id, or same document and earlier start) is removed; repeats are judged on the input.

Distribution.  A window's key is the smallest hash of its 32-byte substrings; equal windows
have equal keys wherever they stand.  A *segment* is a maximal run of windows of a document
with one key, about one per 35 bytes, and its row is small: key, content hash, place.

1. Rows are pre-aggregated in the scan (equal segments of a batch: all but the earliest are
   repeats and go no further than their place), then grouped by key.  Segments equal to an
   earlier one are repeats as a whole.
2. Where a key has several different segments, or a segment may repeat inside itself, the
   earliest segment of each content gets its bytes, and the segments of a key go through a
   suffix array: suffixes smaller than their successors are sorted directly, all others are
   induced by scanning the buckets of first bytes in order, and neighbours whose common
   prefix reaches the window length are equal windows.
3. A key with more than ``hot`` different segments (the surroundings of a passage that many
   documents share) is split: its windows are grouped by a 128-bit hash of their own.

No step gathers the occurrences of a common passage: the scan sends one row per batch, and
the windows of its surroundings differ.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import bounded_batches, materialize, runs, whole_groups

KMER = 32
PIECE = 1_000_000  # windows hashed at a time; a longer text is hashed in pieces
BATCH = 8_000_000  # bytes of text whose segments are pre-aggregated together
SUFFIX_BYTES = 1_000_000  # bytes of whole keys per suffix array
END = 0xFF  # never occurs in UTF-8
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]  # odd multipliers
_NO_ID = -(1 << 63)


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(29)
    x *= _C[1]
    x ^= x >> np.uint64(32)
    return x


def eight_bytes(buf: bytes, n: int) -> np.ndarray:
    """The eight bytes from every place on, as big-endian numbers (zeros past the end)."""
    padded = buf + bytes(16)
    out = np.empty(n, np.uint64)
    for r in range(min(8, n)):
        part = out[r::8]
        part[:] = np.frombuffer(padded, ">u8", count=len(part), offset=r)
    return out


def _sliding(x: np.ndarray, w: int, op) -> np.ndarray:
    """Minimum or maximum of every run of ``w`` values, by doubling."""
    m, s = x, 1
    while 2 * s <= w:
        m = op(m[:-s], m[s:])
        s *= 2
    return op(m[:len(m) - (w - s)], m[w - s:]) if s < w else m


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", int(_C[3])), ("down", pow(int(_C[3]), -1, 1 << 64))):
            _POWERS[name] = np.cumprod(np.r_[np.uint64(1), np.full(n, base, np.uint64)], dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def segments(texts: list[bytes], length: int) -> dict[str, np.ndarray]:
    """Segments of a list of texts: doc (position in the list), start, n (windows), key,
    content hash, and whether the segment may repeat inside itself."""
    w = length - KMER + 1
    out: list[tuple[np.ndarray, ...]] = []
    group: list[tuple[int, int, int]] = []  # (text, first window, windows)
    held = 0

    def flush() -> None:
        nonlocal held
        if group:
            out.append(_hash_pieces(texts, group, length, w))
        group.clear()
        held = 0

    for i, t in enumerate(texts):
        n = len(t) - length + 1
        for at in range(0, max(n, 0), PIECE):
            take = min(PIECE, n - at)
            if held + take + length > PIECE:
                flush()
            group.append((i, at, take))
            held += take + length
    flush()
    names = ("doc", "start", "n", "key", "content", "inner")
    kinds = (np.int64, np.int64, np.int64, np.int64, np.int64, bool)
    return {k: np.concatenate([o[j] for o in out]) if out else np.zeros(0, d) for j, (k, d) in enumerate(zip(names, kinds))}


def _hash_pieces(texts, group, length, w) -> tuple[np.ndarray, ...]:
    buf = b"".join(texts[i][at:at + n + length - 1] for i, at, n in group)
    size = len(buf)
    word = eight_bytes(buf, size)
    kmers = size - KMER + 1
    h = np.zeros(kmers, np.uint64)
    for j in range(KMER // 8):
        h += word[8 * j:8 * j + kmers] * _C[j]
        h ^= h >> np.uint64(31)
        h *= _C[(j + 1) % 4]
    h = _mix(h)
    low = _sliding(h, w, np.minimum)  # key of the window at every place
    count = np.array([n for _, _, n in group])
    first = np.concatenate([[0], np.cumsum(count + length - 1)[:-1]])
    of = np.repeat(np.arange(len(group)), count)  # piece of every valid window
    place = np.arange(len(of)) + np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    key = low[place]
    a, b = runs_of(key, of)
    at = place[a]  # place of the segment's first window in the buffer
    n = b - a
    # content: the hashes of all its 32-byte substrings, weighted by their place in it
    up, down = _powers(kmers + 1)
    total = np.concatenate([[np.uint64(0)], np.cumsum(h * up[:kmers], dtype=np.uint64)])
    content = _mix((total[at + n - 1 + w] - total[at]) * down[at] + n.astype(np.uint64) * _C[0])
    # two substrings of a segment that have its key: it may repeat inside itself
    valid = np.zeros(len(low) + w - 1, np.uint64)
    valid[w - 1 + place] = key
    tops = _sliding(np.concatenate([valid, np.zeros(w - 1, np.uint64)]), w, np.maximum)[:kmers]
    chosen = np.flatnonzero(h == tops)
    twice = np.flatnonzero((h[chosen[1:]] == h[chosen[:-1]]) & (np.diff(chosen) <= w))
    inner = n > w
    if len(twice):
        for p in (chosen[twice], np.maximum(chosen[twice + 1] - w + 1, 0)):
            inner[np.clip(np.searchsorted(at, p, side="right") - 1, 0, len(at) - 1)] = True
    piece = of[a]
    doc = np.array([i for i, _, _ in group])[piece]
    start = at - first[piece] + np.array([x for _, x, _ in group])[piece]
    return doc, start, n, key[a].view(np.int64), content.view(np.int64), inner


def runs_of(key: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (of[1:] != of[:-1])]))
    return s, np.concatenate([s[1:], [len(key)]])


def later_ones(key: np.ndarray, content: np.ndarray, did: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by (key, content, id, start), and in that order whether an equal segment is
    earlier."""
    o = np.lexsort((start, did, content, key))
    k, c, d, p = key[o], content[o], did[o], start[o]
    first = np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])]) if len(o) else np.zeros(0, bool)
    g = np.cumsum(first) - 1
    d0, p0 = d[first][g] if len(o) else d, p[first][g] if len(o) else p
    return o, (d > d0) | ((d == d0) & (p > p0))


# ---------------------------------------------------------------- suffix array

def suffix_array(buf: bytes, depth: int) -> np.ndarray:
    """Suffixes of ``buf`` in order of their first ``depth`` bytes, by two-stage sorting."""
    s = np.frombuffer(buf, np.uint8)
    n = len(s)
    if n == 0:
        return np.zeros(0, np.int64)
    # a suffix is smaller than its successor where the next different byte is larger; the
    # end of the buffer counts as smaller than every byte
    differs = np.concatenate([s[1:] != s[:-1], [True]])
    nxt = np.flatnonzero(differs)
    to = nxt[np.searchsorted(nxt, np.arange(n))]
    after = np.concatenate([s.astype(np.int16), [-1]])
    small = after[to + 1] > s
    direct = np.flatnonzero(small)
    texts = [buf[i:i + depth] for i in direct.tolist()]
    direct = direct[np.array(sorted(range(len(texts)), key=texts.__getitem__), dtype=np.int64)] if len(texts) else direct
    by_byte = s[direct]
    lo, hi = np.searchsorted(by_byte, np.arange(256), "left"), np.searchsorted(by_byte, np.arange(256), "right")
    # scan the buckets in order: a suffix larger than its successor follows from the
    # successor's rank; runs of one byte come shortest first
    large = np.flatnonzero(~small)
    run = (to - np.arange(n))[large]
    order = np.lexsort((run, s[large]))
    large, run = large[order], run[order]
    llo, lhi = np.searchsorted(s[large], np.arange(256), "left"), np.searchsorted(s[large], np.arange(256), "right")
    rank = np.full(n + 1, -1, np.int64)
    out = np.empty(n, np.int64)
    filled = 0
    for c in range(256):
        x, y = llo[c], lhi[c]
        while x < y:
            z = x + int(np.searchsorted(run[x:y], run[x], "right"))
            part = large[x:z]
            part = part[np.argsort(rank[part + 1], kind="stable")]
            out[filled:filled + len(part)] = part
            rank[part] = np.arange(filled, filled + len(part))
            filled += len(part)
            x = z
        part = direct[lo[c]:hi[c]]
        out[filled:filled + len(part)] = part
        rank[part] = np.arange(filled, filled + len(part))
        filled += len(part)
    return out


def equal_neighbours(word: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the common prefix of suffixes ``a`` and ``b`` reaches ``length`` bytes."""
    live = np.arange(len(a))
    for j in [*range(0, length - 7, 8), length - 8]:
        live = live[word[a[live] + j] == word[b[live] + j]]
    out = np.zeros(len(a), bool)
    out[live] = True
    return out


def repeated_windows(parts: list[bytes], did: np.ndarray, start: np.ndarray, length: int) -> list[np.ndarray]:
    """For every segment, which of its windows start earlier somewhere in the list."""
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    buf = bytes([END]).join(parts) + bytes([END])
    first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    sa = suffix_array(buf, length)
    owner = np.repeat(np.arange(len(parts)), sizes + 1)
    within = np.arange(len(buf)) - first[owner]
    sa = sa[within[sa] + length <= sizes[owner[sa]]]
    word = eight_bytes(buf, len(buf))
    same = equal_neighbours(word, sa[:-1], sa[1:], length) if len(sa) > 1 else np.zeros(0, bool)
    cls = np.cumsum(np.concatenate([[True], ~same])) if len(sa) else np.zeros(0, np.int64)
    d, p = did[owner[sa]], start[owner[sa]] + within[sa]
    _, later = later_ones(cls, np.zeros(len(cls), np.int64), d, p)
    o = np.lexsort((p, d, cls))
    flags = np.zeros(len(buf), bool)
    flags[sa[o]] = later
    return [flags[f:f + max(0, z - length + 1)] for f, z in zip(first.tolist(), sizes.tolist())]


# ---------------------------------------------------------------- Spark steps

_ROW = "key long, content long, did long, alt long, start long, n long, inner boolean, rep boolean"
_STAGE = "kind byte, key long, did long, alt long, start long, n long"


def _rows(names: str, cols: list) -> pa.RecordBatch:
    types = {"long": pa.int64(), "boolean": pa.bool_(), "byte": pa.int8(), "binary": pa.binary()}
    fields = [f.split(" ") for f in names.split(", ")]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, types[t]) for c, (_, t) in zip(cols, fields)],
                                      names=[n for n, _ in fields])


def _scan(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = b.column("bytes").to_pylist()
            dids, alts = b.column("did").to_numpy(), b.column("alt").to_numpy()
            at = 0
            while at < len(data):
                end, held = at, 0
                while end < len(data) and (held == 0 or held + len(data[end]) <= BATCH):
                    held += len(data[end])
                    end += 1
                s = segments(data[at:end], length)
                d, x = dids[at:end][s["doc"]], alts[at:end][s["doc"]]
                o, rep = later_ones(s["key"], s["content"], d, s["start"])
                d, start = d[o], s["start"][o]
                # a repeat's row goes anywhere: its place decides, not its key
                key = np.where(rep, _mix((d * 31 + start).astype(np.uint64)).view(np.int64), s["key"][o])
                yield _rows(_ROW, [key, s["content"][o], d, x[o], start, s["n"][o], s["inner"][o], rep])
                at = end
    return run


def _by_key(hot: int):
    """Segments grouped by key: kind 0 a repeat, 1 to be compared, 2 of a hot key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "key"):
            key, content, did, alt, start, n, inner, rep = (t.column(c).to_numpy() for c in
                                                            ("key", "content", "did", "alt", "start", "n", "inner", "rep"))
            done = np.flatnonzero(rep)
            open_ = np.flatnonzero(~rep)
            o, later = later_ones(key[open_], content[open_], did[open_], start[open_])
            o = open_[o]
            k, c = key[o], content[o]
            s, e = runs(k)
            different = np.add.reduceat(np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])]).astype(np.int64), s) \
                if len(o) else np.zeros(0, np.int64)
            different = np.repeat(different, e - s)
            kind = np.where(later, 0, np.where(different > hot, 2, np.where((different > 1) | inner[o], 1, -1)))
            rows = np.concatenate([done, o])
            kind = np.concatenate([np.zeros(len(done), np.int64), kind]).astype(np.int8)
            rows, kind = rows[kind >= 0], kind[kind >= 0]
            if len(rows):
                yield _rows(_STAGE, [kind, key[rows], did[rows], alt[rows], start[rows], n[rows]])
    return run


def _cut(length: int):
    """Bytes of the segments to be compared."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                data = b.column("bytes")[i].as_py()
                did, alt = b.column("did")[i].as_py(), b.column("alt")[i].as_py()
                seg = b.column("segs")[i].as_py()
                yield _rows("key long, did long, alt long, start long, bytes binary", [
                    [x["key"] for x in seg], [did] * len(seg), [alt] * len(seg), [x["start"] for x in seg],
                    [data[x["start"]:x["start"] + x["n"] + length - 1] for x in seg]])
    return run


def _compare(length: int):
    """Repeated windows among the segments of each key, as (did, alt, start, end)."""
    def solve(parts, did, alt, start):
        flags = repeated_windows(parts, did, start, length)
        out = []
        for j, f in enumerate(flags):
            s, e = runs(f)
            for x, y in zip(s.tolist(), e.tolist()):
                if f[x]:
                    out.append((int(did[j]), int(alt[j]), int(start[j]) + x, int(start[j]) + y - 1 + length))
        return _rows("did long, alt long, start long, end long", [list(c) for c in zip(*out)] if out else [[]] * 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "key"):
            key = t.column("key").to_numpy()
            did, alt, start = (t.column(c).to_numpy() for c in ("did", "alt", "start"))
            data = t.column("bytes").to_pylist()
            held, at = 0, 0
            s, e = runs(key)
            for x, y in zip(s.tolist(), e.tolist()):
                more = sum(map(len, data[x:y]))
                if held and held + more > SUFFIX_BYTES:
                    yield solve(data[at:x], did[at:x], alt[at:x], start[at:x])
                    held, at = 0, x
                held += more
            yield solve(data[at:], did[at:], alt[at:], start[at:])
    return run


def _windows(length: int):
    """Every window of a hot key's segments as a segment of its own, with a 128-bit hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: list[bytes] = []
        places: list[np.ndarray] = []

        def rows() -> pa.RecordBatch:
            h = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            k, c = h[:, 0], h[:, 1]
            d, a, s = np.concatenate(places).T
            hashes.clear()
            places.clear()
            o, rep = later_ones(k, c, d, s)
            to = np.where(rep, _mix((d[o] * 31 + s[o]).astype(np.uint64)).view(np.int64), k[o])
            return _rows(_ROW, [to, c[o], d[o], a[o], s[o], np.ones(len(o), np.int64), np.zeros(len(o), bool), rep])

        for b in batches:
            for i in range(b.num_rows):
                data = b.column("bytes")[i].as_py()
                did, alt = b.column("did")[i].as_py(), b.column("alt")[i].as_py()
                for x in b.column("segs")[i].as_py():
                    at = np.arange(x["start"], x["start"] + x["n"])
                    hashes += [hashlib.blake2b(data[p:p + length], digest_size=16).digest() for p in at.tolist()]
                    places.append(np.stack([np.full(len(at), did), np.full(len(at), alt), at], axis=1))
                    if len(hashes) >= 200_000:
                        yield rows()
        if hashes:
            yield rows()
    return run


def _apply():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i in range(b.num_rows):
                data = b.column("bytes")[i].as_py()
                merged: list[list[int]] = []
                spans = b.column("spans")[i].as_py() or []
                for s, e in sorted((x["start"], x["end"]) for x in spans):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                kept, at = [], 0
                for s, e in merged:
                    kept.append(data[at:s])
                    at = e
                kept.append(data[at:])
                rest = b"".join(kept)
                out.append((len(data), len(data) - len(rest), len(merged), hashlib.sha256(rest).hexdigest(), rest))
            e = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), *[pa.array(e[j], pa.int64()) for j in range(3)], pa.array(e[3], pa.string()), pa.array(e[4], pa.binary())],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    return run


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", hot: int = 10_000) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept binary) for every row.

    ``kept`` holds the remaining bytes.  A null text is the empty text; a null id comes before
    all others.  Rows that repeat an id are one document where their texts are equal; where
    they differ, the same start of the same id is not earlier.  Documents shorter than
    ``length`` bytes and empty tables have no windows."""
    if length < KMER:
        raise ValueError(f"length must be at least {KMER}")
    text = F.coalesce(F.col(text_col), F.lit(""))
    # where ids repeat, a hash of the text tells their rows apart
    repeated = not docs.groupBy(id_col).count().where("count > 1").isEmpty()
    keyed = bounded_batches(docs).select(F.col(id_col).cast("long").alias("id"),
                        F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("did"),
                        (F.pmod(F.xxhash64(text), F.lit(1 << 32)) if repeated else F.lit(0).cast("long")).alias("alt"), text.cast("binary").alias("bytes"))
    long_enough = F.octet_length("bytes") >= length

    def grouped(rows: DataFrame) -> DataFrame:
        return rows.repartition("key").sortWithinPartitions("key").mapInArrow(_by_key(hot), _STAGE)

    scanned = keyed.where(long_enough).select("did", "alt", "bytes").mapInArrow(_scan(length), _ROW)
    found = materialize(grouped(scanned), "repeat-segments")

    def with_bytes(kind: int) -> DataFrame:
        segs = found.where(F.col("kind") == kind).groupBy("did", "alt").agg(F.collect_list(F.struct("key", "start", "n")).alias("segs"))
        return keyed.select("did", "alt", "bytes").join(segs, ["did", "alt"])

    spans = found.where("kind = 0").select("did", "alt", "start", (F.col("start") + F.col("n") + length - 1).alias("end"))
    compared = with_bytes(1).mapInArrow(_cut(length), "key long, did long, alt long, start long, bytes binary") \
        .repartition("key").sortWithinPartitions("key") \
        .mapInArrow(_compare(length), "did long, alt long, start long, end long")
    parts = [spans, compared]
    if not found.where("kind = 2").isEmpty():
        split = grouped(with_bytes(2).mapInArrow(_windows(length), _ROW)).where("kind = 0")
        parts.append(split.select("did", "alt", "start", (F.col("start") + F.col("n") + length - 1).alias("end")))
    places = parts[0]
    for p in parts[1:]:
        places = places.unionByName(p)
    places = materialize(places, "repeat-spans").groupBy("did", "alt").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    done = keyed.join(places, ["did", "alt"], "left").select("id", "bytes", "spans").mapInArrow(
        _apply(), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return done.withColumnRenamed("id", id_col)
