"""Near-duplicate join on word shingles by chosen paths.

Documents are sets of five-word shingles; two texts are linked if their Jaccard similarity is
at least ``threshold``.  A run sends every set down a random tree: at a node some positions
of the minhash signature are sampled, each with probability 1/(threshold * positions), and
the set goes to the child named by (position, value), so similar sets keep meeting while
others part.  A node of at most ``limit`` sets is a leaf and is compared by brute force;
larger ones are split again.  Runs are repeated until the estimated recall reaches the
target: of the verified links, those met in one run only and in two runs only tell how many
were met in none (Chao's estimator).  Four bands of similarity are judged apart, so that thousands of easy
links do not hide those near the threshold; while any band misses too many, the number of runs
is doubled.  At ``max_runs`` (at most 1,024) the join fails and says which bands fall short: it never
returns less than the recall asked for without a word.

Exactness.  Equal texts form a class and only one of them travels.  In a leaf, pairs pass a
size bound and a 128-byte sketch (five standard deviations below the threshold) and are then
verified on their full shingle sets.  A pair that meets in several leaves is verified in the
one with the smallest name only, so links are counted once without ever listing pairs.
A node that no longer splits after ``depth`` levels (thousands of nearly equal sets) is cut
into blocks, and each pair of blocks is a leaf: nothing is dropped.

Scale.  What travels is (node, set) rows; sketches go to the leaves with two sets or more,
and shingles only to leaves where some pair passed its sketch.  Components are found by
alternating star contraction on one edge per linked set and leaf.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import bounded_batches, materialize, runs, slices, small_side, text_column, whole_groups

SHINGLE = 5
POSITIONS = 64  # signature positions that paths are chosen from; as many again are only compared
_WORD = re.compile(r"\w+")
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_RUN_BITS = 10
#: runs there is room for, and bands of similarity whose recall is estimated apart
MAX_RUNS, BANDS = 1 << _RUN_BITS, 4
_SEEDS = np.random.default_rng(9).integers(1, 1 << 62, 2 * POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BROADCAST_ROWS = 200_000
NO_NODE = (1 << 63) - 1


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * _C[1]
    x = x ^ (x >> np.uint64(27))
    x = x * _C[2]
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, kept for the words seen lately."""

    def __missing__(self, w: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[w] = h = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
        return h


_WORDS = WordHashes()


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` lower-case words; a text of
    fewer words, but not none, is one shingle."""
    words = _WORD.findall(text.lower())
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    k = min(size, len(h))
    s = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        s = s * _C[0] + h[j:len(h) - k + 1 + j]
        s ^= s >> np.uint64(29)
    return np.unique(mix(s))


def signature(s: np.ndarray) -> np.ndarray:
    """Minhashes (32 bits each) of a set that is not empty."""
    low = np.full(2 * POSITIONS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(s), 2048):
        np.minimum(low, ((s[at:at + 2048, None] * _SEEDS) >> np.uint64(32)).min(axis=0), out=low)
    return low.astype(np.uint32)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        n, sig = [], []
        for t in text_column(b, "text"):
            s = shingles(t)
            n.append(len(s))
            if len(s):
                m = signature(s)
                sig.append(m[:POSITIONS].tobytes() + m[POSITIONS:].astype(np.uint8).tobytes())
            else:
                sig.append(None)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(n, pa.int64()), pa.array(sig, pa.binary())],
                                         names=["id", "t1", "t2", "n", "sig"])


def _root_positions(run: int, threshold: float) -> list[int]:
    """Positions sampled at the root of a run: one, and a second with the probability that
    makes 1/threshold on average; runs take different positions as long as there are any."""
    order = np.random.default_rng(POSITIONS).permutation(POSITIONS)
    extra = np.random.default_rng(1000 + run)
    out = [int(order[run % POSITIONS])]
    if extra.random() < 1 / threshold - 1:
        out.append(int(extra.integers(POSITIONS)))
    return sorted(set(out))


def _child(node: np.ndarray, position: np.ndarray, value: np.ndarray, run: np.ndarray) -> np.ndarray:
    h = mix(mix(node + position.astype(np.uint64) * _C[0]) + value.astype(np.uint64) * _C[2] + _C[1])
    return ((h << np.uint64(_RUN_BITS)) | run.astype(np.uint64)).view(np.int64)


def _signatures(col: pa.Array) -> np.ndarray:
    raw = np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(len(col), 5 * POSITIONS)
    return np.ascontiguousarray(raw[:, :4 * POSITIONS]).view(np.uint32)


def _roots(n_runs: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sig, rid = _signatures(b.column("sig")), b.column("rid").to_numpy()
            nodes, rids = [], []
            for r in range(n_runs):
                for p in _root_positions(r, threshold):
                    full = np.full(len(rid), r, np.uint64)
                    nodes.append(_child(mix(full + _C[0]), np.full(len(rid), p), sig[:, p], full))
                    rids.append(rid)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(rids))], names=["node", "rid"])
    return run


def _split(threshold: float):
    """Children of nodes that are too large."""
    bound = np.uint64(int((1 << 64) / (threshold * POSITIONS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sig, rid = _signatures(b.column("sig")), b.column("rid").to_numpy()
            node = b.column("node").to_numpy().view(np.uint64)
            names, back = np.unique(node, return_inverse=True)
            chosen = mix(names[:, None] + np.arange(1, POSITIONS + 1, dtype=np.uint64) * _C[1]) < bound
            row, position = np.nonzero(chosen[back])
            which = node[row] & np.uint64((1 << _RUN_BITS) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(_child(node[row], position, sig[row, position], which)), pa.array(rid[row])],
                                             names=["node", "rid"])
    return run


def _blocks(limit: int):
    """Pairs of blocks of a node that no longer splits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, rid, count = (b.column(c).to_numpy() for c in ("node", "rid", "count"))
            blocks = -(-count // max(1, limit // 2))
            own = (mix(rid.view(np.uint64) * _C[0]) % blocks.astype(np.uint64)).astype(np.int64)
            row = np.repeat(np.arange(len(rid)), blocks)
            other = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            lo, hi = np.minimum(own[row], other), np.maximum(own[row], other)
            u = node.view(np.uint64)[row]
            out = _child(u, lo, hi, u & np.uint64((1 << _RUN_BITS) - 1))
            yield pa.RecordBatch.from_arrays([pa.array(out), pa.array(rid[row])], names=["node", "rid"])
    return run


def leaves(reps: DataFrame, n_runs: int, threshold: float, limit: int, depth: int) -> DataFrame:
    """(node, rid): the leaves with at least two sets."""
    out = None
    members = materialize(reps.select("rid", "sig").mapInArrow(_roots(n_runs, threshold), "node long, rid long"), "path-1")
    for level in range(1, depth + 1):
        # a table of its own, so that the join's large nodes can be split over tasks
        counts = materialize(members.groupBy("node").count().where("count > 1"), f"path-counts-{level}")
        sized = materialize(members.join(counts, "node"), f"path-sized-{level}")
        done = sized.where(F.col("count") <= limit).select("node", "rid")
        out = done if out is None else out.unionByName(done)
        large = sized.where(F.col("count") > limit)
        if large.isEmpty():
            return out
        if level == depth:
            rest = large.mapInArrow(_blocks(limit), "node long, rid long").distinct()
            return out.unionByName(materialize(rest, "path-blocks"))
        members = materialize(large.join(reps.select("rid", "sig"), "rid").select("node", "rid", "sig")
                              .mapInArrow(_split(threshold), "node long, rid long"), f"path-{level + 1}")
    raise AssertionError("unreachable")


def close_pairs(node: np.ndarray, n: np.ndarray, sketch: np.ndarray, nodes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one node, sorted by (node, n), that pass the size bound and the
    sketch, and for which this node is the smallest they share."""
    size = 2 * POSITIONS
    slack = lambda m: int(m * threshold - 5 * (m * threshold * (1 - threshold)) ** 0.5)
    half, full = slack(POSITIONS), slack(size)
    s, e = runs(node)
    end = np.repeat(e, e - s)
    live = np.arange(len(node))
    left, right = [], []
    lag = 1
    while True:
        live = live[live + lag < end[live]]
        live = live[n[live + lag] * threshold <= n[live] + 1e-9]
        if not len(live):
            break
        for at in range(0, len(live), 20_000):
            i = live[at:at + 20_000]
            j = i + lag
            ok = (sketch[i, :POSITIONS] == sketch[j, :POSITIONS]).sum(axis=1) >= half
            i, j = i[ok], j[ok]
            ok = (sketch[i] == sketch[j]).sum(axis=1) >= full
            left.append(i[ok])
            right.append(j[ok])
        lag += 1
    i = np.concatenate(left) if left else np.zeros(0, np.int64)
    j = np.concatenate(right) if right else np.zeros(0, np.int64)
    # a smaller node that both have?  Similar rows share most nodes, so few pairs stay live
    here = np.ones(len(i), bool)
    live = np.arange(len(i))
    for c in range(nodes.shape[1]):
        smaller = nodes[i[live], c]
        live = live[smaller < node[i[live]]]
        for at in range(0, len(live), 50_000):
            part = live[at:at + 50_000]
            here[part] = ~(nodes[j[part]] == nodes[i[part], c][:, None]).any(axis=1)
        live = live[here[live]]
        if not len(live):
            break
    return i[here], j[here]


def _padded(lists: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of node names as sorted rows of equal length."""
    flat = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    size = flat.value_lengths().to_numpy()
    out = np.full((len(size), int(size.max(initial=1))), NO_NODE)
    out[np.arange(out.shape[1]) < size[:, None]] = flat.flatten().to_numpy()
    return np.sort(out, axis=1)


def _sorted_rows(t: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    o = np.lexsort((t.column("rid").to_numpy(), t.column("n").to_numpy(), t.column("node").to_numpy()))
    t = t.take(pa.array(o))
    sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(t.num_rows, 2 * POSITIONS)
    return t, t.column("node").to_numpy(), t.column("n").to_numpy(), sketch, _padded(t.column("nodes"))


def _candidates(threshold: float):
    """Rows of the leaves that take part in some pair to be verified there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "node"):
            t, node, n, sketch, nodes = _sorted_rows(t)
            i, j = close_pairs(node, n, sketch, nodes, threshold)
            keep = np.unique(np.concatenate([i, j]))
            if len(keep):
                yield from t.take(pa.array(keep)).to_batches()
    return run


def _overlaps(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact sizes of the intersections of the pairs of sets."""
    size = np.array([len(x) for x in sets], dtype=np.int64)
    if not len(i):
        return np.zeros(0, np.int64)
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    local = np.split(flat, np.cumsum(size)[:-1])
    mark = np.zeros(int(flat.max(initial=0)) + 1, bool)
    out = np.zeros(len(i), np.int64)
    order = np.argsort(i, kind="stable")
    s, e = runs(i[order])
    for x, y in zip(s.tolist(), e.tolist()):
        own = local[i[order[x]]]
        mark[own] = True
        for at in range(x, y, 256):
            part = order[at:min(y, at + 256)]
            others = j[part]
            first = np.concatenate([[0], np.cumsum(size[others])[:-1]])
            out[part] = np.add.reduceat(mark[np.concatenate([local[k] for k in others.tolist()])].astype(np.int64), first)
        mark[own] = False
    return out


def _runs_met(nodes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """In how many runs each pair has a leaf in common."""
    run = np.where(nodes == NO_NODE, 0, nodes.view(np.uint64) & np.uint64((1 << _RUN_BITS) - 1))
    words = int(run.max(initial=0)) // 64 + 1
    out = np.zeros(len(i), np.int64)
    for at in range(0, len(i), 50_000):
        a, b, r = nodes[i[at:at + 50_000]], nodes[j[at:at + 50_000]], run[i[at:at + 50_000]]
        met = np.zeros((len(a), words), np.uint64)
        for c in range(nodes.shape[1]):
            both = (b == a[:, c, None]).any(axis=1) & (a[:, c] != NO_NODE)
            met[np.arange(len(a)), (r[:, c] >> np.uint64(6)).astype(np.int64)] |= both.astype(np.uint64) << (r[:, c] & np.uint64(63))
        out[at:at + 50_000] = np.bitwise_count(met).sum(axis=1)
    return out


def _verify(threshold: float, emit_pairs: bool):
    """Exact verification: kind 0 links of a set in this leaf (value: how many), kind 1 an
    edge to the smallest set it is connected with in this leaf, kind 2 pairs (if asked for;
    value: shared shingles), kind 3 how many links of a band of similarity were met in how many runs (``other`` is
    band * 2 MAX_RUNS + runs)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "node"):
            t, node, n, sketch, nodes = _sorted_rows(t)
            i, j = close_pairs(node, n, sketch, nodes, threshold)
            rid = t.column("rid").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in t.column("tokens").to_pylist()]
            both = _overlaps(sets, i, j)
            size = np.array([len(x) for x in sets], dtype=np.int64)
            linked = both + 1e-9 >= threshold * (size[i] + size[j] - both)
            i, j, both = i[linked], j[linked], both[linked]
            links: dict[int, int] = {}
            parent: dict[int, int] = {}
            pairs = []

            def find(x: int) -> int:
                while parent.setdefault(x, x) != x:
                    parent[x] = x = parent[parent[x]]
                return x

            for a, b, shared in zip(i.tolist(), j.tolist(), both.tolist()):
                for x in (a, b):
                    links[x] = links.get(x, 0) + 1
                ra, rb = find(a), find(b)
                if ra != rb:  # the smaller rid is the root
                    if rid[ra] > rid[rb]:
                        ra, rb = rb, ra
                    parent[rb] = ra
                if emit_pairs:
                    pairs.append((2, rid[a], rid[b], shared))
            out = [(0, rid[x], 0, c) for x, c in links.items()] + [(1, rid[x], rid[find(x)], 0) for x in links if find(x) != x]
            near = both / np.maximum(size[i] + size[j] - both, 1)
            band = np.clip(((near - threshold) / max(1 - threshold, 1e-9) * BANDS).astype(np.int64), 0, BANDS - 1)
            out += pairs + [(3, 0, k, c) for k, c in enumerate(np.bincount(_runs_met(nodes, i, j) + band * 2 * MAX_RUNS).tolist()) if c]
            if out:
                cols = [np.array(c, np.int64) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["kind", "rid", "other", "value"])
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        yield pa.RecordBatch.from_arrays(
            [b.column("rid"), pa.array([shingles(t).tobytes() for t in text_column(b, "text")], pa.binary())], names=["rid", "tokens"])


def components(edges: DataFrame) -> DataFrame:
    """(rid, root): the smallest node of each connected component, by alternating large-star
    and small-star steps until the edges are stars."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            e = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # a table of its own, so that the join can split a node with very many edges
        low = materialize(e.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "edges-low")
        joined = e.join(low, "a")
        if large:
            return joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        own = low.select("a", F.col("m").alias("b"))
        return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own).where("a != b").distinct()

    down = edges.select(F.greatest("rid", "other").alias("a"), F.least("rid", "other").alias("b")).where("a != b").distinct()
    now = materialize(down, "edges")
    while True:
        now = materialize(star(materialize(star(now, True), "edges-large"), False), "edges")
        # done when every node has one edge and no node is both child and root
        ends = now.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                            F.struct(F.col("b").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("x")) \
            .groupBy("x.v").agg(F.sum("x.up").alias("up"), F.max("x.down").alias("down"))
        if ends.where("up > 1 or up > 0 and down > 0").isEmpty():
            return now.select(F.col("a").alias("rid"), F.col("b").alias("root"))


def _text_key(text: str):
    return (F.xxhash64(text).alias("t1"), F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("t2"))


def _reached(met: dict[int, int], recall: float) -> bool:
    """Whether links met in 1, 2, .. runs (``met``) are ``recall`` of all, by Chao's estimate of those never met."""
    seen, once, twice = sum(met.values()), met.get(1, 0), met.get(2, 0)
    missed = once * (once - 1) / (2 * (twice + 1))
    return missed <= (1 - recall) * (seen + missed)


def classes(docs: DataFrame, threshold: float, recall: float, n_runs: int, max_runs: int, limit: int, depth: int,
            id_col: str, text_col: str, emit_pairs: bool) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows (id, t1, t2), one row per text (t1, t2, rid, n, copy_of, copies, class_id,
    n_links, first: whether it stands for its class), and the verified links."""
    given = bounded_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")) \
        .select("id", *_text_key("text"), "text")
    rows = materialize(given.mapInArrow(_scan, "id long, t1 long, t2 long, n long, sig binary"), "near-rows")
    reps = materialize(rows.groupBy("t1", "t2").agg(F.min("id").alias("copy_of"), F.first("n").alias("n"), F.first("sig").alias("sig"),
                                                    F.count(F.lit(1)).alias("copies"))
                       .withColumn("rid", F.monotonically_increasing_id()), "near-reps")
    sets = reps.where(F.col("sig").isNotNull())
    while True:
        found = _links(given, sets, n_runs, threshold, limit, depth, emit_pairs)
        met = {r["other"]: r["s"] for r in found.where("kind = 3").groupBy("other").agg(F.sum("value").alias("s")).collect()}
        short = [b for b in range(BANDS) if not _reached({k - b * 2 * MAX_RUNS: c for k, c in met.items() if k // (2 * MAX_RUNS) == b}, recall)]
        if not short:
            break
        if 2 * n_runs > min(max_runs, MAX_RUNS):
            raise RuntimeError(f"{n_runs} runs leave the recall of links below {recall} in bands {short} of {BANDS} from similarity {threshold} to 1")
        n_runs *= 2
    links = found.where("kind = 0").groupBy("rid").agg(F.sum("value").alias("n_links"))
    comp = components(found.where("kind = 1").select("rid", "other"))
    label = comp.unionByName(comp.select(F.col("root").alias("rid"), "root").distinct())
    order = F.struct(F.col("copy_of").isNull().alias("none"), "copy_of", "rid")
    lowest = label.join(reps.select("rid", "copy_of"), "rid").groupBy("root").agg(F.min(order).alias("low"))
    texts = reps.drop("sig").join(links, "rid", "left").join(label, "rid", "left").join(lowest, "root", "left") \
        .withColumn("low", F.coalesce("low", order)) \
        .select("t1", "t2", "rid", "n", "copy_of", "copies", F.col("low.copy_of").alias("class_id"),
                F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), (F.col("low.rid") == F.col("rid")).alias("first"))
    return rows.select("id", "t1", "t2"), materialize(texts, "near-texts"), found, given


def near_duplicates(docs: DataFrame, threshold: float = 0.8, recall: float = 0.999, n_runs: int = 16, max_runs: int = MAX_RUNS,
                    limit: int = 2048, depth: int = 12, id_col: str = "doc_id", text_col: str = "text",
                    emit_pairs: bool = False) -> DataFrame | tuple[DataFrame, DataFrame]:
    """(id, class_id, copy_of, n_links) for every row of ``docs``.

    ``class_id`` is the smallest id among all documents connected by links or equal texts,
    ``copy_of`` the smallest id with an equal text, ``n_links`` the number of different texts
    linked to this text.  With ``emit_pairs`` also (id_a, id_b, similarity) for the links,
    one row per pair of different texts, named by their smallest ids.

    Null and empty texts, and texts without a word, are linked to nothing (equal ones share
    a class); rows without an id belong to a class like any other; repeated rows are copies;
    an empty table gives an empty result."""
    rows, texts, found, _ = classes(docs, threshold, recall, n_runs, max_runs, limit, depth, id_col, text_col, emit_pairs)
    out = rows.join(texts, ["t1", "t2"]).select(F.col("id").alias(id_col), "class_id", "copy_of", "n_links")
    if not emit_pairs:
        return out
    name = lambda c: texts.select(F.col("rid").alias(f"r{c}"), F.col("copy_of").alias(f"id_{c}"), F.col("n").alias(f"n{c}"))
    pairs = found.where("kind = 2").select(F.col("rid").alias("ra"), F.col("other").alias("rb"), "value") \
        .join(name("a"), "ra").join(name("b"), "rb") \
        .select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"),
                (F.col("value") / (F.col("na") + F.col("nb") - F.col("value"))).alias("similarity"))
    return out, pairs


def one_of_each(docs: DataFrame, threshold: float = 0.8, recall: float = 0.999, n_runs: int = 16, max_runs: int = MAX_RUNS,
                limit: int = 2048, depth: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) with one row of each class: the one with the smallest id.

    Texts that stand alone are read straight through; only rows of texts with several copies
    are compared, after all but those with the smallest id are gone."""
    _, texts, _, _ = classes(docs, threshold, recall, n_runs, max_runs, limit, depth, id_col, text_col, False)
    names = docs.columns
    keyed = docs.select("*", *[c.alias(f"__corpus_{n}") for c, n in zip(_text_key(text_col), ("t1", "t2"))])
    touched = texts.where(~F.col("first") | (F.col("copies") > 1)) \
        .select(F.col("t1").alias("__corpus_t1"), F.col("t2").alias("__corpus_t2"), F.col("copy_of").alias("__corpus_copy"),
                F.col("first").alias("__corpus_first"))
    touched = materialize(touched, "near-touched")
    side = small_side(touched, _BROADCAST_ROWS)
    alone = keyed.join(side.select("__corpus_t1", "__corpus_t2"), ["__corpus_t1", "__corpus_t2"], "left_anti")
    chosen = keyed.join(side.where("__corpus_first"), ["__corpus_t1", "__corpus_t2"]) \
        .where(F.col(id_col).cast("long").eqNullSafe(F.col("__corpus_copy"))).dropDuplicates(["__corpus_t1", "__corpus_t2"])
    return alone.select(*names).unionByName(chosen.select(*names))


def _links(given: DataFrame, sets: DataFrame, n_runs: int, threshold: float, limit: int, depth: int, emit_pairs: bool) -> DataFrame:
    """Verified links of all leaves (see ``_verify``)."""
    leaf = leaves(sets, n_runs, threshold, limit, depth)
    lists = leaf.groupBy("rid").agg(F.collect_list("node").alias("nodes"))

    @F.pandas_udf("binary")
    def sketch(sig):
        def one(x: bytes) -> bytes:
            return np.frombuffer(x[:4 * POSITIONS], np.uint32).astype(np.uint8).tobytes() + x[4 * POSITIONS:]
        return sig.map(one)

    shape = "node long, rid long, n long, sketch binary, nodes array<bigint>"
    rows = lists.join(sets.select("rid", "n", "sig"), "rid").select("rid", "n", sketch("sig").alias("sketch"), "nodes") \
        .select(F.explode("nodes").alias("node"), "rid", "n", "sketch", "nodes")
    near = materialize(rows.repartition("node").sortWithinPartitions("node").mapInArrow(_candidates(threshold), shape), "near-leaves")
    wanted = materialize(near.select("rid").distinct().join(sets.select("rid", "t1", "t2", "copy_of"), "rid"), "near-wanted")
    texts = given.join(small_side(wanted, _BROADCAST_ROWS), ["t1", "t2"]).where(F.col("id").eqNullSafe(F.col("copy_of")))
    tokens = texts.select("rid", "text").mapInArrow(_sets, "rid long, tokens binary").groupBy("rid").agg(F.first("tokens").alias("tokens"))
    return materialize(near.join(tokens, "rid").repartition("node").sortWithinPartitions("node")
                       .mapInArrow(_verify(threshold, emit_pairs), "kind long, rid long, other long, value long"), "near-links")
