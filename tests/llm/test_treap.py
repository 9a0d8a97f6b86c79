import math
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from chronoweave.llm import treap

ITEM = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("text", T.StringType())])
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(t):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, k=10):
    bags = [(i, words(t)) for i, t in docs]
    n_docs, total = sum(bool(w) for _, w in bags), sum(len(w) for _, w in bags)
    df = Counter(t for _, w in bags for t in set(w))
    out = []
    for item, text in items:
        scored = []
        for i, w in bags:
            tf, s = Counter(w), 0
            for t in set(words(text)):
                if tf[t]:
                    m = 100 - 90 + (90 * len(w) * n_docs) // total
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k])]
    return Counter(out)


def run(spark, docs_df, items, **kw):
    return Counter(tuple(r) for r in treap.rank(docs_df, spark.createDataFrame(items, ITEM), **kw).collect())


def corpus(n, seed=0):
    rng = np.random.default_rng(seed)
    lex = [f"w{i}" for i in range(60)]
    p = 1 / np.arange(1, 61)
    p /= p.sum()
    out = [(int(i), " ".join(rng.choice(lex, size=rng.integers(0, 40), p=p))) for i in rng.permutation(n)]
    return out + [(n + i, out[0][1] or "w1 w2") for i in range(80)]  # a large group of equal scores


def test_equals_brute_force(spark, make_docs):
    docs = corpus(300)
    items = [("a", "W1 w2 w59"), ("b", "w0, w0 w0!"), ("c", "w30 w31 w32 w33 nowhere"), ("c", "w40"), ("d", "nowhere"), (None, "w5 w6")]
    df = make_docs(docs, clash=True).repartition(3)
    want = brute(docs, items)
    assert run(spark, df, items) == want
    # small ranges, one query in a block: the same rows
    assert run(spark, df, items, range_docs=16, block_terms=1) == want
    assert run(spark, df, items, range_bytes=300) == want


def test_odd_rows(spark, make_docs, odd):
    items = [("1", "one word"), ("2", "same again"), ("3", "中文 ümläut"), ("4", None), ("5", ""), ("6", "id no here"), ("7", "a" * 30_000)]
    assert run(spark, make_docs(odd), items) == brute(odd, items)


def test_empty_tables(spark, make_docs):
    assert run(spark, make_docs([]), [("a", "w1")]) == Counter()
    assert run(spark, make_docs([(1, None), (2, "...")]), [("a", "w1")]) == Counter()
    assert run(spark, make_docs([(1, "w1")]), []) == Counter()


def test_long_text(spark, make_docs):
    rng = np.random.default_rng(1)
    long = " ".join(f"w{i}" for i in rng.integers(0, 5000, 400_000))  # some 2.3 MB
    docs = [(1, long), (2, "w1 w2 w3"), (3, "w4 w1")]
    items = [("a", "w1 w2"), ("b", "w4999 w4")]
    assert run(spark, make_docs(docs), items) == brute(docs, items)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 25), st.integers(1, 10**6)), min_size=1, max_size=120), st.integers(1, 6),
       st.integers(0, 10**6))
def test_search_equals_scan(cells, k, seed):
    grid = {(r, c): v for r, c, v in cells}
    r, c = (np.array(x, np.int64) for x in zip(*grid))
    v = np.array(list(grid.values()), np.int64)
    levels, masks, maxima = treap.build(r, c, v)
    g = treap.Grid(levels, masks, maxima, np.arange(100, 100 + int(c.max()) + 1), [])
    rng = np.random.default_rng(seed)
    rows = np.unique(rng.integers(0, int(r.max()) + 1, 5))
    w = rng.integers(0, 4, len(rows))
    scores = Counter()
    for (a, b), x in grid.items():
        for row, weight in zip(rows, w):
            if a == row:
                scores[100 + b] += int(weight) * x
    want = sorted(((s, i) for i, s in scores.items() if s > 0), key=lambda x: (-x[0], x[1]))[:k]
    assert treap.search(g, rows, w, [], k) == want


def test_tree_holds_every_cell():
    rng = np.random.default_rng(5)
    r, c = rng.integers(0, 1000, 5000), rng.integers(0, 300, 5000)
    key = np.unique(r * 1000 + c)
    r, c = key // 1000, key % 1000
    v = rng.integers(1, 10**6, len(key))
    levels, masks, maxima = treap.build(r, c, v)
    g = treap.Grid(levels, masks, maxima, np.arange(300), [])
    node = np.zeros(len(key), np.int64)
    for level in range(levels):
        shift = levels - level - 1
        assert (g.maxima[level][node] >= v).all()
        left, right = g.children(level, node, ((r >> shift) & 1).astype(np.uint8))
        node = np.where((c >> shift) & 1, right, left)
        assert (node >= 0).all()
    assert (g.maxima[levels][node] == v).all() and len(maxima[levels]) == len(key)


def test_pruning_opens_few_nodes(monkeypatch):
    """With falling impacts along the documents, a search for the best opens few of 4,096 columns."""
    n = 4096
    c = np.arange(n, dtype=np.int64)
    levels, masks, maxima = treap.build(np.zeros(n, np.int64), c, 10**6 - c)
    g = treap.Grid(levels, masks, maxima, c, [])
    opened = []
    real = treap.Grid.bounds
    monkeypatch.setattr(treap.Grid, "bounds", lambda self, level, node, w: opened.append(len(node)) or real(self, level, node, w))
    assert treap.search(g, np.array([0]), np.array([1]), [], 10)[0] == (10**6, 0)
    assert sum(opened) < n // 2  # of 8,191 nodes; OPEN halves at a time


def test_weight_and_terms():
    odd = "Ab1 c_d\tÄx—y\x00Z\x85É\u2003q\x7f 😀😀"
    assert [t.decode() for t in treap.terms(odd.encode())] == words(odd) and treap.terms(None) == []
    assert treap.weight(1, 1) == math.floor(1000 * math.log(4 / 3))
