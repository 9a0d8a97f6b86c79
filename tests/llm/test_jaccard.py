import random
from itertools import combinations

import numpy as np
import pytest

from chronoweave.llm import jaccard as J


def brute(rows, threshold=0.8):
    low = lambda x: (x is None, x)
    copy = {}
    for i, t in rows:
        copy[t] = min(copy.get(t, i), i, key=low)
    texts = list(copy)
    sets = {t: set(J.shingles(t or "").tolist()) for t in texts}
    links = {t: 0 for t in texts}
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t
    for a, b in combinations(texts, 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    cls = {}
    for t in texts:
        cls[find(t)] = min(cls.get(find(t), copy[t]), copy[t], key=low)
    return sorted(((i, cls[find(t)], copy[t], links[t]) for i, t in rows), key=str)


def corpus(rng, groups=12, copies=6, words=80):
    rows, i = [], 0
    for g in range(groups):
        base = [f"w{rng.randrange(2000)}" for _ in range(words)]
        for _ in range(rng.randint(1, copies)):
            t = list(base)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(words)] = f"x{rng.randrange(10 ** 6)}"
            rows.append((i, " ".join(t)))
            i += 1
    return rows


def run(df, **kw):
    return sorted(((r["doc_id"], r["class_id"], r["copy_of"], r["n_links"]) for r in J.near_duplicates(df, **kw).collect()), key=str)


def test_shingles_are_five_word_sets():
    assert len(J.shingles("a b c d e f")) == 2 and len(J.shingles("A, b. c")) == 1 and len(J.shingles(" .,")) == 0
    assert (J.shingles("a b c d e f") == J.shingles("A b  c\nd (e) f!")).all()
    a, b = J.signature(J.shingles(" ".join(map(str, range(200))))), J.signature(J.shingles(" ".join(map(str, range(20, 220)))))
    assert abs((a == b).mean() - 176 / 216) < 0.12


@pytest.mark.parametrize("kw", [{}, {"limit": 3, "depth": 3, "n_runs": 32}, {"limit": 2, "depth": 1}])
def test_against_brute_force(make_docs, odd, kw):
    rows = corpus(random.Random(9)) + [(500 + i, t) for i, t in odd if i] + [(None, "no id here"), (None, None), (900, "one two three"), (901, "One two, three")]
    rows += [(1000 + i, rows[0][1]) for i in range(30)]
    assert run(make_docs(rows, clash=True), **kw) == brute(rows)


def test_dense_group_of_near_copies(make_docs):
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1:]])) for i in range(120)]  # all pairs linked
    assert run(make_docs(rows), limit=16, depth=4) == brute(rows)


def test_pairs(make_docs):
    rows = corpus(random.Random(10), groups=6)
    _, pairs = J.near_duplicates(make_docs(rows), emit_pairs=True)
    got = {(r["id_a"], r["id_b"]): r["similarity"] for r in pairs.collect()}
    want = {}
    for (a, s), (b, t) in combinations(rows, 2):
        x, y = set(J.shingles(s).tolist()), set(J.shingles(t).tolist())
        if s != t and len(x & y) >= 0.8 * len(x | y):
            want[a, b] = len(x & y) / len(x | y)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)


def test_one_of_each(make_docs, odd):
    rows = corpus(random.Random(11)) + [(100 + i, t) for i, t in odd if i is not None] + [(None, None), (None, "only without id"), (None, "only without id")]
    rows.append(rows[0])
    docs = make_docs(rows, clash=True)
    out = J.one_of_each(docs)
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    want = {}
    for i, c, k, _ in brute(rows):
        want[c] = i if c not in want else want[c]
    text = {i: t for i, t in rows if i is not None}
    ids = sorted({c for _, c, _, _ in brute(rows) if c is not None})
    assert got == sorted([(i, text[i]) for i in ids] + [(None, "only without id")], key=str)


def test_components_of_chains_and_stars(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100 + i, 100) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200)]
    got = {(r["rid"], r["root"]) for r in J.components(spark.createDataFrame(edges, "rid long, other long")).collect()}
    assert got == {(i, 0) for i in range(1, 41)} | {(100 + i, 100) for i in range(1, 30)} | {(201, 200), (202, 200)}


def test_empty_table(make_docs):
    assert J.near_duplicates(make_docs([])).collect() == []
    assert J.one_of_each(make_docs([])).collect() == []


def test_every_pair_is_counted_once():
    rng = np.random.default_rng(12)
    sketch = np.repeat(rng.integers(0, 255, (1, 128), dtype=np.uint8), 6, axis=0)
    node = np.array([1, 1, 1, 2, 2, 2])
    nodes = np.array([[1, 2, J.NO_NODE]] * 6)  # the same three sets meet in both nodes
    i, j = J.close_pairs(node, np.full(6, 10), sketch, nodes, 0.8)
    assert sorted(zip(i.tolist(), j.tolist())) == [(0, 1), (0, 2), (1, 2)]


def test_recall_is_judged_by_band_and_never_given_up_in_silence(spark, make_docs, monkeypatch):
    # a thousand links met often do not hide three that were met once
    assert J._reached({5: 1000, 1: 1}, 0.999) and not J._reached({1: 3}, 0.999) and J._reached({}, 0.999)
    base = [f"w{i}" for i in range(60)]
    docs = make_docs([(k, " ".join(base[:40 + k])) for k in range(12)])
    monkeypatch.setattr(J, "_reached", lambda met, recall: False)
    with pytest.raises(RuntimeError, match="recall"):
        J.near_duplicates(docs, n_runs=2, max_runs=4).collect()


def test_runs_met_beyond_64_runs():
    rng = np.random.default_rng(0)
    runs = rng.permutation(1000)[:300]
    nodes = ((rng.integers(0, 2, (6, 300)).astype(np.uint64) << np.uint64(J._RUN_BITS)) | runs.astype(np.uint64)).view(np.int64)
    i, j = np.triu_indices(6, 1)
    assert J._runs_met(nodes, i, j).tolist() == [int((nodes[a] == nodes[b]).sum()) for a, b in zip(i, j)]
