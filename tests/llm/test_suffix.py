import hashlib
import random

import numpy as np
import pytest

from chronoweave.llm import suffix


@pytest.mark.parametrize("alphabet", [b"ab", b"abc\xff", bytes(range(256))])
def test_suffix_array_is_sorted(alphabet):
    rng = random.Random(6)
    for _ in range(120):
        b = bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 150)))
        assert suffix.suffix_array(b, 200).tolist() == sorted(range(len(b)), key=lambda i: b[i:])
    assert suffix.suffix_array(b"a" * 500, 600).tolist() == list(range(499, -1, -1))


def brute(rows, length):
    rows = [(-1 << 63 if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in rows:
        for p in range(len(b) - length + 1):
            k = b[p:p + length]
            first[k] = min(first.get(k, (i, p)), (i, p))
    out = []
    for i, b in rows:
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < (i, p):
                gone[p:p + length] = True
        gone = gone[:-1]
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(docs, length, **kw):
    got = suffix.remove_repeats(docs, length, **kw).collect()
    return sorted((-1 << 63 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got)


def corpus(rng, n=60):
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    passage = " ".join(word() for _ in range(40))
    rows = []
    for i in range(n):
        t = " ".join(word() for _ in range(rng.randint(0, 120)))
        if i % 3 == 0:
            t = t[:50] + passage + t[50:]
        if i % 7 == 0 and rows:
            t = rows[rng.randrange(len(rows))][1]
        if i % 5 == 0:
            t += passage[20:170] + t[:150]
        rows.append((i, t))
    return rows + [(n, "ab" * 400), (n + 1, "x" * 1000), (n + 2, "ab" * 90 + "c" + "ab" * 90), (n + 3, "abc" * 34)]


@pytest.mark.parametrize("hot", [1000, 2])
def test_against_brute_force(make_docs, hot, monkeypatch):
    rows = corpus(random.Random(7))
    assert run(make_docs(rows), 100, hot=hot) == brute(rows, 100)
    assert run(make_docs(rows), 33, hot=hot) == brute(rows, 33)


def test_small_pieces_and_batches_in_process(monkeypatch):
    monkeypatch.setattr(suffix, "PIECE", 64)
    rng = random.Random(8)
    texts = [t.encode() for _, t in corpus(rng, 20)]
    s = suffix.segments(texts, 100)
    places = sorted((d, p) for d, a, n in zip(s["doc"], s["start"], s["n"]) for p in range(a, a + n))
    assert places == [(i, p) for i, t in enumerate(texts) for p in range(len(t) - 99)]
    key = {}
    for d, a, n, k in zip(s["doc"], s["start"], s["n"], s["key"]):
        for p in range(a, a + n):
            w = texts[d][p:p + 100]
            assert key.setdefault(w, k) == k  # equal windows have equal keys


def test_odd_rows(make_docs, odd):
    rows = odd + [(None, "same text again " * 40)]
    assert run(make_docs(rows, clash=True), 100) == brute(rows, 100)
    assert run(make_docs([]), 100) == []
