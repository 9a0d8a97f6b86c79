import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chronoweave.llm import packing

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
LIBRARY = Tokenizer.from_file(JSON)
PARTS = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "'s", "'S", "a", "É", "é", "²", "½", "9", "_", "#", "<|endoftext|>", "<|", "中", "😀", "Σ", "the", " thing"]


@settings(max_examples=1500, deadline=None)
@given(st.one_of(st.lists(st.sampled_from(PARTS), max_size=20).map("".join), st.text(alphabet=st.characters(max_codepoint=0x24F), max_size=40)))
def test_ids_equal_the_library(t):
    assert list(packing.encoder(JSON, RANKS).ids(t)) == LIBRARY.encode(t, add_special_tokens=False).ids


def check_bins(bins, lengths, size):
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(int(lengths[i]) for i in b) <= size for b in bins)


def test_best_fit_against_the_rule():
    rng = random.Random(13)
    for _ in range(50):
        n = np.array([rng.randint(1, 100) for _ in range(rng.randint(0, 60))])
        rooms = []
        for i in sorted(range(len(n)), key=lambda i: -n[i]):
            fits = [r for r in rooms if r >= n[i]]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - n[i])
            else:
                rooms.append(100 - n[i])
        bins = packing.best_fit(n, 100)
        check_bins(bins, n, 100)
        assert sorted(100 - sum(n[i] for i in b) for b in bins) == sorted(rooms)


def test_local_search_only_improves():
    rng = random.Random(14)
    better = 0
    for _ in range(60):
        n = np.array([rng.randint(20, 60) for _ in range(40)])
        start = packing.best_fit(n, 100)
        bins = packing.local_search(start, n, 100)
        check_bins(bins, n, 100)
        assert -(-int(n.sum()) // 100) <= len(bins) <= len(start)
        square = lambda bs: sum(sum(int(n[i]) for i in b) ** 2 for b in bs)
        assert square(bins) >= square(start)
        better += len(bins) < len(start)
    # from one document per bin the search alone reaches a good packing
    n = np.array([rng.randint(5, 60) for _ in range(60)])
    alone = packing.local_search([[i] for i in range(60)], n, 100)
    check_bins(alone, n, 100)
    assert len(alone) <= 1.15 * -(-int(n.sum()) // 100)


def test_pieces_and_sequences(make_docs, odd):
    rng = random.Random(15)
    rows = odd + [(100 + i, " ".join(rng.choice(["the", "of", "thing", "É", "12"]) for _ in range(rng.randint(0, 400)))) for i in range(150)]
    out = packing.pack_documents(make_docs(rows, clash=True), JSON, RANKS, size=128, end_id=2, cell_items=40).collect()
    want = []
    for i, t in rows:
        ids = np.array([*LIBRARY.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 128 or 128
        cuts = [0, *range(first, len(ids) + 1, 128)]
        want += [(i, k, s, e - s, zlib.crc32(ids[s:e].tobytes())) for k, (s, e) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out), key=str) == sorted(want, key=str)
    bins = defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for off, n in sorted(b):
            assert off == at
            at += n
        assert at <= 128
    total = sum(r["length"] for r in out)
    assert len(bins) <= 1.05 * -(-total // 128) + 1


def test_empty_table(make_docs):
    assert packing.pack_documents(make_docs([]), JSON, RANKS).collect() == []


def test_pairs_of_bins_with_many_documents():
    """Every pair of lengths is offered, however many documents a bin holds."""
    n = np.array([1] * 40 + [2] * 20 + [7, 9], np.int64)
    gifts = {tuple(sorted(int(n[x]) for x in g)) for g in packing._gifts(np.arange(len(n)), n)}
    assert gifts == {(1,), (2,), (7,), (9,), (1, 1), (1, 2), (1, 7), (1, 9), (2, 2), (2, 7), (2, 9), (7, 9)}
    # 1 + 2 against a 3: only the exchange of two for one fills the other bin
    lengths = np.array([1] * 39 + [2] * 30 + [47, 50, 3], np.int64)
    bins = [list(range(69)), [69, 71], [70]]
    out = packing.local_search(bins, lengths, 100)
    assert sorted(d for b in out for d in b) == list(range(72)) and all(lengths[b].sum() <= 100 for b in out)
