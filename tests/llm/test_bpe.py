import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chronoweave.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
PARTS = ["'s", "'T", "'LL", " ", "\t", "\n", "\x1c", "\x85", "\xa0", "a", "B", "É", "é", "é", "ß", "İ", "Σ", "ΑΣ", "²", "½", "ª", "9", "٣",
         "_", "#", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "ﬁ", "中", "가", "😀", "‍", "the", "thing", " ", "ǅ", "Ⅷ", "<|"]


@settings(max_examples=1500, deadline=None)
@given(st.one_of(st.lists(st.sampled_from(PARTS), max_size=20).map("".join), st.text(alphabet=st.characters(max_codepoint=0x24F), max_size=40)))
def test_counts_equal_the_library(t):
    assert bpe.merger(PATH).count(t) == len(LIBRARY.encode(t, add_special_tokens=False).ids)


def test_cache_overflow_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    m = bpe.PairMerger(PATH)
    words = [f"word{i % 7}ing" for i in range(50)]
    assert m.count(" ".join(words)) == len(LIBRARY.encode(" ".join(words), add_special_tokens=False).ids)
    assert len(m) <= 3


def test_table(make_docs, odd):
    got = bpe.count_tokens(make_docs(odd, clash=True), PATH, limit=100).collect()
    want = sorted(((i, len((t or "").encode()), len(LIBRARY.encode(t or "", add_special_tokens=False).ids)) for i, t in odd), key=str)
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got), key=str) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 100) for r in got)
    assert bpe.count_tokens(make_docs([]), PATH).collect() == []
