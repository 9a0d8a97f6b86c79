"""Token counts by byte-pair merging with a heap and a linked list.

A word starts as its symbols; the adjacent pair of lowest rank (leftmost on ties) is popped
from a heap and merged in a doubly linked list until no ranked pair is left.  The count is
the number of initial symbols minus the number of merges; no token ids are emitted.

The vocabulary is a tokenizer file of the ``tokenizers`` library whose model is BPE with an
end-of-word suffix, a byte-level alphabet and NFC / white space / lower case normalisation
(``word_bpe_49k.json``).  Counts equal the library's ``encode(text, add_special_tokens=False)``
with special strings inside a text handled as the library does by default (one token each).
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from chronoweave.llm.common import bounded_batches, slices, text_column

#: Words kept with their counts by one Python worker; beyond that the cache starts anew
#: (a word that is not in the cache is merged again, so the counts do not depend on it).
CACHE_WORDS = 500_000

# Characters up to U+024F: letters, numbers and white space stated for the standard
# library's matcher; texts with other characters use Unicode properties (regex module).
_NO = "²³¹¼-¾"
_WS = "\t-\r \x85\xa0"
_LATIN_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_{_NO}]+|[\d{_NO}]|(?:[^\w{_WS}]|_)+")
_LATIN_SPACE = re.compile(rf"[{_WS}]+")
_OTHER = re.compile("[^\x00-ɏ]")
_ANY_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
_ANY_SPACE = regex.compile(r"\p{White_Space}+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    printable Latin-1 characters stand for themselves, the others follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 0x100
    for b in range(256):
        out.append(chr(b if b in plain else extra))
        extra += b not in plain
    return out


class PairMerger(dict):
    """Token count of a word (bytes after normalisation); a dict that fills itself."""

    def __init__(self, path: str):
        super().__init__()
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        suffix = model.get("end_of_word_suffix") or ""
        sym: dict[str, int] = {}
        for a, b in ([m.split(" ") if isinstance(m, str) else m for m in model["merges"]]):
            for s in (a, b, a + b):
                sym.setdefault(s, len(sym))
        alphabet = byte_alphabet()
        for ch in alphabet:
            for s in (ch, ch + suffix):
                sym.setdefault(s, len(sym))
        self.first = [sym[ch] for ch in alphabet]
        self.final = [sym[ch + suffix] for ch in alphabet]
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for i, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.rank.setdefault((sym[a], sym[b]), (i, sym[a + b]))
        special = [re.escape(t["content"]) for t in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(special)) if special else None

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = n = self.merge(word.encode("utf-8", "surrogatepass"))
        return n

    def merge(self, word: bytes) -> int:
        n = len(word)
        if n < 2:
            return n
        rank, first = self.rank, self.first
        sym = [first[b] for b in word]
        sym[-1] = self.final[word[-1]]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            r = rank.get((sym[i], sym[i + 1]))
            if r is not None:
                heap.append((r[0], i, r[1]))
        heapify(heap)
        merges = 0
        while heap:
            r, i, new = heappop(heap)
            a = sym[i]
            j = after[i]
            if a < 0 or j >= n:
                continue
            now = rank.get((a, sym[j]))
            if now is None or now[0] != r:
                continue  # one side was merged meanwhile
            merges += 1
            sym[i], sym[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                x = rank.get((new, sym[k]))
                if x is not None:
                    heappush(heap, (x[0], i, x[1]))
            p = before[i]
            if p >= 0:
                x = rank.get((sym[p], new))
                if x is not None:
                    heappush(heap, (x[0], p, x[1]))
        return n - merges

    def count(self, text: str) -> int:
        if self.special is None or "<|" not in text:
            return self._plain(text)
        parts = self.special.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1

    def _plain(self, text: str) -> int:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if _OTHER.search(text):
                low = _ANY_SPACE.sub(" ", text).replace("Σ", "σ").lower()  # no final sigma rule
                return sum(map(self.__getitem__, _ANY_WORD.findall(low)))
        words = _LATIN_WORD.findall(text.lower())
        return sum(map(self.__getitem__, words))


@lru_cache(maxsize=4)
def merger(path: str) -> PairMerger:
    """One vocabulary per Python worker and path."""
    return PairMerger(path)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row.

    A null text is the empty text (no tokens); ids may be null or repeat; an empty table
    gives an empty result.  A word of any length is merged in n log n steps."""
    thin = bounded_batches(docs).select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    kind = thin.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(vocabulary)
        for b in slices(batches):
            texts = text_column(b, "_text")
            n = [m.count(t) for t in texts]
            size = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), pa.array(size, pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())],
                names=["_id", "n_bytes", "n_tokens", "over_limit"])

    return thin.mapInArrow(run, f"_id {kind}, n_bytes long, n_tokens long, over_limit boolean") \
        .withColumnRenamed("_id", id_col)
