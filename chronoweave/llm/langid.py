"""Language identification with a byte convolutional network.

The network reads the UTF-8 bytes of the lower-cased text: a byte embedding, filters of
several widths, ReLU, max pooling over a window of ``window`` bytes, and a softmax over the
languages.  It is trained in numpy (Adam, cross entropy) on the driver.

* Sample: at most ``sample_rows`` texts in all, dealt equally to the languages, and
  ``windows_per_text`` windows of each, spread over the whole text.  These two parameters bound
  what reaches the driver: rows x windows x window bytes (2 MB by default).  Texts are drawn by
  the hash of their text, so a text that has thousands of copies is drawn once.
* Prediction: every window of every whole text.  Windows are cut from a stream of
  all texts of an Arrow batch in chunks of fixed size, so one very long text needs no more memory
  than many short ones.  The mean log probability of a text's windows, weighted by their
  bytes, gives the language.

Scale.  One pass for the counts of labelled rows, one for the sample, one for the
predictions; nothing of the corpus is shuffled.  The model is some 10 KB.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import bounded_batches, slices

UNDETERMINED = "und"
PAD = 256
#: bytes of text that one step of the network reads; its work arrays hold some 100 floats a byte
CHUNK_BYTES = 1 << 14
LETTER = regex.compile(r"\p{L}")


@dataclass
class ByteNet:
    """Weights: ``emb`` (257, e); ``conv`` (filters, widest * e), zero beyond a filter's own
    width; ``bias`` (filters); ``out`` (filters, languages); ``out_bias``."""

    langs: list[str]
    window: int
    widths: tuple[int, ...]
    emb: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @property
    def reach(self) -> int:
        return max(self.widths) - 1

    def patches(self, stream: np.ndarray) -> np.ndarray:
        """Embedded neighbourhoods (positions, widest * e) of a byte stream."""
        x = self.emb[stream]
        n, w = len(stream) - self.reach, self.reach + 1
        return np.concatenate([x[o:o + n] for o in range(w)], axis=1)

    def filtered(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Filter values (windows, window, filters) before bias and ReLU, and the patches.
        ``windows`` (n, window + reach) end in ``reach`` padding bytes, so no window reads another."""
        p = self.patches(np.r_[windows.ravel(), np.full(self.reach, PAD, windows.dtype)])
        y = p @ self.conv.T
        return y.reshape(len(windows), windows.shape[1], -1)[:, :self.window], p

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        y, _ = self.filtered(windows)
        z = np.maximum(y.max(axis=1) + self.bias, 0) @ self.out + self.out_bias
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def encode(text: str | None) -> bytes:
    """The bytes that the network reads; lone surrogates cannot occur in Spark strings."""
    return (text or "").lower().encode("utf-8", "replace")


def has_letter(text: str | None) -> bool:
    return text is not None and LETTER.search(text) is not None


def cut(raw: bytes, window: int, most: int, reach: int) -> np.ndarray:
    """At most ``most`` windows of a text, spread evenly over it, each padded by ``reach`` bytes or more."""
    b = np.frombuffer(raw, np.uint8)
    n = max(1, -(-len(b) // window))
    at = np.unique(np.linspace(0, n - 1, min(n, most)).round().astype(int))
    out = np.full((len(at), window + reach), PAD, np.int16)
    for row, i in enumerate(at):
        part = b[i * window:(i + 1) * window]
        out[row, :len(part)] = part
    return out


def train(texts: list[bytes], labels: list[str], window: int = 128, widths: tuple[int, ...] = (2, 3, 4), filters: int = 16,
          embedding: int = 8, windows_per_text: int = 4, epochs: int = 4, batch: int = 128, rate: float = 0.01,
          seed: int = 0) -> ByteNet | None:
    """Fit the network on encoded texts; languages are the sorted labels.  None without a text."""
    if not texts:
        return None
    langs = sorted(set(labels))
    place = {v: i for i, v in enumerate(langs)}
    parts = [cut(t, window, windows_per_text, max(widths) - 1) for t in texts]
    x = np.concatenate(parts)
    y = np.repeat([place[v] for v in labels], [len(p) for p in parts])
    # languages weigh the same, whatever their number of windows; so do the texts of one
    share = np.repeat([1.0 / len(p) for p in parts], [len(p) for p in parts])
    weight = (share / np.bincount(y, share, len(langs))[y] * len(y) / len(langs)).astype(np.float32)

    rng = np.random.default_rng(seed)
    widest = max(widths)
    total = filters * len(widths)
    mask = np.zeros((total, widest * embedding), np.float32)
    for i, w in enumerate(widths):
        mask[i * filters:(i + 1) * filters, :w * embedding] = 1
    net = ByteNet(langs, window, tuple(widths),
                  rng.normal(0, 0.5, (257, embedding)).astype(np.float32),
                  (rng.normal(0, 1, mask.shape) / np.sqrt(mask.sum(1, keepdims=True))).astype(np.float32) * mask,
                  np.zeros(total, np.float32),
                  (rng.normal(0, 1, (total, len(langs))) / np.sqrt(total)).astype(np.float32), np.zeros(len(langs), np.float32))
    net.emb[PAD] = 0
    names = ("emb", "conv", "bias", "out", "out_bias")
    m1 = {k: np.zeros_like(getattr(net, k)) for k in names}
    m2 = {k: np.zeros_like(getattr(net, k)) for k in names}
    step, steps = 0, epochs * -(-len(x) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            i = order[at:at + batch]
            step += 1
            g = _gradients(net, x[i], y[i], weight[i])
            g["conv"] *= mask
            g["emb"][PAD] = 0
            lr = rate * (1 - step / (steps + 1))
            for k in names:
                m1[k] += 0.1 * (g[k] - m1[k])
                m2[k] += 0.001 * (g[k] ** 2 - m2[k])
                getattr(net, k)[...] -= lr * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-7)
    return net


def _gradients(net: ByteNet, windows: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean weighted cross entropy; through the maxima only the arg-max
    positions carry any."""
    act, patches = net.filtered(windows)
    stream = windows.ravel()
    n = len(windows)
    arg = act.argmax(axis=1)
    top = np.take_along_axis(act, arg[:, None, :], 1)[:, 0, :] + net.bias
    h = np.maximum(top, 0)
    z = h @ net.out + net.out_bias
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(n), y] -= 1
    p *= weight[:, None] / n
    dh = (p @ net.out.T) * (top > 0)
    pos = arg + (np.arange(n) * windows.shape[1])[:, None]
    e, w = net.emb.shape[1], net.reach + 1
    demb = np.zeros_like(net.emb)
    dpatch = dh[:, :, None] * net.conv[None, :, :]
    for o in range(w):
        byte = stream[pos + o].ravel()
        d = dpatch[:, :, o * e:(o + 1) * e].reshape(-1, e)
        for c in range(e):
            demb[:, c] += np.bincount(byte, d[:, c], len(demb)).astype(np.float32)
    return {"conv": np.einsum("nf,nfk->fk", dh, patches[pos], optimize=True), "bias": dh.sum(0), "emb": demb,
            "out": h.T @ p, "out_bias": p.sum(0)}


def sample(docs: DataFrame, usable: Column, label_col: str, text_col: str, rows: int, window: int,
           windows_per_text: int) -> list[tuple[str, bytes]]:
    """(label, bytes) of at most ``rows`` distinct labelled texts, equally many of each label
    that has so many: those with the smallest hash of their text.

    Labels are counted first; a hash bound for each leaves some 1.5 times the rows it may
    have, and the exact number is taken from these.  With more labels than ``rows`` the most
    frequent ``rows`` labels are learned.  A longer text is cut to its spread windows before
    it leaves the executor, so the driver gets ``windows_per_text * window`` bytes of it."""
    label, text = F.col(label_col), F.col(text_col)
    base = docs.select(text.alias("t"), label.cast("string").alias("l"), F.xxhash64(text).alias("h")) \
        .where(usable & label.isNotNull() & text.rlike(r"\p{L}"))
    counts = base.groupBy("l").agg(F.approx_count_distinct("h").alias("n")).orderBy(F.desc("n"), "l").limit(rows).collect()
    if not counts:
        return []
    each = max(1, rows // len(counts))
    low, high = -(1 << 63), (1 << 63) - 1
    share = [min(1.0, 1.5 * (each + 30) / max(1, r["n"])) for r in counts]
    limits = docs.sparkSession.createDataFrame([(r["l"], min(high, low + int(s * (1 << 64)))) for r, s in zip(counts, share)],
                                               "l string, b bigint")
    spread = F.udf(lambda t: bytes(_spread(t, window, windows_per_text)), "binary")
    drawn = base.join(F.broadcast(limits), "l").where(F.col("h") <= F.col("b")) \
        .select("l", "h", spread("t").alias("s")).groupBy("l", "h").agg(F.min("s").alias("s"))
    top = drawn.groupBy("l").agg(F.slice(F.array_sort(F.collect_list(F.struct("h", "s"))), 1, each).alias("top"))
    return [(r["l"], bytes(x["s"])) for r in top.orderBy("l").collect() for x in r["top"]]


def _spread(text: str, window: int, most: int) -> bytes:
    """The bytes of a text, or of its ``most`` spread windows if it is longer."""
    raw = encode(text)
    return raw if len(raw) <= most * window else cut(raw, window, most, 0).astype(np.uint8).tobytes()


def fit(docs: DataFrame, usable: Column, label_col: str = "lang", text_col: str = "text", sample_rows: int = 4000,
        window: int = 128, windows_per_text: int = 4, **options) -> ByteNet | None:
    """Train on a bounded sample of the ``usable`` rows with a label and a letter."""
    rows = sample(docs, usable, label_col, text_col, sample_rows, window, windows_per_text)
    return train([r[1] for r in rows], [r[0] for r in rows], window=window, windows_per_text=windows_per_text, **options)


def predict(net: ByteNet, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text, all windows read."""
    n = len(texts)
    total = np.zeros((n, len(net.langs)))
    size = np.zeros(n)
    w = net.window
    cells = max(1, CHUNK_BYTES // w)
    held = np.full((cells, w + net.reach), PAD, np.int16)
    owner = np.zeros(cells, np.int64)
    length = np.zeros(cells)
    used = 0

    def flush() -> None:
        nonlocal used
        if used:
            lp = net.log_probabilities(held[:used])
            np.add.at(total, owner[:used], lp * length[:used, None])
            np.add.at(size, owner[:used], length[:used])
            held[:] = PAD
            used = 0

    known = np.array([has_letter(t) for t in texts], bool)
    for i, t in enumerate(texts):
        if not known[i]:
            continue
        raw = np.frombuffer(encode(t), np.uint8)
        at = 0
        while at < len(raw):
            take = min(cells - used, -(-(len(raw) - at) // w))
            part = raw[at:at + take * w]
            whole = len(part) // w
            held[used:used + whole, :w] = part[:whole * w].reshape(whole, w)
            held[used + whole:used + take, :len(part) - whole * w] = part[whole * w:]
            owner[used:used + take] = i
            length[used:used + take] = w
            length[used + take - 1] = len(part) - (take - 1) * w
            used += take
            at += len(part)
            if used == cells:
                flush()
    flush()
    z = total / np.maximum(size, 1)[:, None]
    z -= z.max(axis=1, keepdims=True)
    p = np.exp(z)
    p /= p.sum(axis=1, keepdims=True)
    best = p.argmax(axis=1)
    score = np.where(known, p[np.arange(n), best], 0.0)
    return [net.langs[b] if k else UNDETERMINED for b, k in zip(best, known)], score


def identify(docs: DataFrame, net: ByteNet | None, id_col: str = "doc_id", text_col: str = "text",
             carry: dict[str, Column] | None = None) -> DataFrame:
    """(id, lang_pred, score) for every row of ``docs``.

    A null text and one without a letter are ``und`` with score 0; so is every text if nothing
    could be learned.  Repeated ids and rows each get their row, extra columns do not matter,
    and an empty table gives no rows.  ``carry`` adds expressions over ``docs``."""
    carry = carry or {}
    rows = bounded_batches(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                                       F.struct(F.lit(0).alias("_"), *[c.alias(k) for k, c in carry.items()]).alias("more")))
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = b.column("text").to_pylist()
            lang, score = predict(net, texts) if net is not None else ([UNDETERMINED] * len(texts), np.zeros(len(texts)))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                              b.column("more")], ["id", "lang_pred", "score", "more"])

    out = rows.mapInArrow(work, f"id {kind['id']}, lang_pred string, score double, more {kind['more']}")
    return out.select(F.col("id").alias(id_col), *[F.col(f"more.{k}").alias(k) for k in carry], "lang_pred", "score")


def held_out(id_column: Column, folds: int = 5) -> Column:
    """Whether a row is never learned from: crc32 of its id as text, modulo ``folds``, is 0.  A null id
    counts as the empty text, whose remainder is 0."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % folds == 0


def fit_and_identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
                     **options) -> DataFrame:
    """(id, held_out, lang_pred, score): trained on the rows outside the held-out fold, applied to all."""
    out = held_out(F.col(id_col))
    return identify(docs, fit(docs, ~out, label_col, text_col, **options), id_col, text_col, {"held_out": out})
