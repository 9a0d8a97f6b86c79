import numpy as np
import pytest

from chronoweave.llm import langid

SF = "/root/testdata/sf0.01"


def tiny(seed=1, langs=("a", "b", "c"), window=16, widths=(2, 3)):
    rng = np.random.default_rng(seed)
    f, e, w = 2 * len(widths), 3, max(widths)
    conv = rng.normal(size=(f, w * e)).astype(np.float32)
    for i, k in enumerate(widths):
        conv[2 * i:2 * i + 2, k * e:] = 0
    emb = rng.normal(size=(257, e)).astype(np.float32)
    emb[langid.PAD] = 0
    return langid.ByteNet(list(langs), window, widths, emb, conv, rng.normal(size=f).astype(np.float32),
                          rng.normal(size=(f, len(langs))).astype(np.float32), rng.normal(size=len(langs)).astype(np.float32))


def brute(net, text):
    """The same network by loops: windows, filters one position at a time, mean of log softmax."""
    raw = list(langid.encode(text))
    total, size = np.zeros(len(net.langs)), 0
    for at in range(0, len(raw), net.window):
        part = raw[at:at + net.window]
        cells = part + [langid.PAD] * (net.window - len(part) + net.reach)
        h = []
        for f in range(len(net.conv)):
            best = max(sum(float(net.conv[f, o * 3 + j]) * float(net.emb[cells[i + o], j]) for o in range(net.reach + 1) for j in range(3))
                       for i in range(net.window))
            h.append(max(0.0, best + float(net.bias[f])))
        z = np.array(h) @ net.out + net.out_bias
        total += (z - z.max() - np.log(np.exp(z - z.max()).sum())) * len(part)
        size += len(part)
    p = np.exp(total / size - (total / size).max())
    return net.langs[int(p.argmax())], float(p.max() / p.sum())


def test_network_equals_loops(monkeypatch):
    net = tiny()
    texts = ["x", "Hello wörld " * 9, "a" * 16, "b" * 17, "ñ" * 200, "日本語 text"]
    monkeypatch.setattr(langid, "CHUNK_BYTES", 64)  # texts reach over several chunks
    lang, score = langid.predict(net, texts)
    for t, a, s in zip(texts, lang, score):
        assert (a, pytest.approx(s, abs=1e-5)) == brute(net, t)


def test_prediction_does_not_depend_on_the_batch():
    net = tiny()
    texts = ["one text here", "another, longer text " * 30, "z"]
    alone = [langid.predict(net, [t]) for t in texts]
    lang, score = langid.predict(net, texts)
    assert lang == [a[0][0] for a in alone] and np.allclose(score, [a[1][0] for a in alone], atol=1e-6)


def test_gradients_equal_differences():
    net = tiny()
    net = langid.ByteNet(**{**net.__dict__, **{k: getattr(net, k).astype(np.float64) for k in ("emb", "conv", "bias", "out", "out_bias")}})
    rng = np.random.default_rng(0)
    x = np.full((5, net.window + net.reach), langid.PAD, np.int16)
    x[:, :net.window] = rng.integers(97, 110, (5, net.window))
    y, weight = np.array([0, 1, 2, 1, 0]), np.array([1.0, 0.5, 2.0, 1.0, 1.0])

    def loss():
        return -(net.log_probabilities(x)[np.arange(5), y] * weight).mean()
    g = langid._gradients(net, x, y, weight)
    for k in ("emb", "conv", "bias", "out", "out_bias"):
        a = getattr(net, k)
        for _ in range(12):
            i = tuple(rng.integers(0, s) for s in a.shape) if k != "emb" else (int(rng.integers(97, 110)), int(rng.integers(0, 3)))
            old = a[i]
            a[i] = old + 1e-6
            up = loss()
            a[i] = old - 1e-6
            down = loss()
            a[i] = old
            assert g[k][i] == pytest.approx((up - down) / 2e-6, abs=1e-5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = langid.fit_and_identify(docs).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(truth)
    assert all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and truth[r["doc_id"]] is not None and r["lang_pred"] != "und"]
    assert len(held) > 100 and np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97


def test_odd_rows(spark, make_docs, odd):
    docs = make_docs(odd, clash=True)
    rows = langid.fit_and_identify(docs, label_col="seg").collect()  # one label: "x"
    assert len(rows) == len(odd)
    for r in rows:
        text = dict((i, t) for i, t in odd)[r["doc_id"]] if r["doc_id"] is not None else "?"
        if text is None or not langid.has_letter(text) and r["doc_id"] is not None:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert {r["lang_pred"] for r in rows} == {"x", "und"}
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [True, True]


def test_nothing_to_learn_and_empty(spark, make_docs):
    from pyspark.sql import functions as F
    docs = make_docs([(1, "some text"), (2, None)]).withColumn("lang", F.lit(None).cast("string"))
    assert [(r["lang_pred"], r["score"]) for r in langid.fit_and_identify(docs).collect()] == [("und", 0.0)] * 2
    assert langid.fit_and_identify(docs.limit(0)).collect() == []


def test_copies_are_drawn_once(spark, make_docs):
    from pyspark.sql import functions as F
    docs = make_docs([(i, "same text") for i in range(300)] + [(1000 + i, f"text number {i}") for i in range(40)]).withColumn("lang", F.lit("en"))
    rows = langid.sample(docs, F.lit(True), "lang", "text", 20, 128, 4)
    assert len(rows) == 20 and sum(t == b"same text" for _, t in rows) <= 1


def test_long_text_in_bounded_chunks():
    net = tiny()
    text = "Ein langer Text mit vielen Wörtern. " * 60_000  # some 2 MB
    lang, score = langid.predict(net, [text, "x"])
    part, _ = langid.predict(net, [text[:36 * 400]])
    assert lang[0] == part[0] and len(langid._spread(text, 128, 4)) == 512
