import re

from pyspark.sql import types as T

from chronoweave.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP = {c: c + 32 for c in range(65, 91)}


def words(t):
    return WORD.findall((t or "").translate(UP))


def brute(docs, items, size=10):
    out = []
    for i, t in docs:
        w = words(t)
        hit, who = set(), set()
        for item, bt in items:
            b = words(bt)
            n = min(size, len(b))
            for s in range(len(b) - n + 1 if n else 0):
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == b[s:s + n]:
                        hit.update(range(p, p + n))
                        if item is not None:
                            who.add(str(item))
        out.append((i, len(w), len(hit), len(who), sorted(who)))
    return sorted(out, key=str)


def run(spark, make_docs, docs, items, clash=False):
    b = spark.createDataFrame(items, T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())]))
    got = decontam.decontaminate(make_docs(docs, clash), b).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], list(r["items"])) for r in got), key=str)


def test_against_brute_force(spark, make_docs, odd):
    items = [(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"), (2, "one two three"), (10, "solo"),
             (3, "a b a b a b a b a b a b a b"), (4, None), (5, "..."), (6, "É é É é É é"), (None, "two three"),
             (11, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (12, "one two three four five six seven")]
    docs = odd + [
        (20, "x alpha, BETA gamma delta epsilon zeta eta theta iota kappa lambda mu nu y"),
        (21, "alpha beta gamma delta epsilon zeta eta theta iota KAPPA"), (22, "alpha beta gamma delta epsilon zeta eta theta iota"),
        (23, "one two three one two three solo"), (24, "a b a b a b a b a b a b a b a b a b"), (25, "é é É é É é É é é"),
        (26, "beta gamma delta epsilon zeta eta theta iota kappa lambda"), (26, "solo one two three four five six seven"),
        (27, "gamma delta epsilon zeta eta alpha beta gamma delta epsilon zeta")]
    assert run(spark, make_docs, docs, items) == brute(docs, items)


def test_empty_tables_and_clashing_names(spark, make_docs, odd):
    items = [(1, "same text again same text again same text again")]
    assert run(spark, make_docs, odd, items, clash=True) == brute(odd, items)
    assert run(spark, make_docs, odd, []) == brute(odd, [])
    assert run(spark, make_docs, [], items) == []


def test_shuffled_path_equals_broadcast(spark, make_docs, odd, monkeypatch):
    items = [(1, "same text again same text again same text again"), (2, "one word")]
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", -1)
    assert run(spark, make_docs, odd, items) == brute(odd, items)


def test_no_python_in_the_plan(spark, make_docs, odd):
    b = make_docs([(1, "one word")]).withColumnRenamed("doc_id", "item_id")
    plan = decontam.decontaminate(make_docs(odd), b)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
