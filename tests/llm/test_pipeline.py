import random

import corpus_pipeline as cp
import pytest
from chronoweave.llm.common import materialize
from pyspark.sql import functions as F

import test_decontam
import test_jaccard
import test_pii
import test_quality


@pytest.fixture(scope="module")
def case(spark, tmp_path_factory):
    rng = random.Random(16)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    item = " ".join(word() for _ in range(15))
    clean = [(i, " ".join(word() for _ in range(rng.randint(60, 90)))) for i in range(20)]
    near = [(100 + i, " ".join([*clean[i][1].split()[:-1], "changed"])) for i in range(5)]
    rows = clean + near + [(200, "junk ### $$$ " * 5), (201, clean[0][1]), (202, clean[3][1] + " " + item + " end"),
                           (203, clean[4][1] + " x" + " mail me@here.example now " + " ".join(word() for _ in range(60))), (204, None), (205, "")]
    folder = str(tmp_path_factory.mktemp("sf"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.char_length("text").cast("long")})
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, item


def ids(df):
    return sorted(r["doc_id"] for r in df.collect())


def test_stages_against_brute_force(spark, case):
    folder, rows, item = case
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    stages = dict(cp.STAGES)
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontaminate", "sanitise", "pack"]

    docs = materialize(stages["quality"](spark, docs, folder), "t")
    left = [(i, t) for i, t in rows if test_quality.brute(t)[0] >= 50 and "###" not in t]
    assert ids(docs) == sorted(i for i, _ in left) and docs.columns == names

    docs = materialize(stages["near_duplicates"](spark, docs, folder), "t")
    left = [(i, t) for i, t in left if i in {c for _, c, _, _ in test_jaccard.brute(left)}]
    assert ids(docs) == sorted(i for i, _ in left) and docs.columns == names
    assert not {100, 101, 102, 103, 104, 201} & {i for i, _ in left}

    docs = materialize(stages["decontaminate"](spark, docs, folder), "t")
    left = [(i, t) for i, t in left if not test_decontam.brute([(i, t)], [(1, item)])[0][2]]
    assert ids(docs) == sorted(i for i, _ in left) and docs.columns == names and 202 not in ids(docs)

    docs = materialize(stages["sanitise"](spark, docs, folder), "t")
    assert docs.columns == names
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in docs.collect()}
    assert all(n == len(t) for t, n in got.values())
    assert all(got[i][0] == t for i, t in left if not test_pii.brute(t))
    assert "[EMAIL]" in got[203][0] and "@" not in got[203][0]

    out = stages["pack"](spark, docs, folder)
    assert sorted({r["doc_id"] for r in out.collect()}) == sorted(got)
    assert sorted({r["doc_id"] for r in cp.run(spark, folder).collect()}) == sorted(got)


def test_empty_documents(spark, case, tmp_path):
    folder, _, _ = case
    empty = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in cp.STAGES:
        out = stage(spark, empty, folder)
        assert out.collect() == []
