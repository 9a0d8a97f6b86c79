import numpy as np
import pytest
from pyspark.sql import types as T

from chronoweave.llm import whiten

VEC = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType())])


def brute(vectors, count=4, scale=256):
    x = np.floor(scale * np.array(vectors, float)).astype(np.int64)
    d = np.unique(x, axis=0)
    n, s = len(d), d.sum(0)
    c = d - s / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1][:count], q[:, ::-1][:, :count]
    return n, ((n * x - s) ** 2).sum(1), (x - s / n) @ q / np.sqrt(e), e / np.trace(c.T @ c / n), q


def run(spark, rows, **kw):
    return whiten.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], VEC), **kw).collect()


def compare(rows, ids, vectors):
    n, dev, white, share, _ = brute(vectors)
    k = white.shape[1]
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(rows) == len(got) == len(ids) * k
    for c in range(k):
        w = np.array([got[i, c + 1]["whitened"] for i in ids])
        assert min(np.abs(w - white[:, c]).max(), np.abs(w + white[:, c]).max()) < 1e-8
        assert [got[i, c + 1]["deviation"] for i in ids] == dev.tolist()
        assert got[ids[0], c + 1]["explained"] == pytest.approx(share[c], rel=1e-9)
    assert {r["n"] for r in rows} == {n} and max(r["identity_error"] for r in rows) < 1e-9


def test_equals_eigenvectors(spark):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(300, 12)) * np.linspace(3, 0.2, 12)
    v[100:160] = v[0]  # one vector held by many rows counts once in the fit list
    compare(run(spark, list(enumerate(v.tolist()))), list(range(300)), v)


def test_multiple_eigenvalues(spark):
    """Four equal eigenvalues: whitened columns are uncorrelated with unit variance all the same."""
    v = [(s * np.eye(6)[i]).tolist() for i in range(4) for s in (1.0, -1.0)]
    rows = run(spark, list(enumerate(v)))
    w = np.zeros((8, 4))
    for r in rows:
        w[r["vec_id"], r["component"] - 1] = r["whitened"]
    assert np.allclose(w.T @ w / 8, np.eye(4), atol=1e-9)
    assert {round(r["explained"], 9) for r in rows} == {0.25}


def test_low_rank_and_single(spark):
    line = [[float(i), 2.0 * i, 0.0] for i in range(5)]
    rows = run(spark, list(enumerate(line)))
    assert {r["component"] for r in rows} == {1} and len(rows) == 5  # no variance elsewhere
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []


def test_unusable_rows(spark):
    rng = np.random.default_rng(2)
    good = rng.normal(size=(40, 3)).tolist()
    rows = list(enumerate(good))
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [float("nan"), 0.0, 0.0]), (104, [float("inf"), 0.0, 0.0]), (105, [1.0, 2.0])]
    got = run(spark, rows + bad + [(None, good[0]), (7, good[7])])
    plain = [r for r in got if r["vec_id"] is not None]
    assert len(got) == 3 * 42 and {r["vec_id"] for r in plain} == set(range(40))
    n, dev, *_ = brute(good)
    assert {(r["vec_id"], r["deviation"]) for r in plain} == {(i, int(d)) for i, d in enumerate(dev)}


def test_empty(spark):
    assert run(spark, []) == [] and run(spark, [(1, None)]) == []


def test_exact_deviations_beyond_longs():
    x = np.array([[3 * 10**9, -5], [1, 2]], np.int64)
    s = [3 * 10**9 + 1, -3]
    want = [sum((2 * int(a) - b) ** 2 for a, b in zip(r, s)) for r in x]
    assert whiten._deviations(x, 2, s, max(map(abs, s))) == [v if v < 2**63 else None for v in want]
    big = np.array([[2**40, 0], [0, 2**40]], np.int64)
    assert whiten._deviations(big, 2, [2**40, 2**40], 2**40) == [None, None]


def test_extra_columns(spark):
    from pyspark.sql import functions as F
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(rng.normal(size=(20, 4)).tolist())], VEC)
    for c in ("id", "x", "c", "n", "component", "copies", "whitened"):
        df = df.withColumn(c, F.lit("x"))
    assert len(whiten.whiten(df).collect()) == 80
