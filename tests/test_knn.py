import numpy as np
import pytest

from chronoweave.operators import knn

ROW = "unique_id string, ds long, a double, b double, y double"


def frame(spark, rows):
    return spark.createDataFrame([(f"s{i % 2}", i, *map(float, r[:-1]), r[-1] if r[-1] is None else float(r[-1])) for i, r in enumerate(rows)], ROW)


def brute(train, test, k):
    order = sorted(range(len(train)), key=lambda i: (f"s{i % 2}", i))
    out = {}
    for q, t in enumerate(test):
        d = sorted((sum((u - v) ** 2 for u, v in zip(train[i][:2], t[:2])), n) for n, i in enumerate(order))
        out[q] = np.mean([train[order[n]][2] for _, n in d[:k]])
    return out


def check(spark, train, test, ks, **kw):
    rows = knn.knn_regression(frame(spark, train), frame(spark, test), ["a", "b"], ks, **kw).collect()
    assert len(rows) == len(test) * len(ks)
    for k in ks:
        want = brute(train, test, k)
        got = {r["ds"]: r["y_hat"] for r in rows if r["model"] == f"KNN{k}"}
        assert got == pytest.approx(want, abs=1e-9)


def test_equals_full_scan(spark):
    rng = np.random.default_rng(0)
    train = [(*rng.normal(size=2), rng.normal()) for _ in range(600)]
    test = [(*rng.normal(0, 2, 2), 0) for _ in range(80)]
    check(spark, train, test, (1, 15, 50), pivots=16, chunk_rows=16, query_rows=8)
    check(spark, train, test, (5,))


def test_ties_and_hot_points(spark):
    """Integer grid with many equal distances; a third of the rows are one point, split over chunks."""
    rng = np.random.default_rng(1)
    train = [(*rng.integers(0, 5, 2), i) for i in range(400)] + [(2, 2, 1000 + i) for i in range(200)]
    test = [(*rng.integers(-1, 7, 2), 0) for _ in range(40)] + [(2, 2, 0)] * 30
    check(spark, train, test, (1, 7, 60), pivots=8, chunk_rows=16, query_rows=8)


def test_few_rows(spark):
    check(spark, [(0, 0, 1), (5, 5, 2)], [(1, 1, 0), (9, 9, 0)], (15,))


def test_odd_rows(spark):
    nan = float("nan")
    train = spark.createDataFrame([("s", 1, 0.0, 0.0, 5.0), ("s", 2, None, 0.0, 100.0), ("s", 3, 0.0, nan, 100.0), ("s", 4, 0.0, 0.0, None)], ROW)
    test = spark.createDataFrame([("s", 1, 1.0, 1.0, None), ("s", 2, None, 1.0, None), ("s", 3, nan, 1.0, None), ("s", 1, 1.0, 1.0, None)], ROW)
    got = sorted((r["ds"], r["y_hat"]) for r in knn.knn_regression(train, test, ["a", "b"], (3,)).collect() if r["ds"] == 1)
    assert got == [(1, 5.0), (1, 5.0)]
    rest = [r["y_hat"] for r in knn.knn_regression(train, test, ["a", "b"], (3,)).collect() if r["ds"] > 1]
    assert rest == [None, None]
    assert [r["y_hat"] for r in knn.knn_regression(train.limit(0), test, ["a", "b"], (3,)).collect()] == [None] * 4
    assert knn.knn_regression(train, test.limit(0), ["a", "b"], (3,)).collect() == []


def test_a_query_visits_few_cells(spark):
    """Separate clusters: every query needs cells of its own cluster only."""
    rng = np.random.default_rng(2)
    centres = rng.permutation(20)[:, None] * 100.0 * np.ones(2)
    pivots = centres + rng.normal(size=(20, 2))
    nearest = [np.sort(rng.uniform(0, 1, 5)) for _ in range(20)]
    queries = spark.createDataFrame([(i, 0, (centres[i] + 0.5).tolist()) for i in range(20)], "_q long, _b long, _x array<double>")
    rows = knn._visits(queries, pivots, nearest, np.full(20, 2.0), 5).collect()
    assert sorted((r["_q"], r["_cell"]) for r in rows) == [(i, i) for i in range(20)]
