import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoweave.operators import neighbours
from chronoweave.plans.blocks import fold_blocks, gather, ordered_ranks


def panel(spark, series):
    rows = [(k, i, v) for k, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "unique_id string, i int, y double").select(
        "unique_id", F.timestamp_add("DAY", F.col("i"), F.lit("2020-01-01").cast("timestamp_ntz")).alias("ds"), "y")


def gaps_brute(y, k, alpha=0.05, p=0.05):
    n = len(y)
    width = max(y) - min(y) or 1.0
    score = []
    for i in range(n):
        d = [0.0] + sorted(abs(y[j] - y[i]) for j in range(n) if j != i)[:k]
        steps = [b - a for a, b in zip(d, d[1:])]
        score.append(d[int(np.argmax(steps)) + 1] / width if steps else 0.0)
    order = sorted(score)
    gap = [0.0] + [b - a for a, b in zip(order, order[1:])]
    tail = max(min(math.floor(0.15 * min(n, 5000)), n // 4), 2)
    for i in range(max(math.floor(n * (1 - p)), 1) + 1, n + 1):
        mean = sum(j / (tail - 1) * gap[i - j] for j in range(2, tail + 1) if i - j >= 0)
        if gap[i - 1] > math.log(1 / alpha) * mean:
            return score, [int(s > order[i - 2]) for s in score]
    return score, [0] * n


def check_gaps(spark, series, k, **kw):
    got = {(r["unique_id"], r["ds"].toordinal()): r for r in neighbours.neighbour_gaps(panel(spark, series), k=k, **kw).collect()}
    start = min(d for _, d in got)
    assert len(got) == sum(map(len, series.values()))
    for name, y in series.items():
        seen = [i for i, v in enumerate(y) if v is not None]
        if len(seen) < 2:
            continue
        kk = min(k if k else max(1, math.floor(0.1 * len(seen))), len(seen) - 1)
        score, flag = gaps_brute([y[i] for i in seen], kk)
        assert [got[name, start + i]["nn_score"] for i in seen] == pytest.approx(score, abs=1e-12)
        assert [got[name, start + i]["anomaly_nn"] for i in seen] == flag
    return got


def test_gap_scores_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    spiky = rng.normal(size=300)
    spiky[[7, 90]] = 15.0, 16.0
    series = {"a": spiky.tolist(), "b": rng.integers(0, 6, 200).astype(float).tolist(), "c": [1.0] * 20, "d": [3.0, None, 4.0], "e": [2.0],
              "f": rng.exponential(size=90).tolist()}
    for k in (1, 10, None):
        got = check_gaps(spark, series, k)
    assert any(r["anomaly_nn"] for r in got.values())
    check_gaps(spark, series, 10, block_rows=16)  # many blocks, halos across edges
    # a group of close outliers is found with k above its size
    flags = {i for (n, _), r in check_gaps(spark, {"a": series["a"]}, 10).items() if r["anomaly_nn"] for i in [r["y"]]}
    assert flags == {15.0, 16.0}


def test_gaps_of_odd_rows(spark):
    rows = neighbours.neighbour_gaps(panel(spark, {"a": [None, float("nan"), 1.0, 1.0]}), k=2).orderBy("ds").collect()
    assert [(r["nn_score"], r["anomaly_nn"]) for r in rows] == [(None, 0), (None, 0), (0.0, 0), (0.0, 0)]
    assert neighbours.neighbour_gaps(panel(spark, {"a": [1.0]}).limit(0), k=2).collect() == []


def conformal_brute(y, n, lags, k, threshold, quiet):
    """Row by row with growing lists, as an online detector would."""
    score, out, flag, last = {}, [], [], -math.inf
    metric = None
    for t in range(len(y)):
        if n <= lags or t < n:
            out.append(0.0)
            flag.append(0)
            continue
        ends = range(lags - 1, n) if t < 2 * n else range(t - 2 * n + lags, t - n + 1)
        train = np.array([y[s - lags + 1:s + 1] for s in ends])
        if t % n == 0:
            metric = np.linalg.pinv(train.T @ train / len(train), rcond=1e-12, hermitian=True)
        d = train - np.array(y[t - lags + 1:t + 1])
        dist = np.sort(np.sqrt(np.maximum(np.einsum("ij,jk,ik->i", d, metric, d), 0)))
        score[t] = dist[:k].sum()
        past = [score[s] for s in range(max(n, t - n), t)]
        r = float(np.mean([s < score[t] for s in past])) if past else 0.0
        f = int(r >= threshold and (not quiet or t - last > n // 5))
        last = t if f else last
        out.append(r)
        flag.append(f)
    return out, flag


@pytest.mark.parametrize("quiet", [True, False])
def test_conformal_scores_equal_online_loop(spark, quiet):
    rng = np.random.default_rng(1)
    a = np.sin(np.arange(400) / 3) + rng.normal(0, 0.1, 400)
    a[[150, 333]] += 5
    series = {"a": a.tolist(), "b": rng.normal(size=130).tolist(), "c": [1.0] * 5}
    got = neighbours.conformal_neighbours(panel(spark, series), k=4, lags=5, train_rows=40, threshold=0.95, quiet=quiet, block_rows=64) \
        .orderBy("unique_id", "ds").collect()
    for name, y in series.items():
        score, flag = conformal_brute(y, 40, 5, 4, 0.95, quiet)
        rows = [r for r in got if r["unique_id"] == name]
        assert [r["knn_score"] for r in rows] == pytest.approx(score, abs=0.026)  # a tie of two scores may turn by rounding
        same = sum(abs(r["knn_score"] - s) < 1e-9 for r, s in zip(rows, score))
        assert same >= len(y) - 2 and sum(r["anomaly_knn"] == f for r, f in zip(rows, flag)) >= len(y) - 2
    spikes = [r for r in got if r["unique_id"] == "a"]
    assert spikes[150]["knn_score"] == 1.0 and spikes[333]["knn_score"] == 1.0


def test_ordered_ranks_and_weights(spark):
    rng = np.random.default_rng(2)
    rows = [(f"s{i % 3}", float(v), int(m)) for i, (v, m) in enumerate(zip(rng.permutation(500), rng.integers(1, 9, 500)))]
    df = spark.createDataFrame(rows, "unique_id string, v double, m int").repartition(7)
    got = ordered_ranks(df, ["v"], weight="m").collect()
    for s in ("s0", "s1", "s2"):
        want = sorted((v, m) for i, v, m in rows if i == s)
        mine = sorted((r["v"], r["_rank"], r["_cum"]) for r in got if r["unique_id"] == s)
        assert mine == [(v, j, sum(m for _, m in want[:j])) for j, (v, m) in enumerate(want)]


def test_fold_equals_loop(spark):
    """A recursion that forgets slowly, over blocks with gaps between them."""
    rng = np.random.default_rng(3)
    rows = [(s, int(p), float(v)) for s, size in (("a", 300), ("b", 5)) for p, v in zip(np.sort(rng.choice(900, size, replace=False)), rng.normal(size=size))]
    df = spark.createDataFrame(rows, "unique_id string, _pos long, v double")

    def fn(p, state, v, ):
        s, out = state[0], np.zeros(len(v))
        for i, x in enumerate(v):
            s = 0.97 * s + math.tanh(x * s) + 0.1
            out[i] = s
        return {"s": out}, np.array([s])
    got = {(r["unique_id"], r["_pos"]): r["s"] for r in fold_blocks(gather(df, ["v"], block_rows=32), fn, lambda: np.array([0.5]), {"s": "double"}, ["v"]).collect()}
    for name in ("a", "b"):
        s = 0.5
        for _, p, v in [r for r in rows if r[0] == name]:
            s = 0.97 * s + math.tanh(v * s) + 0.1
            assert got[name, p] == s
