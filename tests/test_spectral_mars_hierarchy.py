import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoweave.operators import hierarchy, mars, smoothing, spectral


def panel(spark, series, unit="DAY"):
    rows = [(k, i, None if v is None else float(v)) for k, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "unique_id string, i int, y double").select(
        "unique_id", F.timestamp_add(unit, F.col("i"), F.lit("2020-01-01").cast("timestamp_ntz")).alias("ds"), "y")


# ---- spectrum and wavelets ----------------------------------------------------------------------


def welch(y, length):
    n = min(length, 2 ** int(math.log2(len(y))))
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)
    total, count = np.zeros(n // 2), 0
    for s in range(0, len(y) - n + 1, n // 2):
        part = np.array(y[s:s + n])
        total += np.abs(np.fft.rfft((part - part.mean()) * window)[1:]) ** 2
        count += 1
    p = total / total.sum()
    return count, -(p[p > 0] * np.log(p[p > 0])).sum() / math.log(len(p)), n / (int(total.argmax()) + 1)


def test_spectral_features_equal_numpy(spark):
    rng = np.random.default_rng(0)
    t = np.arange(1000)
    data = {"noise": rng.normal(size=1000), "cycle": np.sin(2 * np.pi * t / 16), "short": rng.normal(size=50), "tiny": [1.0, 2.0], "const": np.ones(100)}
    got = {r["unique_id"]: r for r in spectral.spectral_features(panel(spark, data), length=64, freq="D", block_rows=100).collect()}
    for k in ("noise", "cycle", "short"):
        assert (got[k]["segments"], got[k]["spectral_entropy"], got[k]["dominant_period"]) == pytest.approx(welch(data[k], 64), abs=2e-6)
    assert got["noise"]["spectral_entropy"] > 0.9 > 0.4 > got["cycle"]["spectral_entropy"] and got["cycle"]["dominant_period"] == 16.0
    assert got["tiny"]["spectral_entropy"] is None and got["const"]["spectral_entropy"] is None and len(got) == 5


def test_bump_wavelet_equals_one_transform_of_the_series(spark):
    rng = np.random.default_rng(1)
    y = rng.normal(size=1500)
    got = spectral.augment_bump_wavelet(panel(spark, {"a": y, "b": [1.0, None, 2.0]}), scales=(2, 5), freq="D", block_rows=900, digits=None).orderBy("unique_id", "ds").collect()
    size = 1 << 14
    w = 2 * np.pi * np.fft.fftfreq(size)
    for s in (2, 5):
        u = (s * w - 5) / 0.6
        hat = np.where(np.abs(u) < 1, np.exp(1 - 1 / np.maximum(1 - u ** 2, 1e-12)), 0) * math.sqrt(s)
        want = np.fft.ifft(np.fft.fft(y, size) * hat)[:1500]
        rows = [r for r in got if r["unique_id"] == "a"]
        peak = np.abs(want).max()
        assert np.abs(np.array([r[f"y_bump_{s}_real"] for r in rows]) - want.real).max() < 1e-4 * peak
        assert np.abs(np.array([r[f"y_bump_{s}_abs"] for r in rows]) - np.abs(want)).max() < 1e-4 * peak
    assert len(got) == 1503


# ---- MARS -----------------------------------------------------------------------------------------


def forward(x, y, knots, max_terms, degree, least):
    """All pairs tried by full least squares, one after the other."""
    col = lambda t: np.prod([np.maximum(s * (x[:, f] - k), 0) for f, k, s in t], axis=0) if t else np.ones(len(x))
    fit = lambda ts: float(((y - (b := np.column_stack([col(t) for t in ts])) @ np.linalg.lstsq(b, y, rcond=None)[0]) ** 2).sum())
    terms, total = [()], float((y ** 2).sum())
    while len(terms) + 2 <= max_terms:
        base, best = fit(terms), None
        for parent in terms:
            if len(parent) < degree:
                for f in range(x.shape[1]):
                    if f not in {h[0] for h in parent}:
                        for k in knots[f]:
                            pair = [(*parent, (f, k, 1)), (*parent, (f, k, -1))]
                            gain = base - fit([*terms, *pair])
                            if best is None or gain > best[0] * (1 + 1e-9):
                                best = (gain, pair)
        if best is None or best[0] < least * total:
            break
        for t in best[1]:
            b, c = np.column_stack([col(t) for t in terms]), col(t)
            if ((c - b @ np.linalg.lstsq(b, c, rcond=None)[0]) ** 2).sum() > 1e-9 * (c ** 2).sum():
                terms.append(t)
    return terms, fit


@pytest.mark.parametrize("degree", [1, 2])
def test_mars_equals_full_search(spark, degree):
    rng = np.random.default_rng(2)
    x = rng.uniform(-1, 1, size=(300, 3))
    y = 2 * np.maximum(x[:, 0] - 0.2, 0) - 3 * np.maximum(-0.3 - x[:, 1], 0) + (x[:, 0] * np.maximum(x[:, 2], 0) if degree == 2 else 0) + rng.normal(0, 0.05, 300)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)] + [(None, 0.0, 0.0, 1.0), (0.0, float("nan"), 0.0, 1.0)], "a double, b double, c double, y double")
    m = mars.fit_mars(df, ["a", "b", "c"], max_terms=7, degree=degree, knots=5)
    z = (x - x.mean(0)) / x.std(0)
    knots = [sorted(set(((np.array(df.where("a is not null and not isnan(b)").selectExpr(f"percentile_approx({c}, array({','.join(str((j + 1) / 6) for j in range(5))}), 10000)").first()[0])
                          - x[:, i].mean()) / x[:, i].std()).tolist())) for i, c in enumerate("abc")]
    terms, fit = forward(z, y - y.mean(), knots, 7, degree, 1e-3)
    pen = 2.0 if degree == 1 else 3.0
    keep, best = list(terms), None
    while True:
        score = mars.gcv(fit(keep), 300, len(keep), pen)
        best = (score, list(keep)) if best is None or score <= best[0] else best
        if len(keep) == 1:
            break
        keep = min(([t for t in keep if t != d] for d in keep[1:]), key=fit)
    approx = lambda ts: sorted((tuple((f, round(k, 9), s) for f, k, s in t)) for t in ts)
    assert m.rows == 300 and approx(m.terms) == approx(best[1])
    assert m.gcv == pytest.approx(best[0], rel=1e-6) and m.rss == pytest.approx(fit(best[1]), rel=1e-6)
    pred = [r["p"] for r in df.limit(300).select(m.column().alias("p")).collect()]
    assert float(((np.array(pred) - y) ** 2).sum()) == pytest.approx(m.rss, rel=1e-6)
    assert m.table()[0][0] == "(intercept)"


def test_mars_odd_inputs(spark):
    df = spark.createDataFrame([(1.0, 5.0)] * 10, "a double, y double")
    m = mars.fit_mars(df, ["a"])
    assert m.terms == [()] and m.coef.tolist() == pytest.approx([5.0])
    assert mars.fit_mars(df.limit(0), ["a"]) is None


# ---- temporal hierarchy ------------------------------------------------------------------------------


def ses(y, a=0.3):
    s = y[0]
    for v in y[1:]:
        s = a * v + (1 - a) * s
    return s


def test_hierarchy_equals_matrices_and_is_coherent(spark):
    rng = np.random.default_rng(3)
    data = {"a": rng.normal(100, 10, 50), "b": rng.normal(5, 1, 24), "s": [1.0, 2.0, 4.0]}
    model = lambda p, h, freq, id_cols: smoothing.ses(p, h, 0.3, freq, id_cols)
    df = panel(spark, data, "MONTH")
    rows = hierarchy.temporal_hierarchy(df, 14, model, 12, "M").orderBy("unique_id", "ds").collect()
    s, nodes = hierarchy.summing_matrix(12)
    assert len(nodes) == 28
    for k in ("a", "b"):
        y = np.array(data[k])
        y = y[len(y) - len(y) // 12 * 12:]
        base = np.array([ses(y.reshape(-1, n).sum(axis=1)) for n, _ in nodes])
        w = np.diag([1 / n for n, _ in nodes])
        want = np.linalg.inv(s.T @ w @ s) @ s.T @ w @ base
        got = [r["y_hat"] for r in rows if r["unique_id"] == k]
        assert got == pytest.approx(np.r_[want, want[:2]].tolist(), rel=1e-9)
    assert [r["y_hat"] for r in rows if r["unique_id"] == "s"] == pytest.approx([ses(data["s"])] * 14)
    up = hierarchy.temporal_hierarchy(df, 12, model, 12, "M", all_levels=True).collect()
    value = {(r["unique_id"], r["k"], r["step"]): r["y_hat"] for r in up}
    for (i, k, j), v in value.items():
        assert v == pytest.approx(sum(value[i, 1, t] for t in range(j * k, (j + 1) * k)), abs=1e-9)
    assert rows[0]["ds"].isoformat().startswith("2024-03-01")
