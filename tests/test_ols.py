import numpy as np
import pytest

from chronoweave.operators import diagnostics
from chronoweave.plans import ols


def test_stacked_solves_equal_numpy(spark):
    rng = np.random.default_rng(0)
    rows = []
    for s in range(7):
        x = rng.normal(size=(40, 2))
        y = s + x @ [2.0, -s] + rng.normal(0, 0.1, 40)
        rows += [(f"s{s}", *map(float, r), float(v)) for r, v in zip(x, y)]
    rows += [("singular", 1.0, 2.0, 3.0)] * 5 + [("gap", None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "unique_id string, a double, b double, y double").repartition(3)
    coefs, design = ols.fit_ols(df, ["unique_id"], ["a", "b"], "y")
    got = {r["unique_id"]: r for r in coefs.collect()}
    assert design == ["_one", "a", "b"] and set(got) == {f"s{s}" for s in range(7)} | {"singular"}
    for s in range(7):
        part = np.array([r[1:] for r in rows if r[0] == f"s{s}"])
        z = np.c_[np.ones(40), part[:, :2]]
        want = np.linalg.lstsq(z, part[:, 2], rcond=None)[0]
        assert got[f"s{s}"]["coef"] == pytest.approx(want.tolist(), abs=1e-9) and got[f"s{s}"]["n"] == 40
        assert got[f"s{s}"]["sse"] == pytest.approx(float(((part[:, 2] - z @ want) ** 2).sum()), rel=1e-6)
    assert got["singular"]["coef"] is None and got["singular"]["sse"] is None
    pred = ols.predict(df.where("unique_id = 's1'"), coefs, ["unique_id"], design).first()
    assert pred["y_hat"] == pytest.approx(got["s1"]["coef"][0] + got["s1"]["coef"][1] * pred["a"] + got["s1"]["coef"][2] * pred["b"])


def test_partial_autocorrelations_solve_yule_walker(spark):
    rng = np.random.default_rng(1)
    acf = {k: np.r_[1.0, np.sort(rng.uniform(-0.5, 0.6, 5))[::-1]] for k in ("a", "b", "c")}
    rows = [(k, i, float(v)) for k, r in acf.items() for i, v in enumerate(r)]
    got = diagnostics.pacf(spark.createDataFrame(rows, "unique_id string, lag int, acf double").repartition(4)).collect()
    for k, r in acf.items():
        mine = {x["lag"]: x["pacf"] for x in got if x["unique_id"] == k}
        assert len(mine) == 6 and mine[0] == 1.0
        for p in range(1, 6):
            toeplitz = np.array([[r[abs(i - j)] for j in range(p)] for i in range(p)])
            assert mine[p] == pytest.approx(np.linalg.solve(toeplitz, r[1:p + 1])[-1], abs=2e-6)
