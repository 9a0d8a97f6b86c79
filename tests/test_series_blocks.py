"""The block/halo plans must equal an unsplit per-series window for any block size."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chronoweave.operators import fill, windows
from chronoweave.plans.series import POS, carry_last, decay_scan, halo_window, prefix_sums, with_positions


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(7)
    rows = []
    for sid, n in (("a", 173), ("b", 61), ("c", 5)):
        ds = pd.date_range("2020-01-01", periods=n, freq="D")
        y = rng.normal(10, 3, n).round(3)
        mask = rng.random(n) < 0.2
        for d, v, m in zip(ds, y, mask):
            rows.append((sid, d.to_pydatetime(), None if m else float(v), float(v)))
    return spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, yn double, y double")


def _pd(df, cols):
    return df.select("unique_id", "ds", *cols).toPandas().sort_values(["unique_id", "ds"]).reset_index(drop=True)


def test_positions_dense(panel):
    p = _pd(with_positions(panel, bucket_days=7), [POS])
    for _, g in p.groupby("unique_id"):
        assert list(g[POS]) == list(range(len(g)))


@pytest.mark.parametrize("block", [4, 10, 1 << 20])
def test_halo_matches_plain_window(panel, block):
    x = with_positions(panel, bucket_days=9)
    got = halo_window(x, 3, 2, lambda w: {"lag3": F.lag("y", 3).over(w),
                                          "cm": F.avg("y").over(w.rowsBetween(-3, 2))}, block_rows=block)
    w = Window.partitionBy("unique_id").orderBy("ds")
    ref = panel.withColumns({"lag3": F.lag("y", 3).over(w), "cm": F.avg("y").over(w.rowsBetween(-3, 2))})
    a, b = _pd(got, ["lag3", "cm"]), _pd(ref, ["lag3", "cm"])
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-12)


@pytest.mark.parametrize("block", [3, 16, 1 << 20])
def test_decay_scan_matches_numpy(panel, block):
    x = with_positions(panel)
    got = _pd(decay_scan(x, {"s1": (F.col("y"), 0.9), "s2": (F.col("y"), 0.3)}, block_rows=block), ["y", "s1", "s2"])
    for _, g in got.groupby("unique_id"):
        for col, b in (("s1", 0.9), ("s2", 0.3)):
            acc, ref = 0.0, []
            for v in g["y"]:
                acc = acc * b + v
                ref.append(acc)
            np.testing.assert_allclose(g[col].to_numpy(), ref, rtol=1e-10)


@pytest.mark.parametrize("block", [3, 1 << 20])
def test_carry_and_prefix(panel, block):
    x = with_positions(panel)
    f = _pd(carry_last(x, "yn", "ff", True, block_rows=block), ["yn", "ff"])
    b = _pd(carry_last(x, "yn", "bf", False, block_rows=block), ["yn", "bf"])
    s = _pd(prefix_sums(x, {"cs": F.col("y")}, block_rows=block, lag=2), ["y", "cs"])
    for (_, gf), (_, gb), (_, gs) in zip(f.groupby("unique_id"), b.groupby("unique_id"), s.groupby("unique_id")):
        pd.testing.assert_series_equal(gf["ff"], gf["yn"].ffill(), check_names=False)
        pd.testing.assert_series_equal(gb["bf"], gb["yn"].bfill(), check_names=False)
        ref = gs["y"].cumsum().shift(2)
        np.testing.assert_allclose(gs["cs"].to_numpy(dtype=float), ref.to_numpy(dtype=float), rtol=1e-12)


def test_ewm_matches_pandas(panel):
    got = _pd(windows.augment_ewm(panel, "y", [0.1, 0.5], block_rows=5), ["y", "y_ewm_mean_alpha_0_1", "y_ewm_mean_alpha_0_5"])
    for _, g in got.groupby("unique_id"):
        np.testing.assert_allclose(g["y_ewm_mean_alpha_0_1"], g["y"].ewm(alpha=0.1, adjust=True).mean(), rtol=1e-10)
        np.testing.assert_allclose(g["y_ewm_mean_alpha_0_5"], g["y"].ewm(alpha=0.5, adjust=True).mean(), rtol=1e-10)


def test_interpolate_matches_pandas(panel):
    got = _pd(fill.interpolate_linear(panel.select("unique_id", "ds", F.col("yn").alias("y")), "y", block_rows=4), ["y"])
    src = _pd(panel, ["yn"])
    for (_, g), (_, s) in zip(got.groupby("unique_id"), src.groupby("unique_id")):
        np.testing.assert_allclose(g["y"].to_numpy(dtype=float), s["yn"].interpolate().to_numpy(dtype=float), rtol=1e-12)


def test_ses3_fixture(spark):
    df = spark.createDataFrame([("s", f"2024-01-0{i+1}", v) for i, v in enumerate([1.0, 2.0, 4.0])],
                               "unique_id string, ds string, y double").withColumn("ds", F.col("ds").cast("timestamp_ntz"))
    x = windows.augment_ewm(df, "y", [0.1]).orderBy("ds").collect()
    assert abs(x[-1]["y_ewm_mean_alpha_0_1"] - 2.439114391143911) < 1e-12


@pytest.mark.parametrize("block", [3, 1 << 20])
def test_forward_scan_matches_pandas(panel, block):
    from chronoweave.plans.series import forward_scan
    x = with_positions(panel)
    got = _pd(forward_scan(x, last={"prev": "yn"}, sums={"cs": F.col("y")}, block_rows=block), ["yn", "y", "prev", "cs"])
    for _, g in got.groupby("unique_id"):
        np.testing.assert_allclose(g["prev"].to_numpy(dtype=float), g["yn"].ffill().shift(1).to_numpy(dtype=float), equal_nan=True)
        np.testing.assert_allclose(g["cs"].to_numpy(dtype=float), g["y"].cumsum().to_numpy(dtype=float), rtol=1e-12)
