import datetime as dt
import math

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from chronoweave.streaming import hourly


def events(folder, rows):
    """``events.parquet`` of (event_id, hours after the start, type, value)."""
    start = dt.datetime(2024, 1, 1)
    pq.write_table(pa.table({"event_id": pa.array([r[0] for r in rows], pa.int64()),
                             "ts": pa.array([start + dt.timedelta(hours=r[1]) for r in rows], pa.timestamp("us")),
                             "user_id": pa.array([1] * len(rows), pa.int64()), "event_type": [r[2] for r in rows],
                             "value": pa.array([r[3] for r in rows], pa.float64()), "props": ["{}"] * len(rows)}), f"{folder}/events.parquet")
    return str(folder)


def test_all_windows_hold_all_rows(spark, tmp_path):
    rng = np.random.default_rng(0)
    rows = [(i, float(h), "ab"[i % 2], 1.0) for i, h in enumerate(np.sort(rng.uniform(0, 30, 400)))]
    folder = events(tmp_path, rows)
    run = hourly.run_stream(hourly.windowed_counts(hourly.events_stream(spark, folder)))
    assert 0 < sum(r["y"] for r in run.table.collect()) < 400 and run.late_rows == 0 and run.watermark.startswith("2024-01-02")
    got = {(r["unique_id"], r["ds"]): r["y"] for r in hourly.all_windows(spark, folder).collect()}
    want = {}
    for _, h, t, _ in rows:
        key = (t, dt.datetime(2024, 1, 1) + dt.timedelta(hours=int(h)))
        want[key] = want.get(key, 0) + 1
    assert got == want
    slid = hourly.all_windows(spark, folder, "2 hours", "1 hour").collect()
    assert len({(r["unique_id"], r["ds"]) for r in slid}) == len(slid) and sum(r["y"] for r in slid) == 800


@pytest.mark.parametrize("sizes", [(1,), (700,), (3, 300, 1, 296)])
def test_batches_equal_loop(sizes):
    rng = np.random.default_rng(1)
    x = rng.normal(size=sum(sizes))
    x[::97] += 9
    mu, var, want = x[0], 0.0, [(x[0], None, 0)]
    for v in x[1:]:
        sd = math.sqrt(var)
        want.append((0.2 * v + 0.8 * mu, abs(v - mu) / sd if sd > 0 else None, int(sd > 0 and abs(v - mu) > 3 * sd)))
        var = 0.2 * (v - mu) ** 2 + 0.8 * var
        mu = 0.2 * v + 0.8 * mu
    got, state, at = [], (math.nan, 0.0), 0
    for n in sizes:
        mean, score, flag, *state = hourly.ewma_batch(x[at:at + n], 0.2, 3.0, *state, at == 0)
        got += list(zip(mean, score, flag))
        at += n
    for g, w in zip(got, want):
        assert g[0] == pytest.approx(w[0], abs=1e-12) and g[2] == w[2]
        assert math.isnan(g[1]) if w[1] is None else g[1] == pytest.approx(w[1], rel=1e-9)


def test_stream_flags_spikes(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(i, i / 10, "ab"[i % 2], float(v)) for i, v in enumerate(rng.normal(size=200))]
    rows[150] = (150, 15.0, "a", 50.0)
    got = hourly.run_to_table(hourly.ewma_flags(hourly.events_stream(spark, events(tmp_path, rows)))).collect()
    assert len(got) == 200 and {r["event_id"]: r["anomaly_ewma"] for r in got}[150] == 1
    values = [v for _, _, t, v in rows if t == "b"]
    mean = hourly.smooth(np.array(values), 0.2, values[0])
    assert [r["ewma_mean"] for r in sorted(got, key=lambda r: r["event_id"]) if r["unique_id"] == "b"] == pytest.approx(mean.tolist(), abs=1e-12)
