"""Labels over the whole panel; intermittent demand and common grids without shuffles of the grid."""

import datetime as dt

import numpy as np
import pytest

import __spark_entry__ as entry
from chronoweave.panel import DS, ID, Y


def test_every_series_and_year_takes_part_in_its_label(spark, tmp_path):
    day = lambda y, d: dt.datetime(y, 1, d)
    rows = [("4-NOT SPECIFIED", day(1995, 1), 3), ("2-HIGH", day(1998, 1), 2), ("1-URGENT", day(1995, 1), 1), ("1-URGENT", day(1999, 2), 5),
            ("3-MEDIUM", day(1995, 1), 4), ("3-MEDIUM", day(1996, 1), 1), ("3-MEDIUM", day(1996, 2), 1), ("3-MEDIUM", day(1996, 3), 1),
            (None, day(1995, 1), 1)]
    orders = [(p, d, 1.0) for p, d, n in rows for _ in range(n)]
    spark.createDataFrame(orders, "o_orderpriority string, o_orderdate timestamp, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    got = entry.queries()["C06_labels_right_join"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    assert {(r.unique_id, r.label) for r in got} == {("4-NOT SPECIFIED", "busy"), ("2-HIGH", "busy"), ("1-URGENT", "busy"), ("3-MEDIUM", "busy"), (None, None)}


# ---- common grid --------------------------------------------------------------------

def plain_grid(rows, steps):
    keys = {r[0] for r in rows}
    out = []
    for k in keys:
        for t in steps:
            here = [r[2] for r in rows if k is not None and r[0] == k and r[1] == t]
            out += [(k, t, v) for v in (here or [None])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk", [4096, 3])
def test_common_grid_equals_a_join_and_shuffles_no_grid(spark, monkeypatch, chunk):
    from chronoweave.operators import timegrid
    monkeypatch.setattr(timegrid, "CHUNK_STEPS", chunk)
    day = lambda d: dt.datetime(2020, 1, d)
    rows = [("a", day(1), 1.0), ("a", day(4), 2.0), ("a", day(4), 3.0), ("b", day(7), None), ("c", None, 5.0), (None, day(2), 4.0), ("d", day(11), 6.0),
            ("e", dt.datetime(2020, 1, 3, 12), 7.0)]
    df = spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y double")
    out = timegrid.common_grid(df, "D")
    assert out.columns == df.columns
    assert sorted((tuple(r) for r in out.collect()), key=repr) == plain_grid(rows, [day(d) for d in range(1, 12)])
    filled = timegrid.common_grid(df, "D", fill={Y: 0.0})
    assert {r[2] for r in filled.where("unique_id = 'b'").collect()} == {0.0}
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_common_grid_of_clamped_month_ends_and_empty_panels(spark):
    from chronoweave.operators import timegrid
    ends = [dt.datetime(2020, 1, 31), dt.datetime(2020, 2, 29), dt.datetime(2020, 3, 31), dt.datetime(2020, 4, 30)]
    rows = [("a", ends[0], 1.0), ("a", ends[1], 2.0), ("a", ends[3], 3.0)]
    df = spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y double")
    assert sorted((tuple(r) for r in timegrid.common_grid(df, "M").collect()), key=repr) == plain_grid(rows, ends)
    assert timegrid.common_grid(df.where("y > 9"), "M").count() == 0


# ---- intermittent demand ------------------------------------------------------------

def demand_panel(spark, n=90):
    rng = np.random.default_rng(7)
    start = dt.datetime(2020, 1, 1)
    rows = []
    for s, share in enumerate([0.05, 0.1, 0.3, 0.6, 1.0, 0.02, 0.15]):
        y = np.where(rng.random(n) < share, rng.integers(1, 5, n), 0)
        rows += [(f"s{s}", start + dt.timedelta(days=i), float(v)) for i, v in enumerate(y)]
    rows += [("none", start + dt.timedelta(days=i), 0.0) for i in range(5)]
    rows += [("one", start + dt.timedelta(days=i), float(i == 3)) for i in range(6)]
    rows += [("gone", start + dt.timedelta(days=i), None if i % 4 else 2.0) for i in range(20)]
    rows += [(None, start + dt.timedelta(days=i), 2.0) for i in range(4)]
    return spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y double")


def table(df):
    return {(r.unique_id, r.ds): r.y_hat for r in df.collect()}


def operators():
    from chronoweave.operators import smoothing as s
    return {
        "classic": (lambda x: s.croston(x, 2), lambda x: s._croston_rows(x, 2, "classic", 0.1, "D", [ID])),
        "sba": (lambda x: s.croston(x, 2, "sba"), lambda x: s._croston_rows(x, 2, "sba", 0.1, "D", [ID])),
        "optimized": (lambda x: s.croston(x, 2, "optimized"), lambda x: s._croston_rows(x, 2, "optimized", 0.1, "D", [ID])),
        "tsb": (lambda x: s.tsb(x, 2), lambda x: s._tsb_rows(x, 2, 0.2, 0.2, "D", [ID])),
        "adida": (lambda x: s.adida(x, 2), lambda x: s._adida_rows(x, 2, "D", [ID], s.ALPHA_GRID, None, "ADIDA")),
        "imapa": (lambda x: s.imapa(x, 2), lambda x: s._imapa_rows(x, 2, "D", [ID], s.ALPHA_GRID)),
    }


@pytest.mark.parametrize("name", ["classic", "sba", "optimized", "tsb", "adida", "imapa"])
def test_packed_series_equal_row_plans(spark, name):
    from chronoweave.operators import smoothing
    x = demand_panel(spark).cache()
    packed, rows = operators()[name]
    want, got = table(rows(x)), table(packed(x))
    assert got.keys() == want.keys()
    assert all((got[k] is None and want[k] is None) or abs(got[k] - want[k]) < 1e-9 for k in want)
    # only the series with NULL values takes the row plan
    _, rest = smoothing._packed(x, [ID], "D")
    assert {r.unique_id for r in rest.select(ID).distinct().collect()} == {"gone"}


def test_series_of_several_blocks_take_row_plans(spark, monkeypatch):
    from chronoweave.operators import smoothing
    monkeypatch.setattr(smoothing, "ARRAY_ROWS", 40)
    x = demand_panel(spark).cache()
    _, rest = smoothing._packed(x, [ID], "D")
    assert {r.unique_id for r in rest.select(ID).distinct().collect()} >= {"gone", "s1"}
    for name in ("classic",):
        packed, rows = operators()[name]
        want, got = table(rows(x)), table(packed(x))
        assert got.keys() == want.keys() and all((got[k] is None and want[k] is None) or abs(got[k] - want[k]) < 1e-9 for k in want)


def test_search_over_many_blocks_of_the_scan(spark):
    """Longer than a block of the scan (100 rows at alpha 0.95): state carried into the next ones."""
    from chronoweave.operators import smoothing
    rng = np.random.default_rng(3)
    y = np.cumsum(rng.normal(0, 1, 450)) + 20
    got = smoothing._ses_search(y[:, None], np.array([450]), smoothing._search_plan(spark, smoothing.ALPHA_GRID))[0]
    best = None
    for a in smoothing.ALPHA_GRID:
        level, sse = y[0], 0.0
        for v in y[1:]:
            sse += (v - level) ** 2
            level = (1 - a) * level + a * v
        best = min(best or (np.inf, 0), (sse, level))
    assert abs(got - best[1]) < 1e-9


@pytest.mark.parametrize("name", ["tsb", "imapa"])
def test_only_demands_are_packed(spark, name, monkeypatch):
    """One packed row per series, with as many values as demands; zeros are not moved by row."""
    from chronoweave.operators import smoothing
    seen = []
    real = smoothing._packed
    monkeypatch.setattr(smoothing, "_packed", lambda *a: seen.append(real(*a)) or seen[-1])
    x = demand_panel(spark).where("unique_id <> 'gone'").cache()
    operators()[name][0](x).collect()
    (packed, rest), = seen
    assert rest is None
    sizes = {r.unique_id: (r._n, len(r._at), len(r._v)) for r in packed.collect()}
    want = {r.unique_id: (r.n, r.d, r.d) for r in x.groupBy(ID).agg({"y": "count"}).join(
        x.where("y <> 0").groupBy(ID).count(), ID, "left").selectExpr("unique_id", "`count(y)` as n", "coalesce(count, 0) as d").collect()}
    assert sizes == want
