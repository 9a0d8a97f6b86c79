"""Queries for lags, differences, rolling and exponentially weighted features."""

from pyspark.sql import functions as F

from chronoweave.operators import timegrid, windows
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.registry import register
from chronoweave.plans.series import POS, regular_positions
from chronoweave.operators.windows import tag
from chronoweave.plans.sqlpanels import ORDERS_DAILY, cte, padded
from chronoweave.sources import panels

W = "over (partition by unique_id order by ds)"


def padded_daily(spark, sf):
    return timegrid.pad_by_time(panels.orders_daily(spark, sf).select(ID, DS, Y), "D", fill={Y: 0.0})


def frame(lo: str, hi: str) -> str:
    return f"over (partition by unique_id order by ds rows between {lo} and {hi})"


P = cte(p=padded(ORDERS_DAILY))


@register("F01_lags", P + f"""
select unique_id, ds, y, lag(y, 1) {W} as y_lag_1, lag(y, 7) {W} as y_lag_7, lag(y, 14) {W} as y_lag_14 from p""",
          ids=("F01",))
def f01(spark, sf):
    return windows.augment_lags(padded_daily(spark, sf), Y, [1, 7, 14], freq="D")


@register("F02_diffs", P + f"""
select unique_id, ds, y, y - lag(y, 1) {W} as y_diff_1, y - lag(y, 2) {W} as y_diff_2 from p""", ids=("F02",))
def f02(spark, sf):
    return windows.augment_diffs(padded_daily(spark, sf), Y, [1, 2], freq="D")


@register("F03_pct_change", P + f"""
select unique_id, ds, y, round(y / nullif(lag(y, 1) {W}, 0) - 1, 6) as y_pctchg_1,
       round(y / nullif(lag(y, 7) {W}, 0) - 1, 6) as y_pctchg_7 from p""", ids=("F03",))
def f03(spark, sf):
    x = windows.augment_pct_change(padded_daily(spark, sf), Y, [1, 7], freq="D")
    return x.withColumns({c: F.round(c, 6) for c in ("y_pctchg_1", "y_pctchg_7")})


def _roll_sql(fn: str, w: int, lo: str, hi: str, name: str, guard: bool = True) -> str:
    v = f"{fn}(y) {frame(lo, hi)}"
    if guard:
        v = f"case when count(*) {frame(lo, hi)} = {w} then {v} end"
    return f"round({v}, 6) as {name}"


@register("F04_rolling_trailing", P + "select unique_id, ds, y, " + ", ".join([
    _roll_sql("avg", 7, "6 preceding", "current row", "y_rolling_mean_win_7"),
    _roll_sql("sum", 7, "6 preceding", "current row", "y_rolling_sum_win_7"),
    _roll_sql("avg", 14, "13 preceding", "current row", "y_rolling_mean_win_14"),
    _roll_sql("sum", 14, "13 preceding", "current row", "y_rolling_sum_win_14"),
]) + " from p", ids=("F04",))
def f04(spark, sf):
    return windows.augment_rolling(padded_daily(spark, sf), Y, [7, 14], ["mean", "sum"], freq="D", digits=6)


@register("F05_rolling_centered", P + "select unique_id, ds, y, " + ", ".join([
    _roll_sql("avg", 4, "2 preceding", "1 following", "y_rolling_mean_win_4"),
    _roll_sql("stddev_samp", 4, "2 preceding", "1 following", "y_rolling_std_win_4"),
    _roll_sql("max", 4, "2 preceding", "1 following", "y_rolling_max_win_4"),
    _roll_sql("avg", 7, "3 preceding", "3 following", "y_rolling_mean_win_7"),
    _roll_sql("stddev_samp", 7, "3 preceding", "3 following", "y_rolling_std_win_7"),
    _roll_sql("max", 7, "3 preceding", "3 following", "y_rolling_max_win_7"),
]) + " from p", ids=("F05",))
def f05(spark, sf):
    return windows.augment_rolling(padded_daily(spark, sf), Y, [4, 7], ["mean", "std", "max"], center=True, freq="D", digits=6)


@register("F06_rolling_centered_partial", P + "select unique_id, ds, y, " + ", ".join([
    _roll_sql("avg", 7, "3 preceding", "3 following", "y_rolling_mean_win_7", guard=False),
    _roll_sql("median", 7, "3 preceding", "3 following", "y_rolling_median_win_7", guard=False),
]) + " from p", ids=("F06",))
def f06(spark, sf):
    return windows.augment_rolling(padded_daily(spark, sf), Y, 7, ["mean", "median"], center=True, partial=True, freq="D", digits=6)


@register("F07_rolling_user_function", P + f"""
select unique_id, ds, y, case when count(*) {frame('6 preceding', 'current row')} = 7
       then max(y) {frame('6 preceding', 'current row')} - min(y) {frame('6 preceding', 'current row')} end as y_range_7
from p""", ids=("F07", "U03"))
def f07(spark, sf):
    return windows.rolling_apply(padded_daily(spark, sf), Y, 7, lambda a: F.array_max(a) - F.array_min(a), "y_range_7", freq="D")


def _ewm_sql(a: float) -> str:
    b = 1.0 - a
    num = f"list_reduce(list(y) {frame('unbounded preceding', 'current row')}, lambda acc, v: acc * {b!r} + v)"
    den = f"((1 - pow({b!r}, row_number() {W})) / {a!r})"
    return f"round({num} / {den}, 6) as y_ewm_mean_alpha_{tag(a)}"


@register("F08_ewm_adjusted", P + "select unique_id, ds, y, " + ", ".join(_ewm_sql(a) for a in (0.1, 0.2, 0.3)) + " from p",
          ids=("F08",))
def f08(spark, sf):
    return windows.augment_ewm(padded_daily(spark, sf), Y, [0.1, 0.2, 0.3], freq="D", digits=6)


@register("F09_lag_transforms", P + f""",
l as (select *, list_reduce(list(y) {frame('unbounded preceding', 'current row')}, lambda acc, v: acc * 0.5 + 0.5 * v) as lvl from p)
select unique_id, ds, y,
  round(case when count(*) {frame('13 preceding', '7 preceding')} = 7 then avg(y) {frame('13 preceding', '7 preceding')} end, 6)
     as rolling_mean_lag7_window_size7,
  round(case when count(*) {frame('34 preceding', '7 preceding')} = 28 then avg(y) {frame('34 preceding', '7 preceding')} end, 6)
     as rolling_mean_lag7_window_size28,
  round(avg(y) {frame('unbounded preceding', '7 preceding')}, 6) as expanding_mean_lag7,
  round(lag(lvl, 7) {W}, 6) as exponentially_weighted_mean_lag7_alpha0_5
from l""",
          ids=("F09", "H14"))
def f09(spark, sf):
    return windows.lag_transforms(padded_daily(spark, sf), Y, 7, rolling=[7, 28], expanding=True, ewm_alphas=[0.5], freq="D", digits=6)


@register("F10_rolling_on_horizon_safe_lag", P + f""",
l as (select *, lag(y, 56) {W} as y_lag_56 from p)
select unique_id, ds, y, y_lag_56,
  round(case when count(y_lag_56) {frame('6 preceding', 'current row')} = 7 then avg(y_lag_56) {frame('6 preceding', 'current row')} end, 6)
     as y_lag_56_rolling_mean_win_7,
  round(case when count(y_lag_56) {frame('27 preceding', 'current row')} = 28 then avg(y_lag_56) {frame('27 preceding', 'current row')} end, 6)
     as y_lag_56_rolling_mean_win_28
from l""", ids=("F10", "O03"))
def f10(spark, sf):
    # positions once, shared by both window passes
    x = regular_positions(padded_daily(spark, sf), "D")
    x = windows.augment_lags(x, Y, [56])
    return windows.augment_rolling(x, "y_lag_56", [7, 28], "mean", digits=6).drop(POS)


@register("F12_top_n_per_series", P + """
select unique_id, ds, y from (select *, rank() over (partition by unique_id order by y desc) as r from p) where r <= 3""",
          ids=("F12",))
def f12(spark, sf):
    return windows.top_n(padded_daily(spark, sf), [ID], F.col(Y).desc(), 3)


@register("F13_row_index", P + f"""
select unique_id, ds, y, row_number() {W} as row_index from p""", ids=("F13",))
def f13(spark, sf):
    return windows.row_index(padded_daily(spark, sf), freq="D")
