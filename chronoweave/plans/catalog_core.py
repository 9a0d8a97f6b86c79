"""Flagship and end-to-end queries."""

from chronoweave.plans import flagship
from chronoweave.plans.registry import register
from chronoweave.plans.sqlpanels import ORDERS_DAILY, cte, padded

_SNAIVE_SQL = cte(
    p=padded(ORDERS_DAILY),
    lt=f"select unique_id, max(ds) as T from p group by 1",
    train="select p.* from p join lt using (unique_id) where p.ds <= lt.T - interval 56 day",
    test="select p.* from p join lt using (unique_id) where p.ds > lt.T - interval 56 day",
    tt="select unique_id, max(ds) as T from train group by 1",
    src="""select t.unique_id, 6 - datediff('day', t.ds, tt.T) as ph, t.y as v
           from train t join tt using (unique_id) where datediff('day', t.ds, tt.T) < 7""",
    fc="""select tt.unique_id, tt.T + to_days(s::int) as ds, (s - 1) % 7 as ph
          from tt cross join range(1, 57) r(s)""",
    f2="select fc.unique_id, fc.ds, 'SeasonalNaive' as model, src.v as y_hat from fc left join src using (unique_id, ph)",
) + """
select f2.unique_id, f2.model,
       round(avg(y_hat - y), 6) as bias, round(avg(abs(y_hat - y)), 6) as mae,
       round(avg(abs(y_hat - y) / case when y <> 0 then abs(y) end), 6) as mape,
       round(avg((y_hat - y) * (y_hat - y)), 6) as mse, round(sqrt(avg((y_hat - y) * (y_hat - y))), 6) as rmse
from f2 join test using (unique_id, ds) group by 1, 2"""

register("flagship_snaive_holdout", _SNAIVE_SQL, ids=("D01", "G01", "K01", "M02", "K06", "C08"))(flagship.holdout_accuracy)
