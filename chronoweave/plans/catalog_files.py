"""Queries for file sources and sinks (A01, A04, A05): each writes files into the shared folder and reads them back."""

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from chronoweave.functions.timekeys import add_steps, steps_between
from chronoweave.operators.reshape import pivot_wider
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.catalog_models import padded_daily
from chronoweave.plans.registry import register
from chronoweave.plans.sqlpanels import NATION_MONTHLY, ORDERS_DAILY, cte, padded
from chronoweave.session import ensure_checkpoint_dir
from chronoweave.sources import files, panels
from chronoweave.sources.tables import read_table


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/files/{uuid.uuid4().hex}"


@register("A01_csv_events", """
select event_id as id, date_trunc('second', ts) as event_date, event_type, value from events""", ids=("A01", "A05"))
def a01(spark, sf):
    """Events written as CSV and scanned with an explicit schema and timestamp format."""
    path = _folder(spark)
    e = read_table(spark, sf, "events")
    files.write_csv(e.select(F.col("event_id").alias("id"), F.col("ts").alias("event_date"), "event_type", "value"), path)
    return files.read_events(spark, path, "id bigint, event_date timestamp_ntz, event_type string, value double")


@register("A01_csv_hour_key", """
select strptime(strftime(date_trunc('hour', ts), '%Y%m%d%H'), '%Y%m%d%H') as ds, event_type as unique_id, count(*) as y from events group by 1, 2""",
          ids=("A01", "A02"))
def a01h(spark, sf):
    """An hourly feed whose time key is the text yyyyMMddHH."""
    path = _folder(spark)
    h = panels.events_hourly(spark, sf).select(F.date_format(DS, "yyyyMMddHH").alias("dateHour"), ID, F.col(Y).cast("long").alias(Y))
    files.write_csv(h, path)
    raw = files.read_events(spark, path, "dateHour string, unique_id string, y bigint")
    return raw.select(F.to_timestamp_ntz("dateHour", F.lit("yyyyMMddHH")).alias(DS), ID, Y)


@register("A04_wide_train_test_files", cte(n=NATION_MONTHLY) + """,
m as (select unique_id, ds, y, datediff('month', min(ds) over (partition by unique_id), ds) + 1 as i,
        datediff('month', min(ds) over (partition by unique_id), max(ds) over (partition by unique_id)) + 1 as n from n)
select unique_id, ds, round(y, 4) as y, case when i <= n - 6 then 'train' else 'test' end as type, 'Monthly' as period from m""", ids=("A04", "B05", "C05", "B10"))
def a04(spark, sf):
    """Ragged wide train and test files (V1 the id, V2 .. the values), each in two parts with different
    columns, bound by name, melted, and put on one calendar."""
    n = panels.nation_monthly(spark, sf).select(ID, DS, F.round(Y, 4).alias(Y))
    edge = n.groupBy(ID).agg(F.min(DS).alias("start_date"), F.max(DS).alias("last"))
    x = n.join(edge, ID).withColumns({"i": steps_between(F.col("start_date"), F.col(DS), "M") + 1,
                                      "n": steps_between(F.col("start_date"), F.col("last"), "M") + 1})
    longest = x.agg(F.max("n")).first()[0]
    parts: dict[str, list[str]] = {"train": [], "test": []}
    for kind, rows, width in (("train", x.where("i <= n - 6"), longest - 6), ("test", x.where("i > n - 6").withColumn("i", F.expr("i - n + 6")), 6)):
        for odd in (0, 1):
            part = rows.where(F.pmod(F.crc32(F.col(ID).cast("binary")), F.lit(2)) == odd).withColumn("col", F.concat(F.lit("V"), (F.col("i") + 1).cast("string")))
            cols = [f"V{j + 2}" for j in range(width)]
            path = _folder(spark)
            files.write_csv(pivot_wider(part, [ID], "col", Y, cols).withColumnRenamed(ID, "V1"), path)
            parts[kind].append(path)
    wide = {k: files.read_wide_files(spark, v, header=True, inferSchema=False) for k, v in parts.items()}
    info = edge.select(ID, "start_date", F.lit("Monthly").alias("period"))
    return files.train_test_long(files.wide_to_long(wide["train"]), files.wide_to_long(wide["test"]), info,
                                 {"Monthly": add_steps(F.col("start_date"), F.col("position") - 1, "M")})


@register("A05_feature_artifacts_roundtrip", cte(p=padded(ORDERS_DAILY)) + """,
s as (select unique_id, avg(y) as m, stddev_pop(y) as sd from p group by 1)
select unique_id, ds, round((y - m) / sd, 6) as y_std, round(y, 6) as y, 'lag,spline' as sets from p join s using (unique_id)""", ids=("A05", "E07"))
def a05(spark, sf):
    """Prepared data, transform parameters and feature sets saved, loaded, and used to invert the transform."""
    path = _folder(spark)
    p = padded_daily(spark, sf)
    params = p.groupBy(ID).agg(F.avg(Y).alias("mean_x"), F.stddev_pop(Y).alias("stdev_x"))
    prepared = p.join(params, ID).select(ID, DS, F.try_divide(F.col(Y) - F.col("mean_x"), F.col("stdev_x")).alias("y_std"))
    files.save_artifacts(spark, path, files.Artifacts({"data_prep": prepared, "transform_params": params}, {"feature_sets": {"spline": ["ds"], "lag": ["y_lag_56"]}}))
    back = files.load_artifacts(spark, path)
    sets = ",".join(sorted(back.params["feature_sets"]))
    return back.tables["data_prep"].join(back.tables["transform_params"], ID).select(
        ID, DS, F.round("y_std", 6).alias("y_std"), F.round(F.col("y_std") * F.col("stdev_x") + F.col("mean_x"), 6).alias(Y), F.lit(sets).alias("sets"))


@register("A05_model_roundtrip", cte(p=padded(ORDERS_DAILY)) + """,
t as (select *, datediff('day', timestamp '1995-01-01', ds)::double as t from p)
select unique_id, ds, round((select regr_intercept(y, t) from t) + (select regr_slope(y, t) from t) * t, 6) as y_hat from t""", ids=("A05",))
def a05m(spark, sf):
    """A fitted pipeline saved, loaded and applied."""
    path = _folder(spark)
    x = padded_daily(spark, sf).withColumn("t", F.datediff(DS, F.lit("1995-01-01").cast("date")).cast("double"))
    model = Pipeline(stages=[VectorAssembler(inputCols=["t"], outputCol="features"),
                             LinearRegression(labelCol=Y, solver="normal", predictionCol="y_hat")]).fit(x)
    files.save_artifacts(spark, path, files.Artifacts(models={"trend": model}))
    return files.load_artifacts(spark, path).models["trend"].transform(x).select(ID, DS, F.round("y_hat", 6).alias("y_hat"))
