"""File sources and sinks (A01, A04, A05): typed CSV scans, wide files, and artifacts (tables, parameters and
fitted pipelines) saved to and loaded from one folder."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS_CSV_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("event_date", T.TimestampNTZType())])


def read_events(spark: SparkSession, path: str, schema: T.StructType = EVENTS_CSV_SCHEMA,
                timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """CSV scan with an explicit schema and timestamp format (no inference pass)."""
    return (spark.read.schema(schema).option("header", True)
            .option("timestampNTZFormat", timestamp_format).option("timestampFormat", timestamp_format).csv(path))


def read_wide_files(spark: SparkSession, paths: Sequence[str], fmt: str = "csv", **options) -> DataFrame:
    """Scan several wide files and row-bind them by column name; files with fewer
    columns get NULLs (ragged M4-style tables)."""
    frames = [spark.read.format(fmt).options(**options).load(p) for p in paths]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def write_panel(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Persist a panel (Parquet by default, partitioned for pruning on read)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_csv(df: DataFrame, path: str, timestamp_format: str = "yyyy-MM-dd HH:mm:ss", mode: str = "overwrite") -> None:
    """CSV files with a header; each task writes its own file."""
    df.write.mode(mode).option("header", True).option("timestampNTZFormat", timestamp_format).option("timestampFormat", timestamp_format).csv(path)


def wide_to_long(wide: DataFrame, id_col: str = "V1", prefix: str = "V", out_id: str = "unique_id", value_col: str = "y") -> DataFrame:
    """(id, position, value) of a wide table whose columns ``prefix2`` .. hold the values of positions 1 ..; cells
    without a value (ragged series) are left out."""
    cols = [c for c in wide.columns if c != id_col and c.startswith(prefix)]
    items = [F.struct(F.lit(int(c[len(prefix):]) - 1).alias("position"), F.col(f"`{c}`").cast("double").alias(value_col)) for c in cols]
    return wide.select(F.col(id_col).cast("string").alias(out_id), F.inline(F.array(*items))).where(F.col(value_col).isNotNull())


def train_test_long(train: DataFrame, test: DataFrame, info: DataFrame, step: Mapping[str, Column], start_col: str = "start_date",
                    period_col: str = "period") -> DataFrame:
    """(unique_id, ds, y, type, period): long train and test positions on one calendar.

    Test positions go on where the series' training positions end; ``step`` gives, for every period, the time of the
    column ``position`` from ``start_col``.  Series without a row in ``info`` are left out."""
    length = train.groupBy("unique_id").agg(F.max("position").alias("_n"))
    both = train.withColumns({"type": F.lit("train"), "_n": F.lit(0)}).unionByName(
        test.join(length, "unique_id", "left").withColumns({"type": F.lit("test"), "_n": F.coalesce("_n", F.lit(0))}))
    both = both.withColumn("position", F.col("position") + F.col("_n")).drop("_n").join(info, "unique_id")
    ds = F.coalesce(*[F.when(F.col(period_col) == p, c) for p, c in step.items()])
    return both.select("unique_id", ds.cast("timestamp_ntz").alias("ds"), "y", "type", period_col)


@dataclass
class Artifacts:
    """What a feature or modelling step hands on: tables, plain parameters, fitted pipelines."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    params: dict = field(default_factory=dict)
    models: dict[str, PipelineModel] = field(default_factory=dict)


def save_artifacts(spark: SparkSession, path: str, artifacts: Artifacts) -> None:
    """Write tables as Parquet, parameters as one JSON text and pipelines in their own format under ``path``
    (any storage that Spark writes to); what is there under the same names is replaced."""
    for name, df in artifacts.tables.items():
        df.write.mode("overwrite").parquet(f"{path}/tables/{name}")
    for name, model in artifacts.models.items():
        model.write().overwrite().save(f"{path}/models/{name}")
    index = {"tables": list(artifacts.tables), "models": list(artifacts.models), "params": artifacts.params}
    spark.createDataFrame([(json.dumps(index),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/index")


def load_artifacts(spark: SparkSession, path: str) -> Artifacts:
    """Read back what :func:`save_artifacts` wrote."""
    index = json.loads(spark.read.text(f"{path}/index").first()[0])
    return Artifacts({n: spark.read.parquet(f"{path}/tables/{n}") for n in index["tables"]}, index["params"],
                     {n: PipelineModel.load(f"{path}/models/{n}") for n in index["models"]})


def checkpoint_table(df: DataFrame, name: str) -> DataFrame:
    """Cut a long lineage by writing to the shared checkpoint folder and reading back.

    The folder comes from ``spark.checkpoint.dir`` (shared storage on a cluster)."""
    from chronoweave.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(df.sparkSession)
    path = f"{base.rstrip('/')}/tables/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
