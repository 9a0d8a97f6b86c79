"""Structured Streaming variants of the bucketed aggregation and the EWMA detector
(T01-T03).

Sources are file streams (``readStream``) with an explicit schema; event time is cast
to ``timestamp`` (event-time watermarks reject ``timestamp_ntz``).  Aggregations carry a
watermark so their state is bounded; the EWMA detector keeps ``(mean, var, n)`` per key in
``applyInPandasWithState`` state and smooths a micro-batch as arrays.  Checkpoints go to the session's
shared checkpoint folder.

A stream in append mode emits a window when the watermark has passed its end.  :func:`all_windows` adds the windows
that are still open when the available input ends, from a batch aggregate of the rows past the
final watermark, so its rows are those of all windows.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from chronoweave.session import ensure_checkpoint_dir

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 1) -> DataFrame:
    """The ``events`` table as a file stream (only ``events.parquet`` in the folder)."""
    return (spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events.parquet")
                 .option("maxFilesPerTrigger", max_files_per_trigger).parquet(sf_dir)
                 .withColumn("event_time", F.col("ts").cast("timestamp")))


def windowed_counts(stream: DataFrame, window: str = "1 hour", slide: str | None = None,
                    watermark: str = "2 hours") -> DataFrame:
    """Tumbling (or sliding, with ``slide``) event-time windows per event type:
    ``(unique_id, ds, y = count, v = sum(value))``.  The watermark drops later rows, closes
    windows and bounds the state."""
    w = F.window("event_time", window, slide) if slide else F.window("event_time", window)
    agg = (stream.withWatermark("event_time", watermark)
                 .groupBy(w.alias("w"), F.col("event_type").alias("unique_id"))
                 .agg(F.count(F.lit(1)).alias("y"), F.sum("value").alias("v")))
    return agg.select("unique_id", F.col("w.start").cast("timestamp_ntz").alias("ds"),
                      F.col("w.end").cast("timestamp_ntz").alias("ds_end"), F.col("y").cast("double").alias("y"),
                      F.round("v", 6).alias("v"))


def smooth(v: np.ndarray, lam: float, start: float) -> np.ndarray:
    """``s_t = lam v_t + (1 - lam) s_(t-1)`` from ``start``, some hundred values at a time as a triangular product."""
    size = 256
    i = np.arange(size)
    apart = i[:, None] - i[None, :]
    weights = np.where(apart >= 0, lam * (1 - lam) ** np.maximum(apart, 0), 0.0)
    fade = (1 - lam) ** (i + 1)
    out = np.empty(len(v))
    for at in range(0, len(v), size):
        part = v[at:at + size]
        m = len(part)
        out[at:at + m] = weights[:m, :m] @ part + fade[:m] * start
        start = out[at + m - 1]
    return out


def ewma_batch(x: np.ndarray, lam: float, k: float, mu: float, var: float, first: bool):
    """Means, scores and flags of the values of a micro-batch in order, and the state after them.

    mu and var are the state before; ``first`` says that there is none yet: the first value is the start
    and has no score."""
    if len(x) == 0:
        return np.zeros(0), np.zeros(0), np.zeros(0, bool), mu, var
    start = x[0] if first else mu
    mean = smooth(x, lam, start)
    error = x - np.r_[start, mean[:-1]]
    spread = smooth(error ** 2, lam, 0.0 if first else var)
    sd = np.sqrt(np.maximum(np.r_[0.0 if first else var, spread[:-1]], 0.0))
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where(sd > 0, np.abs(error) / sd, np.nan)
    flag = np.abs(error) > k * sd
    flag &= sd > 0
    return mean, score, flag, mean[-1], spread[-1]


def ewma_flags(stream: DataFrame, lam: float = 0.2, k: float = 3.0) -> DataFrame:
    """Per event type, online SD-EWMA over ``value`` in event-time order within each
    micro-batch; state = (mean, variance, count) per key."""
    out_schema = T.StructType([T.StructField("unique_id", T.StringType()), T.StructField("event_id", T.LongType()),
                               T.StructField("ds", T.TimestampNTZType()), T.StructField("value", T.DoubleType()),
                               T.StructField("ewma_mean", T.DoubleType()), T.StructField("ewma_score", T.DoubleType()),
                               T.StructField("anomaly_ewma", T.IntegerType())])
    state_schema = T.StructType([T.StructField("mu", T.DoubleType()), T.StructField("var", T.DoubleType()),
                                 T.StructField("n", T.LongType())])

    def step(key, pdfs, state):
        mu, var, n = state.get if state.exists else (np.nan, 0.0, 0)
        pdf = pd.concat(list(pdfs), ignore_index=True).sort_values(["ts", "event_id"])
        x = pdf["value"].to_numpy(float)
        mean, score, flag, mu, var = ewma_batch(x, lam, k, mu, var, n == 0)
        state.update((float(mu), float(var), int(n + len(x))))
        yield pd.DataFrame({"unique_id": key[0], "event_id": pdf["event_id"].to_numpy(), "ds": pdf["ts"].to_numpy(), "value": x,
                            "ewma_mean": mean, "ewma_score": score, "anomaly_ewma": flag.astype("int32")})

    return (stream.groupBy("event_type")
                  .applyInPandasWithState(step, out_schema, state_schema, "append", GroupStateTimeout.NoTimeout))


class Run(NamedTuple):
    """What a stream left behind: the rows of its sink, the last watermark, and how many rows came too late for
    their window (of the last hundred micro-batches, which Spark reports)."""

    table: DataFrame
    watermark: str | None
    late_rows: int


def run_stream(df: DataFrame) -> Run:
    """Run a streaming query over all currently available input (``availableNow``) into a
    Parquet sink in the shared folder, in append mode, and read the sink back."""
    spark = df.sparkSession
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{uuid.uuid4().hex}"
    q = (df.writeStream.format("parquet").option("path", f"{base}/out").outputMode("append")
           .option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start())
    q.awaitTermination()
    progress = q.recentProgress
    marks = [p["eventTime"]["watermark"] for p in progress if "watermark" in p["eventTime"]]
    late = sum(o["numRowsDroppedByWatermark"] for p in progress for o in p["stateOperators"])
    return Run(spark.read.schema(df.schema).parquet(f"{base}/out"), max(marks, default=None), late)


def run_to_table(df: DataFrame) -> DataFrame:
    """The sink's rows of :func:`run_stream`."""
    return run_stream(df).table


def all_windows(spark: SparkSession, sf_dir: str, window: str = "1 hour", slide: str | None = None, watermark: str = "2 hours") -> DataFrame:
    """T01/T02 complete: the windows that the stream closed and those still open at the end of its input.

    Open are the windows that end after the final watermark; their rows are aggregated in batch from the same
    files, reading only rows that can lie in them.  Rows that reached the stream after their window was
    closed are not in the result, as the watermark says; :func:`run_stream` counts them."""
    run = run_stream(windowed_counts(events_stream(spark, sf_dir), window, slide, watermark))
    rows = spark.read.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events.parquet").parquet(sf_dir) \
        .withColumn("event_time", F.col("ts").cast("timestamp"))
    if run.watermark is None:
        return run.table.unionByName(windowed_counts(rows, window, slide, watermark))
    mark = F.lit(run.watermark).cast("timestamp")
    still = windowed_counts(rows.where(F.col("event_time") >= mark - F.expr(f"INTERVAL {window}")), window, slide, watermark)
    return run.table.unionByName(still.where(F.col("ds_end").cast("timestamp") > mark))
