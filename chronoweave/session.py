"""Session helpers: defaults that hold from local[8] to a large cluster."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "chronoweave") -> SparkSession:
    """Create (or reuse) a session with AQE on and the UI off."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("CHRONOWEAVE_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used as is; unset it
    is an error there.  A fresh local folder is created for a local master only (unit
    tests, a laptop), where driver and executors are one process.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="chronoweave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df):
    """Materialise ``df`` in the shared checkpoint folder and continue from it.

    Used between the heavy stages of long feature plans so later steps (and retries after
    a lost executor) start from stored data instead of re-running the whole lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_STORED: list[tuple[SparkSession, str]] = []


def store(df):
    """Write ``df`` once as Parquet into the shared checkpoint folder and continue from the files.

    Like :func:`cut_lineage`, but the plan runs once (a checkpoint runs its last stage twice, which
    counts where that stage is Python code) and later steps read only the columns they use.  The files are
    deleted when the driver program ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _STORED:
        atexit.register(_delete_stored)
    _STORED.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def _delete_stored() -> None:
    for spark, path in _STORED:
        if spark.sparkContext._jsc is None:  # the session has ended already
            return
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
