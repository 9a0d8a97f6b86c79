"""Helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_WRITTEN: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers of a local session find this package wherever the driver was started
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``).

    A folder of its own is set only for a local master, as in tests; on a cluster an unset
    folder is an error, since executors do not see each other's disks."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


#: bytes of an Arrow batch between Spark and Python workers; a batch of texts at Spark's default
#: of 64 MB is held several times over on both sides
BATCH_BYTES = 8 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, with its session's Arrow batches bounded (a smaller bound is left alone)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    conf = df.sparkSession.conf
    if int(re.sub(r"[^0-9]", "", conf.get(key))) > BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return df


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage is cut, the
    rows survive lost executors, and later steps read only the columns they use.  The
    files are deleted when the driver program ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/corpus-{tag}-{uuid.uuid4().hex}"
    bounded_batches(df).write.parquet(path)
    if not _WRITTEN:
        atexit.register(_clean)
    _WRITTEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def _clean() -> None:
    for spark, path in _WRITTEN:
        if spark.sparkContext._jsc is None:  # the session has ended already
            return
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` (a materialized table) with a broadcast hint if it has at most ``rows`` rows;
    beyond that the join shuffles both sides.  The result is the same either way."""
    return F.broadcast(df) if df.count() <= rows else df


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches in parts of at most ``rows`` rows, so the Python objects made of one part are
    gone before the next; a worker's memory does not depend on the session's batch size."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
        del b
        pa.default_memory_pool().release_unused()


def whole_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Re-cut a partition sorted by ``key`` into tables that hold whole groups only."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if b.num_rows == 0:
            continue
        k = b.column(key)
        if held and k[0].as_py() == last and k[-1].as_py() == last:
            held.append(b)
            continue
        v = k.to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(np.r_[True, v[1:] != v[:-1]])[-1])
        if held and k[0].as_py() != last:
            yield pa.Table.from_batches(held)
            held = []
        if cut:
            yield pa.Table.from_batches([*held, b.slice(0, cut)])
            held = []
        held.append(b.slice(cut))
        last = k[-1].as_py()
    if held:
        yield pa.Table.from_batches(held)


def runs(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end positions of the runs of equal values."""
    if len(v) == 0:
        z = np.zeros(0, np.int64)
        return z, z
    s = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
    return s, np.r_[s[1:], len(v)]


def text_column(batch: pa.RecordBatch, name: str) -> list[str]:
    """Texts of a batch; null is the empty text."""
    return ["" if t is None else t for t in batch.column(name).to_pylist()]
