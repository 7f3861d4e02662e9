"""Stage tables: written once, read again, so that later stages neither recompute nor depend on lost executors."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import json
import os
import shutil
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the warehouse where that is not set.

    On a cluster a warehouse on local disks would be another folder on each machine, so it is an error there. A
    checkpoint folder is taken as it is given: a mounted disk that all machines share also begins with file.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        local = base.startswith("file:") or "://" not in base and spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:")
        if local and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    return base.rstrip("/")


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once a Spark application, so that their Python workers can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_strandloom_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    # the driver serves this file to the executors as long as it lives
    d = os.path.realpath(tempfile.mkdtemp())
    atexit.register(shutil.rmtree, d, ignore_errors=True)
    zipped = Path(d) / "strandloom.zip"
    with zipfile.ZipFile(zipped, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(str(zipped))
    sc._strandloom_shipped = True


def work_dir(spark: SparkSession, given: str = "") -> str:
    """The given folder, or a new one in the shared folder.

    A generated folder goes when the application ends.
    """
    if given:
        return given.rstrip("/")
    path = f"{shared(spark)}/strandloom-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def staged(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file(spark: SparkSession, path: str):
    """A path and its file system, as Spark's own readers and writers have them."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_note(spark: SparkSession, path: str, note: dict) -> None:
    """A small JSON object beside stage tables, in whatever store they are; it is there whole or not at all."""
    (target, store), (begun, _) = _file(spark, path), _file(spark, f"{path}.{uuid.uuid4().hex}")
    out = store.create(begun, True)
    out.write(bytearray(json.dumps(note).encode()))
    out.close()
    store.delete(target, False)
    store.rename(begun, target)


def forget_note(spark: SparkSession, path: str) -> None:
    where, store = _file(spark, path)
    store.delete(where, False)


def read_note(spark: SparkSession, path: str) -> dict | None:
    """A note, or None where there is none."""
    where, store = _file(spark, path)
    return json.loads(spark.read.text(path, wholetext=True).first()[0]) if store.exists(where) else None


#: Bytes that Spark sends to a Python worker at a time, and that are worked on at a time.
BATCH_BYTES = 4 << 20


def in_batches(df: DataFrame, each: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow with batches of about ``BATCH_BYTES``, whatever the length of a table's texts and the size of its
    files; workers give free memory back before and after a task."""
    ship(df.sparkSession)
    # Spark's own default is many times as much, and long texts fill it
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _relieve()
        for batch in batches:
            n = max(1, batch.num_rows * BATCH_BYTES // max(1, batch.nbytes))
            for k in range(0, batch.num_rows, n):
                yield from each(batch.slice(k, n))
        _relieve()

    return df.mapInArrow(run, schema)


def _relieve() -> None:
    """Memory that is free goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform.startswith("linux"):
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL("libc.so.6").malloc_trim(0)


def spread(df: DataFrame) -> DataFrame:
    """The rows as they are scanned, or dealt anew where a few files or row groups would leave most cores idle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df._jdf.rdd().getNumPartitions() >= cores else df.repartition(cores)
