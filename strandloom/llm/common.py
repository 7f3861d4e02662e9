"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import os
import shutil
import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.staging import shared

#: Upper to lower case for A-Z, other bytes as they are.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: White space that ends a word: blank and the bytes 9 to 13.
BLANKS = bytes([32, *range(9, 14)])


#: Rows and bytes that a Python function gets at a time, so that long texts don't add up in memory.
ROWS, BYTES = 512, 16 << 20


#: What a worker process keeps from task to task: the tables of one operator at a time, by its name.
_resident: dict = {}


def resident(name: str, build: Callable):
    """What ``build`` gives, kept in this process until another operator runs in it."""
    if name not in _resident:
        vacate(name)
        _resident[name] = build()
    return _resident[name]


def vacate(name: str = "") -> None:
    """Drops what other operators have left in this process, and returns their memory."""
    if _resident and name not in _resident:
        _resident.clear()
        gc.collect()
        with contextlib.suppress(OSError):
            ctypes.CDLL("libc.so.6").malloc_trim(0)


def relieve() -> None:
    """Gives back to the system what a task's batches have left in the memory pools of this process."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def place(df: DataFrame, want: str) -> int:
    """Where a column is: the first with exactly that name, else the first whose name differs in case only."""
    names = df.columns
    found = [i for i, c in enumerate(names) if c == want] or [i for i, c in enumerate(names) if c.lower() == want.lower()]
    if not found:
        raise ValueError(f"column {want!r} is missing; there are {names}")
    return found[0]


def pick(df: DataFrame, **kinds: str) -> DataFrame:
    """The named columns alone, cast to the given types.

    Columns are found by their exact name first, so that extra columns whose names differ in case only do no harm;
    of several columns with one name the first counts. A missing column is an error.
    """
    at = {want: place(df, want) for want in kinds}
    plain = df.toDF(*(f"_c{i}" for i in range(len(df.columns))))
    return plain.select(*(F.col(f"_c{at[k]}").cast(v).alias(k) for k, v in kinds.items()))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null ids fall in fold 0 of the empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def anew(key: str) -> Column:
    """A whole number as an expression of its own.

    An aggregate is dealt by its key, and a join on that key would take it as it is; joined by this instead, both sides
    come fresh from a shuffle, and Spark can split the tasks of a key that very many rows have.
    """
    return F.col(key).bitwiseXOR(F.lit(0))


def shared_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, or under the warehouse where that is not set (as in tests)."""
    return f"{shared(spark)}/strandloom-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str, codec: str = "zstd") -> DataFrame:
    """The rows, written to the shared folder and read again: cuts the lineage so that lost executors cost no rerun.

    The folder is deleted when the Spark application ends, or earlier with ``forget``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}-{what}"
    df.write.option("compression", codec).parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)


def forget(spark: SparkSession, df: DataFrame) -> None:
    """Deletes what ``stored`` wrote, once nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    for file in {f.rpartition("/")[0] for f in df.inputFiles()}:
        where = jvm.org.apache.hadoop.fs.Path(file)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


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


def arrow_map(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]], schema: str, rows: int = ROWS, keeps: str = "") -> DataFrame:
    """mapInArrow, at most ``rows`` rows and about ``BYTES`` bytes at a time, with a function that ``make`` builds once a task; its ``finish``, if any, gives the last batches.

    ``keeps`` names what the function keeps in its process by ``resident``; all else is dropped before it begins.
    """

    ship(df.sparkSession)
    # what Spark sends to a worker at a time; of very long texts its own default is several times as much
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vacate(keeps)
        relieve()
        each = make()
        for batch in batches:
            n = max(1, min(rows, batch.num_rows * BYTES // max(1, batch.nbytes)))
            for k in range(0, batch.num_rows, n):
                yield from each(batch.slice(k, n))
        if hasattr(each, "finish"):
            yield from each.finish()
        del each
        relieve()

    return df.mapInArrow(run, schema)


def slices(column: pa.Array) -> tuple[np.ndarray, memoryview]:
    """Start offsets (one more than rows) and bytes of a text or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return at, memoryview(data) if data is not None else memoryview(b"")


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of unsigned 64-bit integers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Memo(dict):
    """A table that computes missing entries; long keys are not kept, and it starts anew when full."""

    def __init__(self, compute: Callable, most: int = 400_000, longest: int = 48) -> None:
        super().__init__()
        self.compute, self.most, self.longest = compute, most, longest

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


def crc_fold(key: int | None, n: int) -> int:
    """What ``fold`` gives, for one id."""
    return zlib.crc32(b"" if key is None else str(key).encode()) % n
