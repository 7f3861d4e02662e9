"""Token ids in Parquet list columns.

Documents are dealt by ranges of their ids, which Spark finds in a sample, into shards, sorted within each, encoded, and written: ids as dictionary
encoded lists (few distinct values, so pages hold packed indexes), document ids and offsets as delta encoded
integers. Row groups and pages have set sizes and the files carry page indexes, so a reader that wants some
documents, or the metadata alone, reads those pages and columns only.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import _CUT, _MARKS, byte_letters, is_word, plain_word
from .common import Memo, arrow_map, delete_at_exit, pick, resident, shared_dir
from .pieces import MARK, packed

#: Bytes of a row group before compression, and of a page.
ROW_GROUP, PAGE = 32 << 20, 256 << 10
#: Rows of a page at most, so that pages of ids and of numbers end near one another; bytes of input for a shard, and most
#: shards by that rule.
PAGE_ROWS, SHARD_BYTES, MOST_SHARDS = 1024, 128 << 20, 100_000


class LibraryEncoder:
    """The tokenizers library, asked once for each distinct piece between blanks (see ``bpe``)."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        letters = {b: letter for letter, b in byte_letters().items()}
        self.letters = [letters[b] for b in range(256)]
        self.of_word = Memo(self._word, most=200_000)
        self.head = Memo(self._piece, most=50_000)
        self.later = Memo(lambda piece: self._piece(" " + piece), most=50_000)  # of texts taken whole
        self.rest = Memo(self._rest, most=900_000)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        """A word that the patterns leave in one part goes to the library's model alone, byte by byte as its letters."""
        return self._ids(word.encode().decode("latin-1").translate(self.letters))

    def _ids(self, letters: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _rest(self, piece: str) -> bytes:
        if piece.isascii() and piece.isalpha():  # its bytes are its letters
            return self._ids(self.letters[32] + piece)
        if piece[:1] == MARK:
            return self._whole(piece[1:])
        return self._word(" " + piece) if is_word(piece) else self._piece(" " + piece)

    def _piece(self, piece: str) -> bytes:
        # a plain word, with marks behind it or not, is two words of the patterns; each is asked for once
        if (two := plain_word(piece)) is not None:
            return self.rest[two[0][1:]] + (self.of_word[two[1]] if two[1] else b"")
        return self._whole(piece) if (lines := self._lines(piece)) is None else lines

    def _lines(self, piece: str) -> bytes | None:
        """A piece of such words with one line feed between each two, which is a word of the patterns by itself."""
        first, *later = piece.split("\n")
        if not later or (two := plain_word(first)) is None:
            return None
        found = [self.rest[two[0][1:]], self.of_word[two[1]] if two[1] else b""]
        for line in later:
            core = line.rstrip(_MARKS)
            if not is_word(core):
                return None
            found += [self.of_word["\n"], self.of_word[core], self.of_word[line[len(core) :]] if len(core) < len(line) else b""]
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.specials):
            return self._whole(text)
        head, *rest = _CUT.split(text)
        return self.head[head] + b"".join(map(self.later.__getitem__, rest))


def library(path: str) -> LibraryEncoder:
    return resident(f"library {path}", lambda: LibraryEncoder(path))


def write(df: DataFrame, path: str, tokenizer: str, end_id: int = 2, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes columns shard, id, n_tokens, shard_start (ids before the document in its shard) and ids (list of int).

    Each document ends with ``end_id``; null and empty texts hold it alone. Shards ascend by document id, null ids
    first; rows of one id follow one another as they were read. An empty table writes no rows. Other columns are left out.
    """
    rows = pick(df, **{id_col: "bigint", text_col: "string"})
    spark = df.sparkSession
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # of the files, nothing is read
    n = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_SHARDS, size // SHARD_BYTES))
    # ranges of ids, and of places among the rows of an id that very many rows have
    order = [F.col(id_col).asc_nulls_first(), F.col("place").asc()]
    dealt = rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(n, *order).sortWithinPartitions(*order).select(id_col, text_col, F.spark_partition_id().alias("shard"))

    def make():
        lib, done = library(tokenizer), [0]

        def each(batch: pa.RecordBatch):
            ids, ends = packed(batch.column(1), lib.specials, lib.head.__getitem__, lib.rest.__getitem__, lib.encode)
            ids = np.insert(ids, ends, end_id).astype(np.int32)
            n = np.diff(ends, prepend=0) + 1
            starts = done[0] + np.cumsum(n) - n
            done[0] += int(n.sum())
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(0), pa.array(n), pa.array(starts), lists], names=["shard", id_col, "n_tokens", "shard_start", "ids"])

        return each

    coded = arrow_map(dealt, make, f"shard int, `{id_col}` bigint, n_tokens bigint, shard_start bigint, ids array<int>", rows=4096, keeps=f"library {tokenizer}")
    options = {
        "compression": "zstd", "parquet.block.size": ROW_GROUP, "parquet.page.size": PAGE, "parquet.page.row.count.limit": PAGE_ROWS, "parquet.dictionary.page.size": 1 << 20, "parquet.writer.version": "PARQUET_2_0",
        "parquet.enable.dictionary": "false", "parquet.enable.dictionary#ids.list.element": "true",
    }
    coded.write.options(**options).parquet(path)


def read(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """The stored rows with ``start``: ids of all documents before.

    Totals are one row a shard, of which there are as many as the writer was told.
    """
    rows = spark.read.parquet(path)
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()
    before, starts = 0, {}
    for r in sorted(totals, key=lambda r: r["shard"]):
        starts[r["shard"]] = before
        before += r["n"]
    if not starts:
        return rows.withColumn("start", F.lit(0).cast("bigint"))
    offsets = F.array(*(F.lit(starts.get(k, 0)).cast("bigint") for k in range(max(starts) + 1)))
    return rows.withColumn("start", F.col("shard_start") + F.element_at(offsets, F.col("shard") + 1))


def documents(spark: SparkSession, path: str, first: int, last: int, id_col: str = "doc_id") -> DataFrame:
    """The stored rows with ids from ``first`` to ``last``: of other row groups and pages, only the indexes are read."""
    return spark.read.parquet(path).filter(F.col(id_col).between(first, last))


def lengths(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """id and n_tokens of all rows, without reading a token."""
    return spark.read.parquet(path).select(id_col, "n_tokens")


def checksums(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, start, n_tokens and the crc32 of the ids as little-endian unsigned 32-bit integers."""

    def make():
        def each(batch: pa.RecordBatch):
            ids = batch.column(3)
            values = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=True))
            at = ids.offsets.to_numpy().tolist()
            sums = [zlib.crc32(values[a:b]) for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], batch.column(2), pa.array(sums, pa.int64())], names=[id_col, "start", "n_tokens", "ids_crc32"])

        return each

    return arrow_map(rows.select(id_col, "start", "n_tokens", "ids"), make, f"`{id_col}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(spark: SparkSession, documents: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the documents' ids to the shared folder and gives what reading the files back shows."""
    path = f"{shared_dir(spark)}-tokens"
    write(documents, path, tokenizer)
    delete_at_exit(spark, path)
    return checksums(read(spark, path))
