"""The scan of targets for windows that reads have: one pass of a rolling hash over each stretch, of which only what is
found comes out, with as much of the target beside it as the longest read covers.

Read windows of up to ``KEY_BYTES`` are looked up in a table of them, exactly. Beyond that a Bloom filter takes its
place, with the settings' bits and hash functions. It is built by Spark from the keys' hashes, and cut by hash into
parts that each fit a worker; the targets are scanned once for each part (letters are not shuffled, which would cost far
more than hashing them again), and what passes is joined exactly with the windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rolling
from ..plans.staging import in_batches, ship, staged
from .windows import STRETCH, stretches

#: Bytes of read windows and their hashes up to which workers hold all of them; bytes of one part of a filter.
KEY_BYTES, PART_BYTES = 64 << 20, 128 << 20
#: Bits a key and hash functions of a filter for which no settings are given; rows of a batch of what is found.
KEY_BITS, HASHES, ROWS = 16, 8, 1 << 15


def _found(pieces: DataFrame, keys, before: int, after: int, letters: int) -> DataFrame:
    """What a key table or a part of a filter, as a broadcast variable, finds in stretches."""

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at, text = rolling.text_bytes(batch.column(3))
        start, lead = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        width = keys.value.width
        for k in range(0, max(1, len(text)), rolling.CHUNK):
            own = text[k : k + rolling.CHUNK + width - 1]
            hit = keys.value.find(own) + k
            row = np.searchsorted(at, hit, "right") - 1
            offset = hit - at[row] - lead[row]
            good = (offset >= 0) & (offset < letters) & (hit + width <= at[row + 1])
            hit, row, p = hit[good], row[good], (start[row] + offset)[good]
            for s in range(0, len(hit), ROWS):  # a very common window may be found nearly everywhere
                yield rows(batch.column(0), at, text, hit[s : s + ROWS], row[s : s + ROWS], p[s : s + ROWS], width)

    def rows(numbers: pa.Array, at: np.ndarray, text: np.ndarray, hit: np.ndarray, row: np.ndarray, p: np.ndarray, width: int) -> pa.RecordBatch:
        first, last = np.maximum(at[row], hit - before), np.minimum(at[row + 1], hit + width + after)
        around = [text[a:b].tobytes() for a, b in zip(first.tolist(), last.tolist())]
        columns = [numbers.take(pa.array(row)), pa.array(p), rolling.texts(rolling.gather(text, hit, width)), pa.array((hit - first).astype(np.int32)), pa.array(around, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["tnum", "p", "key", "lead", "around"])

    return in_batches(pieces, each, "tnum bigint, p bigint, key string, lead int, around string")


def _matrix(keys: pa.ChunkedArray, width: int) -> np.ndarray:
    parts = [rolling.text_bytes(c)[1] for c in keys.chunks]
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint8)).reshape(-1, width)


def filter_words(keys: DataFrame, width: int, parts: int, bits: int, hashes: int, by: tuple[str, ...] = ()) -> DataFrame:
    """part, word and mask (and ``by``): the words of a Bloom filter of the column ``key`` that have a bit set, in
    ``parts`` parts of ``bits`` bits."""
    ship(keys.sparkSession)
    kinds = dict(keys.dtypes)

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        h = rolling.key_hashes(rolling.text_bytes(batch.column(0))[1].reshape(-1, width))
        part = pa.array(rolling.part_of(h, parts).astype(np.int32))
        for place in rolling.places(h, bits, hashes):
            mask = np.left_shift(np.uint64(1), place & np.uint64(63)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], part, pa.array((place >> np.uint64(6)).astype(np.int64)), pa.array(mask)], names=[*by, "part", "word", "mask"])

    schema = ", ".join([*(f"{c} {kinds[c]}" for c in by), "part int, word bigint, mask bigint"])
    return in_batches(keys.select("key", *by), each, schema).groupBy(*by, "part", "word").agg(F.bit_or("mask").alias("mask"))


def filter_size(count: int, bits: int, hashes: int) -> tuple[int, int, int]:
    """(parts, bits of a part, hash functions) of a filter for so many keys: the settings' bits, or as many as the keys
    ask for, in parts of equal size."""
    wanted = bits or max(64, count * KEY_BITS)
    parts = -(-wanted // (8 * PART_BYTES))
    return parts, -(-wanted // parts // 64) * 64, hashes or HASHES


def candidates(targets: DataFrame, windows: DataFrame, width: int, before: int = 0, after: int = 0, bits: int = 0, hashes: int = 0, work: str = "", key_bytes: int = KEY_BYTES, letters: int = STRETCH) -> DataFrame:
    """tnum, p, key, lead, around of the target windows that some read window equals: ``around`` is the target from
    ``before`` letters left of the window to ``after`` letters right of it, as far as it goes, and the window begins
    after ``lead`` letters of it. ``work`` is a folder for a filter, if one is needed.
    """
    spark = targets.sparkSession
    ship(spark)
    pieces = stretches(targets, width, before, after, letters)
    size = max(letters, before, width + after)
    keys = windows.select("key").distinct()
    most = key_bytes // (width + 8)
    few = keys.limit(most + 1).toArrow()  # never more than the bound and one
    if few.num_rows <= most:
        return _found(pieces, spark.sparkContext.broadcast(rolling.KeyTable(_matrix(few["key"], width))), before, after, size)
    del few
    keys = staged(keys, f"{work}/keys")
    parts, part_bits, hashes = filter_size(keys.count(), bits, hashes)
    words = staged(filter_words(keys, width, parts, part_bits, hashes).repartition("part"), f"{work}/filter")
    found = None
    for k in range(parts):
        held = words.filter(F.col("part") == k).select("word", "mask").toArrow()
        full = np.zeros(part_bits // 64, np.uint64)
        full[held["word"].to_numpy()] = held["mask"].to_numpy().view(np.uint64)
        one = _found(pieces, spark.sparkContext.broadcast(rolling.FilterPart(full, width, k, parts, part_bits, hashes)), before, after, size)
        found = one if found is None else found.union(one)
    return found.join(keys, "key", "left_semi").select("tnum", "p", "key", "lead", "around")


def measured_fill(windows: DataFrame, width: int, bits: int, hashes: int) -> DataFrame:
    """k, n_keys and fill of each window's own filter, by the bits that are set in it."""
    keys = windows.select("k", "key").distinct()
    parts, part_bits, hashes = filter_size(1, bits, hashes)
    words = filter_words(keys, width, parts, part_bits, hashes, ("k",)).groupBy("k").agg((F.sum(F.bit_count("mask")) / (parts * part_bits)).alias("fill"))
    return keys.groupBy("k").agg(F.count("*").alias("n_keys")).join(words, "k")
