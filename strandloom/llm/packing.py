"""Packing of documents into windows of tokens by best-fit decreasing.

Texts become token ids with an end id. A document longer than a window is first cut into full windows; what is left of
it, or a short document, is one piece. Pieces are placed from long to short, each in the tightest window that still
holds it, which a segment tree indexed by remaining capacity finds.

Where a piece goes depends on its length alone, and of lengths there are no more than a window has tokens. So the plan
is made from a histogram of lengths, all pieces of one length at a time, however many there are: it is the plan that
placing piece after piece would give. Each map task numbers its pieces of each length, the tasks' counts (one row for
each task and length) say at which number each task begins, and number and length together say where a piece goes.
Nothing is sorted or gathered by length, so a very common length is no long group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, pick, stored
from .pieces import packed
from .token_store import library

#: Pieces in an Arrow batch at most; rows of tasks' counts up to which they are broadcast (24 bytes each).
PIECES, BROADCAST_COUNTS = 16_384, 1 << 20


class Capacities:
    """Open windows by remaining capacity: runs of neighbouring windows in the leaves of a segment tree whose nodes
    say how many runs there are below."""

    def __init__(self, most: int) -> None:
        self.width = 1 << most.bit_length()
        self.open = [0] * (2 * self.width)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(most + 1)]

    def _count(self, capacity: int, change: int) -> None:
        node = self.width + capacity
        while node:
            self.open[node] += change
            node >>= 1

    def add(self, capacity: int, first: int, windows: int) -> None:
        if capacity and windows:
            self.runs[capacity].append((first, windows))
            self._count(capacity, 1)

    def take(self, capacity: int) -> tuple[int, int]:
        self._count(capacity, -1)
        return self.runs[capacity].pop()

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of an open window that is not under ``least``."""
        node = self.width + least
        if not self.open[node]:
            # up to where a right neighbour has some, then down to its first leaf
            while node and (node & 1 or not self.open[node + 1]):
                node >>= 1
            if not node:
                return None
            node += 1
            while node < self.width:
                node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.width


@dataclass
class Plan:
    """Of each length the runs of its pieces: from which number on, in which windows, how many in each, and where."""

    window: int
    windows: int = 0
    runs: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=dict)


def best_fit_decreasing(lengths: dict[int, int], window: int) -> Plan:
    """The plan for so many pieces of each length. It takes as many steps as there are runs, whatever the counts."""
    plan, tree = Plan(window), Capacities(window)
    for length in sorted(lengths, reverse=True):
        left, done, runs = lengths[length], 0, []
        while left:
            if (capacity := tree.tightest(length)) is None:
                capacity, each = window, window // length
                first, windows = plan.windows, -(-left // each)
                plan.windows += windows
            else:
                each = capacity // length
                first, windows = tree.take(capacity)
            # a window stays the tightest until it holds no further piece of this length
            placed = min(left, windows * each)
            full, rest = divmod(placed, each)
            runs.append((done, first, each, window - capacity))
            tree.add(capacity - each * length, first, full)
            if rest:
                tree.add(capacity - rest * length, first + full, 1)
            tree.add(capacity, first + full + (rest > 0), windows - full - (rest > 0))
            done, left = done + placed, left - placed
        plan.runs[length] = runs
    return plan


def pieces(df: DataFrame, tokenizer: str, window: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, start, length, doc_tokens, ids (binary, little-endian unsigned 32-bit) of each piece, with the map task that
    made it and the piece's number among that task's pieces of its length."""

    def make():
        lib, context = library(tokenizer), TaskContext.get()
        task = context.partitionId() if context else 0
        seen = np.zeros(window + 1, np.int64)

        def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            ids, ends = packed(batch.column(1), lib.specials, lib.head.__getitem__, lib.rest.__getitem__, lib.encode)
            ids = np.ascontiguousarray(np.insert(ids, ends, end_id), "<u4")
            tokens = np.diff(ends, prepend=0) + 1
            parts = -(-tokens // window)
            doc = np.repeat(np.arange(len(tokens)), parts)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)) * window
            length = np.minimum(tokens[doc] - start, window)
            order = np.argsort(length, kind="stable")
            counts = np.bincount(length, minlength=window + 1)
            number = np.empty(len(length), np.int64)
            number[order] = np.arange(len(length)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(seen, counts)
            np.add(seen, counts, out=seen)
            at = np.concatenate([[0], np.cumsum(length)])
            for k in range(0, len(length), PIECES):
                own = slice(k, k + PIECES)
                n = len(length[own])
                offsets = (at[k : k + n + 1] - at[k]) * 4
                data = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids[at[k] : at[k + n]])])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc[own])), pa.array(start[own]), pa.array(length[own]), pa.array(tokens[doc[own]]), data, pa.array(np.full(n, task, np.int32)), pa.array(number[own])],
                    names=[id_col, "start", "length", "doc_tokens", "ids", "task", "number"],
                )

        return each

    rows = pick(df, **{id_col: "bigint", text_col: "string"})
    return arrow_map(rows, make, f"`{id_col}` bigint, start bigint, length bigint, doc_tokens bigint, ids binary, task int, number bigint", rows=4096, keeps=f"library {tokenizer}")


def pack(df: DataFrame, tokenizer: str, window: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start (tokens of its document before it), length, ids, doc_tokens (with the end id),
    sequence_id (from 0, no gaps) and offset (tokens before it in its sequence, no gaps).

    Sequences hold at most ``window`` tokens. Null and empty texts are the end id alone; repeated rows are packed each;
    null ids stay null; an empty table has no pieces; other columns are left out, whatever their names; ties between
    windows of one capacity are broken by how tasks number their pieces, never changing how many windows there are.
    """
    cut = stored(pieces(df, tokenizer, window, end_id, id_col, text_col), "pieces")
    counts = stored(cut.groupBy("task", "length").agg(F.count("*").alias("n")), "lengths")
    # at most one row for each length that a window can hold
    plan = best_fit_decreasing({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, window)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    begins = counts.select("task", "length", F.coalesce(before, F.lit(0)).alias("begin"))
    if counts.count() <= BROADCAST_COUNTS:
        begins = F.broadcast(begins)
    runs = df.sparkSession.createDataFrame(list(plan.runs.items()), "length long, runs array<struct<begin:long,first:long,each:long,at:long>>")
    rows = cut.join(begins, ["task", "length"]).withColumn("number", F.col("number") + F.col("begin"))
    # one row a length, and their number of runs depends on the histogram's shape, not on its counts
    rows = rows.join(F.broadcast(runs), "length").withColumn("run", F.element_at(F.filter("runs", lambda r: r["begin"] <= F.col("number")), -1))
    k, run = F.col("number") - F.col("run.begin"), F.col("run")
    return rows.select(
        id_col, "start", "length", "ids", "doc_tokens",
        (run["first"] + F.floor(k / run["each"])).alias("sequence_id"), (run["at"] + k % run["each"] * F.col("length")).alias("offset"),
    )


def padding(packed_rows: DataFrame, window: int = 1024) -> DataFrame:
    """sequences, tokens and padding: what fills sequences up to ``window``, none where a power of two is reached."""
    used = packed_rows.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    whole = F.col("used").bitwiseAND(F.col("used") - 1) == 0
    return used.agg(F.count("*").alias("sequences"), F.sum("used").alias("tokens"), F.sum(F.when(whole, 0).otherwise(window - F.col("used"))).alias("padding"))


def checksums(packed_rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The pieces with the crc32 of their ids in place of them."""
    return packed_rows.select(id_col, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
