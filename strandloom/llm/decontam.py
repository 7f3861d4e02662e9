"""Benchmark decontamination with suffix arrays of the training text.

A shard is a batch of documents as word numbers (words that no benchmark item has are 0 and end every match). Its
suffix array is built by prefix doubling, and every test suffix (each place of each benchmark item) is sought in it by
binary search, which gives its longest verbatim match in the shard and where that is. Where a match is as long as the
item's window, the range of suffixes that begin with the window gives all occurrences. The longest match of a document
is that of its places with the test suffixes that fall next to them.

The benchmark is read in blocks of bounded size, which are sent to the executors as text and numbered there; a worker
has one block's arrays at a time. Measured with 15.2 million characters in 2.7 million words: 316 MB at most while they
are built, 21 bytes a character, and 260 MB more while a shard of a million words is searched. The driver holds a
block's text alone.
Documents are never shuffled.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, pick, place, resident, slices

#: Bytes that end a word (all below 128 but digits and letters) become blanks, capitals lower case.
_TABLE = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
#: Characters of benchmark text in a block; documents of a shard at most; words of a shard's suffix array: as many as
#: there are test suffixes, which are all sought in it, but no fewer and no more than these; bytes of a word, roughly.
BLOCK_CHARS, SHARD_ROWS, SHARD_WORDS, WORD_BYTES = 16_000_000, 4096, (1 << 18, 1 << 21), 6


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def suffix_array(x: np.ndarray, longest: int) -> np.ndarray:
    """The places of ``x`` that are not 0, sorted by the numbers that follow, as far as the next 0 or ``longest``.

    Ranks by twice as many numbers come from ranks by so many; only places that still tie are sorted again.
    """
    at = np.flatnonzero(x)
    if not len(at):
        return at
    padded = np.append(x, 0).astype(np.int64)
    zeros = np.flatnonzero(padded == 0)
    run = zeros[np.searchsorted(zeros, at)] - at
    key = padded[at] << 32 | padded[at + 1]
    order = np.argsort(key, kind="stable")
    array, key = at[order], key[order]
    slot = np.arange(len(at))
    rank = np.zeros(len(padded), np.int64)
    rank[array] = 1 + np.maximum.accumulate(np.where(np.append(True, key[1:] != key[:-1]), slot, 0))
    left = np.zeros(len(padded), np.int64)
    left[at] = run
    k, tied = 2, slot
    while k < min(longest, int(run.max())):
        r = rank[array[tied]]
        same = r[1:] == r[:-1]
        tied = tied[np.append(same, False) | np.append(False, same)]
        if not len(tied):
            break
        own = array[tied]
        first, second = rank[own], np.where(left[own] > k, rank[np.minimum(own + k, len(padded) - 1)], 0)
        order = np.lexsort((second, first))
        own, first, second = own[order], first[order], second[order]
        array[tied] = own
        new = np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]))
        rank[own] = 1 + tied[np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))]
        k *= 2
    return array


def agreement(x: np.ndarray, places: np.ndarray, t: np.ndarray, starts: np.ndarray, lengths: np.ndarray, known: np.ndarray) -> np.ndarray:
    """How many numbers of ``t`` from each start, ``lengths`` at most, follow each place of ``x``; ``known`` of them do.

    ``x`` ends with 0, which agrees with nothing.
    """
    out = known.copy()
    some = np.arange(len(places))
    while len(some):
        n = out[some]
        some = some[n < lengths[some]]
        n = out[some]
        word = x[places[some] + n]
        some = some[(word == t[starts[some] + n]) & (word != 0)]
        out[some] += 1
    return out


def insertion(x: np.ndarray, array: np.ndarray, t: np.ndarray, starts: np.ndarray, lengths: np.ndarray, after: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Binary search of stretches of ``t`` in a suffix array of ``x``: where each belongs (with ``after``, behind all that
    begin with it), and how many numbers it has in common with the suffixes before and at that place."""
    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(array), np.int64)
    before, behind = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    some = np.arange(len(starts)) if len(array) else np.zeros(0, np.int64)
    while len(some):
        middle = (low[some] + high[some]) >> 1
        places = array[middle]
        # both ends have this much in common with the test suffix, so all between them do
        n = agreement(x, places, t, starts[some], lengths[some], np.minimum(before[some], behind[some]))
        whole = n == lengths[some]
        less = np.where(whole, after, x[places + n] < t[np.minimum(starts[some] + n, len(t) - 1)])
        low[some[less]], before[some[less]] = middle[less] + 1, n[less]
        high[some[~less]], behind[some[~less]] = middle[~less], n[~less]
        some = some[low[some] < high[some]]
    return low, before, behind


class Tests:
    """A block of benchmark items as arrays: word numbers (a 0 after each item), its sorted suffixes, distinct windows."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int) -> None:
        self.number: dict[bytes, int] = {}
        give, lines, ids = self.number.setdefault, [], []
        for item, text in items:
            if words := words_of((text or "").encode()):
                lines.append(np.array([give(w, len(self.number) + 1) for w in words] + [0], np.uint32))
                ids.append(item)
        self.x = np.concatenate(lines) if lines else np.zeros(1, np.uint32)
        sizes = np.array([len(x) - 1 for x in lines], np.int64)
        #: Item ids, and whether an item has one.
        self.ids, self.named = np.array([i or 0 for i in ids], np.int64), np.array([i is not None for i in ids], bool)
        self.depth = int(sizes.max(initial=0))
        self.least = min(window, int(sizes.min(initial=window))) if len(sizes) else 0
        self.array = suffix_array(self.x, self.depth).astype(np.int32)
        ends = np.cumsum(sizes + 1) - 1
        self.lengths = (ends[np.searchsorted(ends, self.array)] - self.array).astype(np.int32) if len(sizes) else np.zeros(0, np.int32)
        #: By window length: the places of distinct windows, and their items (from, to, items).
        self.windows: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        item = np.searchsorted(ends, self.array)
        size = np.minimum(sizes, window)[item] if len(sizes) else np.zeros(0, np.int64)
        for n in np.unique(size).tolist():
            own = (size == n) & (self.lengths >= n)
            at, of = self.array[own].astype(np.int64), item[own]
            # equal windows are neighbours among sorted suffixes
            new = np.append(True, agreement(self.x, at[1:], self.x, at[:-1], np.full(len(at) - 1, n), np.zeros(len(at) - 1, np.int64)) < n)
            which, of = np.unique(np.stack([np.cumsum(new) - 1, of]), axis=1)
            self.windows.append((n, at[new], np.searchsorted(which, np.arange(new.sum() + 1)), of))


def _none() -> np.ndarray:
    return np.zeros(0, np.int64)


def _searched(tests: Tests, x: np.ndarray, body: int) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """For one suffix array: (places, window numbers, window length) of all occurrences that begin in the body, the
    places hit and their longest matches, and the longest match of each (sorted) test suffix."""
    array = suffix_array(x, tests.depth)
    x = np.append(x, 0)
    starts, lengths = tests.array.astype(np.int64), tests.lengths.astype(np.int64)
    low, before, behind = insertion(x, array, tests.x, starts, lengths)
    longest = np.maximum(before, behind)
    reach = np.zeros(len(tests.x), np.int64)
    reach[starts] = longest
    found, hit = [], np.zeros(len(array), bool)
    for n, at, _, _ in tests.windows:
        some = np.flatnonzero(reach[at] >= n)
        size = np.full(len(some), n)
        first, last = (insertion(x, array, tests.x, at[some], size, after)[0] for after in (False, True))
        count = last - first
        slots = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        which = np.repeat(some, count)
        own = array[slots] < body
        hit[slots[own]] = True
        found.append((array[slots[own]], which[own], n))
    slots = np.flatnonzero(hit)
    # the test suffixes next to a place in the common order: the last one that belongs at it or before, and the one after
    after = np.searchsorted(low, slots, side="right")
    far = np.zeros(len(slots), np.int64)
    for side in (after - 1, after):
        ok = np.flatnonzero((side >= 0) & (side < len(starts)))
        far[ok] = np.maximum(far[ok], agreement(x, array[slots[ok]], tests.x, starts[side[ok]], lengths[side[ok]], np.zeros(len(ok), np.int64)))
    return found, array[slots], far, longest


def shard_words(tests: Tests) -> int:
    return max(SHARD_WORDS[0], min(SHARD_WORDS[1], len(tests.array)))


def search(tests: Tests, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray, int]], np.ndarray, np.ndarray]:
    """Places and lengths of all occurrences of windows in a shard; by window length (in the order of ``tests.windows``)
    the places and window numbers; places of occurrences and how long the longest matches there are, without a bound."""
    every: list[list] = [[] for _ in tests.windows]
    far_at, far = [_none()], [_none()]
    if tests.least:
        size = shard_words(tests)
        # shards of very long texts overlap by the longest item
        for k in range(0, len(numbers), size):
            found, at, n, _ = _searched(tests, numbers[k : k + size + tests.depth], size)
            far_at.append(at + k)
            far.append(n)
            for own, (places, which, size) in zip(every, found):
                own.append((places + k, which, size))
    joined = [(np.concatenate([p for p, _, _ in own] or [_none()]), np.concatenate([w for _, w, _ in own] or [_none()]), n) for own, (n, *_) in zip(every, tests.windows)]
    starts = np.concatenate([p for p, _, _ in joined] or [_none()])
    lengths = np.concatenate([np.full(len(p), n) for p, _, n in joined] or [_none()])
    return starts, lengths, joined, np.concatenate(far_at), np.concatenate(far)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str):
    """The benchmark's rows in blocks of about BLOCK_CHARS characters: what the driver holds at a time."""
    rows = pick(benchmark, **{item_col: "bigint", text_col: "string"})
    total = rows.agg(F.sum(F.length(text_col))).first()[0] or 0
    n = int(total // BLOCK_CHARS) + 1
    for b in range(n):
        own = rows if n == 1 else rows.filter(F.pmod(F.xxhash64(item_col, text_col), F.lit(n)) == b)
        yield own.distinct().toArrow()


class Shard:
    """Some documents, and what the blocks of a benchmark find in them, one after the other."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        self.row = batch.column(0)
        at, data = slices(batch.column(1))
        self.texts = [data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        self.counts = np.array([len(words_of(bytes(t))) for t in self.texts], np.int64)
        self.ends = np.cumsum(self.counts + 1)  # a 0 after each document
        self.covered, self.longest = np.zeros(int(self.ends[-1]) + 1, np.int32), np.zeros(len(self.texts), np.int32)
        self.pairs = [np.zeros((2, 0), np.int64)]

    def add(self, tests: Tests) -> None:
        numbers, number = np.zeros(int(self.ends[-1]), np.uint32), tests.number.get
        for text, n, end in zip(self.texts, self.counts.tolist(), self.ends.tolist()):
            numbers[end - 1 - n : end - 1] = [number(w, 0) for w in words_of(bytes(text))]
        starts, lengths, found, far_at, far = search(tests, numbers)
        np.add.at(self.covered, starts, 1)
        np.add.at(self.covered, starts + lengths, -1)
        np.maximum.at(self.longest, np.searchsorted(self.ends, far_at, side="right"), far)
        for (places, which, _), (_, _, ranges, of) in zip(found, tests.windows):
            d, w = np.unique(np.stack([np.searchsorted(self.ends, places, side="right"), which]), axis=1)
            n = ranges[w + 1] - ranges[w]
            own = of[np.repeat(ranges[w] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            d = np.repeat(d, n)[tests.named[own]]
            self.pairs.append(np.unique(np.stack([d, tests.ids[own[tests.named[own]]]]), axis=1))

    def result(self) -> pa.RecordBatch:
        inside = np.diff(np.concatenate([[0], np.cumsum(self.covered) > 0, [0]]).astype(np.int8))
        first, last = np.flatnonzero(inside == 1), np.flatnonzero(inside == -1)
        d, item = np.unique(np.concatenate(self.pairs, axis=1), axis=1)
        owner = np.searchsorted(self.ends, first, side="right")
        begins = (self.ends - self.counts - 1)[owner]
        split = lambda of, values: pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(self.texts) + 1)).astype(np.int32)), values)
        hits = pa.StructArray.from_arrays([pa.array((first - begins).astype(np.int32)), pa.array((last - begins).astype(np.int32))], names=["start", "stop"])
        out = pa.StructArray.from_arrays([pa.array(self.counts), split(owner, hits), split(d, pa.array(item)), pa.array(self.longest)], names=["n_words", "hits", "items", "longest"])
        return pa.RecordBatch.from_arrays([self.row, out], names=["row", "found"])


FOUND = "struct<n_words:bigint,hits:array<struct<start:int,stop:int>>,items:array<bigint>,longest:int>"


def matches(df: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keep: bool = False) -> DataFrame:
    """One row per input row: id (or with ``keep`` all columns as struct ``row``, by position ``_c0`` and so on) and
    ``found``: n_words, hits (stretches of matched words, from and to), items (ids, ascending), longest match in words.

    Words are stretches of digits, letters and bytes from 128, A-Z in lower case. An item's windows are its ``window``
    consecutive words, or all its words if it has fewer. Nulls and empty texts have no words and match nothing; items
    without an id hit but are not listed; repeated rows count as one; an empty benchmark or table matches nothing.
    """
    plain = df.toDF(*(f"_c{i}" for i in range(len(df.columns))))
    chosen = pick(df, **{id_col: "bigint", text_col: "string"})
    if keep:
        row, text = F.struct("*"), F.col(f"_c{place(df, text_col)}").cast("string")
        rows = plain.select(row.alias("row"), text.cast("binary").alias("text"))
    else:
        rows = chosen.select(F.col(id_col).alias("row"), F.col(text_col).cast("binary").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    sent = [df.sparkSession.sparkContext.broadcast(b) for b in _blocks(benchmark, item_col, item_text_col)]
    name = uuid.uuid4().hex

    def make():
        def block(k: int) -> Tests:
            """One block's arrays; where there are several, those of the block before go."""

            def build() -> Tests:
                got: pa.Table = sent[k].value
                return Tests(list(zip(got.column(0).to_pylist(), got.column(1).to_pylist())), window)

            return resident(f"tests {name} {k}", build)

        def each(batch: pa.RecordBatch):
            """A batch in shards of about as many bytes as a suffix array has words for; blocks are changed once a batch."""
            if not sizes:
                sizes.append(WORD_BYTES * (shard_words(block(0)) if sent else SHARD_WORDS[0]))
            ends = np.cumsum(np.diff(slices(batch.column(1))[0]))
            shards, first = [], 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + sizes[0], side="right")))
                shards.append(Shard(batch.slice(first, last - first)))
                first = last
            for k in range(len(sent)):
                for shard in shards:
                    shard.add(block(k))
            yield from (shard.result() for shard in shards)

        sizes: list[int] = []
        return each

    rows = arrow_map(rows, make, f"row {kind}, found {FOUND}", rows=SHARD_ROWS, keeps=f"tests {name} 0")
    return rows if keep else rows.withColumnRenamed("row", id_col)


def digests(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    names = F.array_join(F.array_sort(F.transform("found.items", lambda i: i.cast("string"))), ",")
    hit = F.aggregate("found.hits", F.lit(0).cast("bigint"), lambda x, h: x + h["stop"] - h["start"])
    return matches(documents, benchmark).select("doc_id", "found.n_words", hit.alias("n_hit"), F.size("found.items").cast("bigint").alias("n_items"), F.sha2(names.cast("binary"), 256).alias("items_sha256"), (F.size("found.hits") > 0).alias("contaminated"))


def decontaminate(df: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, all columns, of ``df`` in which no window of a benchmark item occurs; rows without a text stay, as do
    all rows if the benchmark is empty. Repeated rows and rows without an id are judged each by its text."""
    rows = matches(df, benchmark, window, id_col, text_col, keep=True).filter(F.size("found.hits") == 0)
    return rows.select(*(F.col("row")[f"_c{i}"].alias(c) for i, c in enumerate(df.columns)))
