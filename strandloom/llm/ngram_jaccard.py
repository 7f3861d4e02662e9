"""Similarity join of texts by the Jaccard index of their word n-grams, with connected components of the links.

A size-aware heavy-light join. Equal sets are one node. For a pair of sets of sizes s and t the threshold asks for an
overlap of c(s, t). Where the smaller set is light (not larger than the boundary), both sets enumerate their subsets
of c(s, t) elements, and sets that share one are candidates. Where both are heavy, inverted lists are scanned. A list
belongs to a block of shingles, not to one: the shingle hashes are cut into H + 1 + z ranges, where H is the most
elements in which two linked sets of that size can differ, so linked sets agree on more than z whole ranges; a set
leaves out up to z ranges with fewer than two shingles. A shingle, passage or line that very many texts share thus
makes no long list. The boundary is where both ways cost least, by the sizes of all small sets and the lengths of
their lists.

All members of a list are joined to its least, map tasks first, so a list gives as many rows as members and a hot one
as many as map tasks to one reducer. The components of these candidates are then verified exactly, each as blocks of
bounded size, of which only those of sizes that can link meet; only a forest of the true links and each node's number of links leave a block.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import lru_cache
from itertools import combinations
from math import comb, exp, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, LOWER, Memo, anew, arrow_map, forget, mixed, pick, place, resident, slices, stored
from .components import components

_TABLE = bytes(32 if c in BLANKS else LOWER[c] for c in range(256))
#: Least and most texts, and most shingles, of a block of a candidate component. Columns of the overlap product at a
#: time. Entries held by a map task.
LEAST_TEXTS, MOST_TEXTS, BLOCK_SHINGLES, COLUMNS, HELD = 256, 2048, 1 << 20, 4096, 1 << 19
#: Texts of the sample that frequent shingles are found in, and most of these.
SAMPLE, COMMON = 50_000, 500_000
#: Cost of an entry of a list that was not measured. Largest set that may be light; bytes of texts that are looked at for
#: sets of that size.
LIST_COST, MOST_LIGHT, SHORT_BYTES = 3, 40, 768
#: Bits of the filter over candidate texts' ids.
FILTER_BITS = 1 << 26
#: What the first passes give: rows of three kinds.
ENTRY, ENTRY_NAMES = "kind tinyint, a bigint, b bigint, n int, own_check bigint", ["kind", "a", "b", "n", "own_check"]


class Plan:
    """What sizes and a threshold of ``part`` of ``whole`` (90 of 100) ask for."""

    def __init__(self, part: int, whole: int, light: int | None = None) -> None:
        self.part, self.whole = part, whole
        self.light = self.boundary({s: 1 for s in range(1, MOST_LIGHT + 1)}, {}) if light is None else light
        self.ends: list[int] = []  # last size of each band of heavy sizes
        at = self.light + 1
        while at < 1 << 40:
            self.ends.append(at * whole // part)
            at = self.ends[-1] + 1

    def overlap(self, s: int, t: int) -> int:
        return -(-self.part * (s + t) // (self.part + self.whole))

    def partners(self, s: int) -> range:
        return range(-(-self.part * s // self.whole), s * self.whole // self.part + 1)

    def subsets(self, s: int, light: int) -> list[tuple[int, int]]:
        """(partner's size, subset size) for which a set of size s enumerates subsets; equal sets are one already."""
        return [(t, c) for t in self.partners(s) if t and min(s, t) <= light and not ((c := self.overlap(s, t)) == s == t) and c <= min(s, t)]

    def boundary(self, sets: dict[int, int], lengths: dict[int, float]) -> int:
        """The boundary of least cost, from the number of sets by size and how many sets their lists hold.

        An enumerated subset costs one; a list entry as much as there are sets in its list, which it has to be held
        against, or ``LIST_COST`` where no list was measured.
        """

        def cost(light: int) -> float:
            total = 0.0
            for s, n in sets.items():
                total += n * sum(comb(s, c) for _, c in self.subsets(s, light))
                if s > light:
                    total += n * lengths.get(s, LIST_COST) * 2 * (self._differ(s * self.whole // self.part) + 3)
            return total

        return min(range(MOST_LIGHT + 1), key=lambda x: (cost(x), x))

    def _differ(self, last: int) -> int:
        """The most elements in which linked sets differ if the smaller has at most ``last``."""
        return (last + last * self.whole // self.part) * (self.whole - self.part) // (self.whole + self.part)

    def band(self, s: int) -> int:
        return bisect_left(self.ends, s)

    @lru_cache(4096)
    def ranges(self, band: int) -> tuple[int, int, int]:
        """Number of ranges, how many a set may leave out, and of how many shingles at most those are.

        A set of this size nearly always has no more such ranges than it may leave out.
        """
        least = self.ends[band - 1] + 1 if band else self.light + 1
        need = self._differ(self.ends[band]) + 1
        for few in (1, 0):
            for spare in range(2, max(3, need * 3 // 5)):
                mean = least / (need + spare)
                expected = (need + spare) * exp(-mean) * (1 + mean * few)
                if expected + 3 * expected**0.5 + 2 * (1 - few) <= spare:
                    return need + spare, spare, few
        return need + 4, 4, 0


@lru_cache(8)
def plan(part: int, whole: int, light: int | None = None) -> Plan:
    return Plan(part, whole, light)


class Shingles:
    def __init__(self, n: int) -> None:
        self.n, self.hash = n, Memo(xxhash.xxh3_64_intdigest, most=400_000)

    def of(self, text: bytes) -> np.ndarray:
        """Sorted distinct 64-bit hashes of a text's word n-grams; of all its words if they are fewer."""
        words = text.translate(_TABLE).split()
        if not words:
            return np.zeros(0, np.uint64)
        h = mixed(np.array([self.hash[w] for w in words], np.uint64))
        n = min(self.n, len(words))
        with np.errstate(over="ignore"):
            out = h[: len(h) - n + 1].copy()
            for k in range(1, n):
                out = mixed(out + h[k : len(h) - n + 1 + k] * np.uint64(0x9E3779B97F4A7C15))
            if n < self.n:
                out = mixed(out + np.uint64(n))
        return np.unique(out)


def shingles(n: int) -> Shingles:
    return resident(f"shingles {n}", lambda: Shingles(n))


def digest(own: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit digests of a set: its node, and a check that tells sets of one node apart."""
    with np.errstate(over="ignore"):
        sums = np.array([mixed(own).sum(dtype=np.uint64), mixed(own ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)])
        node, check = mixed(sums + np.uint64(len(own))).astype(np.int64).tolist()
        return node, check


def entries(own: np.ndarray, p: Plan, common: np.ndarray | None = None) -> np.ndarray:
    """Keys of the subsets and list blocks that a set goes to; ``common`` holds sorted hashes of frequent shingles.

    Whether a range may be left out depends on its content alone, so linked sets agree about the ranges they agree on.
    """
    s, out = len(own), []
    spread = mixed(own ^ np.uint64(0xD6E8FEB86659FD93))
    with np.errstate(over="ignore"):
        if s * p.part // p.whole <= p.light:  # some partner may be light
            total = spread.sum(dtype=np.uint64)
            for t, c in p.subsets(s, p.light):
                gone = np.array([sum(x) & 0xFFFFFFFFFFFFFFFF for x in combinations(spread.tolist(), s - c)], np.uint64)
                out.append(mixed(total - gone + np.uint64(min(s, t) * 1000003 + max(s, t))))
        if s > p.light:
            rare = None
            if common is not None and len(common):
                known = common[np.minimum(np.searchsorted(common, own), len(common) - 1)] == own
                rare = np.concatenate([[0], np.cumsum(~known)])
            band = p.band(s)
            for b in (band, band - 1):
                if b < 0:
                    continue
                ranges, spare, few = p.ranges(b)
                part = ((own >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)  # ascends as the hashes do
                at = np.searchsorted(part, np.arange(ranges + 1, dtype=np.uint64))
                n = np.diff(at)
                sums = np.concatenate([[np.uint64(0)], np.cumsum(spread, dtype=np.uint64)])
                keys = mixed(sums[at[1:]] - sums[at[:-1]] + mixed(np.arange(ranges, dtype=np.uint64) + np.uint64((b + 1) << 32)) + n.astype(np.uint64))
                full = n > few
                if rare is not None:  # ranges of frequent shingles alone are weak too
                    full &= rare[at[1:]] > rare[at[:-1]]
                out.append(keys[full] if (~full).sum() <= spare else keys)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _runs(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys' places of first entries, and of all entries the first node of their key."""
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    return first, nodes[np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))], keys


def common_shingles(rows: DataFrame, n: int) -> np.ndarray:
    """Hashes of shingles that several texts of a bounded sample have: at most COMMON of them, the most frequent first.

    They only tell which ranges of a set are worth a list; the join is exact whatever they are.
    """
    share = min(1 / 16, SAMPLE / max(1, rows.count()))
    few = rows.filter(F.pmod(F.xxhash64(F.lit("common"), F.col("id")), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    def make():
        of = shingles(n).of

        def each(batch: pa.RecordBatch):
            at, data = slices(batch.column(1))
            sets = [of(bytes(data[x:y])) for x, y in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).astype(np.int64))], names=["s"])

        return each

    seen = arrow_map(few.select("id", "text"), make, "s bigint", keeps=f"shingles {n}").groupBy("s").count().filter("count >= 3")
    found = seen.orderBy(F.desc("count"), "s").limit(COMMON).select("s").toArrow()
    return np.sort(found["s"].to_numpy().astype(np.uint64)) if found.num_rows else np.zeros(0, np.uint64)


def measured(rows: DataFrame, n: int, part: int, whole: int) -> tuple[dict[int, int], dict[int, float]]:
    """Of all sets of at most ``MOST_LIGHT`` shingles: how many distinct ones have each size, and how many sets the
    lists of a set of that size hold on average. Texts of over ``SHORT_BYTES`` bytes count as large."""

    def make():
        every, of = plan(part, whole, 0), shingles(n).of

        def each(batch: pa.RecordBatch):
            at, data = slices(batch.column(0))
            size, node, key = [], [], []
            for x, y in zip(at[:-1].tolist(), at[1:].tolist()):
                own = of(bytes(data[x:y]))
                if 0 < len(own) <= MOST_LIGHT:
                    k = entries(own, every)
                    size.append(np.full(len(k), len(own)))
                    node.append(np.full(len(k), digest(own)[0]))
                    key.append(k.astype(np.int64))
            if size:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(size).astype(np.int32)), pa.array(np.concatenate(node)), pa.array(np.concatenate(key))], names=["s", "node", "key"])

        return each

    short = rows.filter(F.octet_length("text") <= SHORT_BYTES).select("text")
    found = stored(arrow_map(short, make, "s int, node bigint, key bigint", keeps=f"shingles {n}").distinct(), "short-sets")
    lists = found.groupBy("s", "key").agg(F.count("*").cast("double").alias("c"))
    got = lists.groupBy("s").agg((F.sum(F.col("c") * F.col("c")) / F.sum("c")).alias("length"))
    lengths = {r["s"]: r["length"] for r in got.collect()}  # MOST_LIGHT rows
    sets = {r["s"]: r["count"] for r in found.select("s", "node").distinct().groupBy("s").count().collect()}
    forget(rows.sparkSession, found)
    return sets, lengths


def _nodes_and_entries(rows: DataFrame, n: int, part: int, whole: int) -> DataFrame:
    """kind 0: a = node, b = id, n, own_check; kind 1: a = key, b = node; kind 2: a = node, b = node of a candidate."""
    # for higher thresholds ranges hold so many shingles that frequent ones hardly ever fill one
    common = common_shingles(rows, n) if 100 * part < 88 * whole else np.zeros(0, np.uint64)
    sent = rows.sparkSession.sparkContext.broadcast(common)
    light = plan(part, whole, 0).boundary(*measured(rows, n, part, whole))

    def make():
        own_plan, of, seen = plan(part, whole, light), shingles(n).of, set()
        keys, nodes, held = [], [], [0]

        def batch_of(kind: int, a, b, size=None, check=None) -> pa.RecordBatch:
            none = np.zeros(len(a), np.int64)
            columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(none if size is None else size, pa.int32()), pa.array(none if check is None else check, pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int8)), *columns], names=ENTRY_NAMES)

        def flush():
            if not keys:
                return
            k, d = np.concatenate(keys).astype(np.int64), np.concatenate(nodes)
            keys.clear(), nodes.clear()
            held[0] = 0
            order = np.lexsort((d, k))
            first, hub, k = _runs(k[order], d[order])
            d = d[order]
            yield batch_of(1, k[first], d[first])
            if len(pairs := np.unique(np.stack([d[hub != d], hub[hub != d]]), axis=1).T):
                yield batch_of(2, pairs[:, 0], pairs[:, 1])

        def each(batch: pa.RecordBatch):
            at, data = slices(batch.column(1))
            ids, a, size, check = batch.column(0).to_pylist(), [], [], []
            for i, (x, y) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                own = of(bytes(data[x:y]))
                d, c = digest(own)
                a.append(d)
                check.append(c)
                size.append(len(own))
                if len(own) and ids[i] is not None and (d, c) not in seen:
                    seen.add((d, c))
                    if len(k := entries(own, own_plan, sent.value)):
                        keys.append(k)
                        nodes.append(np.full(len(k), d, np.int64))
                        held[0] += len(k)
            yield batch_of(0, a, ids, size, check)
            if held[0] > HELD:
                yield from flush()

        each.finish = flush
        return each

    return arrow_map(rows, make, ENTRY, keeps=f"shingles {n}")


def _joined_lists(rows: DataFrame) -> DataFrame:
    """Entries of equal keys, dealt by key and sorted, become candidates; other rows pass."""
    dealt = rows.repartition(F.when((F.col("kind") == 1) | F.col("b").isNull(), F.col("a")).otherwise(F.col("b"))).sortWithinPartitions("kind", "a", "b")

    def make():
        last = [None, 0]  # key and first node of the list at hand

        def each(batch: pa.RecordBatch):
            lists = batch.column(0).to_numpy() == 1
            if not lists.all():
                yield batch.filter(pa.array(~lists))
            if not lists.any():
                return
            keys, nodes = (batch.filter(pa.array(lists)).column(k).to_numpy() for k in (1, 2))
            _, hub, _ = _runs(keys, nodes)
            if keys[0] == last[0]:
                hub[: np.searchsorted(keys, keys[0], side="right")] = last[1]
            last[:] = keys[-1], hub[-1]
            pairs = np.unique(np.stack([nodes[hub != nodes], hub[hub != nodes]]), axis=1).T
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), 2, np.int8)), pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(np.zeros(len(pairs), np.int32)), pa.array(np.zeros(len(pairs), np.int64))], names=ENTRY_NAMES)

        return each

    return arrow_map(dealt, make, ENTRY, rows=1 << 20)


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets, by products of bounded width over shared elements."""
    flat_l, flat_r = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(flat_l, flat_r)
    out = np.zeros((len(left), len(right)), np.float32)

    def placed(sets: list[np.ndarray], flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(shared, flat)
        ok = shared[np.minimum(at, len(shared) - 1)] == flat
        return np.repeat(np.arange(len(sets)), [len(x) for x in sets])[ok], at[ok]

    if not len(shared):
        return out
    (row_l, col_l), (row_r, col_r) = placed(left, flat_l), placed(right, flat_r)
    for k in range(0, len(shared), COLUMNS):
        m = min(COLUMNS, len(shared) - k)
        parts = []
        for sets, row, col in ((left, row_l, col_l), (right, row_r, col_r)):
            own = (col >= k) & (col < k + m)
            part = np.zeros((len(sets), m), np.float32)
            part[row[own], col[own] - k] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out


def linked(left: list[np.ndarray], right: list[np.ndarray], part: int, whole: int) -> np.ndarray:
    both = overlaps(left, right).astype(np.float64)
    size = np.array([len(x) for x in left], np.float64)[:, None] + np.array([len(x) for x in right], np.float64)[None, :]
    return whole * both >= part * (size - both)


def forest(links: np.ndarray) -> np.ndarray:
    """For each node of a symmetric matrix the first node of its component."""
    root = np.full(len(links), -1)
    for i in range(len(links)):
        if root[i] < 0:
            root[i], front = i, np.array([i])
            while len(front):
                front = np.flatnonzero(links[front].any(0) & (root < 0))
                root[front] = i
    return root


def _verified(blocks: DataFrame, n: int, part: int, whole: int) -> DataFrame:
    """Rows root, i, j, side, node, times, text, grouped by root, i and j: kind 0: a, b = nodes of a forest of links; kind 1: a = node, b = links."""

    def make():
        group: list = []
        of = shingles(n).of

        def done():
            if len(group) < 2:
                group.clear()
                return
            side = np.array([r[3] for r in group])
            nodes, times = np.array([r[4] for r in group], np.int64), np.array([r[5] for r in group], np.int64)
            sets = [r[6] for r in group]
            many = len(group)
            if group[0][1] == group[0][2]:
                full = linked(sets, sets, part, whole)
                full[np.arange(many), np.arange(many)] = False
            else:
                x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
                full = np.zeros((many, many), bool)
                if len(x) and len(y):
                    cross = linked([sets[i] for i in x], [sets[i] for i in y], part, whole)
                    full[np.ix_(x, y)], full[np.ix_(y, x)] = cross, cross.T
            group.clear()
            if not full.any():
                return
            root, counts = forest(full), full.astype(np.float64) @ times
            at, some = np.flatnonzero(root != np.arange(many)), np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array([0, 1], np.int8), [len(at), len(some)])), pa.array(np.concatenate([nodes[at], nodes[some]])), pa.array(np.concatenate([nodes[root[at]], counts[some].astype(np.int64)]))], names=["kind", "a", "b"])

        def each(batch: pa.RecordBatch):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and row[:3] != group[0][:3]:
                    yield from done()
                if not group or row[4] != group[-1][4]:  # a repeated row gives its set twice
                    group.append((*row[:6], of(row[6])))

        each.finish = done
        return each

    dealt = blocks.select("root", "i", "j", "side", "node", "times", "text").repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "side", "node")
    return arrow_map(dealt, make, "kind tinyint, a bigint, b bigint", keeps=f"shingles {n}")


def _texts(documents: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """id, node, own_check and text of the texts whose ids may be in ``wanted`` (column id): a filter of fixed size decides.

    A shuffle compresses texts; packed hashes take about twice the room of their text and don't give way.
    """
    place = F.pmod(F.xxhash64(F.col("id")), F.lit(FILTER_BITS))
    bits = wanted.select(place.alias("p")).groupBy(F.expr("bitmap_bucket_number(p + 1)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p + 1))").alias("bits")).collect()
    whole = np.zeros(FILTER_BITS // 8 + 8192, np.uint8)
    width = 4096
    for r in bits:
        whole[(r["bucket"] - 1) * width : r["bucket"] * width] |= np.frombuffer(bytes(r["bits"]).ljust(width, b"\0"), np.uint8)
    # place p is bit p % 32768 of bucket p / 32768 + 1, least significant bit first
    sent = documents.sparkSession.sparkContext.broadcast(whole)

    def make():
        of = shingles(n).of

        def each(batch: pa.RecordBatch):
            p = batch.column(2).to_numpy(zero_copy_only=False)
            hit = np.flatnonzero(sent.value[p >> 3] >> (p & 7).astype(np.uint8) & 1)
            if not len(hit):
                return
            batch = batch.take(pa.array(hit))
            at, data = slices(batch.column(1))
            both = np.array([digest(of(bytes(data[x:y]))) for x, y in zip(at[:-1].tolist(), at[1:].tolist())], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(both[:, 0]), pa.array(both[:, 1]), batch.column(1)], names=["id", "node", "own_check", "text"])

        return each

    rows = documents.filter(F.col("id").isNotNull()).select("id", "text", place.alias("p"))
    return arrow_map(rows, make, "id bigint, node bigint, own_check bigint, text binary", keeps=f"shingles {n}")


def _placed(members: DataFrame, part: int, whole: int) -> DataFrame:
    """Members of candidate components with the band of their size, the number of blocks of their component there, and
    in the bands before and after.

    Sets that link are in one band or in neighbouring ones, so blocks of other bands never meet. A band is wider than
    the threshold asks for by a millionth, more than logarithms are off.
    """
    width = log(max(whole / part, 1.0001)) * (1 + 1e-6)
    members = members.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / width))
    texts = F.least(F.lit(MOST_TEXTS), F.greatest(F.lit(LEAST_TEXTS), F.sqrt(32.0 * F.count("*"))))
    blocks = members.groupBy("root", "band").agg(F.greatest(F.ceil(F.count("*") / texts), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    blocks = stored(blocks, "blocks")
    beside = lambda step, name: blocks.select("root", (F.col("band") - step).alias("band"), F.col("blocks").alias(name))
    known = blocks.join(beside(1, "blocks_after"), ["root", "band"], "left").join(beside(-1, "blocks_before"), ["root", "band"], "left").fillna(0)
    known = known.select(anew("root").alias("of"), F.col("band").alias("of_band"), "blocks", "blocks_after", "blocks_before")
    return members.join(known, (F.col("root") == F.col("of")) & (F.col("band") == F.col("of_band"))).drop("of", "of_band")


def join(df: DataFrame, n: int = 5, part: int = 80, whole: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id reachable by links, its own included), n_links.

    Texts link when ``whole`` times their shared n-grams is at least ``part`` times all of theirs; n_links counts the
    other rows that a row links with. Null and empty texts and those without words have no shingles and link with
    nothing, rows without an id neither (their component is null); equal texts and repeated rows link with each other;
    ties go to the smaller id; an empty table gives an empty one; other columns are left out.
    """
    rows = pick(df, **{id_col: "bigint", text_col: "string"}).toDF("id", "text")
    return _linked(rows, n, part, whole).select(F.col("id").alias(id_col), "n_shingles", "component_id", "n_links")


def _linked(rows: DataFrame, n: int, part: int, whole: int) -> DataFrame:
    """What ``join`` gives for rows id, text, and the digests of the set and root (of the component; null where nothing can link) of each."""
    texts = rows.withColumn("text", F.col("text").cast("binary"))
    found = stored(_joined_lists(_nodes_and_entries(texts, n, part, whole)), "jaccard")
    docs = stored(found.filter("kind = 0").select(F.col("a").alias("digest"), "own_check", F.col("b").alias("id"), F.col("n").cast("bigint").alias("n_shingles")), "documents")
    # different sets of one 64-bit digest are nodes of their own, which share its candidates
    nodes = docs.filter("n_shingles > 0 and id is not null").groupBy("digest", "own_check").agg(F.min("id").alias("id"), F.count("*").alias("times"), F.min("n_shingles").alias("n"))
    first = F.min("own_check").over(Window.partitionBy("digest")) == F.col("own_check")
    nodes = nodes.withColumn("node", F.when(first, F.col("digest")).otherwise(F.xxhash64("digest", "own_check")))
    nodes = stored(nodes, "nodes")
    # candidates: components of shared subsets and lists, in blocks of bounded size
    candidates = components(found.filter("kind = 2").select("a", "b"), "candidates")
    forget(rows.sparkSession, found)
    members = stored(candidates.withColumnRenamed("node", "digest").join(nodes, "digest"), "members")
    placed = _placed(members, part, whole)
    # the small tables first: texts are dealt twice only, by id and by block
    known = _texts(texts, members.select("id"), n).withColumnRenamed("node", "digest")
    members = placed.join(known, ["id", "digest", "own_check"])
    code = lambda band, block: F.shiftleft(band, 32) + block
    mine, band = F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")), F.col("band")
    others = lambda count, pair: F.transform(F.when(F.col(count) > 0, F.sequence(F.lit(0).cast("long"), F.col(count).cast("long") - 1)).otherwise(F.array().cast("array<bigint>")), pair)
    pair = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), side.alias("side"))
    within = others("blocks", lambda x: pair(code(band, F.least(F.col("mine"), x)), code(band, F.greatest(F.col("mine"), x)), (F.col("mine") > x).cast("int")))
    after = others("blocks_after", lambda x: pair(code(band, F.col("mine")), code(band + 1, x), F.lit(0)))
    before = others("blocks_before", lambda x: pair(code(band - 1, x), code(band, F.col("mine")), F.lit(1)))
    pairs = members.withColumn("mine", mine).select("root", "node", "times", "text", F.inline(F.concat(within, after, before)))
    true = stored(_verified(pairs, n, part, whole), "links")
    links = true.filter("kind = 1").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("links"))
    least = nodes.join(components(true.filter("kind = 0").select("a", "b"), "components"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = least.groupBy("root").agg(F.min("id").alias("component_id"))
    classes = least.join(ids.select(anew("root").alias("of"), "component_id"), F.col("root") == F.col("of")).join(links, "node", "left")
    classes = classes.select(anew("digest").alias("of"), F.col("own_check").alias("of_check"), "node", "root", "component_id", (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    same = (F.col("digest") == F.col("of")) & (F.col("own_check") == F.col("of_check"))
    columns = ["id", "digest", "own_check", "root", "n_shingles", "component_id", "n_links"]
    linkable = docs.filter("n_shingles > 0 and id is not null").join(classes, same).select(*columns)
    alone = docs.filter("n_shingles = 0 or id is null").withColumns({"root": F.lit(None).cast("bigint"), "component_id": F.col("id"), "n_links": F.lit(0).cast("bigint")}).select(*columns)
    return linkable.unionByName(alone)


def deduplicate(df: DataFrame, n: int = 5, part: int = 80, whole: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, all columns, of ``df``, one of each group: of those with its least id one; rows that link with nothing stay.

    Of repeated rows one stays. Rows of one id are judged each by its own text. Rows without an id link with nothing
    (see ``join``), so all of them stay, whatever their text; so do all without a word.
    """
    at, text_at = place(df, id_col), place(df, text_col)
    plain = df.toDF(*(f"_c{i}" for i in range(len(df.columns))))
    key = plain[f"_c{at}"].cast("bigint")
    linked = _linked(pick(df, **{id_col: "bigint", text_col: "string"}).toDF("id", "text"), n, part, whole).filter(F.col("id").isNotNull())
    least = F.col("component_id") == F.col("id")
    ids = linked.groupBy("id").agg(F.count("*").alias("times"), F.max(least).alias("least"), F.max(F.col("root").isNotNull()).alias("links"))
    ids = stored(ids.select("id", "least", (F.col("least") & F.col("links") & (F.col("times") > 1)).alias("shared")), "ids")
    alone = ids.filter("least and not shared").select("id")
    # of most rows a filter tells that they stay; only those that may go are dealt by id
    clear, unclear = _apart(plain, key, ids.filter("not least or shared").select("id"))
    kept = clear.unionByName(unclear.join(alone, key == F.col("id"), "left_semi"))
    if not (shared := ids.filter("shared").select("id")).isEmpty():
        mine = linked.join(shared, "id", "left_semi").filter(least).select(F.col("id").alias("of"), F.col("digest").alias("own"), F.col("own_check").alias("check"), "root").distinct()
        rows = unclear.join(shared, key == F.col("id"), "left_semi").select(F.struct("*").alias("row"), key.alias("id"), F.col(f"_c{text_at}").cast("string").cast("binary").alias("text"))
        rows = _with_nodes(rows, n).withColumn("order", F.struct(F.xxhash64("row.`_c%d`" % text_at), F.monotonically_increasing_id()))
        rows = rows.join(mine, (F.col("id") == F.col("of")) & (F.col("node") == F.col("own")) & (F.col("own_check") == F.col("check")))
        # map tasks choose first, so a row repeated very often is no long group
        one = rows.filter("root is not null").groupBy("root").agg(F.min_by("row", "order").alias("row")).select("row")
        kept = kept.unionByName(one.unionByName(rows.filter("root is null").select("row")).select("row.*"))
    return kept.toDF(*df.columns)


def _apart(rows: DataFrame, key: Column, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key is surely not in ``ids`` (column id) or null, and the others: a filter of fixed size decides."""
    of = lambda x: F.pmod(F.xxhash64(x), F.lit(FILTER_BITS)) + 1
    p = of(F.col("id"))
    bits = ids.select(F.bitmap_bucket_number(p).alias("bucket"), F.bitmap_bit_position(p).alias("bit")).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    bits = F.broadcast(stored(bits, "filter"))  # at most FILTER_BITS, 32,768 a row
    p = of(key)
    bit = F.bitmap_bit_position(p)
    byte = F.conv(F.hex(F.substring("bits", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), bit.bitwiseAND(F.lit(7)).cast("int"))) != 0, F.lit(False))
    marked = rows.join(bits, F.bitmap_bucket_number(p) == F.col("bucket"), "left").withColumn("hit", hit & key.isNotNull())
    return marked.filter(~F.col("hit")).select(*rows.columns), marked.filter("hit").select(*rows.columns)


def _with_nodes(rows: DataFrame, n: int) -> DataFrame:
    """row, id, node and own_check (digests of the text's set) of rows row, id, text."""

    def make():
        of = shingles(n).of

        def each(batch: pa.RecordBatch):
            at, data = slices(batch.column(2))
            both = np.array([digest(of(bytes(data[x:y]))) for x, y in zip(at[:-1].tolist(), at[1:].tolist())], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both[:, 0]), pa.array(both[:, 1])], names=["row", "id", "node", "own_check"])

        return each

    return arrow_map(rows, make, f"row {rows.schema['row'].dataType.simpleString()}, id bigint, node bigint, own_check bigint", keeps=f"shingles {n}")
