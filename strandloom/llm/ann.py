"""Approximate nearest neighbours by largest inner product: an inverted file of coarse centroids whose residuals are
product-quantised, asymmetric distance tables, and exact reranking.

Equal vectors are one entry that carries the smallest ids of its rows, as many as a result can hold and one more, so
a very common vector is one row of one list. Centroids and codebooks are fitted on a bounded sample; every entry is
indexed. How many lists are probed is read from the true neighbours, among all entries, of some of the queries
themselves: queries may lie elsewhere than most entries. Lists are cut into blocks, as are the queries that probe one.
Of a block the nearest by code distance, and all that tie with them, are scored exactly, and only those leave it that
are no farther than the nearest of the sample that the query is sure to have.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, place, ship, stored

#: Vectors that centroids and codebooks are fitted on; codewords a part; entries and queries of a block; queries scored
#: at a time; queries whose true neighbours say how many lists all have to probe.
SAMPLE, WORDS, BLOCK, QUERY_BLOCK, QUERIES, GAUGE = 20_000, 256, 4096, 4096, 128, 512


def _means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """k-means; empty clusters take the farthest vectors."""
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near, far = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
        if (empty := np.flatnonzero(n == 0)).size:
            centres[empty] = x[np.argsort(-far)[: empty.size]]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    half = (centres * centres).sum(1) / 2
    at, far = np.empty(len(x), np.int64), np.empty(len(x), np.float32)
    for k in range(0, len(x), 4096):
        s = x[k : k + 4096] @ centres.T - half
        at[k : k + 4096] = s.argmax(1)
        far[k : k + 4096] = -s.max(1)
    return at, far


class Coder:
    """Coarse centroids and codebooks of the residuals' parts."""

    def __init__(self, sample: np.ndarray, lists: int, parts: int, seed: int = 17) -> None:
        rng = np.random.default_rng(seed)
        self.centres = _means(sample, max(1, min(lists, len(sample))), rng)
        self.width = -(-sample.shape[1] // parts)
        rest = self.cut(sample - self.centres[nearest(sample, self.centres)[0]])
        self.books = [_means(np.ascontiguousarray(rest[:, p]), min(WORDS, len(sample)), rng) for p in range(rest.shape[1])]

    def cut(self, x: np.ndarray) -> np.ndarray:
        """Vectors as parts of equal width, filled up with zeros."""
        n = -(-x.shape[1] // self.width)
        full = np.zeros((len(x), n * self.width), np.float32)
        full[:, : x.shape[1]] = x
        return full.reshape(len(x), n, self.width)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = nearest(x, self.centres)[0]
        rest = self.cut(x - self.centres[own])
        return own, np.stack([nearest(np.ascontiguousarray(rest[:, p]), b)[0].astype(np.uint8) for p, b in enumerate(self.books)], axis=1)

    def places(self, q: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """Of each query the place of one list in the order in which the query probes them, from 0."""
        near = q @ self.centres.T
        return (near > near[np.arange(len(q)), lists][:, None]).sum(1)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """Inner products of the queries' parts with all codewords: queries x parts x codewords."""
        parts, out = self.cut(q), np.zeros((len(q), len(self.books), WORDS), np.float32)
        for p, b in enumerate(self.books):
            out[:, p, : len(b)] = parts[:, p] @ b.T
        return out

    def by_codes(self, q: np.ndarray, coarse: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Scores of coded entries for queries: those of the centroids, and by the tables those of the residuals."""
        tables, out = self.tables(q), coarse.astype(np.float32)
        for p in range(codes.shape[1]):
            out += tables[:, p][:, codes[:, p]]
        return out


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float32) if len(column) else np.zeros((0, 1), np.float32)


def _doubles(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64) if len(column) else np.zeros((0, 1))


def _usable(rows: DataFrame, kind: str) -> DataFrame:
    e = F.col("e")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = rows.filter(e.isNotNull() & F.col("id").isNotNull()).filter(F.coalesce(finite, F.lit(False)) & F.exists(e, lambda x: x != 0))
    # one zero, so that equal vectors have equal keys
    rows = rows.withColumn("e", F.transform("e", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x).cast(kind)))
    sizes = rows.groupBy(F.size("e").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("e") == (sizes[0] if sizes else 0)).withColumn("h", F.xxhash64("e"))


def _best(rows: DataFrame, by: list[str], order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows of each key; Spark limits each map task's groups before the shuffle."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= most)


def _plan(index: DataFrame, asked: DataFrame) -> DataFrame:
    """list, blocks and query_blocks of each list that some query probes: as many rows as there are lists."""
    held = index.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    wanted = asked.select(F.explode("lists").alias("list")).groupBy("list").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("query_blocks"))
    return held.join(wanted, "list")


def _probes(asked: DataFrame, index: DataFrame, entries: DataFrame, coder: Coder, k: int, reach: float) -> int:
    """How many lists hold ``reach`` of the true ``k`` nearest of at most ``GAUGE`` queries, which meet all entries."""
    some = asked.orderBy(F.xxhash64(F.lit("gauge"), "q")).limit(GAUGE).toArrow()
    if not some.num_rows:
        return 1
    numbers, vectors = some["q"].to_numpy(), _doubles(some["e"].combine_chunks())
    sent = asked.sparkSession.sparkContext.broadcast(vectors)

    def nearest_of(batches):
        """Each query's nearest of a task's entries, and the places of the lists that they are in."""
        queries, held = sent.value, [np.zeros((len(sent.value), 0)), np.zeros((len(sent.value), 0), np.int64), np.zeros((len(sent.value), 0), np.int64)]
        for batch in batches:
            for s in range(0, batch.num_rows, 2048):
                part = batch.slice(s, 2048)
                own = np.broadcast_to(part.column(1).to_numpy(), (len(queries), len(part)))
                lists = np.broadcast_to(part.column(0).to_numpy().astype(np.int64), own.shape)
                held = [np.concatenate(x, axis=1) for x in zip(held, (queries @ _doubles(part.column(2)).T, own, lists))]
                if held[0].shape[1] > k + 1:
                    top = np.argpartition(held[0], -k - 1, axis=1)[:, -k - 1 :]
                    held = [np.take_along_axis(x, top, axis=1) for x in held]
        n = held[0].shape[1]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(queries)), n)), *(pa.array(x.ravel()) for x in held)], names=["i", "score", "h", "list"])

    near = _best(index.select("list", "h", "e").mapInArrow(nearest_of, "i bigint, score double, h bigint, list bigint"), ["i"], [F.desc("score"), F.col("h")], k + 1)
    hits = _best(near.join(entries, "h").select("i", "score", "list", F.explode("ids").alias("id")), ["i"], [F.desc("score"), F.col("id")], k + 1).toArrow()  # GAUGE times k + 1 rows at most
    i, other = hits["i"].to_numpy(), hits["id"].to_numpy()
    i, lists = i[other != numbers[i]], hits["list"].to_numpy()[other != numbers[i]]
    if not len(i):
        return 1
    places = np.sort(coder.places(vectors[i].astype(np.float32), lists))
    return int(places[min(len(places) - 1, int(len(places) * reach))]) + 1


def search(vectors: DataFrame, every: int = 20, k: int = 20, reach: float = 0.97, rerank: int = 512, parts: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest found of each row whose id is divisible by ``every``.

    All rows but the query's own are candidates, all if there are no more than ``k``; ties go to the smaller id.
    Null and zero vectors, those with null or non-finite components, those of another length than most, and rows
    without an id take no part, as query or candidate; of repeated rows one counts; an empty table gives an empty one.
    A query searches as many lists as hold ``reach`` of the true neighbours of ``GAUGE`` queries at most, which are
    held against all entries, and as many as hold ``rerank`` entries. Of each block of a list the ``rerank`` entries nearest by their codes, and those with the
    same codes, are scored exactly, in double precision.
    """
    double = vectors.schema.fields[place(vectors, vector_col)].dataType.simpleString() == "array<double>"
    kind = "double" if double else "float"
    rows = stored(_usable(pick(vectors, **{id_col: "bigint", vector_col: f"array<{kind}>"}).toDF("id", "e"), kind).distinct(), "vectors")
    entries = _best(rows, ["h", "e"], [F.col("id")], k + 1).groupBy("h", "e").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    entries = stored(entries, "entries")
    n = entries.count()
    share = min(1 << 30, int((1 << 30) * SAMPLE / max(1, n)) + 1)
    sample = entries.filter(F.pmod(F.xxhash64(F.lit("fit"), "h"), F.lit(1 << 30)) < share).orderBy("h").select("h", "e").limit(SAMPLE).toArrow()
    kept = 4 * (k + 1)  # of a query, before scores are summed in the order of the components
    spark, schema = vectors.sparkSession, f"query_id bigint, rank int, {id_col if id_col != 'query_id' else 'vec_id'} bigint, score double"
    if not sample.num_rows:
        return spark.createDataFrame([], schema)
    lists = int(min(4096, max(1, round(n**0.5))))
    ship(spark)
    seen = _vectors(sample["e"].combine_chunks())  # SAMPLE vectors at most
    fitted = Coder(seen, lists, parts)
    coder = spark.sparkContext.broadcast(fitted)
    # what queries are sure to have, if they probe its list: hashes, vectors and lists of the sample
    sure = spark.sparkContext.broadcast((np.sort(sample["h"].to_numpy()), _doubles(sample["e"].combine_chunks()), nearest(seen, fitted.centres)[0]))

    def coded(batches):
        for batch in batches:
            own, codes = coder.value.encode(_vectors(batch.column(1)))
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), *batch.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(np.isin(batch.column(0).to_numpy(), sure.value[0]))], names=["list", "h", "e", "first", "codes", "sure"])

    index = stored(entries.select("h", "e", F.col("ids")[0].alias("first")).mapInArrow(coded, f"list int, h bigint, e array<{kind}>, first bigint, codes binary, sure boolean"), "index")
    queries = rows.filter(F.col("id") % every == 0)
    asked = queries.groupBy("h", "e").agg(F.min("id").alias("q")).select("q", "e")
    probes = _probes(asked, index, entries, fitted, k, reach)
    filled = np.zeros(len(fitted.centres), np.int64)
    for r in index.groupBy("list").count().collect():  # as many rows as lists
        filled[r["list"]] = r["count"]

    def probed(batches):
        c = coder.value
        for batch in batches:
            q = _vectors(batch.column(1))
            near = q @ c.centres.T
            order = np.argsort(-near, axis=1, kind="stable").astype(np.int32)
            # further lists where those hold fewer entries than are scored of a block
            more = (np.cumsum(filled[order], axis=1) < max(k + 1, rerank)).sum(1) + 1
            m = np.minimum(np.maximum(probes, more), order.shape[1])
            chosen = np.arange(order.shape[1]) < m[:, None]
            exact, least = _doubles(batch.column(1)), np.full(len(q), -np.inf)
            _, held, lists_of = sure.value
            if len(held) > k:  # so many entries of these lists are at least as near
                searched = np.zeros(order.shape, bool)
                np.put_along_axis(searched, order, chosen, axis=1)
                for s in range(0, len(q), QUERIES):
                    scores = np.where(searched[s : s + QUERIES][:, lists_of], exact[s : s + QUERIES] @ held.T, -np.inf)
                    least[s : s + QUERIES] = np.partition(scores, -k - 1, axis=1)[:, -k - 1]
            wanted = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(m)]).astype(np.int32)), pa.array(order[chosen]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), wanted, pa.array(least)], names=["q", "e", "lists", "least"])

    asked = stored(asked.mapInArrow(probed, f"q bigint, e array<{kind}>, lists array<int>, least double"), "asked")
    dealt = F.broadcast(stored(_plan(index, asked), "lists"))  # as many rows as lists
    left = index.join(dealt, "list").select("list", "h", F.col("e").cast("array<double>").alias("e"), "first", "codes", "sure", F.pmod("h", F.col("blocks").cast("long")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("query_block"))
    right = asked.select("q", "e", "least", F.explode("lists").alias("list")).join(dealt, "list")
    right = right.select("list", "q", F.col("e").cast("array<double>").alias("e"), "least", F.pmod(F.xxhash64("q"), F.col("query_blocks").cast("long")).cast("int").alias("query_block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))

    def found(left: pa.Table, right: pa.Table) -> pa.Table:
        """Of one block the entries that may be among the nearest of the queries sent to it."""
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            c, centre = coder.value, coder.value.centres[left["list"][0].as_py()]
            codes = np.frombuffer(b"".join(left["codes"].to_pylist()), np.uint8).reshape(left.num_rows, -1)
            is_sure = left["sure"].to_numpy()
            h, first, asked_by, least = left["h"].to_numpy(), left["first"].to_numpy(), right["q"].to_numpy(), right["least"].to_numpy()
            x, q = _doubles(left["e"].combine_chunks()), _doubles(right["e"].combine_chunks())
            for s in range(0, len(q), QUERIES):
                own = q[s : s + QUERIES]
                if len(codes) <= rerank:
                    scores = own @ x.T
                else:
                    near, scores = own.astype(np.float32), np.full((len(own), len(codes)), -np.inf)
                    coded = c.by_codes(near, np.repeat((near @ centre)[:, None], len(codes), axis=1), codes)
                    some = (coded >= np.partition(coded, -rerank, axis=1)[:, -rerank, None]) | is_sure
                    for i, chosen in enumerate(some):
                        scores[i, chosen] = x[chosen] @ own[i]
                bound = least[s : s + QUERIES]
                if len(codes) > kept:
                    bound = np.maximum(bound, np.partition(scores, -kept, axis=1)[:, -kept])
                # sums in another order differ in the last bits
                i, j = np.nonzero((scores >= (bound - 1e-9 * np.abs(bound))[:, None]) & (scores > -np.inf))
                out.append((asked_by[s + i], h[j], first[j], scores[i, j]))
        columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
        return pa.table([pa.array(x) for x in columns], names=["q", "h", "first", "near"])

    keys = ("list", "block", "query_block")
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(found, "q bigint, h bigint, first bigint, near double")
    near = _best(near, ["q"], [F.desc("near"), F.col("first")], kept).select("q", "h")
    exact = F.aggregate(F.zip_with("e", "asked", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda x, y: x + y)
    scored = near.join(entries, "h").join(asked.select("q", F.col("e").alias("asked")), "q").select("q", exact.alias("score"), F.explode("ids").alias("id"))
    near = _best(scored, ["q"], [F.desc("score"), F.col("id")], k + 1)
    near = near.groupBy("q").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "id"))).alias("near"))  # k + 1 rows at most
    mine = queries.select("id", F.col("h"), "e").join(queries.groupBy("h", "e").agg(F.min("id").alias("q")), ["h", "e"]).select("id", "q").join(near, "q")
    mine = mine.select(F.col("id").alias("query_id"), F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, k).alias("near"))
    return mine.select("query_id", F.posexplode("near").alias("rank", "hit")).select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("hit.id").alias(id_col), (-F.col("hit.minus")).alias("score"))
