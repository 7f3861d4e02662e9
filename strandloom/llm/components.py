"""Connected components by contraction and alternating stars.

Edges are contracted within partitions, a bounded number at a time, to a forest of those that a partition holds. The
partitions are then made fewer, as many as hold ``HELD`` edges each, and contracted again for as long as that halves the
edges; no more than ``HELD`` go to a single task, which ends the work. Where nodes are too many for that, rounds of stars
follow: each links every node's larger neighbours, then its smaller ones, to the least of them, and contracts again.
Rounds grow with the logarithm of the number of nodes; every intermediate edge set is written to the shared folder. A
node with very many neighbours is no long group: map tasks take minima first, and joins to them can be split (``anew``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import anew, arrow_map, forget, stored

#: Edges that a task holds.
HELD = 1 << 20


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of an edge list and the least node that each reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while len(x):
        least = np.minimum(label[x], label[y])
        before = label.copy()
        # the roots of both ends, and the ends, go to the lesser root
        for ends in (label[x], label[y], x, y):
            np.minimum.at(label, ends, least)
        label = label[label]
        if np.array_equal(label, before):
            break
    return nodes, nodes[label]


def _contracted(dealt: DataFrame) -> DataFrame:
    """Each partition's edges, ``HELD`` at a time, as stars around the least nodes: fewer rows than there are nodes."""

    def make():
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def contract():
            nodes, least = roots(*(np.concatenate(x) for x in zip(*held)))
            own = nodes != least
            held[:] = [(nodes[own], least[own])]

        def finish():
            if held:
                contract()
                a, b = held.pop()
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        def each(batch: pa.RecordBatch):
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            if sum(len(a) for a, _ in held) > HELD:
                contract()
                if len(held[0][0]) > HELD // 2:
                    yield from finish()

        each.finish = finish
        return each

    return arrow_map(dealt, make, "a bigint, b bigint", rows=1 << 20)


def _star(edges: DataFrame) -> DataFrame:
    """One large star and one small star: edges (a, b) with b < a."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(anew("a").alias("u"), F.least("m", "a").alias("m"))
    # large: each larger neighbour goes to the least of the neighbourhood
    large = both.join(least, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    # small: each smaller neighbour and the node itself go to the least smaller neighbour
    small = large.groupBy("a").agg(F.min("b").alias("m"))
    joined = large.join(small.select(anew("a").alias("u"), "m"), F.col("a") == F.col("u"))
    return joined.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, what: str) -> DataFrame:
    """node and root (the least node that it reaches) of all nodes of an edge list a, b of integers; loops are dropped."""
    spark = edges.sparkSession
    edges = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    state = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    now, k = stored(_contracted(edges.repartition("a")), f"{what}-0"), 0

    def replaced(after: DataFrame) -> tuple:
        """Writes the next edge set in the place of the present one."""
        nonlocal now, k
        k += 1
        after = stored(after, f"{what}-{k}")
        forget(spark, now)
        now = after
        return state(now)

    def narrowed(found: tuple) -> tuple:
        """Contracts in ever fewer partitions; stars around the least nodes, as components end, stay as they are."""
        while found[0] > HELD:
            before, found = found[0], replaced(_contracted(now.repartition(-(-found[0] // max(1, HELD)), "a", "b")))
            if 2 * found[0] > before:
                break
        return found

    before = narrowed(state(now))
    while before[0] > HELD:
        if (reached := narrowed(replaced(_star(now)))) == before:
            break
        before = reached
    if 0 < before[0] <= HELD:
        replaced(_contracted(now.repartition(1)))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
