"""What five filters remove, alone, together and in every order, by inclusion and exclusion.

Each text fails or passes five filters, named A to E. For all 32 sets of filters the number of documents that fail
every one of a set is aggregated as a sum of products of flags, by part of the corpus. From these joint counts a Moebius
inversion gives the rest without a further look at a document: what survives any set of filters (hence any order of
them), what only one filter catches, and the Shapley value as the sum of the Harsanyi dividends of the sets that a
filter belongs to, each shared evenly among its members.

Equal texts share their flags, so documents are counted by text before anything else is asked of them: a text that
very many documents have is one row a task. The least id that has a text is found among such rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import permutations
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick

FILTERS = "ABCDE"
SETS = 1 << len(FILTERS)
#: How many shares of a document the Shapley value of one is given in: in all orders together, each filter is met so often.
ORDERS = 120
#: The blanks that end a word, and the signs that a text of filter D holds.
BLANKS, SIGNS = " \t\n\x0b\x0c\r", "#$%&*|"


def flags(text: Column) -> dict[str, Column]:
    """1 where a text fails, for the filters that look at the text alone: few words, repeated words, capitals, signs."""
    inner = F.btrim(text, F.lit(BLANKS))
    words = F.split(inner, "[\\x20\\x09-\\x0D]+", -1)
    n = F.when(inner == "", 0).otherwise(F.size(words)).cast("long")
    different = F.when(inner == "", 0).otherwise(F.size(F.array_distinct(words))).cast("long")
    capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("long")
    return {
        "A": (n < 50).cast("long"),
        "B": (100 * different < 65 * n).cast("long"),
        "C": (100 * capitals > 5 * F.length(text)).cast("long"),
        "D": reduce(lambda a, b: a | b, (F.contains(text, F.lit(s)) for s in SIGNS)).cast("long"),
    }


def failures(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", good_col: str = "quality", bad_col: str = "toxic") -> DataFrame:
    """part, A to E (0 or 1), good, toxic and n: how many documents of each kind fail just these filters."""
    rows = pick(documents, **{id_col: "bigint", text_col: "string", part_col: "string"}).toDF("id", "text", "part")
    text = F.coalesce("text", F.lit(""))
    rows = rows.select("id", F.coalesce("part", F.lit("")).alias("part"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), *(c.alias(k) for k, c in flags(text).items()))
    kind = ["digest", "part", *FILTERS[:4]]
    rows = rows.groupBy("id", *kind).agg(F.count("*").alias("n"))
    marks = pick(labels, **{id_col: "bigint", good_col: "int", bad_col: "int"}).toDF("id", "good", "toxic").filter("id is not null")
    marks = marks.groupBy("id").agg(F.coalesce(F.max(F.col("good") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    # rows without an id have no label: they would all meet in one task of the join
    known, unknown = rows.filter("id is not null").join(marks, "id", "left"), rows.filter("id is null").withColumns({"good": F.lit(None).cast("boolean"), "toxic": F.lit(None).cast("boolean")})
    mark = lambda c: F.coalesce(c, F.lit(False)).cast("long").alias(c)
    rows = known.unionByName(unknown).select("id", *kind, mark("good"), mark("toxic"), "n")
    least = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n")))
    rows = rows.groupBy(*kind, "good", "toxic").agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("loose"), least.alias("least"))
    # of one text there are at most as many rows as parts and kinds of labels
    rows = rows.withColumn("first", F.min("least.id").over(Window.partitionBy("digest")))
    original = F.col("loose") + F.when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(0)
    both = F.array(F.struct(F.lit(0).cast("long").alias("E"), original.alias("n")), F.struct(F.lit(1).cast("long").alias("E"), (F.col("n") - original).alias("n")))
    rows = rows.select("part", *FILTERS[:4], "good", "toxic", F.inline(both)).filter("n > 0")
    return rows.groupBy("part", *FILTERS, "good", "toxic").agg(F.sum("n").alias("n"))


def members(subset: int) -> list[int]:
    return [k for k in range(len(FILTERS)) if subset >> k & 1]


def joint_counts(failed: DataFrame) -> DataFrame:
    """part, and for each of the 32 sets how many documents, good ones and toxic ones fail all filters of it."""
    weights = {"every": "n", "good": "n * good", "toxic": "n * toxic"}
    sums = {f"{name}{s}": " * ".join([weight, *(FILTERS[k] for k in members(s))]) for name, weight in weights.items() for s in range(SETS)}
    return failed.groupBy("part").agg(*(F.expr(f"sum({product})").alias(k) for k, product in sums.items()))


def _signed(name: str, sets: list[int], weight: Callable[[int], int]) -> str:
    return " + ".join(f"{name}{s} * {weight(len(members(s)))}L" for s in sets)


def _survivors(name: str) -> Column:
    """For each set of filters how many documents fail none of it: the joint counts of its subsets, odd ones taken off."""
    of_sets = (_signed(name, [s for s in range(SETS) if s & m == s], lambda k: (-1) ** k) for m in range(SETS))
    return F.expr(f"array({', '.join(of_sets)})")


def _of_filters(weight: Callable[[int], int]) -> Column:
    """For each filter the weighted joint counts of the sets that it belongs to."""
    of_filters = (_signed("every", [s for s in range(SETS) if s >> f & 1], weight) for f in range(len(FILTERS)))
    return F.expr(f"array({', '.join(of_filters)})")


def audit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", good_col: str = "quality", bad_col: str = "toxic") -> DataFrame:
    """One row for each part, order of the filters and step: filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley.

    Null texts are empty, null parts the empty text. A document repeats another if a smaller id anywhere has its text;
    a row without an id repeats none and is repeated by none; rows of one id and text count each, and are alike. A
    document is good (toxic) if any row of ``labels`` for its id says so; labels of no document and rows without an id
    count for nothing. Extra columns do no harm, whatever their names; an empty table gives an empty one.
    """
    counts = joint_counts(failures(documents, labels, id_col, text_col, part_col, good_col, bad_col))
    rows = counts.select(
        "part",
        _survivors("every").alias("left"), _survivors("good").alias("good"), _survivors("toxic").alias("toxic"),
        F.array(*(f"every{1 << f}" for f in range(len(FILTERS)))).alias("failing"),
        _of_filters(lambda k: (-1) ** (k - 1)).alias("alone"),
        # a dividend is the joint count with its sign, and a member's share of it a k-th
        _of_filters(lambda k: (-1) ** (k - 1) * (ORDERS // k)).alias("shapley"),
        F.explode(F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))).alias("filter_order"),
    )
    rows = rows.withColumn("step", F.explode(F.array(*(F.lit(k) for k in range(1, len(FILTERS) + 1)))))
    before = reduce(add, (F.when(F.instr("filter_order", f) < F.col("step"), 1 << k).otherwise(0) for k, f in enumerate(FILTERS)))
    own = F.ascii(F.substr("filter_order", F.col("step"), F.lit(1))) - ord("A")
    rows = rows.withColumns({"before": before, "own": own})
    rows = rows.withColumn("after", F.col("before") + F.element_at(F.array(*(F.lit(1 << k) for k in range(len(FILTERS)))), F.col("own") + 1))
    lost = lambda c: F.get(c, F.col("before")) - F.get(c, F.col("after"))
    return rows.select(
        "part", "filter_order", "step", F.get("left", F.col("after")).alias("kept"), lost("left").alias("removed"), (F.get("failing", F.col("own")) - lost("left")).alias("redundant"),
        F.get("alone", F.col("own")).alias("unique_fails"), lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), F.get("shapley", F.col("own")).alias("shapley"),
    )
