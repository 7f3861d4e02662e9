"""Windows of reads, and stretches of targets in which windows are looked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.sequences import dinucleotides

#: Letters of a target's stretch: longer targets are cut.
STRETCH = 1 << 16


def read_windows(reads: DataFrame, starts: Sequence[int], width: int, min_dinuc: int = 0, seen: Observation | None = None) -> DataFrame:
    """k, q, key, seq for each window of each read that reaches to its end and is varied enough.

    ``seen`` is told, while the rows are made, how many reads reach to the end of each window k (``reads k``), and about
    how many different keys are varied enough (``keys k``).
    """
    each = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(q).alias("q")) for k, q in enumerate(starts)))
    rows = reads.select("seq", F.inline(each)).filter(F.length("seq") >= F.col("q") + width)
    rows = rows.withColumn("key", F.substr("seq", F.col("q") + 1, F.lit(width))).withColumn("varied", dinucleotides(F.col("key")) >= min_dinuc)
    if seen is not None:
        of = range(len(starts))
        reads_of, keys_of = (F.count_if(F.col("k") == k).alias(f"reads {k}") for k in of), (F.approx_count_distinct(F.when((F.col("k") == k) & F.col("varied"), F.col("key")), 0.01).alias(f"keys {k}") for k in of)
        rows = rows.observe(seen, *reads_of, *keys_of)
    return rows.filter("varied").select("k", "q", "key", "seq")


def window_sides(windows: DataFrame, width: int) -> DataFrame:
    """The windows with what is left and right of them in their read."""
    return windows.select("k", "q", "key", F.substr("seq", F.lit(1), F.col("q")).alias("left"), F.substr("seq", F.col("q") + width + 1, F.length("seq")).alias("right"), "seq")


def window_counts(reads: DataFrame, starts: Sequence[int], width: int, strict: bool = False) -> DataFrame:
    """k and n_reads, the number of reads that are long enough for each window; with ``strict`` none is an error."""
    each = F.array(*(F.struct(F.lit(k).alias("k"), F.count_if(F.length("seq") >= q + width).alias("n_reads")) for k, q in enumerate(starts)))
    counts = reads.agg(each.alias("w")).select(F.inline("w"))
    if strict:
        counts = counts.withColumn("n_reads", F.when(F.col("n_reads") == 0, F.raise_error(F.concat(F.lit("no read is long enough for window "), F.col("k").cast("string")))).otherwise(F.col("n_reads")))
    return counts


def stretches(targets: DataFrame, width: int, before: int = 0, after: int = 0, letters: int = STRETCH) -> DataFrame:
    """tnum, start, lead, text: stretches of targets in which each window begins exactly once, at or after ``start``,
    which is letter ``lead`` of the text; with ``before`` letters to the left of it and ``after`` beyond its end, as far
    as the target goes.

    A target of at most ``letters`` letters is one stretch and stays as it is; a longer one is cut once, from left to
    right, because offsets in a long text cost time in proportion. Targets shorter than a window have none.
    """
    size = max(letters, before, width + after)
    cuts = F.when(F.length("seq") > size, F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{size}}}"), F.lit(0)))
    rows = targets.filter(F.length("seq") >= width).select("tnum", "seq", cuts.alias("cuts"))
    piece = lambda start, lead, text: F.struct(start.cast("long").alias("start"), lead.cast("int").alias("lead"), text.alias("text"))
    other = lambda i: F.coalesce(F.get("cuts", i), F.lit(""))
    cut = F.transform("cuts", lambda c, i: piece(i * size, F.when(i > 0, before).otherwise(0), F.concat(F.right(other(i - 1), F.lit(before)), c, F.left(other(i + 1), F.lit(width - 1 + after)))))
    whole = F.array(piece(F.lit(0), F.lit(0), F.col("seq")))
    return rows.select("tnum", F.inline(F.when(F.col("cuts").isNull(), whole).otherwise(cut)))


def fill_estimate(windows: DataFrame, bits: int, hashes: int) -> DataFrame:
    """k, n_keys and fill: how full a Bloom filter of each window's keys would be, by the usual formula."""
    return windows.groupBy("k").agg(F.count_distinct("key").alias("n_keys")).withColumn("fill", 1 - F.exp(-F.lit(float(hashes)) * F.col("n_keys") / F.lit(float(bits))))
