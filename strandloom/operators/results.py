"""Names of targets and reads, reads without a match, and what one asks of a result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import dinucleotides
from . import scan


def with_target_names(matches: DataFrame, targets: DataFrame) -> DataFrame:
    """seq, tseq, pos, nmiss, name, tlen."""
    return matches.join(targets.select("tnum", "name", "tlen"), "tnum").select("seq", "tseq", "pos", "nmiss", "name", "tlen")


def with_read_names(named: DataFrame, reads: DataFrame) -> DataFrame:
    """The eight columns of a result."""
    return named.join(reads.select("seq", "n", "names"), "seq").select("seq", "tseq", "pos", "nmiss", "name", "tlen", "n", "names")


def nonmatching(reads: DataFrame, result: DataFrame) -> DataFrame:
    """names, seq and qual of the distinct reads that have no match."""
    return reads.join(result.select("seq"), "seq", "left_anti").select("names", "seq", F.repeat(F.lit("!"), F.length("seq")).alias("qual"))


def matched_reads(result: DataFrame) -> DataFrame:
    return result.agg(F.count_distinct("seq").alias("n_reads"))


def matched_targets(result: DataFrame) -> DataFrame:
    return result.agg(F.count_distinct("name").alias("n_targets"))


def unmatched_names(reads: DataFrame, result: DataFrame) -> DataFrame:
    """names of distinct reads that no result row has, as a set difference."""
    return reads.select("names").subtract(result.select("names"))


def unknown_reads(result: DataFrame, reads: DataFrame) -> DataFrame:
    """Result rows whose sequence is no read's: none, if the result is right."""
    return result.join(reads.select("seq"), "seq", "left_anti")


def verified_reads(result: DataFrame, reads: DataFrame) -> DataFrame:
    """Result rows whose sequence is a read's."""
    return result.join(reads.select("seq"), "seq", "left_semi")


def verified_targets(matches: DataFrame, targets: DataFrame) -> DataFrame:
    """Matches with ok: whether the target has that stretch at that place."""
    joined = matches.join(targets.select("tnum", F.col("seq").alias("target")), "tnum")
    return joined.withColumn("ok", F.substr("target", F.col("pos") + 1, F.length("tseq")) == F.col("tseq")).drop("target")


def _seed(seq: Column, width: int) -> Column:
    """Of a sequence's stretches side by side the most varied one, the first of these: q and key."""
    each = F.transform(F.sequence(F.lit(0), F.length(seq) - width, F.lit(width)), lambda q: F.struct(dinucleotides(F.substr(seq, q + 1, F.lit(width))).alias("varied"), (-q).alias("minus"), F.substr(seq, q + 1, F.lit(width)).alias("key")))
    return F.array_max(each)


def contained(rows: DataFrame, targets: DataFrame, seq: str = "tseq", width: int = 24, work: str = "") -> DataFrame:
    """The distinct values of a column that occur in some target, wherever that is.

    A stretch of each is looked up by the scan of targets, with as much beside it as the longest sequence has, and the
    whole sequence compared there. The stretch is as wide as the shortest sequence allows; without a letter a sequence
    occurs in every target.
    """
    wanted = rows.select(F.col(seq).alias("seq")).filter("seq is not null").distinct()
    filled = wanted.filter("seq <> ''")
    least, most = filled.agg(F.min(F.length("seq")), F.max(F.length("seq"))).first()
    anywhere = wanted.filter("seq = ''").join(targets.select(F.lit("").alias("seq")).limit(1), "seq", "left_semi")
    if least is None:
        return anywhere.withColumnRenamed("seq", seq)
    width = min(width, least)
    seeds = filled.withColumn("seed", _seed(F.col("seq"), width)).select("seq", F.col("seed.key").alias("key"), (-F.col("seed.minus")).alias("q"))
    found = scan.candidates(targets, seeds, width, most - width, most - width, work=work)
    there = found.join(seeds, "key").filter(F.substr("around", F.col("lead") - F.col("q") + 1, F.length("seq")) == F.col("seq")).filter(F.col("lead") >= F.col("q"))
    return there.select("seq").distinct().union(anywhere).withColumnRenamed("seq", seq)
