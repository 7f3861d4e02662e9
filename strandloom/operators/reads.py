"""Preparation and deduplication of reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.sequences import NAME_LIMIT, first_token, normalised, shortened


def prepare_reads(rows: DataFrame, least: int = 0, most: int = 300, seen: Observation | None = None) -> DataFrame:
    """seq and name: reads shorter than ``least`` and empty ones go, others are normalised and cut to ``most`` letters.

    ``seen`` is told, while the rows are made, how many reads are too short (``skipped``).
    """
    if seen is not None:
        rows = rows.observe(seen, F.count_if(F.length("seq") < least).alias("skipped"))
    kept = rows.filter((F.length("seq") >= least) & (F.length("seq") > 0))
    return kept.select(normalised(F.substring("seq", 1, most)).alias("seq"), shortened(F.col("name")).alias("name"))


def skipped_reads(rows: DataFrame, least: int) -> DataFrame:
    """skipped: how many reads are too short."""
    return rows.agg(F.count_if(F.length("seq") < least).alias("skipped"))


#: Into how many first rounds the names of one sequence are dealt, by map task.
ROUNDS = 64


def distinct_reads(reads: DataFrame) -> DataFrame:
    """seq, n and names: equal sequences in one row, with their names' first tokens in the order of whole names.

    Names beyond the limit are cut, so of a sequence only its first names can show: each takes its separator at least.
    They are found in two rounds, first among those of some map tasks, then among what these rounds leave; before
    either shuffle Spark lets no task send more than the limit. Reads without a name count, and show nothing.
    """
    counts = reads.groupBy("seq").agg(F.count("*").alias("n"), F.count("name").alias("named"), F.max("name").alias("last"))
    first = reads.filter("name is not null").select("seq", "name", (F.spark_partition_id() % ROUNDS).alias("round"))
    for by in (("seq", "round"), ("seq",)):
        # Spark drops rows before the shuffle for limits of up to 1,000
        rank = F.row_number().over(Window.partitionBy(*by).orderBy("name"))
        first = first.withColumn("rank", rank).filter(F.col("rank") <= NAME_LIMIT).drop("rank")
    names = first.groupBy("seq").agg(F.array_sort(F.collect_list("name")).alias("all"))
    rows = counts.join(names, "seq", "left")
    # beyond the limit one more name can be decisive if all before it are empty; two more always are
    more = F.when(F.col("named") > NAME_LIMIT + 1, ";;").when(F.col("named") > NAME_LIMIT, F.concat(F.lit(";"), first_token(F.col("last")))).otherwise("")
    joined = F.concat(F.array_join(F.transform(F.coalesce("all", F.array().cast("array<string>")), first_token), ";"), more)
    # named once, so that it is joined once
    return rows.select("seq", "n", F.transform(F.array(joined), shortened)[0].alias("names"))
