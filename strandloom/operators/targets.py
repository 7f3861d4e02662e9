"""Preparation of targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import normalised, reverse_complement


def prepare_targets(rows: DataFrame, reverse: bool = False, by_line: bool = False) -> DataFrame:
    """tnum (row number), id_num, name, seq, tlen from rows of number, name, seq.

    With ``reverse`` each row is followed by its reverse complement, named with _r. ``by_line`` keeps the input's
    number as id_num, so both rows of a text line share it; tnum, by which everything is joined, never repeats.
    """
    seq = normalised(F.col("seq"))
    rows = rows.select("number", "name", seq.alias("seq"))
    if not reverse:
        rows = rows.withColumn("tnum", F.col("number"))
    else:
        both = F.array(
            F.struct((F.col("number") * 2).alias("tnum"), F.col("name").alias("name"), F.col("seq").alias("seq")),
            F.struct((F.col("number") * 2 + 1).alias("tnum"), F.concat("name", F.lit("_r")).alias("name"), reverse_complement(F.col("seq")).alias("seq")),
        )
        rows = rows.select("number", F.explode(both).alias("r")).select("number", "r.*")
    return rows.select("tnum", F.col("number" if by_line else "tnum").alias("id_num"), "name", "seq", F.length("seq").alias("tlen"))
