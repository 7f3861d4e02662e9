"""The matches of all windows as one relation, and the best of each read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_matches(matches: DataFrame) -> DataFrame:
    """seq, tseq, pos, nmiss, tnum: each match once, whichever windows found it."""
    return matches.select("seq", "tseq", "pos", "nmiss", "tnum").distinct()


def best_per_read(matches: DataFrame, tolerance: int = 0) -> DataFrame:
    """The matches of each read with at most ``tolerance`` mismatches more than its best one."""
    # map tasks take minima first, so a read with very many matches is no long group
    least = matches.groupBy("seq").agg(F.min("nmiss").alias("least"))
    return matches.join(least, "seq").filter(F.col("nmiss") <= F.col("least") + tolerance).select(*matches.columns)
