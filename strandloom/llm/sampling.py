"""Bounded samples of labelled rows for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def classes(rows: DataFrame, label: str) -> list[tuple[object, int]]:
    """All labels and their counts, the most frequent first, ties by label: one row a label."""
    counted = rows.filter(F.col(label).isNotNull()).groupBy(label).count().orderBy(F.desc("count"), label)
    return [(r[0], r[1]) for r in counted.collect()]


def spread(rows: DataFrame, key: str, label: str, counts: list[tuple[object, int]], per_class: int, order: Column | None = None) -> DataFrame:
    """About ``per_class`` rows of each label, by the hash of their key; ``bounded`` cuts the rest.

    Of the rows of one key (those without one included) and label the first by ``order`` counts; Spark limits each
    map task's groups before the shuffle, so a key that very many rows have is no long group.
    """
    bits = 30
    shares = rows.sparkSession.createDataFrame([(v, min(1 << bits, int((1 << bits) * per_class / max(1, n)) + 1)) for v, n in counts], f"_label {dict(rows.dtypes)[label]}, _share long")
    # one row a label, as the driver holds them
    chosen = rows.join(F.broadcast(shares), F.col(label) == F.col("_label")).filter(F.pmod(F.xxhash64(F.lit("fit"), F.col(key)), F.lit(1 << bits)) < F.col("_share"))
    rank = F.row_number().over(Window.partitionBy(key, label).orderBy(order if order is not None else F.lit(0)))
    return chosen.withColumn("_rank", rank).filter("_rank = 1").select(*rows.columns)


def bounded(found: list, label: int, per_class: int) -> list:
    """At most ``per_class`` of the rows of each label, in the rows' own order."""
    seen: dict = {}
    out = []
    for r in sorted(found, key=lambda r: (str(r[label]), str(r[0]))):
        seen[r[label]] = seen.get(r[label], 0) + 1
        if seen[r[label]] <= per_class:
            out.append(r)
    return out
