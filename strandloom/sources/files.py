"""Readers and writers of read, target and result files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.sequences import padded_number
from ..plans.staging import ship, staged, work_dir
from . import stores
from .fastq import FastqSource
from .framing import FramedSource, framed, unframed

__all__ = ["framed", "unframed"]


def _source(spark: SparkSession, kind: type) -> str:
    """The name of a data source of this package, which the session knows from now on."""
    ship(spark)
    known = spark.__dict__.setdefault("_strandloom_sources", set())
    if kind.name() not in known:
        spark.dataSource.register(kind)
        known.add(kind.name())
    return kind.name()


def numbered(df: DataFrame, keep: Column | None = None, across: bool = False) -> DataFrame:
    """Rows of a text scan with ``file`` and ``number``: their place among the file's (kept) rows, from 0; with
    ``across`` among those of all files, in the order of their names.

    A split knows its offset in the file and reads in order, so places are counted within splits, and the splits'
    totals, one row each, give where each begins. Nothing depends on how splits are dealt to tasks. Without ``keep``
    the rows themselves stay where they are: only the totals are joined to them.
    """
    rows = df.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    if keep is not None:
        rows = rows.filter(keep)
        rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("file", "block").orderBy("at")) - 1)
        totals = rows.groupBy("file", "block").agg(F.count("*").alias("n"), F.lit(0).cast("bigint").alias("first"))
    else:  # ids of a task's rows are consecutive
        rows = rows.withColumn("place", F.col("at"))
        totals = rows.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    return _placed(rows, totals, across).drop("at")


def _placed(rows: DataFrame, totals: DataFrame, across: bool) -> DataFrame:
    """Numbers from places in splits (file, block) and the splits' numbers of rows."""
    order = Window.orderBy("file", "block") if across else Window.partitionBy("file").orderBy("block")
    before = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.withColumn("start", F.coalesce(before, F.lit(0)) - F.col("first")).drop("n", "first")
    # the number of splits is bounded by the scan's tasks, so this side is small; sizes decide how it is joined
    return rows.join(totals, ["file", "block"]).withColumn("number", F.col("start") + F.col("place")).drop("block", "place", "start")


def lines(spark: SparkSession, path: str, across: bool = False) -> DataFrame:
    """value of each line of text files; files that end in .sz are in the snappy framing format."""
    if path.rstrip("/").endswith(".sz"):
        return framed_lines(spark, path, across)
    return numbered(spark.read.text(path), across=across)


def framed_lines(spark: SparkSession, path: str, across: bool = False, range_bytes: int | None = None) -> DataFrame:
    """Lines of framed files (or of a folder of them) with file and number, read in ranges of chunks."""
    reader = spark.read.format(_source(spark, FramedSource))
    reader = reader.option("rangeBytes", range_bytes) if range_bytes else reader
    rows = reader.option("totals", "false").load(path)
    totals = reader.option("totals", "true").load(path).withColumn("first", F.lit(0).cast("bigint"))
    return _placed(rows, totals, across)


def write_framed(rows: DataFrame, path: str) -> None:
    """The column ``value`` as lines of parts in the framing format, in the order of the rows; replaces what was there."""
    rows.select("value").write.format(_source(rows.sparkSession, FramedSource)).mode("overwrite").save(path)


def read_fastq(spark: SparkSession, path: str, range_bytes: int | None = None) -> DataFrame:
    """name (the whole header line) and seq of four-line records; an incomplete last record is left out.

    Files are read in ranges that begin at a record (see ``fastq``); framed files, and those in stores that only Spark
    reads, line by line.
    """
    if path.rstrip("/").endswith(".sz") or not stores.reachable(path):
        return fastq_by_lines(spark, path)
    reader = spark.read.format(_source(spark, FastqSource))
    return (reader.option("rangeBytes", range_bytes) if range_bytes else reader).load(path)


def fastq_by_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same by the numbers of lines: headers and sequences are dealt by record, with a mark of the last line for the
    record's completeness."""
    line = (F.col("number") % 4).cast("int")
    rows = lines(spark, path).select("file", F.floor(F.col("number") / 4).alias("record"), line.alias("line"), F.when(line < 2, F.col("value")).alias("value")).filter("line <> 2")
    records = rows.groupBy("file", "record").agg(F.max(F.when(F.col("line") == 0, F.col("value"))).alias("name"), F.max(F.when(F.col("line") == 1, F.col("value"))).alias("seq"), F.max("line").alias("last"))
    return records.filter("last = 3").select("name", "seq")


def is_fasta(path: str) -> bool:
    return path.lower().endswith("fasta")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """number, name (the whole header line with its >) and seq (its lines in one); headers without a sequence don't count."""
    text = F.regexp_replace(F.col("value"), "^>", "")
    seq = F.regexp_replace(F.regexp_replace(text, r"^[^\n]*(\n|$)", ""), r"[\r\n]", "")
    rows = numbered(spark.read.text(path, lineSep="\n>"), seq != "", across=True)
    return rows.select("number", F.concat(F.lit(">"), F.regexp_replace(F.substring_index(text, "\n", 1), "\r", "")).alias("name"), seq.alias("seq"))


def read_text_targets(spark: SparkSession, path: str) -> DataFrame:
    """number, name and seq of tab-separated lines up to the first empty one; a line without a tab is an error.

    The parts of a folder are one text, in the order of their names.
    """
    rows = lines(spark, path, across=True)
    end = rows.filter("value = ''").agg(F.min("number")).first()[0]
    if end is not None:
        rows = rows.filter(F.col("number") < end)
    parts = F.split("value", "\t", -1)
    checked = F.when(F.size(parts) < 2, F.raise_error(F.concat(F.lit("no tab in target line "), F.col("number").cast("string")))).otherwise(parts)
    return rows.select("number", checked.alias("p")).select("number", F.col("p")[0].alias("name"), F.col("p")[1].alias("seq"))


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """number, name and seq; the file's name decides how it is read."""
    return read_fasta(spark, path) if is_fasta(path) else read_text_targets(spark, path)


RESULT_ORDER = ("seq", "tseq", "pos", "nmiss", "name", "tlen", "n", "names")


def in_line_order(result: DataFrame) -> DataFrame:
    """Result rows sorted as their lines are: every column as text."""
    return result.orderBy(*(F.col(c).cast("string") for c in RESULT_ORDER))


def write_result(result: DataFrame, path: str, single: bool = False) -> None:
    """The eight columns, tab-separated without header, in line order; replaces what was there.

    Parts hold ranges, so in the order of their names they are the sorted result; ``single`` makes one file of it.
    """
    rows = in_line_order(result.select(*RESULT_ORDER))
    (rows.coalesce(1) if single else rows).write.mode("overwrite").csv(path, sep="\t", quote="", escape="", emptyValue="")


def nonmatch_path(path: str) -> str:
    """result.txt gives result.nonmatch.txt.fastq."""
    stem, dot, end = path.rpartition(".")
    return f"{stem}.nonmatch.{end}.fastq" if dot and "/" not in end else f"{path}.nonmatch.fastq"


def write_nonmatch(nonmatch: DataFrame, path: str, single: bool = False) -> None:
    """names, seq and a quality of ! for each letter, as four-line records in the order of sequences; see ``write_result``."""
    record = F.concat_ws("\n", "names", "seq", F.lit("+"), F.col("qual"))
    rows = nonmatch.orderBy("seq").select(record.alias("value"))
    (rows.coalesce(1) if single else rows).write.mode("overwrite").text(path)


def target_paths(path: str, end: str = "parquet") -> tuple[str, str]:
    """genes.txt gives genes.txt.parquet and genes_ids.txt.parquet beside it, whatever its extension; so with .sz."""
    stem, dot, extension = path.rpartition(".")
    stem = stem if dot and "/" not in extension else path
    return f"{stem}.txt.{end}", f"{stem}_ids.txt.{end}"


def write_targets(targets: DataFrame, path: str, framed_text: bool = False) -> tuple[str, str]:
    """Sequences by row number, and ids with names and lengths, as two Parquet tables, or as two folders of framed text
    whose lines, in the order of parts, belong together by their place."""
    sequences, ids = target_paths(path, "sz" if framed_text else "parquet")
    if framed_text:
        # made once: sorting looks at all rows twice, and there are two folders
        rows = staged(targets, f"{work_dir(targets.sparkSession)}/prepared").orderBy("tnum")
        write_framed(rows.select(F.col("seq").alias("value")), sequences)
        write_framed(rows.select(F.concat_ws("\t", padded_number(F.col("id_num")), "name", F.col("tlen").cast("string")).alias("value")), ids)
    else:
        targets.select("tnum", "seq").write.mode("overwrite").parquet(sequences)
        targets.select("tnum", "id_num", "name", "tlen").write.mode("overwrite").parquet(ids)
    return sequences, ids


def read_prepared(spark: SparkSession, sequences: str, ids: str) -> DataFrame:
    """tnum, name, seq and tlen of prepared targets: the two Parquet tables, or two text files (framed, if they end in
    .sz) whose lines belong together by their place: a sequence, and number, name and length."""
    if sequences.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(sequences).join(spark.read.parquet(ids).select("tnum", "name", "tlen"), "tnum")
    fields = F.split("value", "\t", -1)
    seqs = lines(spark, sequences, across=True).select(F.col("number").alias("tnum"), fields[0].alias("seq"))
    names = lines(spark, ids, across=True).select(F.col("number").alias("tnum"), fields[1].alias("name"))
    return seqs.join(names, "tnum").withColumn("tlen", F.length("seq"))
