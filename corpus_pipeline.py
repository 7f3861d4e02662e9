"""The corpus pipeline: each stage takes what its predecessor kept, written as Parquet and read again.

1. quality: texts that the byte-level network scores under 0.5 go;
2. near_copies: of each group of texts linked by 80 % of their 5-word shingles the one with the least id stays;
3. decontamination: texts in which a benchmark window occurs go;
4. secrets: secrets in the texts become a mark;
5. bpe: texts become token ids, and their digests show that decoding gives the texts back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm import bpe, decontam, ngram_jaccard, quality, secrets
from strandloom.llm.common import stored, table

TOKENIZER = "byte_bpe_50k.json"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fits on the labelled ones of these documents and keeps those that score as good; unlabelled ones are scored alike.

    Null and empty texts score as one empty chunk; repeated rows and rows without an id are scored by their text; all
    columns stay; an empty table stays empty.
    """
    return quality.good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by 80 % of five-word shingles stays, all columns: the one with the least id.

    Rows without an id, without a text or without a word stay; of repeated rows one does; an empty table stays empty.
    """
    return ngram_jaccard.deduplicate(docs, n=5, part=80, whole=100)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows, all columns, in which no window of 10 words of a benchmark item (all words of a shorter one) occurs.

    Rows without a text stay; repeated rows and rows without an id are judged by their text; an empty table stays empty.
    """
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows and columns, with a mark in the place of every secret; null and empty texts stay as they are."""
    return secrets.redact(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (packed little-endian unsigned 32-bit integers) and the digests of ids and decoded text.

    Null texts have no tokens, as empty ones; repeated rows stay repeated; null ids stay null; other columns go.
    """
    rows = bpe.round_trip(docs, public_tokenizers.path(TOKENIZER))
    return rows.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality", keep_good), ("near_copies", keep_one_of_near_copies), ("decontamination", drop_contaminated), ("secrets", mask_secrets), ("bpe", to_tokens)]
#: A convolutional network and byte-pair merges are beyond SQL: the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
