"""Operators 1, 7 and 8 against the tokenizers library, text by text."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

from strandloom.llm import bpe, token_count, token_store  # noqa: E402
from strandloom.llm.common import shared_dir  # noqa: E402

PATH = public.path("byte_bpe_50k.json")
PARTS = ["a, ", "b. ", "2, ", ",", ". ", "\x01", "the", "'s", "'ll", " ", "  ", "\n", "\t", "　", " ", "՘", "1", "é", "中", "\x1c", "\x85", "!", "<|endoftext|>", "\U000ff000", "Ha", " \n", "ﬁ", "\xa0", "'", "𝟘"]


def texts():
    rng = random.Random(4)
    found = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    return [*found, None, "", " ", "word, word. End.", "a" * 3000, "abc" * 1500, " " * 2000, "word " * 5000, "x" * 300 + " y"]


def expected():
    library = tokenizers.Tokenizer.from_file(PATH)
    return {k: (t, library.encode(t or "", add_special_tokens=False).ids) for k, t in enumerate(texts())}, library


@pytest.fixture(scope="module")
def table(spark):
    # extra columns, among them names that clash with results and with the text's in another case
    rows = [(k, t, "x", 1) for k, t in enumerate(texts())]
    spark.conf.set("spark.sql.caseSensitive", "true")
    df = spark.createDataFrame(rows, "doc_id long, text string, TEXT string, n_tokens int").repartition(3)
    yield df
    spark.conf.set("spark.sql.caseSensitive", "false")


def test_ids_and_text(spark, table):
    want, library = expected()
    got = {r["doc_id"]: r for r in bpe.digests(table, PATH).collect()}
    assert set(got) == set(want)
    for k, (_, ids) in want.items():
        data = np.array(ids, "<u4").tobytes()
        text = library.decode(ids, skip_special_tokens=False)
        assert (got[k]["n_tokens"], got[k]["ids_sha256"], got[k]["decoded_sha256"]) == (len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(text.encode()).hexdigest()), want[k]


def test_encode_then_decode(spark, table):
    coded = bpe.encode(table, PATH)
    assert {r["doc_id"]: r["text"] for r in bpe.decode(coded, PATH).collect()} == {k: t or "" for k, t in enumerate(texts())}


def test_merging_by_scan_and_by_heap_agree():
    vocab = bpe.vocabulary(PATH)
    rng = random.Random(2)
    for _ in range(300):
        word = bytes(rng.choice(b"etaoin shrdlu") for _ in range(rng.randint(1, 60)))
        merges, symbols = token_count.merge_by_heap(vocab, word)
        assert vocab.merge(word) == symbols and len(symbols) == len(word) - merges


def test_counts(spark, table):
    want, _ = expected()
    got = {r["doc_id"]: r for r in token_count.token_counts(table, PATH, limit=20).collect()}
    for k, (t, ids) in want.items():
        assert (got[k]["n_bytes"], got[k]["n_tokens"], got[k]["over_limit"]) == (len((t or "").encode()), len(ids), len(ids) > 20)


def test_store(spark, table):
    want, _ = expected()
    path = shared_dir(spark)
    token_store.write(table, path, PATH, shards=5)
    got = {r["doc_id"]: r for r in token_store.checksums(token_store.read(spark, path)).collect()}
    start = 0
    for k in sorted(want):
        ids = [*want[k][1], 2]
        assert (got[k]["start"], got[k]["n_tokens"], got[k]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_store_writes_dictionary_pages_and_indexes(spark, table, tmp_path):
    import pyarrow.parquet as pq

    token_store.write(table, str(tmp_path / "t"), PATH, shards=2)
    for f in (tmp_path / "t").glob("part-*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for c in (meta.row_group(0).column(k) for k in range(meta.num_columns)):
            assert c.has_offset_index
            assert ("RLE_DICTIONARY" in c.encodings) == ("element" in c.path_in_schema)
            if c.path_in_schema in ("doc_id", "n_tokens", "shard_start"):
                assert "DELTA_BINARY_PACKED" in c.encodings


def test_selective_reads_skip_pages_and_columns(spark, tmp_path):
    df = spark.range(20000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text number "), F.col("id").cast("string"), F.repeat(F.lit(" word"), 30)).alias("text"))
    path = str(tmp_path / "t")
    token_store.write(df, path, PATH, shards=1)

    def scanned(rows):
        """Rows that the file scan gave, before Spark's own filter."""
        rows.collect()
        plan = rows._jdf.queryExecution().executedPlan()
        while plan.children().size():
            plan = plan.children().apply(0)
        return plan.metrics().apply("numOutputRows").value(), plan.toString()

    some = token_store.documents(spark, path, 7000, 7010)
    assert [r["doc_id"] for r in some.orderBy("doc_id").collect()] == list(range(7000, 7011))
    n, plan = scanned(token_store.documents(spark, path, 7000, 7010))
    assert 11 <= n <= 2 * token_store.PAGE_ROWS and "PushedFilters" in plan
    n, plan = scanned(token_store.lengths(spark, path))
    assert n == 20000 and "ids" not in plan.split("ReadSchema")[1]


def test_rows_of_one_id_are_split_over_shards(spark, tmp_path):
    df = spark.range(4000).select(F.lit(5).cast("bigint").alias("doc_id"), F.concat(F.lit("row "), F.col("id").cast("string")).alias("text"))
    token_store.write(df, str(tmp_path / "t"), PATH, shards=4)
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "t")).groupBy("shard").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 2000
    rows = token_store.read(spark, str(tmp_path / "t")).orderBy("start").collect()
    assert rows[0]["start"] == 0 and all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("rows", [[], [(None, None), (None, "a b"), (1, "same"), (1, "same")]])
def test_empty_tables_null_ids_and_repeated_rows(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert bpe.digests(df, PATH).count() == token_count.token_counts(df, PATH).count() == len(rows)
    stored = token_store.round_trip(spark, df, PATH).orderBy("start").collect()
    assert len(stored) == len(rows)
    if rows:
        assert [r["doc_id"] for r in stored] == [None, None, 1, 1] and stored[0]["n_tokens"] == 1


def test_lines_of_words_are_asked_for_word_by_word(monkeypatch):
    library = tokenizers.Tokenizer.from_file(PATH)
    rng = random.Random(8)
    lines = [" ".join(rng.choice(["Word", "and", "été", "it's", "end.\nNext", "list:\nOne,\nTwo.", "wh'\ns", "a_\nb", "x.\n\ny", "c\r\nd", "e\n", "\nf", "Zw.)\n(q", "中\nb", "1\n2", "k.\nm7"]) for _ in range(30)) for _ in range(300)]
    encoder = token_store.LibraryEncoder(PATH)
    asked = []
    monkeypatch.setattr(encoder, "_whole", lambda text, real=encoder._whole: asked.append(text) or real(text))
    pieces = [f"{a}{m}\n{b}{n}" for a in ("ab", "été", "The") for m in ("", ".", ".)", "'") for b in ("s", "But", "ça") for n in ("", ",", "'")]
    for piece in pieces:
        assert encoder.rest[piece] == np.array(library.encode(" " + piece, add_special_tokens=False).ids, "<u4").tobytes()
    assert not asked
    for text in lines:
        assert encoder.encode(text) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
