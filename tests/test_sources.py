"""Files: the target goldens, FASTQ, the framing format, numbering over splits."""

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandloom.operators.targets import prepare_targets
from strandloom.plans import pipeline
from strandloom.sources import files, framing, stores

GENES = [("gene1", "ATACGATCTACGATCA"), ("gene2", "TTAATTAATTAA"), ("gene3", "ATTAGGCC")]
BACK = ["TGATCGTAGATCGTAT", "TTAATTAATTAA", "GGCCTAAT"]


def rows(df):
    return [(r["id_num"], r["name"], r["seq"], r["tlen"]) for r in df.orderBy("tnum").collect()]


@pytest.fixture
def fasta(tmp_path):
    path = tmp_path / "genes.fasta"
    path.write_text("".join(f">{n}\n{s[:6]}\n{s[6:]}\n" for n, s in GENES))
    return str(path)


@pytest.fixture
def text(tmp_path):
    path = tmp_path / "genes.txt"
    path.write_text("".join(f"{n}\t{s}\n" for n, s in GENES))
    return str(path)


def test_fasta(spark, fasta):
    got = rows(prepare_targets(files.read_targets(spark, fasta)))
    assert got == [(k, f">{n}", s, len(s)) for k, (n, s) in enumerate(GENES)]


def test_fasta_with_reverse(spark, fasta):
    got = rows(prepare_targets(files.read_targets(spark, fasta), reverse=True))
    want = [x for k, (n, s) in enumerate(GENES) for x in ((2 * k, f">{n}", s, len(s)), (2 * k + 1, f">{n}_r", BACK[k], len(s)))]
    assert got == want


def test_text_targets(spark, text):
    assert rows(prepare_targets(files.read_targets(spark, text), by_line=True)) == [(k, n, s, len(s)) for k, (n, s) in enumerate(GENES)]


def test_text_with_reverse_repeats_ids_but_not_row_numbers(spark, text):
    df = prepare_targets(files.read_targets(spark, text), reverse=True, by_line=True)
    got = rows(df)
    assert [r[0] for r in got] == [0, 0, 1, 1, 2, 2] and [r[2] for r in got] == [x for (_, s), b in zip(GENES, BACK) for x in (s, b)]
    assert sorted(r["tnum"] for r in df.collect()) == list(range(6))


def test_prepare_writes_two_tables(spark, fasta):
    sequences, ids = pipeline.prepare(spark, fasta, True)
    assert sequences.endswith("genes.txt.parquet") and ids.endswith("genes_ids.txt.parquet")
    assert spark.read.parquet(sequences).count() == spark.read.parquet(ids).count() == 6


def test_text_stops_at_an_empty_line_and_wants_two_fields(spark, tmp_path):
    path = tmp_path / "t.txt"
    path.write_text("a\tACGT\tmore\nb\tACG\n\nc\tAAAA\n")
    assert [r["name"] for r in files.read_targets(spark, str(path)).orderBy("number").collect()] == ["a", "b"]
    path.write_text("a\tACGT\nonly\n")
    with pytest.raises(Exception, match="no tab"):
        files.read_targets(spark, str(path)).collect()


def test_fasta_header_without_sequence_takes_no_number(spark, tmp_path):
    path = tmp_path / "t.FASTA"
    path.write_text(">a one\nacgN\n>empty\n>b\nAC\nGT")
    got = rows(prepare_targets(files.read_targets(spark, str(path))))
    assert got == [(0, ">a one", "XXXX", 4), (1, ">b", "ACGT", 4)]


def test_numbers_do_not_depend_on_splits(spark, tmp_path):
    path = tmp_path / "big.fastq"
    path.write_text("".join(f"@r{k}\n{'ACGT' * (k % 7 + 1)}\n+\n{'!' * 4}\n" for k in range(3000)) + "@half\nACGT\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
        got = {r["name"]: r["seq"] for r in files.read_fastq(spark, str(path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {f"@r{k}": "ACGT" * (k % 7 + 1) for k in range(3000)}


def crc(data):
    out = 0xFFFFFFFF
    for x in data:
        out ^= x
        for _ in range(8):
            out = out >> 1 ^ (0x82F63B78 if out & 1 else 0)
    return out ^ 0xFFFFFFFF


def test_sums():
    rng = random.Random(1)
    parts = [rng.randbytes(n) for n in (0, 1, 2, 3, 4, 5, 255, 256, 257, 4096)] + [b"123456789", bytes(32), b"\xff" * 32]
    assert framing.crc32c(parts).tolist() == [crc(p) for p in parts]
    assert framing.crc32c([b"123456789"])[0] == 0xE3069283  # the published check value
    whole = rng.randbytes(65536)
    assert framing.crc32c([whole, whole[:-1]]).tolist() == [crc(whole), crc(whole[:-1])]


def test_framing_format(spark, tmp_path):
    import pyarrow as pa

    data = b"a\tACGT\nb\tGG\n" * 9000
    assert files.unframed(files.framed(data)) == data and len(files.framed(data)) < len(data) // 4
    noise = random.Random(2).randbytes(200_000)
    assert files.unframed(files.framed(noise)) == noise and len(files.framed(noise)) < len(noise) + 64
    body = pa.Codec("snappy").compress(data[:60000], asbytes=True)
    stream = b"\xff\x06\x00\x00sNaPpY" + b"\xfe\x02\x00\x00zz" + b"\x00" + (len(body) + 4).to_bytes(3, "little")
    good = int(framing.masked(framing.crc32c([data[:60000]]))[0]).to_bytes(4, "little")
    assert files.unframed(stream + good + body) == data[:60000]
    with pytest.raises(ValueError, match="wrong sum"):
        files.unframed(stream + b"\0\0\0\0" + body)
    with pytest.raises(ValueError, match="cut short"):
        files.unframed(stream + good + body[:-1])
    with pytest.raises(ValueError, match="unknown chunk"):
        files.unframed(b"\x02\x05\x00\x00zzzzz")
    path = tmp_path / "x.txt.sz"
    path.write_bytes(files.framed(b"a\tACGT\nb\tGG\n"))
    assert [(r["number"], r["name"], r["seq"]) for r in files.read_targets(spark, str(path)).orderBy("number").collect()] == [(0, "a", "ACGT"), (1, "b", "GG")]


@pytest.mark.parametrize("chunk", [1, 7, 64, 65536])
@pytest.mark.parametrize("end", [b"", b"\n"])
def test_every_line_is_in_one_range_of_chunks(monkeypatch, chunk, end):
    monkeypatch.setattr(framing, "CHUNK", chunk)
    rng = random.Random(chunk)
    monkeypatch.setattr(framing, "crc32c", lambda parts: np.array([crc(p) for p in parts], np.uint32))
    want = [b"x" * rng.choice([0, 1, 5, 20, 200]) for _ in range(60)] + [b"last"]
    data = framing.framed(b"\n".join(want) + end)
    read = lambda n, at: data[at : at + n]
    for wanted in (1, 30, 300, 1 << 20):
        starts = framing.index(read, len(data), wanted)
        got = [x for a, b in zip(starts, starts[1:]) for some in framing.lines(read, a, b, len(data)) for x in some]
        assert got == want, wanted
        assert len(starts) > 2 or wanted > 300 or chunk > 64


def test_framed_parts_keep_order_and_number(spark, tmp_path):
    rows = [f"line {k} " + "y" * (k % 50) for k in range(20_000)]
    ordered = spark.range(0, 20_000, numPartitions=6).select(F.concat(F.lit("line "), F.col("id").cast("string"), F.lit(" "), F.repeat(F.lit("y"), (F.col("id") % 50).cast("int"))).alias("value"))
    for _ in range(2):  # the second time over the first
        files.write_framed(ordered, str(tmp_path / "x.sz"))
    assert sorted(p.name for p in (tmp_path / "x.sz").iterdir()) == ["_SUCCESS", *(f"part-{k:05d}.sz" for k in range(6))]
    got = files.framed_lines(spark, str(tmp_path / "x.sz"), across=True, range_bytes=5000)
    assert spark.read.format("strandloom_framed").option("rangeBytes", 5000).load(str(tmp_path / "x.sz")).rdd.getNumPartitions() > 6
    assert [r["value"] for r in got.orderBy("number").collect()] == rows
    bad = tmp_path / "bad.sz"
    bad.write_bytes(files.framed(b"some text\n")[:-3] + b"zzz")
    with pytest.raises(Exception, match="wrong sum|snappy|Corrupt"):
        files.framed_lines(spark, str(bad)).collect()


@pytest.mark.parametrize("kind", ["fasta", "text"])
@pytest.mark.parametrize("reverse", [False, True])
def test_prepared_targets_as_framed_text(spark, request, kind, reverse):
    """The four published pairs of files: byte for byte, once the frames are off."""
    sequences, ids = pipeline.prepare(spark, request.getfixturevalue(kind), reverse, framed_text=True)
    assert sequences.endswith("genes.txt.sz") and ids.endswith("genes_ids.txt.sz")
    text = lambda path: b"".join(files.unframed(p.read_bytes()) for p in sorted(Path(path).glob("part-*"))).decode()
    name = (">{}" if kind == "fasta" else "{}").format
    rows = [(s, n, k, b) for k, ((n, s), b) in enumerate(zip(GENES, BACK))]
    every = [x for s, n, k, b in rows for x in ([(s, name(n)), (b, name(n) + "_r")] if reverse else [(s, name(n))])]
    number = (lambda i: i // 2) if reverse and kind == "text" else (lambda i: i)
    assert text(sequences) == "".join(s + "\n" for s, _ in every)
    assert text(ids) == "".join(f"{number(i):011d}\t{n}\t{len(s)}\n" for i, (s, n) in enumerate(every))
    back = files.read_prepared(spark, sequences, ids).orderBy("tnum").collect()
    assert [(r["tnum"], r["seq"], r["name"], r["tlen"]) for r in back] == [(i, s, n, len(s)) for i, (s, n) in enumerate(every)]


def fastq(n, rng, end="\n"):
    rows, out = [], []
    for k in range(n):
        length = rng.randint(0, 30)
        name, seq = rng.choice("@>") + f"r{k} " + rng.choice(["", "@x", "+"]), "".join(rng.choice("ACGTN") for _ in range(length))
        quality = "".join(rng.choice("@+>!IF") for _ in range(length))  # as awkward as may be
        rows.append((name, seq))
        out.append(end.join([name, seq, "+" + rng.choice(["", name[1:]]), quality]) + end)
    return rows, out


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_every_record_is_in_one_range(end):
    from strandloom.sources import fastq as source

    rng = random.Random(4)
    rows, out = fastq(60, rng, end)
    for tail in ("", "@half" + end + "ACGT", out[0].rstrip("\r\n")):
        data = ("".join(out) + tail).encode()
        want = rows + ([rows[0]] if tail.endswith(out[0].rstrip("\r\n")) and tail else [])
        for size in (1, 2, 3, 17, 64, 500, 10**6):
            got = []
            for a in range(0, len(data), size):
                batch = source.owned(lambda n, at: data[at : at + n], a, min(len(data), a + size), len(data))  # noqa: B023
                got += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            assert got == want, (tail, size)


def test_fastq_in_seven_ranges_equals_one(spark, tmp_path):
    import gzip

    rows, out = fastq(3000, random.Random(5))
    path = tmp_path / "reads.fastq"
    path.write_text("".join(out) + "@half\nACGT\n")
    one = files.read_fastq(spark, str(path))
    seven = files.read_fastq(spark, str(path), range_bytes=-(-path.stat().st_size // 7))
    assert one.rdd.getNumPartitions() == 1 and seven.rdd.getNumPartitions() == 7
    assert "Exchange" not in seven._jdf.queryExecution().executedPlan().toString()
    want = sorted(rows)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, seven.collect())) == want
    assert sorted(map(tuple, files.fastq_by_lines(spark, str(path)).collect())) == want
    packed = tmp_path / "reads.fastq.gz"
    packed.write_bytes(gzip.compress(path.read_bytes()))
    assert sorted(map(tuple, files.read_fastq(spark, str(packed)).collect())) == want
    (tmp_path / "reads.fastq.sz").write_bytes(files.framed(path.read_bytes()))
    assert sorted(map(tuple, files.read_fastq(spark, str(tmp_path / "reads.fastq.sz")).collect())) == want
    assert not stores.reachable("viewfs://store/in/reads.fastq") and not stores.reachable(str(tmp_path / "none"))


def test_files_without_a_record_give_no_rows(spark, tmp_path):
    none = spark.createDataFrame([], "names string, seq string, qual string")
    files.write_nonmatch(none, f"{tmp_path}/none.fastq")
    assert files.read_fastq(spark, f"{tmp_path}/none.fastq").collect() == []
    (tmp_path / "none.sz").mkdir()
    assert files.framed_lines(spark, f"{tmp_path}/none.sz").collect() == []


def test_targets_in_many_parts_are_one_file(spark, tmp_path):
    rows = spark.range(0, 500, numPartitions=5).select(F.concat_ws("\t", F.concat(F.lit("g"), F.col("id").cast("string")), F.lit("ACGT")).alias("value"))
    rows.write.text(str(tmp_path / "genes.txt"))
    got = files.read_targets(spark, str(tmp_path / "genes.txt")).orderBy("number").collect()
    assert [(r["number"], r["name"]) for r in got] == [(k, f"g{k}") for k in range(500)]
    rows.select(F.concat_ws("\n", F.concat(F.lit(">"), F.split("value", "\t")[0]), F.lit("AC"), F.lit("GT"))).write.text(str(tmp_path / "genes.fasta"))
    got = files.read_targets(spark, str(tmp_path / "genes.fasta")).orderBy("number").collect()
    assert [(r["number"], r["name"], r["seq"]) for r in got] == [(k, f">g{k}", "ACGT") for k in range(500)]


def test_paths():
    assert files.nonmatch_path("/d/result.txt") == "/d/result.nonmatch.txt.fastq"
    assert files.is_fasta("x.FASTA") and not files.is_fasta("x.fa")


def test_totals_of_framed_ranges_are_counted_apart(spark, tmp_path):
    some = [f"line {k} " + "x" * (k % 5000) for k in range(400)]
    files.write_framed(spark.createDataFrame([(x,) for x in some], "value string").repartition(3), f"{tmp_path}/a.sz")
    reader = spark.read.format("strandloom_framed").option("rangeBytes", 20_000)
    rows = reader.option("totals", "false").load(f"{tmp_path}/a.sz").groupBy("file", "block").count().collect()
    assert sorted(map(tuple, reader.option("totals", "true").load(f"{tmp_path}/a.sz").collect())) == sorted(map(tuple, rows))
