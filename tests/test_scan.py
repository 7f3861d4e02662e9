"""The rolling-hash scan, the filter in place of a key table, and hot keys, against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandloom.functions import rolling
from strandloom.functions import sequences as S
from strandloom.functions.sequences import hamming
from strandloom.operators import matching, scan, windows
from strandloom.operators.targets import prepare_targets


def letters(rng, n, alphabet="ACGT"):
    return "".join(rng.choice(alphabet) for _ in range(n))


def target_table(spark, texts):
    return prepare_targets(spark.createDataFrame([(k, f"g{k}", s) for k, s in enumerate(texts)], "number long, name string, seq string"))


def window_table(spark, rows):
    """k, q, key, seq of (k, q, width, read)."""
    return spark.createDataFrame([(k, q, r[q : q + w], r) for k, q, w, r in rows], "k int, q int, key string, seq string")


@pytest.mark.parametrize("width", [1, 7, 20, 300])
def test_equal_windows_have_equal_hashes(width):
    rng = random.Random(width)
    text = np.frombuffer((letters(rng, 900) + letters(rng, 400, "AC") + "A" * 350 + letters(rng, 900)).encode() * 2, np.uint8)
    hashes = rolling.window_hashes(text, width)
    assert len(hashes) == len(text) - width + 1
    by = {}
    for k, h in enumerate(hashes.tolist()):
        by.setdefault(text[k : k + width].tobytes(), set()).add(h)
    assert all(len(v) == 1 for v in by.values()) and len({min(v) for v in by.values()}) == len(by)
    keys = np.array([text[k : k + width] for k in (0, 5, 77)])
    assert rolling.key_hashes(keys).tolist() == [hashes[0], hashes[5], hashes[77]]


def test_a_key_table_is_exact(monkeypatch):
    """Also if hashes are poor: the text itself is compared, and keys of one hash are hashed anew."""
    rng = random.Random(1)
    text = letters(rng, 5000)
    keys = sorted({text[k : k + 9] for k in rng.sample(range(4900), 60)} | {letters(rng, 9) for _ in range(40)})
    want = [k for k in range(len(text) - 8) if text[k : k + 9] in set(keys)]
    data, rows = np.frombuffer(text.encode(), np.uint8), np.array([list(k.encode()) for k in keys], np.uint8)
    assert rolling.KeyTable(rows).find(data).tolist() == want
    plain = rolling.window_hashes
    monkeypatch.setattr(rolling, "window_hashes", lambda x, w, seed=0: plain(x, w, seed) & np.uint64(0xFFF0000000000000 if seed < 2 else 0xFFFFFFFF00000000))
    table = rolling.KeyTable(rows)
    assert table.seed == 2 and table.find(data).tolist() == want
    assert rolling.KeyTable(np.zeros((0, 9), np.uint8)).find(data).tolist() == []


@pytest.mark.parametrize("width, before, after", [(4, 0, 0), (4, 7, 30), (30, 100, 3)])
def test_stretches_and_what_is_around_a_window(spark, width, before, after, size=64):
    rng = random.Random(3)
    texts = [letters(rng, n) for n in (3, 4, 63, 64, 65, 127, 128, 129, 1000, 0)]
    targets = target_table(spark, texts)
    reads = sorted({t[p : p + width] for t in texts for p in range(0, max(0, len(t) - width + 1), 5)})
    found = window_table(spark, [(0, 0, width, r) for r in reads])
    got = scan.candidates(targets, found, width, before, after, letters=size).collect()
    want = sorted((k, p, t[p : p + width], min(p, before), t[max(0, p - before) : p + width + after]) for k, t in enumerate(texts) for p in range(len(t) - width + 1) if t[p : p + width] in set(reads))
    assert sorted(map(tuple, got)) == want and want


def test_long_texts_cross_chunks(spark, monkeypatch):
    monkeypatch.setattr(rolling, "CHUNK", 1000)
    rng = random.Random(4)
    texts = [letters(rng, 7000), letters(rng, 999), letters(rng, 1001)]
    keys = {t[p : p + 12] for t in texts for p in (0, 988, 989, 990, 995, 999, 1000, 3000, 5990, 6988) if p + 12 <= len(t)}
    found = window_table(spark, [(0, 0, 12, k) for k in keys])
    got = scan.candidates(target_table(spark, texts), found, 12).select("tnum", "p", "key").collect()
    assert sorted(map(tuple, got)) == sorted((k, p, t[p : p + 12]) for k, t in enumerate(texts) for p in range(len(t) - 11) if t[p : p + 12] in keys)


@pytest.mark.parametrize("bits, part_bytes", [(0, 1 << 20), (4000, 1 << 20), (40_000, 1000), (64, 1000)])
def test_the_filter_loses_nothing_and_what_passes_is_joined(spark, tmp_path, monkeypatch, bits, part_bytes):
    monkeypatch.setattr(scan, "PART_BYTES", part_bytes)
    rng = random.Random(5)
    texts = [letters(rng, 3000) for _ in range(4)]
    found = window_table(spark, [(0, 0, 10, t[p : p + 10]) for t in texts for p in range(0, 2900, 40)])
    targets = target_table(spark, texts)
    exact = scan.candidates(targets, found, 10, 3, 9)
    got = scan.candidates(targets, found, 10, 3, 9, bits, 5, str(tmp_path), key_bytes=0)
    # one scan for each part of the filter, of stretches, not of offsets
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("MapInArrow") == plan.count("Generate inline") == scan.filter_size(found.count(), bits, 5)[0]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exact.collect()))
    assert scan.candidates(targets, found.limit(0), 10, bits=bits, work=str(tmp_path / "none"), key_bytes=0).count() == 0


def test_filter_settings(monkeypatch):
    assert scan.filter_size(1000, 4_000_000, 20) == (1, 4_000_000, 20) and scan.filter_size(1000, 0, 0) == (1, 16_000, scan.HASHES)
    parts, bits, _ = scan.filter_size(10, 4_000_000_000, 20)
    assert parts == 4 and parts * bits >= 4_000_000_000 and bits <= 8 * scan.PART_BYTES


def test_measured_fill(spark):
    rng = random.Random(6)
    rows = [(k, 0, 12, letters(rng, 12)) for k, n in ((0, 3000), (1, 300)) for _ in range(n)]
    found = window_table(spark, rows + rows[:50])
    got = {r["k"]: r for r in scan.measured_fill(found, 12, 100_000, 20).collect()}
    want = {r["k"]: r for r in windows.fill_estimate(found, 100_000, 20).collect()}
    assert got.keys() == want.keys()
    for k in got:
        assert got[k]["n_keys"] == want[k]["n_keys"] and got[k]["fill"] == pytest.approx(want[k]["fill"], rel=0.02) and got[k]["fill"] != want[k]["fill"]


def test_hamming(spark):
    rng = random.Random(7)
    pairs = [(letters(rng, n, "ACGTX"), letters(rng, n, "ACGTX")) for n in [*range(0, 40), 100, 300, 5000]] + [("ACGTX" * 9, "ACGTX" * 9), ("~aZ", "\x01aY")]
    got = spark.createDataFrame(pairs, "a string, b string").select(hamming(F.col("a"), F.col("b")).alias("n")).collect()
    assert [r["n"] for r in got] == [sum(x != y for x, y in zip(a, b)) for a, b in pairs]


def pairs_of_a_hot_key(rng, targets, reads, lengths):
    key = "ACGTACGG"
    rows = []
    for _ in range(targets):
        lead = rng.randint(0, 6)
        rows.append((letters(rng, lead, "AC"), letters(rng, rng.randint(0, 14), "AC")))
    texts = [a + key + b for a, b in rows]
    found = []
    while len(found) < reads:
        q, n = rng.choice([(0, 0), (1, 4)]), rng.choice(lengths)
        r = letters(rng, q[1], "AC") + key + letters(rng, n, "AC")
        found.append((*q, 8, r))
    return texts, sorted(set(found))


@pytest.mark.parametrize("mode", ["first", "best"])
@pytest.mark.parametrize("compat", [False, True])
@pytest.mark.parametrize("share", [0.5, 0.9])
def test_hot_keys_have_the_matches_of_all_pairs(spark, monkeypatch, mode, compat, share):
    rng = random.Random(8)
    texts, rows = pairs_of_a_hot_key(rng, 60, 40, [0, 3, 9])
    targets, found = target_table(spark, [*texts, "CCCCGGGGTTTTAAAA"]), window_table(spark, [*rows, (0, 0, 8, "CCCCGGGGTT"), (1, 4, 8, "CCCCGGGGTTTTA")])
    here = scan.candidates(targets, found, 8, 4, 20)
    plain = matching.best_of_windows(here, found, None, share, 8, mode, 7, 30, compat)
    monkeypatch.setattr(matching, "HOT_PAIRS", 500)
    monkeypatch.setattr(matching, "BLOCK", 13)
    hot = matching.hot_keys(here, found)
    assert [(r["key"], r["target_blocks"] > 1, r["read_blocks"] > 1) for r in hot.collect()] == [("ACGTACGG", True, True)]
    got = matching.best_of_windows(here, found, hot, share, 8, mode, 7, 30, compat)
    columns = ["k", "q", "key", "seq", "tnum", "p", "pos", "tseq", "nmiss"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, plain.select(columns).collect()))
    assert got.filter("key = 'ACGTACGG'").count() > 7


def test_first_mode_stops_when_it_has_enough():
    targets = [(k, 5, 5, b"CACAC" + b"ACGTACGG" + b"T" * 20) for k in range(1000)]
    reads = [(0, 3, f"CAC{'ACGTACGG'}{'T' * (k % 7)}{'G' * (k % 3)}".encode()) for k in range(1000)]
    for mode, bound in (("first", 12_000), ("best", 10**6)):
        seen = []
        rows = matching.first_of_block(targets, reads, 0.5, 8, mode, 10, 30, False, seen.append)
        assert len(rows) == 10 and sum(seen) <= bound
        assert [r[3:5] for r in rows] == sorted(r[3:5] for r in rows)


def test_a_million_pairs_of_one_key(spark):
    """1,000 reads with one window, 1,000 targets that hold it: no plan makes a row of each pair before the limit."""
    rng = random.Random(9)
    key = letters(rng, 12)
    reads = sorted({letters(rng, 5) + key + letters(rng, 6) for _ in range(1000)})
    texts = [rng.choice(reads) + letters(rng, 8) for _ in range(1000)]
    targets, found = target_table(spark, texts), window_table(spark, [(0, 5, 12, r) for r in reads])
    here = scan.candidates(targets, found, 12, 5, 40)
    hot = matching.hot_keys(here, found)
    assert hot.count() == 1
    got = matching.best_of_windows(here, found, hot, 0.6, 12, "first", 10).collect()
    assert len(got) == 10
    every = sorted((t[:5], t[17:23], k, "5", r[:5], r[17:]) for k, t in enumerate(texts) for r in reads if sum(x != y for x, y in zip(r, t)) <= int((1 - 0.6) * 23.0))[:10]
    assert sorted((r["tseq"][:5], r["tseq"][17:], r["tnum"], str(r["p"]), r["seq"][:5], r["seq"][17:]) for r in got) == every


def test_long_sequences_are_compared_as_they_are(spark):
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("ACGTX"), n)) for n in (0, 1, 7, 300, 5000, 70_000)]
    rows = [(k, a, b) for k, (a, b) in enumerate((a, b) for a in texts for b in texts)] + [(-1, None, "A"), (-2, "A", None)]
    got = {r[0]: r[1] for r in S.differing(spark.createDataFrame(rows, "tnum long, a string, b string"), "tnum", "a", "b").collect()}
    for k, a, b in rows[:-2]:
        most = max(len(a), len(b))
        assert got[k] == sum(x != y for x, y in zip(a.ljust(most, "X"), b.ljust(most, "X")))
    assert got[-1] is None and got[-2] is None


def test_batches_of_long_texts_are_bounded(spark):
    from strandloom.plans.staging import BATCH_BYTES, in_batches

    def each(batch):
        yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["bytes", "n"])

    long = spark.range(0, 4000, numPartitions=1).select(F.repeat(F.lit("ACGT"), 2500).alias("seq"))
    got = in_batches(long, each, "bytes bigint, n bigint").collect()
    assert sum(r["n"] for r in got) == 4000 and max(r["bytes"] for r in got) <= 1.1 * BATCH_BYTES
