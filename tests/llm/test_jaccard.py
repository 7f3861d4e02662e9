"""Operator 2 against all pairs, and its parts."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandloom.llm import ngram_jaccard as J
from strandloom.llm.components import components


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def brute(rows, n, part, whole):
    sets = [(i, shingles(t, n)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = {i: 0 for i, _ in sets}
    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and whole * len(s & t) >= part * len(s | t):
                links[i], links[j] = links[i] + 1, links[j] + 1
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return sorted((i, len(s), find(i), links[i]) for i, s in sets)


def rows(seed, words, lengths, n=500, edits=2):
    rng = random.Random(seed)
    found = []
    for i in range(n):
        if rng.random() < 0.5 or not found:
            t = [rng.choice(words) for _ in range(rng.choice(lengths))]
        else:
            t = rng.choice(found)[1].split()
            for _ in range(rng.randint(0, edits)):
                if t:
                    t[rng.randrange(len(t))] = rng.choice(words)
            t = t[:-1] if rng.random() < 0.3 else t
        found.append((i * 7 % 1009, " ".join(t)))
    return found + [(5000, None), (5001, ""), (5002, " \n\t"), (5003, "A B"), (5004, "a\tb")]


@pytest.mark.parametrize("n, part", [(3, 90), (5, 80), (2, 60)])
def test_equals_all_pairs(spark, n, part):
    found = rows(n, [f"w{k}" for k in range(40)], [0, 1, 2, 3, 5, 9, 12, 15, 17, 18, 19, 22, 25, 30, 60, 130])
    got = sorted(map(tuple, J.join(spark.createDataFrame(found, "doc_id long, text string").repartition(3), n, part, 100).collect()))
    assert got == brute(found, n, part, 100)


def test_a_large_group_of_near_copies_is_verified_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "LEAST_TEXTS", 8)
    monkeypatch.setattr(J, "MOST_TEXTS", 16)
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(100)]
    found = []
    for i in range(120):
        t = list(base)
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(100)] = f"x{rng.randrange(10**6)}"
        found.append((i, " ".join(t)))
    got = sorted(map(tuple, J.join(spark.createDataFrame(found, "doc_id long, text string"), 3, 90, 100).collect()))
    assert got == brute(found, 3, 90, 100)


def test_repeated_rows_null_ids_and_an_empty_table(spark):
    found = [(1, "a b c d e f g"), (1, "a b c d e f g"), (1, "other words in this one now"), (None, "a b c d e f g"), (None, None), (7, "a b c d e f g")]
    df = spark.createDataFrame([(i, t, "x") for i, t in found], "doc_id long, text string, component_id string")
    got = sorted((tuple(r) for r in J.join(df).collect()), key=str)
    assert got == sorted([(1, 3, 1, 2), (1, 3, 1, 2), (1, 2, 1, 0), (None, 3, None, 0), (None, 0, None, 0), (7, 3, 1, 2)], key=str)
    assert J.join(df.limit(0)).collect() == []
    kept = J.deduplicate(df)
    assert kept.columns == df.columns and kept.filter("doc_id = 7").count() == 0 and kept.filter("doc_id is null").count() == 2


def test_one_of_the_rows_that_share_an_id_stays(spark):
    copy, near, other = "a b c d e f g h i j k l", "a b c d e f g h i j k z", "other words in this one now"
    found = [(1, copy, "x")] * 3 + [(1, other, "x"), (1, "", "x"), (1, "", "x"), (2, near, "x"), (2, "text of its own in here", "y"), (3, other, "x"), (4, "alone with its id only", "x"), (None, copy, "x"), (None, copy, "x")]
    df = spark.createDataFrame(found, "doc_id long, text string, node string").repartition(3)
    kept = J.deduplicate(df, part=70)
    want = [found[0], found[3], found[4], found[5], found[7], found[9], found[10], found[11]]
    assert kept.columns == df.columns and sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("part", [90, 80, 50])
def test_linked_sets_always_share_an_entry(part):
    rng, plan = np.random.default_rng(part), J.plan(part, 100)
    for size in [*range(1, 45), 60, 100, 300, 1000]:
        for _ in range(6):
            own = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            other = own.copy()
            while True:  # as far away as the threshold allows, by exchanges and losses
                next_ = other.copy()
                if rng.random() < 0.5 and len(next_) > 1:
                    next_ = np.delete(next_, rng.integers(len(next_)))
                else:
                    next_[rng.integers(len(next_))] = rng.integers(0, 2**64, dtype=np.uint64)
                next_ = np.unique(next_)
                both = len(np.intersect1d(own, next_))
                if 100 * both < part * (len(own) + len(next_) - both):
                    break
                other = next_
            if not np.array_equal(own, other):
                common = np.sort(rng.permutation(np.union1d(own, other))[: rng.integers(size + 1)])
                for known in (None, common):
                    assert set(J.entries(own, plan, known).tolist()) & set(J.entries(other, plan, known).tolist())


def test_the_boundary_follows_the_sizes_and_lists_of_the_data(spark):
    plan = J.plan(80, 100, 0)
    assert plan.boundary({12: 100}, {12: 1.0}) < 12 <= plan.boundary({12: 100}, {12: 1000.0})
    assert plan.boundary({}, {}) == 0
    texts = [(k, f"a b c d e f g {k % 5}") for k in range(50)] + [(50, "a b"), (51, None), (52, ""), (53, "w " * 5000)]
    rows = spark.createDataFrame(texts, "id long, text string").withColumn("text", F.col("text").cast("binary"))
    sets, lengths = J.measured(rows, 3, 80, 100)
    assert sets == {1: 1, 6: 5} and 1 <= lengths[6] <= 5


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 150)] + [(7, 7), (200, 200)]
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert got == {(k, 0) for k in range(61)} | {(k, 100) for k in range(100, 150)}


def test_components_of_more_edges_than_a_task_holds():
    from strandloom.llm import components as C

    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 300, 400), rng.integers(0, 300, 400)
    whole = dict(zip(*C.roots(a, b)))
    held = [(a[k : k + 20], b[k : k + 20]) for k in range(0, 400, 20)]
    now = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    for x, y in held:  # contracting what was contracted with what comes next
        nodes, least = C.roots(np.concatenate([now[0], x]), np.concatenate([now[1], y]))
        now = nodes[nodes != least], least[nodes != least]
    assert dict(zip(now[0], now[1])) == {k: v for k, v in whole.items() if k != v}


@pytest.mark.parametrize("held", [0, 30, 100, 1 << 20])
def test_components_by_star_rounds_and_by_one_task_agree(spark, monkeypatch, held):
    from strandloom.llm import components as C

    monkeypatch.setattr(C, "HELD", held)  # no edges are few enough, some are after contraction, or all are
    edges = [(i, i + 1) for i in range(0, 60)] + [(500, i) for i in range(400, 460)] + [(900, 901), (901, 900), (7, 7)]
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long").repartition(8), "test").collect()}
    assert got == {(i, 0) for i in range(61)} | {(i, 400) for i in [*range(400, 460), 500]} | {(900, 900), (901, 900)}
    assert not components(spark.createDataFrame([(3, 3)], "a long, b long"), "test").count()


def test_different_sets_of_one_digest_stay_apart(spark, monkeypatch):
    one, two = [f"a{k}" for k in range(40)], [f"b{k}" for k in range(40)]
    found = [(1, " ".join(one)), (2, " ".join(one + ["x"])), (3, " ".join(two)), (4, " ".join(two + ["y"])), (5, " ".join(two)), (6, "quite another text")]
    known = {J.digest(J.Shingles(3).of(t.encode())): k % 2 for k, t in found[:5]}
    real = J.digest
    # the texts 1 and 3, and 2 and 4, get one digest
    monkeypatch.setattr(J, "digest", lambda own: (known.get(real(own), real(own)[0]), real(own)[1]))
    got = sorted(map(tuple, J.join(spark.createDataFrame(found, "doc_id long, text string"), 3, 90, 100).collect()))
    assert got == brute(found, 3, 90, 100)
    kept = J.deduplicate(spark.createDataFrame([*found, (1, found[2][1])], "doc_id long, text string"), 3, 90, 100)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 1, 6]


def test_texts_that_stay_are_not_dealt(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=20_000)) for _ in range(60)]
    df = spark.createDataFrame([*((i, t, i) for i, t in enumerate(texts)), (60, texts[3] + " more", 60), (None, texts[4], 61)], "doc_id long, text string, other long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = J.deduplicate(df)
        bus, store = spark.sparkContext._jsc.sc().listenerBus(), spark.sparkContext._jsc.sc().statusStore()
        written = lambda: (bus.waitUntilEmpty(), sum(s.shuffleWriteBytes() for s in stages(spark, store)))[1]
        at = written()
        assert sorted(r["other"] for r in kept.collect()) == [*range(60), 61]
        assert written() - at < 200_000  # of 1.2 MB
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def stages(spark, store):
    none = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
    found = store.stageList(None, False, False, none, spark._jvm.java.util.ArrayList())
    return [found.apply(i) for i in range(found.size())]


@pytest.mark.parametrize("bits", [1 << 10, 1 << 16])
def test_the_filter_of_ids_misses_none(spark, monkeypatch, bits):
    monkeypatch.setattr(J, "FILTER_BITS", bits)
    ids = spark.range(0, 3000, 7)
    rows = spark.range(-50, 3000).withColumn("id", F.when(F.col("id") >= -5, F.col("id")))
    clear, unclear = J._apart(rows, F.col("id"), ids)
    clear, unclear = [r["id"] for r in clear.collect()], {r["id"] for r in unclear.collect()}
    assert clear.count(None) == 45 and None not in unclear and unclear >= set(range(0, 3000, 7))
    assert sorted({*clear, *unclear} - {None}) == list(range(-5, 3000)) and len(clear) - 45 + len(unclear) == 3005
