"""Operators 3, 4, 5 and 9: held-out accuracy, recall and exact counts against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandloom.llm import ann, lang_id, lm, quality
from strandloom.llm.common import crc_fold, fold

DIR = "/root/testdata/sf0.01"
WORDS = {"aa": ["uno", "due", "tre", "quattro", "cinque"], "bb": ["eins", "zwei", "drei", "vier", "fünf"], "cc": ["один", "два", "три"]}


def test_fold_is_crc32_of_the_id_as_text(spark):
    rows = [(k,) for k in range(50)] + [(None,)]
    got = spark.createDataFrame(rows, "doc_id long").select("doc_id", fold("doc_id", 3).alias("f")).collect()
    assert all(r["f"] == crc_fold(r["doc_id"], 3) for r in got)


def test_languages_of_held_out_texts(spark):
    got = lang_id.held_out(spark.read.parquet(f"{DIR}/documents.parquet"))
    joined = got.join(spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(joined) == 1000 and all(0 <= r["score"] <= 1 for r in joined)
    out = [r for r in joined if r["held_out"]]
    assert all(r["held_out"] == (crc_fold(r["doc_id"], 3) == 1) for r in joined)
    assert sum(r["lang_pred"] == r["lang"] for r in out) / len(out) > 0.97


def test_language_corner_cases(spark):
    rng = random.Random(1)
    rows = [(k, " ".join(rng.choice(WORDS[lang]) for _ in range(20)), lang) for k, lang in enumerate(["aa", "bb", "cc"] * 30)]
    rows += [(100, None, "aa"), (101, "", None), (102, "12 - 3!", "bb"), (None, "uno due", None), (103, "tre " * 40000, None), (103, "tre " * 40000, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, lang_pred string")
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in lang_id.held_out(df).collect()]
    assert len(got) == len(rows)
    by = {k: p for k, p, _ in got}
    assert by[100] == by[101] == by[102] == "und" and by[None] == "aa" and by[103] == "aa"
    assert sum(by[k] == lang for k, _, lang in rows[:90]) > 85
    one = lang_id.predict(df, lang_id.fit(df.filter("lang = 'bb'")))
    assert {r["lang_pred"] for r in one.collect()} == {"bb", "und"}
    nothing = lang_id.predict(df, lang_id.fit(df.limit(0)))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"} and lang_id.held_out(df.limit(0)).count() == 0


def test_codewords_are_apart():
    for k in (2, 3, 4, 6, 7, 20):
        code = lang_id.codewords(k)
        distances = [(code[i] != code[j]).sum() for i in range(k) for j in range(i)]
        assert min(distances) >= 1 and (k not in (7, 20) or min(distances) >= 5)


def test_a_profile_does_not_depend_on_pieces(monkeypatch):
    text = ("wörter und " * 300).encode()
    whole = lang_id.profile(text)
    monkeypatch.setattr(lang_id, "PIECE", 97)
    assert np.array_equal(whole, lang_id.profile(text))


def test_quality_of_held_out_texts(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = quality.held_out(documents, labels).join(labels.select("doc_id", "quality"), "doc_id").collect()
    out = [r for r in got if r["held_out"]]
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in got)
    good, bad = ([r for r in out if r["quality"] == q] for q in (1, 0))
    assert sum(r["predicted"] == 1 for r in good) / len(good) > 0.98
    assert sum(r["predicted"] == 0 for r in bad) / len(bad) > 0.9


def test_quality_corner_cases(spark):
    rows = [(1, "good words stand here. " * 30), (2, "### $$$ %%% " * 50), (3, None), (4, ""), (None, "good"), (5, "x" * 100_000), (5, "x" * 100_000)]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, None), (9, 1), (None, 1), (4, 7)], "doc_id long, quality int")
    net = quality.fit(df, labels)
    got = {r["doc_id"]: r["score"] for r in quality.score(df, net).collect()}
    assert got[1] > 0.5 > got[2] and quality.score(df, net).count() == len(rows) and got[3] == got[4]
    kept = quality.good(df, net)
    assert kept.columns == df.columns and {1} <= {r["doc_id"] for r in kept.collect()} and 2 not in {r["doc_id"] for r in kept.collect()}
    assert quality.score(df.limit(0), net).count() == 0
    assert quality.score(df, quality.fit(df, labels.limit(0))).count() == len(rows)


def test_chunks_cover_a_text():
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        text = bytes(k % 250 + 1 for k in range(n))
        rows = quality.chunks(text)
        seen = np.zeros(len(rows) * quality.STEP + quality.CHUNK, np.uint8)
        for k, r in enumerate(rows):
            seen[k * quality.STEP : k * quality.STEP + quality.CHUNK] = r
        assert seen[:n].tobytes() == text and not seen[n:].any()


def nearest(rows, every, k):
    out = {}
    rows = sorted(set((i, tuple(v)) for i, v in rows))
    for i, v in rows:
        if i % every == 0:
            scored = sorted((-sum(float(a) * float(b) for a, b in zip(v, w)), j) for j, w in rows if j != i)[:k]
            out[i] = [(n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    return out


def asked(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {k: sorted(v) for k, v in out.items()}


def test_neighbours_of_few_vectors_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.standard_normal(8).astype(np.float32).tolist()) for k in range(60)]
    rows += [(100 + k, rows[0][1]) for k in range(50)]  # one vector many times
    odd = [(500, None), (520, [0.0] * 8), (540, [float("nan")] * 8), (560, [float("inf")] + [1.0] * 7), (580, [None] + [1.0] * 7), (600, [1.0, 2.0]), (None, [1.0] * 8), rows[3]]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + odd], "vec_id long, embedding array<float>, score string")
    got, want = asked(ann.search(df)), nearest(rows, 20, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [x[:2] for x in got[q]] == [x[:2] for x in want[q]]
        assert np.allclose([x[2] for x in got[q]], [x[2] for x in want[q]], rtol=0, atol=1e-9)
    few = asked(ann.search(df.filter("vec_id < 5")))
    assert {k: len(v) for k, v in few.items()} == {0: 4}
    assert ann.search(df.limit(0)).count() == 0 and ann.search(df.filter("vec_id = 520")).count() == 0


def test_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    got, hit, n = asked(ann.search(df)), 0, 0
    for i in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[i]
        scores[i] = -np.inf
        top = set(ids[np.lexsort((ids, -scores))[:20]].tolist())
        hit, n = hit + len(top & {j for _, j, _ in got[ids[i]]}), n + 20
    assert hit / n >= 0.9


@pytest.mark.parametrize("kind", ["queries elsewhere", "copies apart by very little"])
def test_recall_on_other_rows(spark, kind):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((6000, 32))
    if kind == "queries elsewhere":
        x[np.arange(6000) % 20 > 0] *= 0.1
        x[np.arange(6000) % 20 > 0] += 2 * rng.standard_normal(32)
    else:
        x = x[rng.integers(0, 2, 6000)] + 1e-5 * x
    x = x.astype(np.float32).astype(np.float64)
    got, hit, n = asked(ann.search(spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<float>"))), 0, 0
    for i in range(0, 6000, 20):
        scores = x @ x[i]
        scores[i] = -np.inf
        assert [r for r, _, _ in got[i]] == list(range(1, 21))
        hit, n = hit + len(set(np.argsort(-scores)[:20].tolist()) & {j for _, j, _ in got[i]}), n + 20
    assert hit / n >= 0.95


def test_language_model(spark):
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice(["the cat", "a dog", "Runs", "far", f"rare{rng.randrange(200)}"]) for _ in range(rng.randint(0, 30)))) for k in range(300)]
    rows += [(900, None), (901, " \n"), (None, "the cat"), (902, "new words only"), (903, "the cat runs"), (903, "the cat runs"), (904, "far " * 20000)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double").repartition(3)
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) + [None]
    count = Counter(w for k, t in rows if crc_fold(k, 5) != 1 for w in words(t))
    total, distinct = sum(count.values()), len(count)
    got = lm.held_out(spark, df).collect()
    assert len(got) == len(rows)
    texts = {k: t for k, t in rows}
    for r in got:
        own = words(texts[r["doc_id"]])
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(count[w] > 0 for w in own), total)
        assert abs(base - r["base_score"]) < 1e-6 * max(1, abs(base)) and r["score"] < 0
        assert r["held_out"] == (crc_fold(r["doc_id"], 5) == 1)
    out = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 300]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)  # it knows what follows what
    assert lm.held_out(spark, df.limit(0)).count() == 0
    alone = lm.score(df, df.limit(0)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and abs(r["base_score"]) < 1e-9 for r in alone)


def test_all_pairs_count_in_the_fit(spark):
    texts = spark.createDataFrame([("a b c a b " * k,) for k in range(1, 30)] + [("rare once",)], "text string").select(F.col("text").cast("binary"))
    head = lm.head_of(lm.word_counts(texts), lm.HEAD)
    pairs = lm.pair_counts(texts, head)
    want = {r["cell"]: r["n"] for r in pairs.collect()}
    got = lm.whole_counts(pairs)
    assert got.shape == (lm._BEGIN + 1, lm._ALL) and int(got.sum()) == sum(want.values()) == head.total
    assert {int(k): int(got.ravel()[k]) for k in np.flatnonzero(got)} == want


def test_model_probabilities_add_up_to_one(spark):
    """Over all words that follow one context, the unseen one included."""
    train = spark.createDataFrame([("a b a c d e",), ("a b b f",)], "text string")
    words = ["a", "b", "c", "d", "e", "f", "unseen"]
    got = {r["doc_id"]: r["score"] for r in lm.score(spark.createDataFrame([(k, w) for k, w in enumerate(words)] + [(99, "")], "doc_id long, text string"), train).collect()}
    counts = lm.word_counts(train.select(F.col("text").cast("binary")))
    head = lm.head_of(counts, lm.HEAD)
    model = lm.fit(lm.pair_counts(train.select(F.col("text").cast("binary")), head), head)
    assert np.allclose(np.exp(model.r @ model.q.T + model.b - model.total[:, None]).sum(1), 1, atol=1e-4)
    # the probability of a one-word text is that of the word at the start times that of the end after it
    known = 1 - 0.5 / (head.total + 0.5 * (head.distinct + 1))
    context = {w: head.context[head.number[w.encode()]] if w != "unseen" else lm.CONTEXTS + lm.class_of(b"unseen") for w in words}
    after = {w: known * np.exp(model.likely(np.array([context[w]]), np.array([0])))[0] for w in words}
    assert abs(sum(10 ** got[k] / after[w] for k, w in enumerate(words)) + 10 ** got[99] - 1) < 1e-3


def test_model_probabilities_add_up_to_one_over_classes_and_words_beyond_the_head(spark):
    rng = random.Random(2)
    texts = [" ".join([f"w{rng.randrange(40)}" for _ in range(8)] + [f"x{k}", f"x{k + 1}"]) for k in [*range(0, 9000, 2), *range(0, 7400, 2)]]
    seen = sorted({w for t in texts for w in t.split()}) + ["unseen"]
    train = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    asked = spark.createDataFrame(list(enumerate([*(f"w0 {w}" for w in seen), "w0"])), "doc_id long, text string")
    rows = lm.score(asked, train, head_words=8000).collect()
    got = {r["doc_id"]: r["score"] for r in rows}
    assert sum(r["n_known"] for r in rows) == sum(r["n_tokens"] for r in rows) - 1
    counts = lm.word_counts(train.select(F.col("text").cast("binary")))
    head = lm.head_of(counts, 8000)
    assert lm.SYMBOLS < len(head.n) <= 8000 < head.distinct and head.class_n.sum() + head.n[: lm.SYMBOLS].sum() == head.total and head.class_words.sum() == head.distinct - lm.SYMBOLS
    model = lm.fit(lm.pair_counts(train.select(F.col("text").cast("binary")), head), head)
    known = 1 - 0.5 / (head.total + 0.5 * (head.distinct + 1))

    def end_after(w):
        k = head.number.get(w.encode())
        context = head.context[k] if k is not None else lm.CONTEXTS + lm.class_of(w.encode())
        return known * math.exp(model.likely(np.array([context]), np.array([0]))[0])

    start = 10 ** got[len(seen)] / end_after("w0")  # of w0 at a text's start
    # of each word after w0: the score of both without the start and the end
    assert abs(sum(10 ** got[k] / start / end_after(w) for k, w in enumerate(seen)) + end_after("w0") - 1) < 1e-4


@pytest.mark.parametrize("n", [1, 5, 300])
def test_means_have_as_many_centres_as_wanted(n):
    x = np.random.default_rng(0).standard_normal((300, 4)).astype(np.float32)
    assert len(ann._means(x, n, np.random.default_rng(1))) == n
