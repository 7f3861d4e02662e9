"""Packing against the tokenizers library and against best fit of one piece after the other."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

from strandloom.llm import packing  # noqa: E402

PATH = public.path("byte_bpe_50k.json")


def one_by_one(lengths, window):
    """Sizes of the pieces in each window: every piece, from long to short, goes to the fullest window that holds it."""
    windows = []
    for n in sorted(lengths, reverse=True):
        fitting = [w for w in windows if sum(w) + n <= window]
        if fitting:
            min(fitting, key=lambda w: window - sum(w)).append(n)
        else:
            windows.append([n])
    return windows


def unrolled(plan, lengths):
    """Window and offset of every piece of a plan."""
    for length, count in lengths.items():
        runs = plan.runs[length]
        for k in range(count):
            begin, first, each, at = [r for r in runs if r[0] <= k][-1]
            yield first + (k - begin) // each, at + (k - begin) % each * length, length


@pytest.mark.parametrize("window", [1, 7, 64, 100])
def test_plan_equals_placing_one_by_one(window):
    rng = random.Random(window)
    for _ in range(60):
        lengths = Counter(rng.choice([rng.randint(1, window), rng.randint(1, max(1, window // 4)), max(1, window // 2)]) for _ in range(rng.randint(0, 120)))
        plan = packing.best_fit_decreasing(lengths, window)
        found = defaultdict(list)
        for at, offset, length in unrolled(plan, lengths):
            found[at].append((offset, length))
        assert sorted(found) == list(range(plan.windows))
        for pieces in found.values():
            used = 0
            for offset, length in sorted(pieces):
                assert offset == used
                used += length
            assert used <= window
        # windows of one capacity may be exchanged: how full they become is fixed, not with what
        assert Counter(sum(n for _, n in p) for p in found.values()) == Counter(map(sum, one_by_one(lengths.elements(), window)))


def test_plan_takes_few_steps_for_many_pieces():
    rng = np.random.default_rng(1)
    plan = packing.best_fit_decreasing({n: int(c) for n, c in enumerate(rng.integers(1, 10**12, 1024), 1)}, 1024)
    assert sum(map(len, plan.runs.values())) < 10_000 and plan.windows > 10**11


def test_tightest_capacity():
    tree, rng = packing.Capacities(100), random.Random(3)
    held = Counter()
    for _ in range(3000):
        if held and rng.random() < 0.4:
            c = rng.choice(list(held))
            tree.take(c)
            held[c] -= 1
            held += Counter()
        else:
            c = rng.randint(1, 100)
            tree.add(c, 0, 1)
            held[c] += 1
        least = rng.randint(1, 100)
        assert tree.tightest(least) == min((c for c in held if c >= least), default=None)


def test_pieces_of_whole_texts(spark):
    rng = random.Random(5)
    words = ["alpha", "beta", " gamma,", "\n", "日本", "<|endoftext|>", "x1y2", "  "]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 40, 700, 2500]))) for _ in range(150)] + [None, "", "word " * 300_000] + ["the same text"] * 400
    rows = [("x", k, t, 5, 6) for k, t in enumerate(texts)] + [("x", None, "no id", 5, 6)] + [("x", 3, texts[3], 5, 6)] * 2
    docs = spark.createDataFrame(rows, "DOC_ID string, doc_id long, text string, length int, ids int").repartition(7)
    packed = packing.pack(docs, PATH)
    got = packing.checksums(packed).collect()
    library = tokenizers.Tokenizer.from_file(PATH)
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    copies = Counter(i for _, i, *_ in rows)
    assert by_doc.keys() == copies.keys()
    lengths = []
    for _, i, text, *_ in {r[1]: r for r in rows}.values():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        want = [(k, min(1024, len(ids) - k), zlib.crc32(np.array(ids[k : k + 1024], "<u4").tobytes()), len(ids)) for k in range(0, len(ids), 1024)]
        assert sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in by_doc[i]) == sorted(want * copies[i])
        lengths += [w[1] for w in want] * copies[i]
    for pieces in sequences.values():
        used = 0
        for offset, length in sorted(pieces):
            assert offset == used
            used += length
        assert used <= 1024
    assert sorted(sequences) == list(range(len(sequences)))
    want = one_by_one([n for n in lengths if n < 1024], 1024)
    assert len(sequences) == sum(n == 1024 for n in lengths) + len(want)
    whole = [n & (n - 1) == 0 for n in (sum(w) for w in want)]
    assert packing.padding(packed).first()["padding"] == sum(1024 - sum(w) for w, p in zip(want, whole) if not p)
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_counts_of_tasks_may_be_many(spark, monkeypatch):
    """Beyond the broadcast limit the tasks' counts are joined by shuffle, and nothing else changes."""
    docs = spark.createDataFrame([(k, "a b c " * (k % 50)) for k in range(300)], "doc_id long, text string").repartition(5, "doc_id")
    one = packing.checksums(packing.pack(docs, PATH)).collect()
    monkeypatch.setattr(packing, "BROADCAST_COUNTS", 0)
    assert sorted(packing.checksums(packing.pack(docs, PATH)).collect()) == sorted(one)
