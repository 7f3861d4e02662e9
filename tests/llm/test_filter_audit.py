"""The filter audit against five filters applied document by document, in all orders."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from strandloom.llm import filter_audit

RESULT = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def texts():
    rng = random.Random(8)
    found = []
    for _ in range(120):
        words = [rng.choice(["aa", "bb", "Cc", "DDD", "x#", "é", "\U0001d7d8"]) + str(rng.randint(0, rng.choice([3, 500]))) for _ in range(rng.choice([0, 5, 49, 50, 51, 120]))]
        found.append(rng.choice([" ", "\n", "\x0b ", "\x1c"]).join(words))
    return found + ["", None, " ", "\t", "A" * 40, "word\xa0word", "|", "  lead and trail  ", "repeat " * 400_000]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    pool = texts()
    found = [(k, t, rng.choice(["web", "books", None, ""])) for k, t in enumerate(pool)]
    found += [(rng.randint(0, 400), rng.choice(pool[:-1]), rng.choice(["web", "books"])) for _ in range(300)]
    found += [(None, pool[3], "web"), (None, pool[3], "books"), (None, "only here", "web"), (5, pool[5], "books"), (5, pool[5], "books")]
    return found + [(1000 + k, "hot text that very many have", "web") for k in range(900)]


def brute(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    failed = []
    for i, t, part in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and first[t] < i}
        failed.append((part or "", frozenset(k for k, v in fails.items() if v), i in good and i is not None, i in toxic and i is not None))
    out, shapley = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        tally = defaultdict(Counter)
        for part, fails, g, x in failed:
            gone = next((k for k, f in enumerate(order, 1) if f in fails), 6)
            for step, f in enumerate(order, 1):
                c = tally[part, step]
                c["kept"] += gone > step
                c["removed"] += gone == step
                c["redundant"] += f in fails and gone < step
                c["unique_fails"] += fails == {f}
                c["good_lost"] += gone == step and g
                c["toxic_lost"] += gone == step and x
        for (part, step), c in tally.items():
            out[part, order, step] = c
            shapley[part, order[step - 1]] += c["removed"]
    return {k: (*(c[x] for x in RESULT[:-1]), shapley[k[0], k[1][k[2] - 1]]) for k, c in out.items()}


def test_every_order(spark, rows):
    labels = [(k, k % 2, int(k % 7 == 0)) for k in range(0, 1500, 3)] + [(4, None, 1), (4, 1, None), (4, 0, 0), (None, 1, 1), (9999, 1, 1)]
    docs = spark.createDataFrame([("x", i, 1, t, s, 2) for i, t, s in rows], "DOC_ID string, doc_id long, TEXT int, text string, source string, E int").repartition(6)
    marks = spark.createDataFrame([("x", *r, 7) for r in labels], "DOC_ID string, doc_id long, quality int, toxic int, QUALITY int")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in RESULT) for r in filter_audit.audit(docs, marks).collect()}
    want = brute(rows, labels)
    assert len(got) == 3 * 600 and got == want
    parts = {k[0] for k in got}
    for part in parts:  # a filter's value, shared over all orders, adds up to all that is removed
        last = got[part, "ABCDE", 5]
        n = sum((s or "") == part for _, _, s in rows)
        assert sum(got[part, "ABCDE", k][6] for k in range(1, 6)) == 120 * (n - last[0])


def test_empty_tables_and_no_labels(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs.limit(0), marks).count() == 0
    got = filter_audit.audit(docs, marks)
    assert got.filter("good_lost <> 0 or toxic_lost <> 0").count() == 0 and got.filter("removed > 0").count() > 0


def test_a_hot_text_is_counted_before_it_is_dealt(spark, rows):
    """The plan adds up rows of one text and id in map tasks, and joins no text."""
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = filter_audit.failures(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_sum" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
