"""The registered matching queries against their SQL, on the smallest tables."""

from collections import Counter

import pytest

from strandloom.operators import matching
from strandloom.plans import queries as Q

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    df = Q.queries()[name](spark, DIR)
    columns = sorted(df.columns)
    got = Counter(tuple(r[x] for x in columns) for r in df.collect())
    want = c.sql(Q.oracle_sql()[name])
    assert sorted(want.columns) == columns
    assert got == Counter(tuple(dict(zip(want.columns, row))[x] for x in columns) for row in want.fetchall())


def test_every_query_has_sql():
    assert set(Q.queries()) == set(Q.oracle_sql())


def test_letters_after_a_prefix_count(spark, tmp_path):
    texts = ["a" * 60 + "bcdac", "a" * 70, "b" * 55]  # a, b, c and d become A, C, G and T
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    # AA, AC, CG, GT, TA, AG
    assert {r["tnum"]: r["n"] for r in Q.dinuc(spark, str(tmp_path)).collect()} == {0: 6, 1: 1, 2: 1}
    # bcd and c, and the five places that the other text lacks; all of 55 and the 15 places beyond
    assert {r["tnum"]: r["nmiss"] for r in Q.hamming(spark, str(tmp_path)).collect()} == {0: 9, 1: 70}


def test_reads_reach_the_end_of_a_long_item(spark, tmp_path):
    texts = ["acgt" * 250 + "tail", "", None, "a"]
    spark.createDataFrame([(2 * k + 2, t) for k, t in enumerate(texts)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["name"].split()[0]: len(r["seq"]) for r in Q.raw_reads(spark, str(tmp_path)).collect()}
    assert got == {f"@r2_{o}_1": min(120, 1004 - o) for o in range(0, 1004, 50)} | {"@r8_0_1": 1}


def test_limits_tolerance_and_repeats_leave_something_out(spark):
    """Else the queries could not tell these operators from none."""
    sf = "/root/testdata/sf0.01"
    n = {k: Q.queries()[k](spark, sf).count() for k in ("kmer_candidates", "verified_matches", "topk_first", "topk_best", "distinct_matches", "prep_reads", "read_dedup")}
    assert n["topk_first"] == n["topk_best"] < n["verified_matches"] and n["read_dedup"] < n["prep_reads"]
    assert Q.read_dedup(spark, sf).filter("names like '%...'").count() > 0
    run = Q.a_run(spark, sf)
    pairs = matching.window_pairs(run.candidates(), run.windows())
    inside = pairs.filter("length(around) - lead + q >= length(seq)").count()
    assert n["verified_matches"] < inside < pairs.count()  # too many mismatches, and reads past a target's end
    assert run.best().count() < run.matches().select("seq", "tseq", "pos", "nmiss", "tnum").distinct().count()
    firsts, bests = (set(map(tuple, Q.queries()[k](spark, sf).collect())) for k in ("topk_first", "topk_best"))
    assert firsts != bests
