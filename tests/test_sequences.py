"""Scalar functions against plain Python, also on random sequences."""

import random

from pyspark.sql import functions as F

from strandloom.functions import sequences as S


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_normalise_and_reverse(spark):
    got = values(spark, [("ACGTN",), ("acgt",), ("",), (None,)], "s string", S.normalised(F.col("s")), S.reverse_complement(S.normalised(F.col("s"))))
    assert got == [("ACGTX", "XACGT"), ("XXXX", "XXXX"), ("", ""), (None, None)]


def test_dinucleotides(spark):
    rng = random.Random(1)
    rows = [("".join(rng.choice("ACGTNX") for _ in range(n)),) for n in (0, 1, 2, 3, 10, 40, 80)]
    plain = lambda s: len({tuple(c if c in "ACGT" else "X" for c in s[i : i + 2]) for i in range(len(s) - 1)})
    assert [x for (x,) in values(spark, rows, "s string", S.dinucleotides(F.col("s")))] == [plain(s) for (s,) in rows]


def test_hamming_counts_x_as_equal_to_x(spark):
    rng = random.Random(2)
    rows = [("XXA", "XXC")] + [tuple("".join(rng.choice("ACGTX") for _ in range(n)) for _ in "ab") for n in (1, 7, 50)]
    assert [x for (x,) in values(spark, rows, "a string, b string", S.hamming(F.col("a"), F.col("b")))] == [sum(x != y for x, y in zip(a, b)) for a, b in rows]


def test_allowed_mismatches_is_cut_in_double_precision(spark):
    assert values(spark, [(100,), (20,), (0,)], "n int", S.allowed_mismatches(F.col("n"), 0.9)) == [(9,), (1,), (0,)]


def test_names(spark):
    rows = [("@r1 more words",), ("  @r2",), ("a" * 1000,), ("a" * 1001,)]
    got = values(spark, rows, "s string", S.first_token(F.col("s")), S.shortened(F.col("s")))
    assert got[0] == ("@r1", "@r1 more words") and got[1][0] == "@r2"
    assert got[2][1] == "a" * 1000 and got[3][1] == "a" * 995 + "..."
    assert values(spark, [(7,)], "n long", S.padded_number(F.col("n"))) == [("00000000007",)]
