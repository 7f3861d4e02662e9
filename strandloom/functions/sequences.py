"""Scalar functions on sequences over A, C, G, T and X, as Column expressions."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.staging import in_batches
from .rolling import text_bytes

#: Longest name that is kept whole, and how much of a longer one stays before "...".
NAME_LIMIT, NAME_KEPT = 1000, 995


def normalised(seq: Column) -> Column:
    """Everything but the capitals A, C, G and T becomes X."""
    return F.regexp_replace(seq, "[^ACGT]", "X")


def reverse_complement(seq: Column) -> Column:
    """The sequence backwards with A and T, C and G exchanged; X stays."""
    return F.translate(F.reverse(seq), "ACGT", "TGCA")


def dinucleotides(seq: Column) -> Column:
    """Number of distinct adjacent pairs, all letters but A, C, G and T being one; 0 for fewer than two letters."""
    # one search for each pair there can be: substr() would walk a long text from its start for every place
    pairs = [x + y for x in "ACGTX" for y in "ACGTX"]
    found = F.transform(F.array(normalised(seq)), lambda plain: reduce(add, (F.contains(plain, F.lit(p)).cast("int") for p in pairs)))
    return found[0]


def packed(seq: Column) -> Column:
    """An ASCII text as whole numbers of eight letters each, the last of as many as are left."""
    return F.transform(F.regexp_extract_all(F.hex(seq), F.lit(".{1,16}"), F.lit(0)), lambda x: F.conv(x, 16, -10).cast("bigint"))


def hamming(a: Column, b: Column) -> Column:
    """Number of places that differ in two sequences of one length; X equals X.

    Eight letters are compared at a time: of each letter's byte the differing bits are folded into one, and these counted.
    """

    def places(x: Column, y: Column) -> Column:
        bits = x.bitwiseXOR(y)
        for step in (4, 2, 1):
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, step))
        return F.bit_count(bits.bitwiseAND(F.lit(0x0101010101010101)))

    return F.aggregate(F.zip_with(packed(a), packed(b), places), F.lit(0), lambda n, d: n + d)


def differing(rows: DataFrame, key: str, a: str, b: str, to: str = "nmiss") -> DataFrame:
    """``key`` and the number of places that differ in two ASCII sequences of a row, the shorter one taken to go on with
    X: ``hamming`` for long sequences, whose letters are compared in tasks as they are, without a number for each eight."""

    def counted(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        (at, one), (to_at, two) = text_bytes(batch.column(1)), text_bytes(batch.column(2))
        found = np.zeros(batch.num_rows, np.int32)
        for k, (i, j, m, n) in enumerate(zip(at[:-1].tolist(), to_at[:-1].tolist(), at[1:].tolist(), to_at[1:].tolist())):
            both = min(m - i, n - j)
            found[k] = np.count_nonzero(one[i : i + both] != two[j : j + both]) + np.count_nonzero(one[i + both : m] != 88) + np.count_nonzero(two[j + both : n] != 88)
        empty = pc.or_(batch.column(1).is_null(), batch.column(2).is_null())
        yield pa.RecordBatch.from_arrays([batch.column(0), pc.if_else(empty, pa.scalar(None, pa.int32()), pa.array(found))], names=[key, to])

    return in_batches(rows.select(key, a, b), counted, f"`{key}` {dict(rows.dtypes)[key]}, `{to}` int")


def allowed_mismatches(length: Column, share: float) -> Column:
    """How many places may differ if ``share`` must match: in double precision, cut to a whole number."""
    return ((F.lit(1.0) - F.lit(float(share))) * length.cast("double")).cast("int")


def first_token(name: Column) -> Column:
    """The first stretch of a name without white space."""
    return F.regexp_extract(name, r"^\s*(\S+)", 1)


def shortened(name: Column) -> Column:
    """Names over the limit are cut and end in three dots."""
    return F.when(F.length(name) > NAME_LIMIT, F.concat(F.substring(name, 1, NAME_KEPT), F.lit("..."))).otherwise(name)


def padded_number(n: Column) -> Column:
    """Eleven digits, so that the order of texts is that of numbers."""
    return F.lpad(n.cast("string"), 11, "0")
