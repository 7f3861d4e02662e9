"""Verified matches of candidates with the read windows of their key, and the limits on matches of a window."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import allowed_mismatches, hamming
from ..plans.staging import ship

#: Pairs of a key from which it is hot: its candidates and windows then meet in blocks of at most about so many each.
HOT_PAIRS, BLOCK = 1 << 14, 1 << 11
#: Letters that are compared at once; letters of the target that the original sees from its first offset.
COMPARED, COMPAT_REACH = 8 << 20, 100


def window_pairs(found: DataFrame, windows: DataFrame) -> DataFrame:
    """Candidates with k, q and seq of the read windows of their key; a read can't begin before its target."""
    return found.join(windows, "key").filter(F.col("p") >= F.col("q"))


def verified(pairs: DataFrame, share: float, width: int, compat: bool = False) -> DataFrame:
    """The pairs whose read lies in its target and differs in no more places than allowed: k, q, key, seq, tnum, p,
    pos, tseq, nmiss.

    ``compat`` keeps a limit of the original: a window that starts at the read's first letter and the target's first
    offset sees 100 letters of the target at most. It adds ``tail``, the target's right side as far as is known.
    """
    length, at = F.length("seq"), F.col("lead") - F.col("q")
    rows = pairs.withColumn("pos", (F.col("p") - F.col("q")).cast("int")).withColumn("tseq", F.substr("around", at + 1, length))
    if compat:
        rows = rows.filter((F.col("q") > 0) | (F.col("p") > 0) | (length <= COMPAT_REACH))
    # a read that runs past the target's end gets fewer letters
    rows = rows.filter(F.length("tseq") == length).withColumn("nmiss", hamming(F.col("seq"), F.col("tseq")))
    tail = [F.substr("around", F.col("lead") + width + 1, F.lit(1 << 30)).alias("tail")] if compat else []  # scan order has it as far as the longest read reaches
    return rows.filter(F.col("nmiss") <= allowed_mismatches(length, share)).select("k", "q", "key", "seq", "tnum", "p", "pos", "tseq", "nmiss", *tail)


def limited(matches: DataFrame, mode: str, most: int, width: int, max_read_length: int = 300, compat: bool = False) -> DataFrame:
    """At most ``most`` matches of each window (k, key): the first in scan order, or (any mode but "first") those with
    the fewest mismatches, ties in scan order.

    Scan order is that of lines with the target's left and right sides, its number, the position as text, and the
    read's sides. Without ``compat`` the target's sides are those within the read; with it the right one is as long as
    the longest read allows, and "first" keeps one match more.
    """
    q, length = F.col("q"), F.length("seq")
    left, right = F.substr("tseq", F.lit(1), q), F.substr("tseq", q + width + 1, length)
    if compat:
        right = F.substr("tail", F.lit(1), F.greatest(F.lit(max_read_length - width) - q, F.lit(0)))
    scan = [left, right, F.col("tnum"), F.col("p").cast("string"), F.substr("seq", F.lit(1), q), F.substr("seq", q + width + 1, length)]
    order = scan if mode == "first" else [F.col("nmiss"), *scan]
    rank = F.row_number().over(Window.partitionBy("k", "key").orderBy(*order))
    return matches.withColumn("rank", rank).filter(F.col("rank") <= _most(mode, most, compat)).drop("rank")


def _most(mode: str, most: int, compat: bool) -> int:
    return most + (1 if mode == "first" and compat else 0)


def hot_keys(found: DataFrame, windows: DataFrame, pairs: int | None = None, size: int | None = None) -> DataFrame:
    """key, target_blocks, read_blocks: keys with more than ``pairs`` pairs, and into how many blocks of about ``size``
    rows either side goes."""
    pairs, size = HOT_PAIRS if pairs is None else pairs, BLOCK if size is None else size
    here = found.groupBy("key").agg(F.count("*").alias("targets"))
    there = windows.groupBy("key").agg(F.count("*").alias("reads"))
    blocks = lambda n: F.ceil(F.col(n) / size).cast("int")
    return here.join(there, "key").filter(F.col("targets") * F.col("reads") > pairs).select("key", blocks("targets").alias("target_blocks"), blocks("reads").alias("read_blocks"))


def _sides(texts: list[bytes], q: int, width: int) -> list[tuple[bytes, bytes]]:
    return [(x[:q], x[q + width :]) for x in texts]


def first_of_block(targets: list[tuple], reads: list[tuple], share: float, width: int, mode: str, most: int, max_read_length: int, compat: bool, seen: Callable[[int], None] = lambda pairs: None) -> list[tuple]:
    """Of a block of one key's targets (tnum, p, lead, around) and reads (k, q, seq), for each k no more matches than
    the limit leaves: rows of k, q, seq, tnum, p, tseq, nmiss and tail.

    Both sides are put in scan order and merged: in "first" mode a target is compared with the reads only as long as
    matches are missing. Reads of one length share an order of the targets, so each length has a merge of its own.
    ``seen`` is told how many pairs were compared.
    """
    by_window = defaultdict(list)
    for k, q, seq in reads:
        by_window[k, q, len(seq)].append(seq)
    out = defaultdict(list)
    for (k, q, length), seqs in by_window.items():
        allowed = int((1.0 - share) * float(length))
        reach = max(0, max_read_length - width - q)
        rows = [(around[lead - q : lead - q + length], around[lead + width :], tnum, p) for tnum, p, lead, around in targets if p >= q and not (compat and q == 0 and p == 0 and length > COMPAT_REACH)]
        rows = [r for r in rows if len(r[0]) == length]
        if not rows:
            continue
        scan = lambda r, q=q, reach=reach: (r[0][:q], r[1][:reach] if compat else r[0][q + width :], r[2], str(r[3]))
        rows.sort(key=scan)
        seqs = [s for _, s in sorted(zip(_sides(seqs, q, width), seqs))]
        right = np.frombuffer(b"".join(seqs), np.uint8).reshape(-1, length)
        at, step, best = 0, max(1, most // len(seqs)), []
        while at < len(rows) and not (mode == "first" and len(best) >= most):
            step = min(step, max(1, COMPARED // (len(seqs) * length)))
            left = np.frombuffer(b"".join(r[0] for r in rows[at : at + step]), np.uint8).reshape(-1, length)
            miss = (left[:, None] != right[None]).sum(2)
            seen(miss.size)
            i, j = np.nonzero(miss <= allowed)
            best += zip((miss[i, j] if mode != "first" else np.zeros(len(i), int)).tolist(), (i + at).tolist(), j.tolist(), miss[i, j].tolist())
            at, step = at + step, 2 * step
            if len(best) > most:
                best = sorted(best)[:most]
        out[k, q] += [(rank, scan(rows[i]), _sides([seqs[j]], q, width), (k, q, seqs[j], rows[i][2], rows[i][3], rows[i][0], n, rows[i][1])) for rank, i, j, n in best]
    return [row[-1] for rows in out.values() for row in sorted(rows)[:most]]


def first_of_hot_keys(found: DataFrame, windows: DataFrame, hot: DataFrame, share: float, width: int, mode: str, most: int, max_read_length: int = 300, compat: bool = False) -> DataFrame:
    """The rows of ``verified`` that can be among the matches of a hot key, no more than the limit from each block."""
    ship(found.sparkSession)
    left = found.join(hot, "key").withColumn("target_block", F.pmod(F.xxhash64("tnum", "p"), "target_blocks").cast("int"))
    left = left.select("key", "tnum", "p", "lead", "around", "target_block", F.explode(F.sequence(F.lit(0), F.col("read_blocks") - 1)).alias("read_block"))
    right = windows.join(hot, "key").withColumn("read_block", F.pmod(F.xxhash64("k", "seq"), "read_blocks").cast("int"))
    right = right.select("key", "k", "q", "seq", "read_block", F.explode(F.sequence(F.lit(0), F.col("target_blocks") - 1)).alias("target_block"))
    kept = _most(mode, most, compat)
    names = ["k", "q", "key", "seq", "tnum", "p", "pos", "tseq", "nmiss", *(["tail"] if compat else [])]

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            texts = lambda c: [x.encode() for x in c.to_pylist()]
            targets = list(zip(left["tnum"].to_pylist(), left["p"].to_pylist(), left["lead"].to_pylist(), texts(left["around"])))
            reads = list(zip(right["k"].to_pylist(), right["q"].to_pylist(), texts(right["seq"])))
            rows = first_of_block(targets, reads, share, width, mode, kept, max_read_length, compat)
        key = left["key"][0].as_py() if left.num_rows else None
        columns = {
            "k": pa.array([r[0] for r in rows], pa.int32()), "q": pa.array([r[1] for r in rows], pa.int32()), "key": pa.array([key] * len(rows), pa.string()), "seq": pa.array([r[2].decode() for r in rows], pa.string()),
            "tnum": pa.array([r[3] for r in rows], pa.int64()), "p": pa.array([r[4] for r in rows], pa.int64()), "pos": pa.array([r[4] - r[1] for r in rows], pa.int32()), "tseq": pa.array([r[5].decode() for r in rows], pa.string()),
            "nmiss": pa.array([r[6] for r in rows], pa.int32()), "tail": pa.array([r[7].decode() for r in rows], pa.string()),
        }
        return pa.table({c: columns[c] for c in names})

    schema = "k int, q int, key string, seq string, tnum bigint, p bigint, pos int, tseq string, nmiss int" + (", tail string" if compat else "")
    keys = ("key", "target_block", "read_block")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(block, schema)


def best_of_windows(found: DataFrame, windows: DataFrame, hot: DataFrame | None, share: float, width: int, mode: str, most: int, max_read_length: int = 300, compat: bool = False) -> DataFrame:
    """``limited`` of all verified matches, without ever making the pairs of a hot key as rows."""
    if hot is None:
        rows = verified(window_pairs(found, windows), share, width, compat)
    else:
        rows = verified(window_pairs(found.join(hot, "key", "left_anti"), windows), share, width, compat)
        rows = rows.unionByName(first_of_hot_keys(found, windows, hot, share, width, mode, most, max_read_length, compat))
    return limited(rows, mode, most, width, max_read_length, compat)
