"""Language-model scores.

A log-bilinear model gives each token from the one before it: the score of symbol w in context h is r_h . q_w + b_w,
trained in numpy by noise-contrastive estimation. Symbols are the frequent words and classes of all other words by
their last bytes, contexts likewise, so the network takes part in the score of every known token and has a fixed size;
its statistics, counts of all words and of all context-symbol pairs, come from the whole training part. A word of a
class has its share of the class's probability by its count. All unseen words together have the probability of half a
token, whatever the context, and the others share the rest, so the probabilities of all tokens add up to one.

Word counts stay a distributed table. Words above a count that at most ``HEAD`` words reach are sent to the executors;
the others are joined by word.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, arrow_map, fold, pick, slices, stored

#: Most words that are sent to executors; symbols that are words; contexts that are words; classes of other words;
#: numbers per vector.
HEAD, SYMBOLS, CONTEXTS, CLASSES, DIM = 300_000, 7168, 3071, 1024, 32
#: Steps of the estimation over all pairs; noise symbols for each pair.
ROUNDS, NOISE = 60, 256
#: Counted words and pairs that a task holds before it passes them on.
HELD = 500_000
END = b"\n"  # the end token; no word holds it
_BEGIN = CONTEXTS + CLASSES  # the context at a text's start
_ALL = SYMBOLS + CLASSES


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


def _texts(column: pa.Array) -> list[bytes]:
    at, data = slices(column)
    return [bytes(data[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def word_counts(texts: DataFrame) -> DataFrame:
    """word (binary) and n of all tokens of a one-column table of texts, ends of texts included."""

    def make():
        held: Counter = Counter()

        def flush():
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()

        def each(batch: pa.RecordBatch):
            for t in _texts(batch.column(0)):
                held.update(words_of(t))
            held[END] += batch.num_rows
            if len(held) > HELD:
                yield from flush()

        each.finish = flush
        return each

    return arrow_map(texts, make, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Head:
    """The frequent words: numbers by falling count (the end token first), counts, contexts."""

    def __init__(self, found: list[tuple[bytes, int]], total: int, distinct: int) -> None:
        found = sorted(found, key=lambda x: (x[0] != END, -x[1], x[0]))
        self.number = {w: k for k, (w, _) in enumerate(found)}
        self.n = np.array([n for _, n in found], np.float64)
        self.total, self.distinct = total, distinct
        own = np.array([class_of(w) for w, _ in found], np.int64)
        place = np.arange(len(found))
        self.context = np.where(place < CONTEXTS, place, CONTEXTS + own)
        self.symbol = np.where(place < SYMBOLS, place, SYMBOLS + own)
        #: Tokens and distinct words of each class, those beyond the head included.
        self.class_n, self.class_words = np.zeros(CLASSES), np.zeros(CLASSES)


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


def head_of(counts: DataFrame, most: int) -> Head:
    """The words above the least eighth of a power of two that at most ``most`` words reach, and the totals."""
    step = F.floor(F.log2("n") * 8)
    sizes = {r["step"]: (r["words"], r["n"]) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect()}
    total, distinct = sum(n for _, n in sizes.values()), sum(w for w, _ in sizes.values())
    room, least = most, 1 << 30
    for k in sorted(sizes, reverse=True):
        room -= sizes[k][0]
        if room < 0:
            break
        least = k
    own = (step >= least) | (F.col("word") == F.lit(END))
    found = counts.filter(own).select("word", "n").toArrow()
    head = Head(list(zip(found["word"].to_pylist(), found["n"].to_pylist())), total, distinct)
    # END, a word of one byte, is always in the head
    end = F.expr("substring(word, greatest(octet_length(word) - 2, 1), 3)")
    for r in counts.filter(~own).groupBy((F.crc32(end) % CLASSES).alias("class")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():  # CLASSES rows
        head.class_n[r["class"]], head.class_words[r["class"]] = r["n"], r["words"]
    rest = head.symbol >= SYMBOLS
    np.add.at(head.class_n, head.symbol[rest] - SYMBOLS, head.n[rest])
    np.add.at(head.class_words, head.symbol[rest] - SYMBOLS, 1)
    return head


def _numbered(head: Head, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """All tokens of the texts: numbers (-1: not in the head), symbols, contexts, where each text ends, and the words."""
    words: list[bytes] = []
    ends = []
    for t in texts:
        words += words_of(t)
        words.append(END)
        ends.append(len(words))
    get = head.number.get
    number = np.array([get(w, -1) for w in words], np.int64)
    if len(head.n):
        context, symbol = head.context[number], head.symbol[number]
    else:
        context, symbol = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    far = np.flatnonzero(number < 0)
    own = np.array([class_of(words[i]) for i in far.tolist()], np.int64)
    context[far], symbol[far] = CONTEXTS + own, SYMBOLS + own
    ends = np.array(ends, np.int64)
    before = np.empty(len(words), np.int64)
    before[1:] = context[:-1]
    before[np.concatenate([[0], ends[:-1]])] = _BEGIN
    return number, symbol, before, ends, words


def _summed(cells: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not cells:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    own, at = np.unique(np.concatenate(cells), return_inverse=True)
    return own, np.bincount(at, np.concatenate(times), len(own)).astype(np.int64)


def pair_counts(texts: DataFrame, head: Head) -> DataFrame:
    """cell (context times symbols, plus symbol) and n: how often each symbol follows each context in all texts."""
    sent = texts.sparkSession.sparkContext.broadcast(head)

    def make():
        cells, times = [], []

        def flush():
            own, n = _summed(cells, times)
            cells.clear(), times.clear()
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(n)], names=["cell", "n"])

        def each(batch: pa.RecordBatch):
            _, symbol, before, _, _ = _numbered(sent.value, _texts(batch.column(0)))
            own, n = np.unique(before * _ALL + symbol, return_counts=True)
            cells.append(own)
            times.append(n)
            if sum(map(len, cells)) > HELD:
                own, n = _summed(cells, times)
                cells[:], times[:] = [own], [n]
                if len(own) > HELD:
                    yield from flush()

        each.finish = flush
        return each

    return arrow_map(texts, make, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))


class Model:
    """Vectors of contexts and symbols, biases, and each context's normaliser."""

    def __init__(self, r: np.ndarray, q: np.ndarray, b: np.ndarray) -> None:
        self.r, self.q, self.b = r, q, b
        # a product of all contexts with all symbols, some contexts at a time
        self.total = np.concatenate([np.log(np.exp(z - (m := z.max(1, keepdims=True))).sum(1)) + m[:, 0] for z in (r[k : k + 256] @ q.T + b for k in range(0, len(r), 256))])

    def likely(self, before: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Normalised log-probabilities (base e) of symbols after contexts."""
        out = np.empty(len(symbol), np.float64)
        for k in range(0, len(symbol), 1 << 16):
            h, w = before[k : k + (1 << 16)], symbol[k : k + (1 << 16)]
            out[k : k + (1 << 16)] = np.einsum("nd,nd->n", self.r[h], self.q[w]) + self.b[w] - self.total[h]
        return out


def _sums(like: np.ndarray, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """An array like the given one with the sums of the rows of each place."""
    out, order = np.zeros_like(like), np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    out[at[first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


def whole_counts(pairs: DataFrame) -> np.ndarray:
    """All counts of pairs as one array of contexts x symbols, of one size however large the training part is."""
    n = np.zeros((_BEGIN + 1) * _ALL, np.float32)
    # a context's cells in one row, some partitions at a time
    rows = pairs.groupBy(F.floor(F.col("cell") / _ALL).alias("context")).agg(F.collect_list("cell").alias("cells"), F.collect_list(F.col("n").cast("double")).alias("n"))

    def packed(batches):
        for batch in batches:
            for cells, times in zip(batch.column(1), batch.column(2)):
                yield pa.RecordBatch.from_arrays([pa.array([cells.values.to_numpy().astype("<i4").tobytes()], pa.binary()), pa.array([times.values.to_numpy().astype("<f4").tobytes()], pa.binary())], names=["cells", "n"])

    for r in rows.mapInArrow(packed, "cells binary, n binary").toLocalIterator():
        n[np.frombuffer(r["cells"], "<i4")] = np.frombuffer(r["n"], "<f4")
    return n.reshape(-1, _ALL)


def fit(pairs: DataFrame, head: Head, seed: int = 3) -> Model:
    """Trains by noise-contrastive estimation over all counts: in each of ``ROUNDS`` steps every pair of the training part
    counts as often as it occurs, against ``NOISE`` noise symbols each, all symbols in the shares that they have.
    """
    rng = np.random.default_rng(seed)
    count = whole_counts(pairs)
    of_context = count.sum(1, dtype=np.float64)
    n = np.concatenate([np.pad(head.n[:SYMBOLS], (0, max(0, SYMBOLS - len(head.n)))), head.class_n])
    some = n > 0
    noise = n / max(1.0, n.sum())
    with np.errstate(divide="ignore"):
        log_noise = np.log(noise).astype(np.float32)
    p = {"r": (rng.standard_normal((_BEGIN + 1, DIM)) * 0.1).astype(np.float32), "q": (rng.standard_normal((_ALL, DIM)) * 0.1).astype(np.float32), "b": np.where(some, log_noise, 0).astype(np.float32)}
    m, v = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}
    against = (np.log(np.float32(NOISE)) + np.where(some, log_noise, 0)).astype(np.float32)
    seen, total = np.flatnonzero(of_context), of_context.sum()
    drawn = (NOISE * noise).astype(np.float32)

    for t in range(1, ROUNDS + 1 if len(seen) else 1):
        g = {k: np.zeros_like(x) for k, x in p.items()}
        for k in range(0, len(seen), 256):
            h = seen[k : k + 256]
            r, own = p["r"][h], (of_context[h] / total).astype(np.float32)[:, None]
            z = r @ p["q"].T
            z += p["b"] - against
            np.negative(np.clip(z, -30, 30, out=z), out=z)
            np.reciprocal(np.add(np.exp(z, out=z), 1, out=z), out=z)  # the chance that a symbol is no noise
            x = count[h] * np.float32(1 / total)
            z *= x + own * drawn
            x -= z
            g["r"][h] = x @ p["q"]
            g["q"] += x.T @ r
            g["b"] += x.sum(0)
        now = 0.1 * (1 - 0.9 * t / ROUNDS)
        for k, y in g.items():
            m[k] += np.float32(0.1) * (y - m[k])
            v[k] += np.float32(0.02) * (y * y - v[k])
            p[k] += np.float32(now / (1 - 0.9**t)) * m[k] / (np.sqrt(v[k] / np.float32(1 - 0.98**t)) + np.float32(1e-10))
    p["b"][~some] = -np.inf
    if not some.any():
        p["b"][:] = 0
    return Model(p["r"], p["q"], p["b"])


def score(documents: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text", head_words: int = HEAD) -> DataFrame:
    """One row per document: id, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities of the text).

    At most ``head_words`` words, and their counts, are sent to executors; how many does not change the result.
    Null and empty texts are their end token alone; words are of any length; repeated rows stay repeated, in training
    too; null ids stay null; without documents the result is empty; without training documents the base is that of
    one unseen token and so is the score; other columns are left out.
    """
    learn = pick(train, **{text_col: "string"}).select(F.col(text_col).cast("binary"))
    counts = stored(word_counts(learn), "word-counts")
    head = head_of(counts, head_words)
    model = fit(pair_counts(learn, head), head)
    total, distinct = head.total, head.distinct
    base_of_all = float(np.log10(total + 0.5 * (distinct + 1)))
    unseen = float(np.log10(0.5) - base_of_all)
    known_share = float(np.log10(1 - 10**unseen)) if total else 0.0
    sent = documents.sparkSession.sparkContext.broadcast((head, model))

    def make():
        head, model = sent.value
        logs = np.log10(np.append(head.n, 0) + 0.5)
        # a word of a class has (n + 0.5) of these
        of_class = np.append(np.zeros(SYMBOLS), np.log10(np.maximum(head.class_n + 0.5 * head.class_words, 0.5)))

        def each(batch: pa.RecordBatch):
            number, symbol, before, ends, words = _numbered(head, _texts(batch.column(2)))
            starts = np.concatenate([[0], ends[:-1]])
            known = number >= 0
            added = lambda x: np.add.reduceat(x, starts)
            own = np.where(known, logs[number], 0.0)
            # of a known word; the rows of far words say which are
            likely = model.likely(before, symbol) / np.log(10) - of_class[symbol] + known_share if total else np.zeros(len(words))
            far = np.flatnonzero(~known).tolist()
            likely_far = likely[far].tolist()
            likely = np.where(known, likely + np.where(symbol >= SYMBOLS, own, 0.0), 0.0)
            text_of = np.searchsorted(ends, far, side="right").tolist()
            tails, times, sums, at, k = [], [], [], [0], 0
            for d in range(len(ends)):
                mine: dict[bytes, list] = {}
                while k < len(far) and text_of[k] == d:
                    each_word = mine.setdefault(words[far[k]], [0, 0.0])
                    each_word[0] += 1
                    each_word[1] += likely_far[k]
                    k += 1
                tails += mine
                times += [n for n, _ in mine.values()]
                sums += [x for _, x in mine.values()]
                at.append(len(tails))
            tail = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays([pa.array(tails, pa.binary()), pa.array(times, pa.int32()), pa.array(sums, pa.float64())], names=["word", "times", "likely"]))
            columns = [pa.array(ends - starts), pa.array(added(known.astype(np.int64))), pa.array(added(own)), pa.array(added(likely)), tail]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=["row", "id", "n_tokens", "n_head", "own", "likely", "tail"])

        return each

    rows = pick(documents, **{id_col: "bigint", text_col: "string"}).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("binary"))
    rows = stored(arrow_map(rows, make, "row bigint, id bigint, n_tokens bigint, n_head bigint, own double, likely double, tail array<struct<word:binary,times:int,likely:double>>"), "lm-parts")
    tails = rows.select("row", F.inline("tail")).join(counts, "word", "left").groupBy("row")
    known = F.col("n") > 0
    smoothed = F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)
    tails = tails.agg(
        F.sum(smoothed).alias("tail_own"), F.sum(F.when(known, F.col("times")).otherwise(0)).alias("tail_known"),
        F.sum(F.when(known, F.col("likely") + smoothed).otherwise(F.col("times") * unseen)).alias("tail_likely"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return rows.drop("tail").join(tails, "row", "left").select(
        F.col("id").alias(id_col), "n_tokens", (F.col("n_head") + zero("tail_known")).alias("n_known"), F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("own") + zero("tail_own") - F.col("n_tokens") * base_of_all).alias("base_score"),
        (F.col("likely") + zero("tail_likely")).alias("score"),
    )


def held_out(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Learns from the documents outside fold 1 of 5 and scores all."""
    rows = pick(documents, doc_id="bigint", text="string")
    return score(rows, rows.filter(fold("doc_id", 5) != 1)).select("doc_id", (fold("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
