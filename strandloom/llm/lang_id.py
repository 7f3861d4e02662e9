"""Language identification with error-correcting output codes.

Each language has a codeword; a linear classifier over hashed byte n-grams predicts each bit. Decoding weighs each
bit's loss by how well that bit was learned, takes the nearest codeword, and flags texts whose second nearest is
almost as near. The classifiers are fitted in numpy on a bounded sample; predictions read whole texts.
"""

from __future__ import annotations

import itertools
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, arrow_map, fold, pick, slices
from .sampling import bounded, classes, spread

#: Buckets of n-grams, lengths of n-grams, bytes that are counted at a time.
BUCKETS, LENGTHS, PIECE = 4096, (1, 2, 3, 4), 1 << 20
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def profile(text: bytes) -> np.ndarray:
    """Square roots of the shares of each n-gram bucket (unit length), over the whole text."""
    counts = np.zeros(BUCKETS, np.int64)
    text = b" " + text.translate(LOWER) + b" "
    reach = max(LENGTHS) - 1
    for k in range(0, len(text), PIECE):
        # n-grams that begin in this piece
        b = np.frombuffer(text[k : k + PIECE + reach], np.uint8).astype(np.uint32)
        own, h = min(PIECE, len(text) - k), None
        for n in LENGTHS:
            m = min(own, len(b) - n + 1)
            if m <= 0:
                break
            h = b[:m] + np.uint32(1) if h is None else h[:m] * np.uint32(257) + b[n - 1 : n - 1 + m] + np.uint32(1)
            counts += np.bincount((h * np.uint32(2654435761)) >> np.uint32(20), minlength=BUCKETS)
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """k codewords of bits -1 and 1: all splits of the classes for few classes, else the best of random balanced codes."""
    if k <= 1:
        return np.ones((k, 0), np.float32)
    if k <= 6:
        rows = [(1, *rest) for rest in itertools.product((1, -1), repeat=k - 1) if -1 in rest]
        return np.array(rows, np.float32).T
    rng, n = np.random.default_rng(seed), int(10 * math.log2(k)) + 1
    best, apart = None, -1
    for _ in range(50):
        code = np.stack([rng.permutation(np.where(np.arange(k) % 2, 1, -1)) for _ in range(n)], axis=1)
        distance = (n - code @ code.T) // 2 + n * np.eye(k, dtype=int)
        if distance.min() > apart:
            best, apart = code, distance.min()
    return best.astype(np.float32)


class Model:
    """Languages, codewords (languages x bits), weights (buckets x bits), bias and weight of each bit."""

    def __init__(self, names: list[str], x: np.ndarray, y: np.ndarray, rounds: int = 200) -> None:
        self.names, self.code = names, codewords(len(names))
        bits = self.code.shape[1]
        self.w, self.b, self.trust = np.zeros((BUCKETS, bits), np.float32), np.zeros(bits, np.float32), np.ones(bits, np.float32)
        if not bits or not len(x):
            return
        goal = self.code[y]
        share = (1 / np.bincount(y, minlength=len(names)).clip(1))[y].astype(np.float32)
        share = (share / share.sum())[:, None]
        m, v, mb, vb = np.zeros_like(self.w), np.zeros_like(self.w), np.zeros_like(self.b), np.zeros_like(self.b)
        for t in range(1, rounds + 1):
            margin = goal * (x @ self.w + self.b)
            slope = -goal * share / (1 + np.exp(np.clip(margin, -30, 30)))
            for value, g, first, second in ((self.w, x.T @ slope + 1e-5 * self.w, m, v), (self.b, slope.sum(0), mb, vb)):
                first += 0.1 * (g - first)
                second += 0.001 * (g * g - second)
                value -= 0.5 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        right = ((goal * (x @ self.w + self.b) > 0) * share).sum(0)
        self.trust = np.log(np.clip(right, 0.51, 0.999) / (1 - np.clip(right, 0.51, 0.999))).astype(np.float32)
        self.trust /= self.trust.mean()

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest codeword by weighted logistic loss, its share against the others, and whether it is ambiguous."""
        f = np.clip(x @ self.w + self.b, -30, 30)
        loss = np.stack([(self.trust * np.log1p(np.exp(-f * c))).sum(1) for c in self.code], axis=1)
        odds = np.exp(loss.min(1, keepdims=True) - loss)
        odds /= odds.sum(1, keepdims=True)
        two = np.sort(odds, axis=1)[:, ::-1][:, :2]
        return loss.argmin(1), odds.max(1), (two[:, 0] - two[:, 1] < 0.2) if two.shape[1] > 1 else np.zeros(len(x), bool)


def fit(rows: DataFrame, max_rows: int = 4000, least: int = 8, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fits on at most ``max_rows`` rows, spread over all languages by the hash of their ids; with more than
    ``max_rows`` / ``least`` languages on up to ``least`` rows of each.

    Rows without a language or text teach nothing; of rows with one id (or none) and language one is taken. What
    reaches the driver is a vector of fixed length per sampled row.
    """
    rows = pick(rows, **{id_col: "bigint", text_col: "string", lang_col: "string"}).filter(F.col(lang_col).isNotNull() & (F.length(text_col) > 0))
    counts = classes(rows, lang_col)
    each = max(least, max_rows // max(1, len(counts)))

    def make():
        def vectors(batch: pa.RecordBatch):
            at, data = slices(batch.column(1))
            x = [profile(bytes(data[a:b])).astype(np.float16).tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(x, pa.binary())], names=["id", "lang", "x"])

        return vectors

    found = arrow_map(spread(rows, id_col, lang_col, counts, each, F.xxhash64(text_col)), make, "id bigint, lang string, x binary").collect()
    found = bounded(found, 1, each)
    names = sorted({r["lang"] for r in found})
    x = np.array([np.frombuffer(r["x"], np.float16) for r in found], np.float32).reshape(-1, BUCKETS)
    return Model(names, x, np.array([names.index(r["lang"]) for r in found], int))


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text.decode("utf-8", "replace")))


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, lang_pred, score (0 to 1), ambiguous.

    Null texts and texts without a letter are ``und`` with score 0, as is everything if no language was learned;
    repeated rows stay repeated; null ids stay null; an empty table gives an empty one; other columns are left out.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make():
        model: Model = sent.value

        def each(batch: pa.RecordBatch):
            at, data = slices(batch.column(1))
            texts = [bytes(data[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            known = [bool(model.names) and has_letter(t) for t in texts]
            names, scores, doubts = np.full(len(texts), "und", object), np.zeros(len(texts)), np.zeros(len(texts), bool)
            if any(known):
                best, score, doubt = model.decode(np.stack([profile(t) for t, k in zip(texts, known) if k]))
                names[known], scores[known], doubts[known] = np.array(model.names, object)[best], score, doubt
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names.tolist(), pa.string()), pa.array(scores), pa.array(doubts)], names=[id_col, "lang_pred", "score", "ambiguous"])

        return each

    rows = pick(df, **{id_col: "bigint", text_col: "string"})
    return arrow_map(rows, make, f"`{id_col}` bigint, lang_pred string, score double, ambiguous boolean")


def held_out(documents: DataFrame) -> DataFrame:
    """Learns from the documents outside fold 1 of 3 and predicts all: doc_id, held_out, lang_pred, score, ambiguous."""
    rows = pick(documents, doc_id="bigint", text="string", lang="string")
    return predict(rows, fit(rows.filter(fold("doc_id", 3) != 1))).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "ambiguous")
