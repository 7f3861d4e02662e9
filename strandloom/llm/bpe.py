"""Byte-pair encoding and decoding.

Encoding holds, for each short word, a contiguous array of part boundaries and an array of the ranks of adjacent
parts; it scans for the least rank, deletes the boundary between the two parts and refreshes the neighbouring ranks.
Words longer than ``SHORT`` bytes, for which repeated scans would take quadratic time, go through the heap of
``token_count`` instead.

Texts are cut before each blank that a non-blank follows. Every token of the byte-level patterns starts there at the
latest, so a piece between two cuts has the same tokens wherever it stands, and is worth remembering.
"""

from __future__ import annotations

import json
import re
import string
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, arrow_map, pick, resident, slices
from .pieces import MARK, packed

SHORT = 128
NONE = 1 << 60
_CUT = re.compile(r" (?=\S)")
# The pattern that splits text before the merges, as the vocabulary's public description has it.
_WORDS = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself if it is printable Latin-1,
    else the next free one from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


_MARKS = string.punctuation


def is_word(piece: str) -> bool:
    """Whether a piece is letters below U+0250 alone, hence one word of the patterns."""
    return piece.isalpha() and (piece.isascii() or max(piece) < "ɐ")


def plain_word(piece: str) -> tuple[str, str] | None:
    """A piece of one blank, letters below U+0250 and then marks, as the two words that the patterns make of it."""
    core = piece.rstrip(_MARKS)
    if core[:1] == " " and is_word(core[1:]):
        return core, piece[len(core) :]
    return None


class Vocabulary:
    """A byte-level BPE vocabulary file: ids, bytes of each id, ranks of pairs."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        letters, ids = byte_letters(), data["model"]["vocab"]
        self.bytes_of = {i: bytes(letters[c] for c in token) for token, i in ids.items()}
        self.specials = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.bytes_of |= {i: s.encode() for s, i in self.specials.items()}
        self.first = [0] * 256
        for letter, b in letters.items():
            self.first[b] = ids[letter]
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for pair in data["model"]["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[ids[a] << 32 | ids[b]] = len(self.merged)
            self.merged.append(ids[a + b])
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self._words = None
        self._path = path

    def words(self, piece: str) -> list[str]:
        """The words of a piece. Above U+024F, where Unicode versions differ, the tokenizers library splits."""
        if not piece or max(piece) < "ɐ":
            return _WORDS.findall(piece)
        if self._words is None:
            from tokenizers import Tokenizer

            self._words = Tokenizer.from_file(self._path).pre_tokenizer
        return [piece[a:b] for _, (a, b) in self._words.pre_tokenize_str(piece)]

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word, by the contiguous rank array."""
        first, rank = self.first, self.rank.get
        parts = [first[b] for b in word]
        if len(parts) > SHORT:
            from .token_count import merge_by_heap

            return merge_by_heap(self, word)[1]
        bounds = list(range(len(parts)))
        ranks = [rank(a << 32 | b, NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NONE:
                break
            i = ranks.index(least)
            parts[i] = self.merged[least]
            del parts[i + 1], bounds[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank(parts[i] << 32 | parts[i + 1], NONE)
            if i:
                ranks[i - 1] = rank(parts[i - 1] << 32 | parts[i], NONE)
        return parts

    def split_specials(self, text: str) -> list[str]:
        """Ordinary text at even places, special tokens at odd ones."""
        if self.special_cut is None:
            return [text]
        return self.special_cut.split(text)


class Encoder:
    """Texts to ids packed as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.of_word = Memo(lambda w: self._pack(vocabulary.merge(w.encode())), most=100_000)
        self.head = Memo(self._piece, most=50_000)
        self.later = Memo(lambda piece: self._piece(" " + piece), most=50_000)  # of texts taken whole
        self.rest = Memo(self._rest, most=200_000)

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _rest(self, piece: str) -> bytes:
        if piece[:1] == MARK:
            return self._piece(piece[1:])
        return self._pack(self.vocabulary.merge(b" " + piece.encode())) if is_word(piece) else self._piece(" " + piece)

    def _piece(self, piece: str) -> bytes:
        if (two := plain_word(piece)) is not None:
            return self.of_word[two[0]] + (self.of_word[two[1]] if two[1] else b"")
        return b"".join([self.of_word[w] for w in self.vocabulary.words(piece)])

    def plain(self, text: str) -> bytes:
        if not text:
            return b""
        head, *rest = _CUT.split(text)
        return self.head[head] + b"".join(map(self.later.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        if not any(s in text for s in self.vocabulary.specials):
            return self.plain(text)
        out = []
        for k, part in enumerate(self.vocabulary.split_specials(text)):
            out.append(self._pack([self.vocabulary.specials[part]]) if k % 2 else self.plain(part))
        return b"".join(out)


    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts, and where each text's end."""
        return packed(texts, self.vocabulary.specials, self.head.__getitem__, self.rest.__getitem__, self.encode)


def binary(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Ids as one binary value a text."""
    at = np.concatenate([[0], ends * 4]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(ids))])


def vocabulary(path: str) -> Vocabulary:
    return resident(f"vocabulary {path}", lambda: Vocabulary(path))


def encoder(path: str) -> Encoder:
    return resident(f"encoder {path}", lambda: Encoder(Vocabulary(path)))


def decode_ids(vocab: Vocabulary, ids: bytes) -> str:
    """Text of packed ids; bytes that are no UTF-8 become replacement characters, unknown ids an error."""
    wanted = memoryview(ids).cast("I").tolist() if ids else []
    return b"".join(map(vocab.bytes_of.__getitem__, wanted)).decode("utf-8", "replace")


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_tokens`` (long) and ``ids`` (binary, little-endian unsigned 32-bit integers).

    Null and empty texts have no ids (0, empty binary); repeated rows stay repeated; null ids stay null; an empty
    table gives an empty one; other columns are left out, whatever their names. Strings of special tokens inside a
    text become those tokens, as the library does by default. Texts are never cut.
    """

    def make():
        enc = encoder(path)

        def each(batch: pa.RecordBatch):
            ids, ends = enc.column(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends, prepend=0)), binary(ids, ends)], names=[id_col, "n_tokens", "ids"])

        return each

    rows = pick(df, **{id_col: "bigint", text_col: "string"})
    return arrow_map(rows, make, f"`{id_col}` bigint, n_tokens bigint, ids binary", rows=1024, keeps=f"encoder {path}")


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, the columns ``keep`` and ``text``, decoded from packed ids; null ids give empty text."""
    rows = df.select(id_col, ids_col, *keep)
    schema = ", ".join([f"`{id_col}` bigint", *(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), "text string"])

    def make():
        vocab = vocabulary(path)

        def each(batch: pa.RecordBatch):
            at, data = slices(batch.column(1))
            texts = [decode_ids(vocab, bytes(data[a:b])) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(batch.column(2 + k) for k in range(len(keep))), pa.array(texts, pa.string())], names=[id_col, *keep, "text"])

        return each

    return arrow_map(rows, make, schema, keeps=f"vocabulary {path}")


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_tokens``, ``ids`` as ``encode`` gives them, and ``text`` as ``decode`` gives it
    from these ids, in one pass of one Python worker. Nulls, empty texts and other columns are as there."""

    def make():
        enc = encoder(path)

        def each(batch: pa.RecordBatch):
            ids, ends = enc.column(batch.column(1))
            texts = pa.array([decode_ids(enc.vocabulary, ids[a:b].tobytes()) for a, b in zip([0, *ends.tolist()], ends.tolist())], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends, prepend=0)), binary(ids, ends), texts], names=[id_col, "n_tokens", "ids", "text"])

        return each

    rows = pick(df, **{id_col: "bigint", text_col: "string"})
    return arrow_map(rows, make, f"`{id_col}` bigint, n_tokens bigint, ids binary, text string", rows=1024, keeps=f"encoder {path}")


def digests(documents: DataFrame, path: str) -> DataFrame:
    """Encodes and decodes every text: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    rows = round_trip(documents, path)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
