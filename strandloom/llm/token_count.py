"""Token counts without identifiers.

Each word is a linked list of symbols; a heap holds the adjacent pairs by rank. The lowest pair is popped and merged
again and again; the count of a word is its number of first symbols less the number of merges.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import _CUT, Vocabulary, is_word, plain_word
from .common import Memo, arrow_map, pick, resident, slices
from .pieces import MARK, sums


def merge_by_heap(vocab: Vocabulary, word: bytes) -> tuple[int, list[int]]:
    """Merges made, and the symbols that are left."""
    symbols = [vocab.first[b] for b in word]
    n, rank, merged = len(symbols), vocab.rank.get, vocab.merged
    heap = []
    for i in range(n - 1):
        if (r := rank(symbols[i] << 32 | symbols[i + 1])) is not None:
            heap.append((r, i))
    if not heap:
        return 0, symbols
    heapify(heap)
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    merges = 0
    while heap:
        r, i = heappop(heap)
        j = right[i]
        if symbols[i] < 0 or j < 0 or rank(symbols[i] << 32 | symbols[j]) != r:
            continue  # one of the two has been merged since
        symbols[i], symbols[j] = merged[r], -1
        merges += 1
        k = right[i] = right[j]
        if k >= 0:
            left[k] = i
            if (s := rank(symbols[i] << 32 | symbols[k])) is not None:
                heappush(heap, (s, i))
        h = left[i]
        if h >= 0 and (s := rank(symbols[h] << 32 | symbols[i])) is not None:
            heappush(heap, (s, h))
    return merges, [s for s in symbols if s >= 0]


class Counter:
    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab = vocab
        self.of_word = Memo(self._word, most=200_000)
        self.head = Memo(self._piece, most=50_000)
        self.later = Memo(lambda piece: self._piece(" " + piece), most=50_000)  # of texts taken whole
        self.rest = Memo(self._rest, most=1_000_000)

    def _word(self, word: str) -> int:
        data = word.encode()
        return len(data) - merge_by_heap(self.vocab, data)[0]

    def _rest(self, piece: str) -> int:
        if piece[:1] == MARK:
            return self._piece(piece[1:])
        return self._word(" " + piece) if is_word(piece) else self._piece(" " + piece)

    def _piece(self, piece: str) -> int:
        if (two := plain_word(piece)) is not None:
            return self.of_word[two[0]] + (self.of_word[two[1]] if two[1] else 0)
        return sum([self.of_word[w] for w in self.vocab.words(piece)])

    def plain(self, text: str) -> int:
        if not text:
            return 0
        head, *rest = _CUT.split(text)
        return self.head[head] + sum(map(self.later.__getitem__, rest))

    def count(self, text: str) -> int:
        if not any(s in text for s in self.vocab.specials):
            return self.plain(text)
        return sum(1 if k % 2 else self.plain(part) for k, part in enumerate(self.vocab.split_specials(text)))


def counter(path: str) -> Counter:
    return resident(f"counter {path}", lambda: Counter(Vocabulary(path)))


def token_counts(df: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Null and empty texts have 0 bytes and 0 tokens; repeated rows stay repeated; null ids stay null; an empty table
    gives an empty one; other columns are left out, whatever their names. Very long words take n log n time.
    """

    def make():
        c = counter(path)

        def each(batch: pa.RecordBatch):
            at, _ = slices(batch.column(1))
            n = sums(batch.column(1), c.vocab.specials, c.head.__getitem__, c.rest.__getitem__, c.count)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((at[1:] - at[:-1]).astype("int64")), pa.array(n), pa.array(n > limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

        return each

    rows = pick(df, **{id_col: "bigint", text_col: "string"})
    return arrow_map(rows, make, f"`{id_col}` bigint, n_bytes bigint, n_tokens bigint, over_limit boolean", rows=2048, keeps=f"counter {path}")
