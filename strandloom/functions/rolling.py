"""Rolling hashes of all windows of a text at once, and what looks them up: a table of keys, or a part of a filter.

A hash is a polynomial in the letters. Sums from the first letter on, each term scaled down by a power of the base, are
one running total; the difference of two of them, scaled up again, is the hash of the window between. So a window costs
the same whatever its width, and no letter is looked at twice.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa

#: An odd number, so that it can be divided by; letters that are hashed at a time.
_BASE, CHUNK = 0x9E3779B97F4A7C15, 1 << 18


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of unsigned 64-bit integers (a public finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2^64."""
    both = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            both.append(np.cumprod(steps))
    return both[0], both[1]


@cache
def _letters(seed: int) -> np.ndarray:
    return mixed(np.arange(256, dtype=np.uint64) + np.uint64(256 * seed + 1))


def window_hashes(letters: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """The hash of each window of ``width`` bytes: as many as there are places where one begins."""
    n = len(letters)
    if n < width:
        return np.zeros(0, np.uint64)
    up, down = _powers(1 << max(19, (n - 1).bit_length()))  # one size for all chunks
    total = np.zeros(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_letters(seed)[letters] * down[:n], out=total[1:])
        return mixed((total[width:] - total[:-width]) * up[: n - width + 1])


def key_hashes(keys: np.ndarray, seed: int = 0) -> np.ndarray:
    """The hashes of keys, one a row."""
    n, width = keys.shape
    step = max(1, CHUNK // width)
    return np.concatenate([window_hashes(keys[k : k + step].ravel(), width, seed)[::width] for k in range(0, n, step)] or [np.zeros(0, np.uint64)])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each text of a column begins and the last one ends, and the bytes of all; nulls are empty."""
    column = column.fill_null("") if column.null_count else column
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    letters = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return at - at[0], letters[at[0] : at[-1]]


class KeyTable:
    """Keys of one width by their hashes, in order, and a table that most other hashes miss. What it finds is exact."""

    def __init__(self, keys: np.ndarray) -> None:
        self.width, self.seed = keys.shape[1], 0
        while True:
            hashes = key_hashes(keys, self.seed)
            order = np.argsort(hashes)
            self.hashes = hashes[order]
            if (self.hashes[1:] != self.hashes[:-1]).all():
                break
            self.seed += 1  # two keys have one hash
        self.keys = keys[order]
        self.shift = np.uint64(64 - min(24, max(12, len(keys).bit_length() + 5)))
        self.some = np.zeros(1 << (64 - int(self.shift)), bool)
        self.some[(self.hashes >> self.shift).astype(np.int64)] = True

    def find(self, letters: np.ndarray) -> np.ndarray:
        """Where windows begin that are keys."""
        hashes = window_hashes(letters, self.width, self.seed)
        at = np.flatnonzero(self.some[(hashes >> self.shift).astype(np.int64)])
        found = hashes[at]
        near = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1) if len(self.hashes) else at
        same = self.hashes[near] == found if len(self.hashes) else np.zeros(len(at), bool)
        at, near = at[same], near[same]
        step = max(1, CHUNK // self.width)
        same = [(gather(letters, at[k : k + step], self.width) == self.keys[near[k : k + step]]).all(1) for k in range(0, len(at), step)]
        return at[np.concatenate(same)] if same else at


def places(hashes: np.ndarray, bits: int, count: int) -> list[np.ndarray]:
    """The ``count`` places of each hash among so many bits, one array for each of them."""
    with np.errstate(over="ignore"):
        step = mixed(hashes + np.uint64(1)) | np.uint64(1)
        return [(hashes + np.uint64(i) * step) % np.uint64(bits) for i in range(count)]


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Which part of a filter a hash belongs to."""
    return (mixed(hashes ^ np.uint64(_BASE)) % np.uint64(parts)).astype(np.int64)


class FilterPart:
    """One of the parts of a Bloom filter: its words, and the hashes that belong to it."""

    def __init__(self, words: np.ndarray, width: int, part: int, parts: int, bits: int, count: int) -> None:
        self.words, self.width, self.part, self.parts, self.bits, self.count = words, width, part, parts, bits, count

    def find(self, letters: np.ndarray) -> np.ndarray:
        """Where windows begin that belong to this part and may be keys. Most are out after a look or two."""
        hashes = window_hashes(letters, self.width)
        at = np.flatnonzero(part_of(hashes, self.parts) == self.part) if self.parts > 1 else np.arange(len(hashes))
        left = hashes[at]
        with np.errstate(over="ignore"):
            step = mixed(left + np.uint64(1)) | np.uint64(1)
            for i in range(self.count):
                place = (left + np.uint64(i) * step) % np.uint64(self.bits)
                known = (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
                at, left, step = at[known], left[known], step[known]
        return at


def gather(letters: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The windows that begin at these places, one a row."""
    return letters[at[:, None] + np.arange(width)] if len(at) else np.zeros((0, width), np.uint8)


def texts(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as a column of texts."""
    n, width = rows.shape
    offsets = np.arange(0, n * width + 1, max(width, 1), dtype=np.int32) if width else np.zeros(n + 1, np.int32)
    return pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows)))
