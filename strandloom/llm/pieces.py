"""Whole columns of texts cut at blanks and numbered in Arrow, so that a tokenizer sees each distinct piece once.

A cut before a blank is safe where a non-blank stands on one side of it: every token of the byte-level patterns ends
or starts there. Texts with a blank between blanks, and those with special tokens, go to the tokenizer whole. In most texts commas and stops are cut from the words before them too.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Stands before a comma or stop that was cut from the word before it: such a piece has no blank before it.
MARK = "\x01"
_LETTERS = r"A-Za-z0-9\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}"
_BLANK = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"


def numbered(column: pa.Array, specials: Iterable[str]) -> tuple[np.ndarray, np.ndarray, list[str], dict[int, str]]:
    """(numbers of pieces, where each text's pieces end, distinct pieces, texts to be taken whole by their place).

    Each text's first piece stands without a blank before it and all others with one; a whole text is one piece.
    The number of a first piece is len(distinct) + its text's place.
    """
    column = column.fill_null("") if column.null_count else column
    odd = pc.match_substring_regex(column, "|".join([f"{_BLANK} ({_BLANK}|$)", MARK, *map(re.escape, specials)]))
    whole = {i: column[i].as_py() for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()}
    if whole:
        column = pc.if_else(odd, pa.scalar("", column.type), column)
    # no token goes from a letter or digit to a mark; texts where some comma or stop follows another sign stay as they are
    plain = pc.invert(pc.match_substring_regex(column, rf"(^|[^{_LETTERS}])[.,] "))
    cut = column
    for sign in ".,":
        cut = pc.replace_substring(cut, sign + " ", f" {MARK}{sign} ")
    parts = pc.split_pattern(pc.if_else(plain, cut, column), " ")
    coded = parts.flatten().dictionary_encode()
    numbers = coded.indices.to_numpy().astype(np.int64)
    ends = np.cumsum(pc.list_value_length(parts).to_numpy().astype(np.int64))
    return numbers, ends, coded.dictionary.to_numpy(zero_copy_only=False).tolist(), whole


def values(column: pa.Array, specials: Iterable[str], head: Callable, rest: Callable, text: Callable) -> tuple[list, np.ndarray, np.ndarray]:
    """(values of the distinct pieces, numbers of pieces, where each text's end): ``head`` gives the value of a first
    piece, ``rest`` that of another one, ``text`` that of a whole text."""
    numbers, ends, distinct, whole = numbered(column, specials)
    first = np.concatenate([[0], ends[:-1]])
    found = [text(whole[i]) if i in whole else head(distinct[k]) for i, k in enumerate(numbers[first].tolist())]
    later = np.ones(len(numbers), bool)
    later[first] = False
    used = np.zeros(len(distinct), bool)
    used[numbers[later]] = True
    none = rest("") if used.any() else found[0]
    all_values = [*(map(rest, distinct) if used.all() else (rest(p) if u else none for p, u in zip(distinct, used.tolist()))), *found]
    numbers[first] = len(distinct) + np.arange(len(ends))
    return all_values, numbers, ends


def packed(column: pa.Array, specials: Iterable[str], head: Callable, rest: Callable, text: Callable) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column (unsigned 32-bit) and where each text's end; the functions give packed ids."""
    found, numbers, ends = values(column, specials, head, rest, text)
    pool = np.frombuffer(b"".join(found), "<u4")
    n = np.fromiter(map(len, found), np.int64, len(found)) // 4
    start = np.cumsum(n) - n
    lengths = n[numbers]
    done = np.cumsum(lengths)
    place = np.repeat(start[numbers] - done + lengths, lengths)
    place += np.arange(len(place))
    return pool[place], done[ends - 1]


def sums(column: pa.Array, specials: Iterable[str], head: Callable, rest: Callable, text: Callable) -> np.ndarray:
    """The sum of the pieces' values, by text."""
    found, numbers, ends = values(column, specials, head, rest, text)
    done = np.cumsum(np.array(found, np.int64)[numbers])[ends - 1]
    return np.diff(done, prepend=0)
