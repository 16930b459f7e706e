"""Hashes of words and word shingles of many texts at once, in numpy.

Words are runs of letters and digits of the lower-cased text. All texts of a chunk become one
array of code points, a word's hash is a polynomial in them, and a shingle's a mix of its words'.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cache

import numpy as np

SHINGLE_WORDS = 5
CHUNK_CHARS = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_STEP = np.uint64(0xA0761D6478BD642F)


def text_chunks(texts: list[str | None], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `limit` characters together; a longer text is a range of its own."""
    at = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > limit:
            yield at, i
            at, size = i, 0
        size += len(t or "") + 1
    if at < len(texts):
        yield at, len(texts)


@cache
def word_table() -> np.ndarray:
    """For each code point, whether it belongs to words; made once in a process."""
    table = np.fromiter(map(str.isalnum, map(chr, range(sys.maxunicode + 1))), bool, sys.maxunicode + 1)
    table.setflags(write=False)
    return table


def scramble(h: np.ndarray) -> np.ndarray:
    h = h ^ h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    h *= _STEP
    return h ^ h >> np.uint64(32)


def word_hashes(texts: list[str | None], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of words before each text and at the end)."""
    lowered = [(t or "").lower() for t in texts]
    code = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    member = table[code]
    first = member.copy()
    first[1:] &= ~member[:-1]
    starts = np.flatnonzero(first)
    ends = np.cumsum([0, *(len(t) + 1 for t in lowered)])
    before = np.searchsorted(starts, ends)
    if not len(starts):
        return np.zeros(0, np.uint64), before
    at = np.flatnonzero(member)
    inside = np.cumsum(first)[at] - 1
    place = at - starts[inside]
    powers = np.full(int(place.max()) + 1, _BASE)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    terms = (code[at].astype(np.uint64) + np.uint64(1)) * powers[place]
    return scramble(np.add.reduceat(terms, np.flatnonzero(place == 0))), before


def shingles(words: np.ndarray, before: np.ndarray,
             size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of `size` words of one text, number of them before each text)."""
    n = np.maximum(np.diff(before) - size + 1, 0)
    m = max(0, len(words) - size + 1)
    h = np.zeros(m, np.uint64)
    for i in range(size):
        h = (h + words[i:i + m]) * _BASE
        h ^= h >> np.uint64(31)
    inside = np.zeros(m + 1, np.int64)
    np.add.at(inside, before[:-1][n > 0], 1)
    np.add.at(inside, (before[:-1] + n)[n > 0], -1)
    return scramble(h[np.cumsum(inside)[:m] > 0]), np.concatenate([[0], np.cumsum(n)])
