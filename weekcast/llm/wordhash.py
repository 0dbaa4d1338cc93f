"""Words of many texts as 64-bit hashes, in numpy: no Python object for a word.

A word is a run of letters, marks and digits (Unicode), lower-cased.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

MULT = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


@lru_cache(1)
def word_characters() -> np.ndarray:
    """For each code point: is it part of a word."""
    return np.fromiter((unicodedata.category(chr(i))[0] in "LMN" for i in range(0x110000)), bool, 0x110000)


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """MULT**i and MULT**-i modulo 2**64, for i below n."""
    out = []
    for m in (MULT, pow(MULT, -1, 1 << 64)):
        p = np.full(n, m, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def hashed(texts: list[str], is_word: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, index of its text), in text order."""
    is_word = word_characters() if is_word is None else is_word
    lowered = [t.lower() for t in texts]
    if not lowered:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    codes = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    inside = is_word[codes]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate([[0], edge])
    first, last = edge[::2], edge[1::2]  # the text ends with a line end, so words close
    size = 1 << max(16, int(len(codes)).bit_length())
    power, inverse = _powers(size)
    run = np.cumsum(np.where(inside, codes.astype(np.uint64) + np.uint64(1), np.uint64(0)) * power[: len(codes)], dtype=np.uint64)
    run = np.concatenate([np.zeros(1, np.uint64), run])
    h = (run[last] - run[first]) * inverse[first]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h, np.searchsorted(ends, first, side="right")


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words (fewer words: the whole run; none: empty)."""
    if not len(h):
        return h
    width = min(width, len(h))
    n = len(h) - width + 1
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = (out ^ h[i : i + n]) * np.uint64(MULT)
        out ^= out >> np.uint64(31)
    return out
