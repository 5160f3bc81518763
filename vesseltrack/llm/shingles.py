"""Word shingles of a text as sorted 64-bit numbers."""

from __future__ import annotations

import numpy as np
from pandas.util import hash_array

from .common import ASCII_LOWER, ASCII_UPPER

WORDS = 5

_FOLD = bytes.maketrans(ASCII_UPPER.encode(), ASCII_LOWER.encode())
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def word_hashes(text: str) -> np.ndarray:
    """One number per word ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased (bytes are split at exactly these characters)."""
    words = text.encode("utf-8", "surrogatepass").translate(_FOLD).split()
    return hash_array(np.array(words, dtype=object), categorize=False) if words else np.zeros(0, dtype=np.uint64)


def distinct(a: np.ndarray) -> np.ndarray:
    """The different numbers, ascending."""
    a = np.sort(a)
    return a[np.concatenate(([True], a[1:] != a[:-1]))] if len(a) else a


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct shingles, ascending; a text of fewer words is one shingle as a whole."""
    w = word_hashes(text) if text else np.zeros(0, dtype=np.uint64)
    if not len(w):
        return w
    n = min(words, len(w))
    m = len(w) - n + 1
    with np.errstate(over="ignore"):
        total = np.full(m, n, dtype=np.uint64)
        for i in range(n):
            total = (total ^ (total >> np.uint64(29))) * _ODD + w[i:m + i]
    return distinct(mix(total))
