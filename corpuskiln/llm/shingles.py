"""Word shingles as 64-bit hashes: the same in every worker, vectorised per document."""

from __future__ import annotations

import re

import numpy as np
import xxhash

# Fixed value: a word is a run of letters and digits.
WORD = re.compile(r"[^\W_]+")

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MOST_CACHED = 1 << 20


class _WordIds(dict):
    """64-bit ids of words, kept while there are not too many."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _MOST_CACHED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_IDS = _WordIds()


def word_ids(words: list[str]) -> list[int]:
    """64-bit ids of words."""
    return [_IDS[w] for w in words]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's sequences of ``width`` words; empty for null or fewer words."""
    words = WORD.findall(text.lower()) if text else []
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(_IDS.__getitem__, words), np.uint64, len(words))
    whole = np.zeros(n, np.uint64)
    for i in range(width):
        whole = (whole + ids[i:i + n]) * (_MIX + np.uint64(2 * i))
    return np.unique(mix(whole))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sorted arrays of distinct hashes; 0 if either is empty."""
    if not len(a) or not len(b):
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return both / (len(a) + len(b) - both)
