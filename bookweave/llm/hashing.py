"""Hashes of words and shingles as NumPy arrays, the same in every process."""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64
#: Odd multipliers; fixed so that stored hashes stay comparable.
STEP, FIRST, SECOND = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
MEMO = 1 << 17  # words a worker remembers, some 25 MB


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = _Words()


def word_ids(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_words.__getitem__, words), "u8", len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over the word."""
    x = (x ^ (x >> U(30))) * FIRST
    x = (x ^ (x >> U(27))) * SECOND
    return x ^ (x >> U(31))


def runs(ids: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n consecutive ids."""
    if len(ids) < n:
        return ids[:0]
    h = np.full(len(ids) - n + 1, n, "u8")
    for k in range(n):
        h = mixed(h * STEP + ids[k : len(ids) - n + 1 + k])
    return h


def shingles(words: list[bytes], n: int) -> np.ndarray:
    """Sorted hashes of the distinct n-word shingles; a shorter text is one shingle, none has no words."""
    ids = word_ids(words)
    return np.unique(runs(ids, min(n, len(ids)))) if len(ids) else ids
