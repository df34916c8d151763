"""Hashed word shingles of a text."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

#: Words whose hash a worker remembers before it starts anew.
CACHE = 150_000
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def _place(i: int) -> np.uint64:
    return np.uint64((0x9E3779B97F4A7C15 * (2 * i + 1) ** 5 ^ (i << 32)) & (1 << 64) - 1 | 1)


def shingles(text: bytes, n: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles of UTF-8 text, A-Z lower-cased.

    Words lie between the six ASCII white-space characters. A text with fewer than n words is one
    shingle (which its number of words sets apart); one without words has none.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, np.int64)
    ids = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    k = min(n, len(ids))
    h = np.full(len(ids) - k + 1, k, np.uint64)
    for i in range(k):  # a sum of word hashes, each times an odd number that its place gives
        h += ids[i : len(ids) - k + 1 + i] * _place(i)
    h = np.sort(_mix(h).view(np.int64))
    return h[np.append(True, h[1:] != h[:-1])]


def set_key(s: np.ndarray) -> int:
    """A 64-bit identifier of a set of shingles."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)
