"""Five-word shingle sets as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_KNOWN_MOST = 1_000_000


class Shingler:
    """Distinct shingles of a text, sorted; keeps the hashes of words it has met."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.known: dict[bytes, int] = {}

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > _KNOWN_MOST:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def __call__(self, text: bytes | None) -> np.ndarray:
        """A-Z lower-cased, words between white space; fewer than five words make one shingle,
        no words none. The seed holds the length, so short texts match only their like."""
        words = text.lower().split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        h = self._hashes(words)
        length = min(self.words, len(h))
        count = len(h) - length + 1
        total = np.full(count, length, np.uint64)
        for i in range(length):
            total = (total ^ (total >> np.uint64(29))) * _FACTOR + h[i : i + count]
        total ^= total >> np.uint64(32)
        total *= np.uint64(0xD6E8FEB86659FD93)
        total ^= total >> np.uint64(32)
        return np.unique(total)
