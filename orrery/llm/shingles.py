"""Word shingle sets of documents as sorted arrays of 64-bit hashes (inside Arrow tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

# fixed odd multipliers of a 64-bit finaliser
M1, M2, M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of uint64 values."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Hashes of words, remembered up to ``most`` words per task."""

    def __init__(self, most: int = 1 << 18):
        self.known, self.most = {}, most

    def words(self, text: str | None) -> np.ndarray:
        """Hash of each word of ``text`` in order; words split at space and code points
        9-13, A-Z lower-cased."""
        w = (text or "").encode().lower().split()
        known = self.known
        if len(known) > self.most:
            known.clear()
        for x in set(w).difference(known):
            known[x] = xxhash.xxh64_intdigest(x)
        return np.fromiter(map(known.__getitem__, w), np.uint64, len(w))


def shingles(h: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word windows of word hashes ``h``; with fewer
    words the whole sequence is one; no words: empty."""
    if not len(h):
        return h
    k = min(n, len(h))
    with np.errstate(over="ignore"):
        s = np.full(len(h) - k + 1, k, np.uint64)
        for i in range(k):
            s = mix(s * M3 + h[i:len(h) - k + 1 + i])
    return np.unique(s)
