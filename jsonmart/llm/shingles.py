"""Word shingles of a text as 64-bit hashes, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of ``n`` words, in order; runs of different lengths never share a start value."""
    m = len(hashes) - n + 1
    out = np.full(max(m, 0), n, dtype=np.uint64)
    for k in range(n if m > 0 else 0):
        out += hashes[k : k + m]
        out *= _MULTIPLIER
        out ^= out >> _SHIFT
    return out


def shingle_set(text: bytes | None, n: int) -> np.ndarray:
    """Distinct n-word shingles of a text, A-Z in lower case; a shorter text is one shingle, no words give none."""
    words = (text or b"").lower().split()  # bytes: only A-Z change, only the six ASCII spaces split
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = word_hashes(words)
    return np.unique(window_hashes(hashes, min(n, len(hashes))))
