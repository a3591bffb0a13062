"""Hashed word shingles of a text, and what is computed from sets of them."""

from __future__ import annotations

import numpy as np
import xxhash

_ODD = np.array(
    [(0x9E3779B97F4A7C15 * (2 * i + 1) ^ 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF | 1 for i in range(64)],
    np.uint64,
)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit hashes; hashing anew takes less time than looking words up."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` words; of fewer words, one for all of them."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.uint64)
    size = min(size, n)
    total = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        total = mix(total * _ODD[i] + hashes[i : n - size + 1 + i])
    return total
