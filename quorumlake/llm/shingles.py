"""Word shingles of a text as hash sets, and their minhash signatures.

A word is a maximal run of letters, digits, underscores or characters beyond
ASCII, in lower case. A text of fewer words than a shingle has one shingle, of
all its words; a text without words has none.
"""

from __future__ import annotations

import numpy as np

from .hashing import mix, prefix, spans

WORDS = 5
_FACTORS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
_INSIDE = np.zeros(256, bool)
_INSIDE[128:] = True
_INSIDE[np.frombuffer(b"0123456789_abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8)] = True
CHUNK = 2048


def word_hashes(text: str) -> np.ndarray:
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _INSIDE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return spans(prefix(data), edges[0::2], edges[1::2])


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    hashed = word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(hashed):
        return hashed
    width = min(words, len(hashed))
    rows = len(hashed) - width + 1
    total = np.full(rows, width, np.uint64)
    for j in range(width):
        total += hashed[j : j + rows] * _FACTORS[j % len(_FACTORS)]
    return np.unique(mix(total))


def set_key(shingles: np.ndarray) -> bytes:
    """Sixteen bytes that stand for the set."""
    a = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    b = mix(shingles + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return np.array([a, b], np.uint64).tobytes()


def signature(shingles: np.ndarray, first: int, count: int) -> np.ndarray:
    """Minimum of each of `count` random orders, from number `first` on (uint32)."""
    numbers = np.arange(2 * first, 2 * (first + count), dtype=np.uint64)
    seeds = mix(numbers + np.uint64(0x9FB21C651E98DF25))
    shifts, factors = seeds[0::2], seeds[1::2] | np.uint64(1)
    least = np.full(count, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), CHUNK):
        ranks = (shingles[at : at + CHUNK, None] ^ shifts) * factors
        ranks ^= ranks >> np.uint64(32)
        ranks *= factors
        np.minimum(least, ranks.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)
