"""Vectorised hashes of substrings: prefix sums of a polynomial modulo 2**64, then mixed."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(kind: str, count: int) -> np.ndarray:
    """The first powers of the base ("up") or of its inverse ("down")."""
    held = _POWERS[kind]
    if len(held) < count:
        base = np.uint64(BASE if kind == "up" else INVERSE)
        held = np.empty(max(count, 2 * len(held), 1 << 16), np.uint64)
        held[0] = 1
        held[1:] = base
        np.multiply.accumulate(held, out=held)
        _POWERS[kind] = held
    return held[:count]


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix(symbols: np.ndarray) -> np.ndarray:
    """Prefix sums over an array of small integers (bytes or code points)."""
    out = np.zeros(len(symbols) + 1, np.uint64)
    scaled = symbols.astype(np.uint64)
    scaled += np.uint64(0x632BE59BD9B4E019)
    scaled *= powers("up", len(symbols))
    np.cumsum(scaled, out=out[1:])
    return out


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of [start, end); equal for equal strings wherever they stand."""
    x = (sums[end] - sums[start]) * powers("down", len(sums))[start]
    return mix(x + (end - start).astype(np.uint64))


def grams(sums: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all substrings of length k."""
    n = len(sums) - 1
    x = (sums[k:] - sums[: n - k + 1]) * powers("down", n - k + 1)
    return mix(x)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
