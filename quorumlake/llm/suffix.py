"""Suffix arrays by two-stage sorting, for strings cut into regions.

Stage one sorts directly only the suffixes that are smaller than their
successor. Stage two scans the buckets of first bytes in ascending order and
induces every other suffix from its successor. Common prefixes of neighbours
follow. All steps are numpy operations on whole buckets.

A region ends in a zero byte that occurs nowhere else, so no common prefix
reaches over it; only suffixes of the wanted starts are kept, with those their
order is induced from.
"""

from __future__ import annotations

import numpy as np

from .hashing import mix

WORD_BYTES = 8


def words(text: np.ndarray) -> np.ndarray:
    """At each position the next eight bytes as one big-endian number; the text must end in eight spare bytes."""
    out = text.astype(np.uint64)
    for step in (1, 2, 4):
        following = out[step:].copy()
        out <<= np.uint64(8 * step)
        out[:-step] |= following
    return out


def smaller(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; the last one isn't."""
    n = len(text)
    differs = np.empty(n, bool)
    differs[:-1] = text[:-1] != text[1:]
    differs[-1] = True
    # equal neighbours take the verdict of the next position that differs
    at = np.where(differs, np.arange(n, dtype=np.int32), np.int32(n))
    at = np.minimum.accumulate(at[::-1])[::-1]
    less = np.zeros(n, bool)
    less[:-1] = text[:-1] < text[1:]
    return less[at]


def sort_direct(word: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions `at` in the order of their first `depth` bytes."""
    keys = word[at]
    order = np.argsort(keys, kind="stable")
    at, keys = at[order], keys[order]
    fresh = np.ones(len(at), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    for offset in range(WORD_BYTES, depth, WORD_BYTES):
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        rows = np.flatnonzero(tied)
        if not len(rows):
            break
        group = np.cumsum(fresh[rows])
        part = at[rows]
        keys = word[part + offset]
        order = np.lexsort((keys, group))
        keys = keys[order]
        at[rows] = part[order]
        # groups keep their places, so only breaks inside a group are new
        new = np.zeros(len(rows), bool)
        new[1:] = keys[1:] != keys[:-1]
        fresh[rows] |= new
    return at


def sort_small(text: np.ndarray, word: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """As sort_direct, but equal strings are sorted once."""
    if not len(at):
        return at
    hashed = np.zeros(len(at), np.uint64)
    for offset in range(0, depth, WORD_BYTES):
        hashed = mix(hashed + word[at + offset])
    _, first, member = np.unique(hashed, return_index=True, return_inverse=True)
    order = sort_direct(word, at[first], depth)
    rank = np.empty(len(text), np.int32)
    rank[order] = np.arange(len(order))
    return at[np.argsort(rank[at[first]][member], kind="stable")]


def suffix_array(text: np.ndarray, word: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted positions in suffix order, exact to at least `depth` bytes.

    `text` holds zero only as separator, ends in one, and is followed by at
    least depth + 8 zero bytes; `word` is words(text). `wanted` is a mask over the text.
    """
    n = len(text) - depth - WORD_BYTES
    small = smaller(text[:n])
    small[text[:n] == 0] = True
    # a larger suffix is induced from its successor: follow each chain to the next smaller one
    following = np.minimum.accumulate(np.where(small, np.arange(n, dtype=np.int32), np.int32(n))[::-1])[::-1]
    starts = np.flatnonzero(wanted[:n])
    ends = following[starts]
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends + 1, -1)
    active = np.cumsum(edge[:n]) > 0
    direct = np.flatnonzero(active & small & (text[:n] != 0))
    direct = sort_small(text, word, direct, depth)
    bounds = np.searchsorted(text[direct], np.arange(257))
    larger = active & ~small
    inbox: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        parts = list(inbox[c])
        inbox[c] = []
        current = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        while len(current):
            before = current - 1
            current = before[(before >= 0) & larger[before] & (text[before] == c)]
            if len(current):
                parts.append(current)
        ordered = np.flatnonzero(active & (text[:n] == 0)) if c == 0 else direct[bounds[c] : bounds[c + 1]]
        bucket = np.concatenate([*parts, ordered]) if parts else ordered
        if not len(bucket):
            continue
        before = bucket - 1
        before = before[(before >= 0) & larger[before] & (text[before] > c)]
        if len(before):
            symbol = text[before]
            order = np.argsort(symbol, kind="stable")
            before, symbol = before[order], symbol[order]
            cuts = np.flatnonzero(symbol[1:] != symbol[:-1]) + 1
            for piece in np.split(before, cuts):
                inbox[text[piece[0]]].append(piece)
        out.append(bucket[wanted[bucket]])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def common_prefixes(word: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each position with the one before it in order, up to `depth`; 0 for the first."""
    length = np.zeros(len(order), np.int64)
    rows = np.arange(1, len(order))
    for offset in range(0, depth, WORD_BYTES):
        if not len(rows):
            break
        a, b = word[order[rows - 1] + offset], word[order[rows] + offset]
        unlike = a != b
        x = a[unlike] ^ b[unlike]
        lead = np.zeros(len(x), np.int64)
        for shift in range(8):
            lead += (x >> np.uint64(56 - 8 * shift)) == 0
        length[rows[unlike]] += lead
        rows = rows[~unlike]
        length[rows] += WORD_BYTES
    return np.minimum(length, depth)
