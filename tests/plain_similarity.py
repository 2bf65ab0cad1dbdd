"""The fuzzy scores in plain Python, one pair at a time: what the column functions must equal."""

from __future__ import annotations

import re

# Weights of the combined score.
TOKEN_WEIGHT = 0.95
PARTIAL_WEIGHT = 0.9
LONG_PARTIAL_WEIGHT = 0.6


def _prepare(text: str) -> str:
    return re.sub(r"[\W_]", " ", text.lower()).strip()


def _common_length(a: str, b: str) -> int:
    """Longest common subsequence length, one bit row per character of `b`."""
    positions: dict[str, int] = {}
    for i, ch in enumerate(a):
        positions[ch] = positions.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hits = row & positions.get(ch, 0)
        row = ((row + hits) | (row - hits)) & full
    return len(a) - row.bit_count()


def _percent(distance: int, total: int) -> float:
    return 100.0 - 100.0 * distance / total if total else 100.0


def _ratio(a: str, b: str) -> float:
    return _percent(len(a) + len(b) - 2 * _common_length(a, b), len(a) + len(b))


def _partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter text against any window of the longer."""
    short, long = sorted((a, b), key=len)
    size = len(short)
    if not size:
        return 0.0
    starts = range(1 - size, len(long))
    return max(_ratio(short, long[max(0, s) : s + size]) for s in starts)


def _token_parts(a: str, b: str) -> tuple[str, str, str]:
    left, right = set(a.split()), set(b.split())
    return tuple(" ".join(sorted(part)) for part in (left & right, left - right, right - left))


def _token_set(a: str, b: str) -> float:
    common, only_a, only_b = _token_parts(a, b)
    if common and not (only_a and only_b):
        return 100.0
    gap = 1 if common else 0
    size_a = len(common) + gap + len(only_a)
    size_b = len(common) + gap + len(only_b)
    distance = len(only_a) + len(only_b) - 2 * _common_length(only_a, only_b)
    score = _percent(distance, size_a + size_b)
    if common:
        score = max(
            score,
            _percent(gap + len(only_a), len(common) + size_a),
            _percent(gap + len(only_b), len(common) + size_b),
        )
    return score


def _sorted_tokens(text: str) -> str:
    return " ".join(sorted(text.split()))


def token_set_score(a: str | None, b: str | None) -> float:
    """Similarity of the two token sets, order and repeats ignored."""
    if not a or not b:
        return 0.0
    a, b = _prepare(a), _prepare(b)
    return _token_set(a, b) if a and b else 0.0


def name_score(a: str | None, b: str | None) -> float:
    """The best of the plain, token and partial ratios, weighted by length."""
    if not a or not b:
        return 0.0
    a, b = _prepare(a), _prepare(b)
    if not a or not b:
        return 0.0
    spread = max(len(a), len(b)) / min(len(a), len(b))
    best = _ratio(a, b)
    sorted_a, sorted_b = _sorted_tokens(a), _sorted_tokens(b)
    if spread < 1.5:
        return max(best, TOKEN_WEIGHT * max(_ratio(sorted_a, sorted_b), _token_set(a, b)))
    weight = PARTIAL_WEIGHT if spread <= 8 else LONG_PARTIAL_WEIGHT
    common, only_a, only_b = _token_parts(a, b)
    partial_sets = 100.0 if common else _partial_ratio(only_a, only_b)
    partial_tokens = max(_partial_ratio(sorted_a, sorted_b), partial_sets)
    return max(best, weight * _partial_ratio(a, b), weight * TOKEN_WEIGHT * partial_tokens)


def token_jaccard(a: str | None, b: str | None) -> float:
    """Shared distinct tokens over all distinct tokens."""
    left, right = set((a or "").split()), set((b or "").split())
    return len(left & right) / len(left | right) if left | right else 0.0
