"""Fuzzy string scores from 0 to 100 as column functions, built on the normalised indel ratio.

Everything runs in the JVM. The length of the longest common subsequence is
found bit by bit: the places of each character of one text are kept as masks of
BITS places, and the other text is folded over them with one addition a mask.

A `Scorer` says how a text is prepared once, how two prepared texts score, and
what their score cannot exceed. Bounds put the number of characters that two
texts share, in any order, for the common subsequence.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the combined score.
TOKEN_WEIGHT = 0.95
PARTIAL_WEIGHT = 0.9
LONG_PARTIAL_WEIGHT = 0.6

#: Places in a mask; one addition of two masks and a carry must fit a long.
BITS = 62
FULL = (1 << BITS) - 1

#: Length of what two texts share, in order (exact) or in any order (a bound).
Common = Callable[[Column, Column], Column]


@dataclass(frozen=True)
class Scorer:
    """How texts are compared; without a `bound` every pair is scored."""

    prepare: Callable[[Column], Column]
    score: Callable[[Column, Column], Column]
    bound: Callable[[Column, Column], Column] | None = None


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _letters(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, F.lit("")))


def _mask(letters: Column, letter: Column) -> Column:
    places = F.transform(letters, lambda x, i: F.when(x == letter, F.call_function("shiftleft", _long(1), i)).otherwise(_long(0)))
    return F.aggregate(places, _long(0), lambda held, place: held.bitwiseOR(place))


def places(text: Column) -> Column:
    """The masks of a text: how many a letter has, and for each letter its masks."""

    def made(letters: Column) -> Column:
        count = F.ceil(F.size(letters) / BITS).cast("int")
        numbers = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
        blocks = F.transform(numbers, lambda k: F.slice(letters, (k - 1) * BITS + 1, BITS))
        masks = lambda blocks: F.transform(F.array_distinct(letters), lambda c: F.transform(blocks, lambda b: _mask(b, c)))
        return F.struct(count.alias("n"), F.map_from_arrays(F.array_distinct(letters), let(blocks, masks)).alias("masks"))

    return let(_letters(text), made)


def _one_mask(held: Column, mask: Column) -> Column:
    hits = held.bitwiseAND(mask)
    return (held + hits).bitwiseOR(held - hits).bitwiseAND(_long(FULL))


def _many_masks(held: Column, masks: Column) -> Column:
    """One addition over several masks, the carry going from each to the next."""

    def added(acc: Column, pair: Column) -> Column:
        hits = pair["held"].bitwiseAND(pair["mask"])
        total = pair["held"] + hits + acc["carry"]
        kept = total.bitwiseOR(pair["held"] - hits).bitwiseAND(_long(FULL))
        return F.struct(
            F.call_function("shiftright", total, F.lit(BITS)).alias("carry"), F.concat(acc["out"], F.array(kept)).alias("out")
        )

    pairs = F.zip_with(held, masks, lambda v, m: F.struct(v.alias("held"), m.alias("mask")))
    start = F.struct(_long(0).alias("carry"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(pairs, start, added)["out"]


def common_with(table: Column, text: Column) -> Column:
    """Length of the longest common subsequence of a text and the one `table` holds the places of."""
    single = F.aggregate(
        _letters(text), _long(FULL),
        lambda held, c: _one_mask(held, F.coalesce(F.get(F.element_at(table["masks"], c), F.lit(0)), _long(0))),
    )
    several = F.aggregate(
        _letters(text), F.array_repeat(_long(FULL), table["n"]),
        lambda held, c: let(F.element_at(table["masks"], c), lambda m: F.when(m.isNull(), held).otherwise(_many_masks(held, m))),
    )
    left = F.aggregate(F.transform(several, F.bit_count), F.lit(0), lambda total, n: total + n)
    return F.when(table["n"] == 0, 0).when(table["n"] == 1, BITS - F.bit_count(single)).otherwise(BITS * table["n"] - left)


def common_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence; the shorter text, whose table costs less, is the one tabled."""
    swapped = F.length(a) > F.length(b)
    ordered = F.struct(F.when(swapped, b).otherwise(a).alias("short"), F.when(swapped, a).otherwise(b).alias("long"))
    return let(ordered, lambda p: let(places(p["short"]), lambda table: common_with(table, p["long"])))


def shared_letters(a: Column, b: Column) -> Column:
    """How many characters two texts share in any order: at least their common subsequence."""
    count = lambda text, c: F.length(text) - F.length(F.replace(text, c, F.lit("")))
    both = F.array_intersect(_letters(a), _letters(b))
    return F.aggregate(both, F.lit(0), lambda n, c: n + F.least(count(a, c), count(b, c)))


def _percent(distance: Column, total: Column) -> Column:
    return F.when(total == 0, 100.0).otherwise(100.0 - 100.0 * distance / total)


def _ratio(a: Column, b: Column, common: Common) -> Column:
    total = F.length(a) + F.length(b)
    return let(common(a, b), lambda n: _percent(total - 2 * n, total))


def plain(text: Column) -> Column:
    """Lower case, letters and digits only, anything else a blank; null as empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]", " "))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, " "), "")


def prepared(text: Column) -> Column:
    """(text, words, ordered): the plain text, its distinct words in order, and all its words in order as a text."""
    return let(
        plain(text),
        lambda t: F.struct(
            t.alias("text"), F.array_sort(F.array_distinct(_words(t))).alias("words"), F.array_join(F.array_sort(_words(t)), " ").alias("ordered")
        ),
    )


def _parts(a: Column, b: Column) -> Column:
    """The words of both texts, of the first alone and of the second alone, each as a text."""
    joined = lambda words: F.array_join(words, " ")
    return F.struct(
        joined(F.array_intersect(a["words"], b["words"])).alias("both"),
        joined(F.array_except(a["words"], b["words"])).alias("a"),
        joined(F.array_except(b["words"], a["words"])).alias("b"),
    )


def _token_set_of(parts: Column, common: Common) -> Column:
    some = parts["both"] != ""
    gap = some.cast("int")
    shared, size_a, size_b = F.length(parts["both"]), F.length(parts["a"]), F.length(parts["b"])
    total = 2 * (shared + gap) + size_a + size_b
    # what both share against all the words of one of them
    against = lambda size: _percent(gap + size, 2 * shared + gap + size)
    ratio = lambda n: _percent(size_a + size_b - 2 * n, total)
    apart = let(common(parts["a"], parts["b"]), ratio)
    shares = F.greatest(against(size_a), against(size_b))
    # no more can be common than the shorter side, which often decides it
    return (
        F.when(some & ((size_a == 0) | (size_b == 0)), 100.0)
        .when(some & (ratio(F.least(size_a, size_b)) <= shares), shares)
        .when(some, F.greatest(apart, shares))
        .otherwise(apart)
    )


def _token_set(a: Column, b: Column, common: Common) -> Column:
    empty = (a["text"] == "") | (b["text"] == "")
    return F.when(empty, 0.0).otherwise(let(_parts(a, b), lambda parts: _token_set_of(parts, common)))


def _windows(short: Column, long: Column) -> Column:
    """The best ratio of a text against any window of its size, cut at the ends, of a longer one."""
    size = F.length(short)
    starts = F.sequence(1 - size, F.length(long) - 1)

    def scored(table: Column) -> Column:
        def at(s: Column) -> Column:
            window = F.substr(long, F.greatest(s, F.lit(0)) + 1, F.least(s, F.lit(0)) + size)
            return let(window, lambda w: _percent(size + F.length(w) - 2 * common_with(table, w), size + F.length(w)))

        return F.array_max(F.transform(starts, at))

    return F.when(size == 0, 0.0).otherwise(let(places(short), scored))


def _window_bound(short: Column, long: Column) -> Column:
    size = F.length(short)
    return F.when(size == 0, 0.0).otherwise(let(shared_letters(short, long), lambda n: 200.0 * n / (size + n)))


def _partial(a: Column, b: Column, windows: Common) -> Column:
    swapped = F.length(a) > F.length(b)
    return let(F.struct(F.when(swapped, b).otherwise(a).alias("s"), F.when(swapped, a).otherwise(b).alias("l")), lambda p: windows(p["s"], p["l"]))


def _name(a: Column, b: Column, common: Common, windows: Common) -> Column:
    size_a, size_b = F.length(a["text"]), F.length(b["text"])
    spread = F.greatest(size_a, size_b) / F.least(size_a, size_b)
    whole = _ratio(a["text"], b["text"], common)
    alike = F.greatest(
        whole, TOKEN_WEIGHT * _ratio(a["ordered"], b["ordered"], common), TOKEN_WEIGHT * let(_parts(a, b), lambda p: _token_set_of(p, common))
    )
    weight = F.when(spread <= 8, PARTIAL_WEIGHT).otherwise(LONG_PARTIAL_WEIGHT)
    sets = let(_parts(a, b), lambda p: F.when(p["both"] != "", 100.0).otherwise(_partial(p["a"], p["b"], windows)))
    tokens = F.greatest(_partial(a["ordered"], b["ordered"], windows), sets)
    unlike = F.greatest(whole, weight * _partial(a["text"], b["text"], windows), weight * TOKEN_WEIGHT * tokens)
    empty = (a["text"] == "") | (b["text"] == "")
    return F.when(empty, 0.0).when(spread < 1.5, alike).otherwise(unlike)


#: Similarity of the two sets of words, order and repeats ignored.
TOKEN_SET = Scorer(
    prepared, lambda a, b: _token_set(a, b, common_length), lambda a, b: _token_set(a, b, shared_letters)
)

#: The best of the plain, token and partial ratios, weighted by length.
NAME = Scorer(
    prepared,
    lambda a, b: _name(a, b, common_length, _windows),
    lambda a, b: _name(a, b, shared_letters, _window_bound),
)


def _jaccard(a: Column, b: Column) -> Column:
    all_words = F.size(F.array_union(a, b))
    return F.when(all_words == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / all_words)


#: Shared distinct words over all distinct words, from 0 to 1.
JACCARD = Scorer(lambda text: F.array_distinct(F.array_remove(F.split(F.coalesce(text, F.lit("")), "\\s+"), "")), _jaccard)


def scored(scorer: Scorer, a: Column, b: Column) -> Column:
    """The score of two text columns of one row."""
    both = F.struct(scorer.prepare(a).alias("a"), scorer.prepare(b).alias("b"))
    return let(both, lambda pair: scorer.score(pair["a"], pair["b"]))


def token_set_score(a: Column, b: Column) -> Column:
    return scored(TOKEN_SET, a, b)


def name_score(a: Column, b: Column) -> Column:
    return scored(NAME, a, b)
