"""Porter stemming as a column function, with the widely used extensions to the 1980 algorithm.

The shape of a word has `0` for each consonant and `1` for each vowel; a `y` is
a vowel behind a consonant. The measure counts the steps from vowel to
consonant. All in the JVM; callers stem each distinct term once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .similarity import let

# Words with their own stem.
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}

# Suffix and replacement, used where the rest has a measure above 0.
STEP_2 = [pair.split(":") for pair in (
    "ational:ate tional:tion enci:ence anci:ance izer:ize bli:ble alli:al entli:ent eli:e ousli:ous "
    "ization:ize ation:ate ator:ate alism:al iveness:ive fulness:ful ousness:ous aliti:al iviti:ive "
    "biliti:ble fulli:ful logi:log"
).split()]
STEP_3 = [pair.split(":") for pair in "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:".split()]

# Suffixes dropped where the rest has a measure above 1.
STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()


def _without(word: Column, letters: int) -> Column:
    return F.left(word, F.length(word) - letters)


def _shape(word: Column) -> Column:
    marked = F.regexp_replace(F.regexp_replace(word, "[^aeiouy]", "0"), "[aeiou]", "1")

    def resolved(x: Column) -> Column:
        once = F.replace(F.replace(x, F.lit("0y"), F.lit("01")), F.lit("1y"), F.lit("10"))
        vowel = lambda held: F.when(F.right(held, F.lit(1)) == "0", "1").otherwise("0")
        folded = F.aggregate(F.split(x, ""), F.lit(""), lambda held, c: F.concat(held, F.when(c == "y", vowel(held)).otherwise(c)))
        return let(once, lambda shape: F.when(F.contains(shape, F.lit("y")), folded).otherwise(shape))

    return let(F.regexp_replace(marked, "^y", "0"), resolved)


def _steps(shape: Column) -> Column:
    return F.regexp_count(shape, F.lit("10"))


def _measure(word: Column) -> Column:
    return _steps(_shape(word))


def _short_end(word: Column, shape: Column) -> Column:
    return (shape == "10") | (F.endswith(shape, F.lit("010")) & ~F.right(word, F.lit(1)).isin("w", "x", "y"))


def _suffix(word: Column, suffixes: list[str]) -> Column:
    # no suffix in these lists comes before a longer one that ends in it, so the longest is meant
    return F.regexp_extract(word, f"({'|'.join(suffixes)})\\z", 1)


def _plural(word: Column) -> Column:
    twice = word.endswith("sses") | (word.endswith("ies") & (F.length(word) > 4))
    return F.when(twice, _without(word, 2)).when(word.endswith("s") & ~word.endswith("ss"), _without(word, 1)).otherwise(word)


def _past_and_gerund(word: Column) -> Column:
    def ended(suffix: str) -> Column:
        return word.endswith(suffix) & F.contains(_shape(_without(word, len(suffix))), F.lit("1"))

    def mended(rest: Column, shape: Column) -> Column:
        last = F.right(rest, F.lit(1))
        double = (F.length(rest) > 1) & (last == F.substring(rest, -2, 1)) & (F.right(shape, F.lit(1)) == "0")
        return (
            F.when(rest.endswith("at") | rest.endswith("bl") | rest.endswith("iz"), F.concat(rest, F.lit("e")))
            .when(double, F.when(last.isin("l", "s", "z"), rest).otherwise(_without(rest, 1)))
            .when((_steps(shape) == 1) & _short_end(rest, shape), F.concat(rest, F.lit("e")))
            .otherwise(rest)
        )

    rest = F.when(ended("ed"), _without(word, 2)).when(ended("ing"), _without(word, 3))
    return (
        F.when(word.endswith("ied"), F.when(F.length(word) == 4, _without(word, 1)).otherwise(_without(word, 2)))
        .when(word.endswith("eed"), F.when(_measure(_without(word, 3)) > 0, _without(word, 1)).otherwise(word))
        .otherwise(let(rest, lambda r: F.when(r.isNull(), word).otherwise(let(_shape(r), lambda s: mended(r, s)))))
    )


def _final_y(word: Column) -> Column:
    follows = F.right(_shape(_without(word, 1)), F.lit(1)) == "0"
    return F.when(word.endswith("y") & (F.length(word) > 2) & follows, F.concat(_without(word, 1), F.lit("i"))).otherwise(word)


def _replaced(word: Column, rules: list[list[str]]) -> Column:
    """The suffix replaced where the rest has a measure above 0."""
    endings = F.create_map(*[F.lit(part) for rule in rules for part in rule])

    def applied(suffix: Column) -> Column:
        rest = F.left(word, F.length(word) - F.length(suffix))
        weighed = F.when(suffix == "logi", F.concat(rest, F.lit("l"))).otherwise(rest)
        return F.when((suffix != "") & (_measure(weighed) > 0), F.concat(rest, endings[suffix])).otherwise(word)

    return let(_suffix(word, [suffix for suffix, _ in rules]), applied)


def _derived(word: Column) -> Column:
    doubled = word.endswith("alli") & (_measure(_without(word, 4)) > 0)
    return let(F.when(doubled, _without(word, 2)).otherwise(word), lambda w: _replaced(w, STEP_2))


def _long_suffix(word: Column) -> Column:
    def applied(suffix: Column) -> Column:
        rest = F.left(word, F.length(word) - F.length(suffix))
        allowed = (suffix != "") & ((suffix != "ion") | rest.endswith("s") | rest.endswith("t"))
        return F.when(allowed & (_measure(rest) > 1), rest).otherwise(word)

    return let(_suffix(word, list(STEP_4)), applied)


def _final_e(word: Column) -> Column:
    def applied(rest: Column, shape: Column) -> Column:
        steps = _steps(shape)
        return F.when((steps > 1) | ((steps == 1) & ~_short_end(rest, shape)), rest).otherwise(word)

    return F.when(word.endswith("e"), let(_without(word, 1), lambda r: let(_shape(r), lambda s: applied(r, s)))).otherwise(word)


def _final_l(word: Column) -> Column:
    return F.when(word.endswith("ll") & (_measure(_without(word, 1)) > 1), _without(word, 1)).otherwise(word)


RULES = (_plural, _past_and_gerund, _final_y, _derived, lambda w: _replaced(w, STEP_3), _long_suffix, _final_e, _final_l)


def stem(term: Column | str) -> Column:
    """The stem of a term in lower case; null stays null."""
    irregular = F.create_map(*[F.lit(part) for pair in IRREGULAR.items() for part in pair])

    def regular(word: Column) -> Column:
        out = word
        for rule in RULES:
            out = let(out, rule)
        return out

    word = F.lower(F.col(term) if isinstance(term, str) else term)
    return let(word, lambda w: F.coalesce(irregular[w], F.when(F.length(w) <= 2, w).otherwise(regular(w))))
