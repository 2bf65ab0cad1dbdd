"""The stemmer in plain Python, one word at a time: what the column function must equal."""

from __future__ import annotations

from quorumlake.functions.stem import IRREGULAR, STEP_2, STEP_3, STEP_4

_SUFFIXES_2 = tuple(suffix for suffix, _ in STEP_2)
_SUFFIXES_3 = tuple(suffix for suffix, _ in STEP_3)
_SUFFIXES_4 = tuple(STEP_4)

class _Letters(dict):
    """Vowel, consonant or `y`, per character code; unseen ones are consonants."""

    def __missing__(self, code: int) -> str:
        self[code] = "c"
        return "c"


_LETTERS = _Letters({ord(ch): "v" for ch in "aeiou"} | {ord("y"): "y"})


def _shape(word: str) -> str:
    """One letter per character: `c` for a consonant, `v` for a vowel."""
    shape = word.translate(_LETTERS)
    while "y" in shape:
        at = shape.index("y")
        shape = shape[:at] + ("v" if shape[:at].endswith("c") else "c") + shape[at + 1 :]
    return shape


def _measure(word: str) -> int:
    return _shape(word).count("vc")


def _short_end(word: str) -> bool:
    shape = _shape(word)
    return shape == "vc" or (shape.endswith("cvc") and word[-1] not in "wxy")


def _replace(word: str, rules, suffixes: tuple[str, ...]) -> str:
    if not word.endswith(suffixes):
        return word
    for suffix, replacement in rules:
        if word.endswith(suffix):
            rest = word[: -len(suffix)]
            weighed = rest + "l" if suffix == "logi" else rest
            return rest + replacement if _measure(weighed) > 0 else word
    return word


def _plural(word: str) -> str:
    if word.endswith("sses") or (word.endswith("ies") and len(word) > 4):
        return word[:-2]
    if word.endswith("s") and not word.endswith("ss"):
        return word[:-1]
    return word


def _past_and_gerund(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    suffix = next((s for s in ("ed", "ing") if word.endswith(s) and "v" in _shape(word[: -len(s)])), None)
    if suffix is None:
        return word
    rest = word[: -len(suffix)]
    if rest.endswith(("at", "bl", "iz")):
        return rest + "e"
    if len(rest) > 1 and rest[-1] == rest[-2] and _shape(rest)[-1] == "c":
        return rest if rest[-1] in "lsz" else rest[:-1]
    return rest + "e" if _measure(rest) == 1 and _short_end(rest) else rest


def _derived(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _derived(word[:-2])
    return _replace(word, STEP_2, _SUFFIXES_2)


def _long_suffix(word: str) -> str:
    if not word.endswith(_SUFFIXES_4):
        return word
    for suffix in STEP_4:
        if word.endswith(suffix):
            rest = word[: -len(suffix)]
            allowed = suffix != "ion" or rest.endswith(("s", "t"))
            return rest if allowed and _measure(rest) > 1 else word
    return word


def _final_letters(word: str) -> str:
    if word.endswith("e"):
        size = _measure(word[:-1])
        if size > 1 or (size == 1 and not _short_end(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def porter_stem(word: str) -> str:
    word = word.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _past_and_gerund(_plural(word))
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1])[-1] == "c":
        word = word[:-1] + "i"
    return _final_letters(_long_suffix(_replace(_derived(word), STEP_3, _SUFFIXES_3)))
