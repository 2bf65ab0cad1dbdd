"""Personal data: fixed patterns, and the same patterns behind disguises.

Transducers rewrite a text and keep every edit with its source position: one
folds look-alike letters and drops invisible ones, one turns runs of spelled
digits into digits, one undoes at/dot disguises. Identifiers are found in the
rewritten text and their spans mapped back through the edits, so a span always
names characters of the text as given.

Defined cases: a null text counts as empty; a find that overlaps a base span
of its kind is not added; a null doc_id is carried along.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flushed, map_rows

KINDS = ("email", "ip", "card", "phone")

# The patterns of the base scan. Digit runs are taken whole
# (possessive), which finds the same matches in linear time.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", re.ASCII)
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
IP = re.compile(r"[0-9]++(?:\.[0-9]++\.[0-9]++\.[0-9]++)?", re.ASCII)
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+", re.ASCII)
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]", re.ASCII)

# Cyrillic and Greek letters that look like Latin ones.
LOOKALIKES = str.maketrans(
    "АВЕКМНОРСТХаеорсухіјѕԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧοα",
    "ABEKMHOPCTXaeopcyxijsdqwABEZHIKMNOPTYXoa",
)
HIDDEN = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
DISGUISED = re.compile(
    "[\u00ad\u200b-\u200d\u2060\ufeff\u0391-\u03c9\u0400-\u0458\u0501\u051b\u051d"
    "\u2460-\u249b\uff01-\uff5e\U0001d400-\U0001d7ff]+"
)
# Digit words of the four languages.
SPELLED = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9", "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5",
    "sechs": "6", "sieben": "7", "acht": "8", "neun": "9", "zéro": "0", "un": "1", "deux": "2", "trois": "3",
    "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9", "cero": "0", "uno": "1", "dos": "2",
    "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_WORDS = "|".join(sorted(SPELLED, key=len, reverse=True))
SPELLED_RUN = re.compile(
    rf"(?<!\w)(?:plus[\s-]+|\+\s?)?(?:{_WORDS}|[0-9])(?:[\s().-]{{1,3}}(?:{_WORDS}|[0-9]+|dot|point)){{2,}}(?!\w)", re.IGNORECASE
)
SPELLED_WORD = re.compile(rf"(?:{_WORDS})", re.IGNORECASE)
#: what stands between a digit word and its neighbour
GAP = re.compile(r"(?<=[^\W0-9_])[\s.-]{1,3}(?=\w)|(?<=\w)[\s.-]{1,3}(?=[^\W0-9_])")
PLUS = re.compile(r"plus[\s-]+(?=[0-9])", re.IGNORECASE)
NUMERIC_DOT = re.compile(r"(?<=[0-9])\s{0,3}[\[({]?\s{0,3}(?:dot|point)\s{0,3}[\])}]?\s{0,3}(?=[0-9])", re.IGNORECASE)
BRACKET_AT = re.compile(r"\s{0,3}[\[({<]\s{0,3}(?:at|@)\s{0,3}[\])}>]\s{0,3}", re.IGNORECASE)
BRACKET_DOT = re.compile(r"\s{0,3}[\[({<]\s{0,3}(?:dot|point|\.)\s{0,3}[\])}>]\s{0,3}", re.IGNORECASE)
# Endings that make "name at host.ending" an address; behind a spelled dot any letters do.
ENDINGS = "com|org|net|edu|gov|info|io|co|de|fr|es|uk|eu|us"
_HOST = rf"[A-Za-z0-9-]+(?:(?:\s{{1,3}}dot\s{{1,3}}|\.)[A-Za-z0-9-]+)*(?:\s{{1,3}}dot\s{{1,3}}[A-Za-z]{{2,}}|\.(?:{ENDINGS}))\b"
SPOKEN = re.compile(rf"(?<=[A-Za-z0-9])(?P<at>\s{{1,3}}at\s{{1,3}}|@)(?={_HOST})", re.IGNORECASE)
SPOKEN_TAIL = re.compile(_HOST, re.IGNORECASE)
# "at" between white space; led by its letters, which are quick to find
SPOKEN_AT = re.compile(r"at(?<=\sat)(?=\s)")
ENDED = re.compile(rf"\.(?:{ENDINGS})\b")
SPOKEN_DOT = re.compile(r"\s{1,3}dot\s{1,3}", re.IGNORECASE)


class Edited:
    """A rewritten text and the edits that lead back to its source."""

    def __init__(self, source: str, edits: list[tuple[int, int, str]]) -> None:
        """edits: (start, end, replacement) in the source, ordered, apart."""
        parts, self.marks, at, length = [], [], 0, 0
        for start, end, new in edits:
            parts += (source[at:start], new)
            length += start - at
            self.marks.append((length, length + len(new), start, end))
            length += len(new)
            at = end
        parts.append(source[at:])
        self.text = "".join(parts)
        self.starts = [m[0] for m in self.marks]

    def back(self, start: int, end: int) -> tuple[int, int]:
        """The source span of [start, end) of the rewritten text."""
        return self._at(start, False), self._at(end - 1, True)

    def _at(self, at: int, last: bool) -> int:
        k = bisect.bisect_right(self.starts, at) - 1
        if k < 0:
            return at + last
        new_start, new_end, start, end = self.marks[k]
        if at < new_end:
            same = new_end - new_start == end - start
            return start + at - new_start + last if same else (end if last else start)
        return end + at - new_end + last


def _fold(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in DISGUISED.finditer(text):
        for at, c in enumerate(m[0], m.start()):
            new = "" if c in HIDDEN else unicodedata.normalize("NFKC", c).translate(LOOKALIKES)
            if new != c:
                edits.append((at, at + 1, new))
    return edits


def _spelled(text: str) -> bool:
    """Whether three digit words may stand in a row; spares most texts the pattern below."""
    low = text.lower()
    for mark in "-.()":
        low = low.replace(mark, " ")
    words = low.split()
    if SPELLED.keys().isdisjoint(words):
        return False
    row = 0
    for word in words:
        row = row + 1 if word in SPELLED or word in ("dot", "point") or word.isdigit() else 0
        if row == 3:
            return True
    return False


def _digits(text: str) -> list[tuple[int, int, str]]:
    edits = []
    if not _spelled(text):
        return edits
    for m in SPELLED_RUN.finditer(text):
        words = list(SPELLED_WORD.finditer(text, m.start(), m.end()))
        if len(words) < 2:
            continue
        inner = []
        if plus := re.match(r"plus[\s-]+", m[0], re.IGNORECASE):
            inner.append((m.start(), m.start() + plus.end(), "+"))
        inner += [(w.start(), w.end(), SPELLED[w[0].lower()]) for w in words]
        for gap in GAP.finditer(text, m.start(), m.end()):
            if not _near_dot(text, gap.start(), gap.end()) and not (plus and gap.start() < m.start() + plus.end()):
                inner.append((gap.start(), gap.end(), ""))
        edits += sorted(inner)
    return edits


def _near_dot(text: str, start: int, end: int) -> bool:
    """Whether a gap stands beside the word dot or point, which a later step reads."""
    around = text[max(0, start - 5) : start].lower(), text[end : end + 5].lower()
    return around[0].endswith(("dot", "point")) or around[1].startswith(("dot", "point"))


def _at_dot(text: str) -> list[tuple[int, int, str]]:
    low = text.lower()
    dotted = "dot" in low or "point" in low
    patterns = []
    if any(c in text for c in "[({<"):
        patterns += [(BRACKET_AT, "@"), (BRACKET_DOT, ".")]
    if dotted:
        patterns.append((NUMERIC_DOT, "."))
    if "plus" in low:
        patterns.append((PLUS, "+"))
    edits = {}
    for pattern, new in patterns:
        for m in pattern.finditer(text):
            edits.setdefault(m.start(), (m.start(), m.end(), new))
    if ("@" in text and dotted) or ((dotted or ENDED.search(low)) and SPOKEN_AT.search(low)):
        for m in SPOKEN.finditer(text):
            edits.setdefault(m.start("at"), (m.start("at"), m.end("at"), "@"))
            tail = SPOKEN_TAIL.match(text, m.end("at"))
            for dot in SPOKEN_DOT.finditer(text, m.end("at"), tail.end() if tail else m.end("at")):
                edits.setdefault(dot.start(), (dot.start(), dot.end(), "."))
    kept, end = [], 0
    for edit in sorted(edits.values()):
        if edit[0] >= end and edit[2] != text[edit[0] : edit[1]]:
            kept.append(edit)
            end = edit[1]
    return kept


STEPS: tuple[Callable[[str], list[tuple[int, int, str]]], ...] = (_fold, _digits, _at_dot)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses: the local part is what stands before an @ in one run."""
    low, at = 0, text.find("@")
    while at >= 0:
        start = low + len(text[low:at].rstrip(LOCAL))
        host = DOMAIN.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
        low = host.end() if host else at + 1
        at = text.find("@", low)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    stripped = part.lstrip("0")
    return len(stripped) <= 3 and int(stripped or "0") <= 255


def identifiers(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in order."""
    found = [(s, 0, e) for s, e in emails(text)]
    for m in IP.finditer(text):
        if "." in m[0] and all(map(_small, m[0].split("."))):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() < 12:
            continue
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def overlap(base: list[tuple[int, int, int]]) -> Callable[[int, int, int], bool]:
    """Whether a span overlaps one of its kind; those of a kind are given in order and stand apart."""
    starts = [[s for s, k, _ in base if k == kind] for kind in range(len(KINDS))]
    ends = [[e for _, k, e in base if k == kind] for kind in range(len(KINDS))]

    def overlaps(start: int, kind: int, end: int) -> bool:
        before = bisect.bisect_left(starts[kind], end)
        return before > 0 and ends[kind][before - 1] > start

    return overlaps


def disguised(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the source that only the rewritten text shows."""
    layers, current = [], text
    for step in STEPS:
        if edits := step(current):
            layers.append(Edited(current, edits))
            current = layers[-1].text
    if not layers:
        return []
    found, overlaps = [], overlap(base)
    for start, kind, end in identifiers(current):
        for layer in reversed(layers):
            start, end = layer.back(start, end)
        if not overlaps(start, kind, end):
            found.append((start, kind, end))
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _scan(rows: Iterator[tuple]) -> Iterator[tuple]:
    for doc_id, text in rows:
        text = text or ""
        base = identifiers(text)
        added = disguised(text, base)
        yield (
            doc_id,
            *(sum(kind == k for _, kind, _ in base) for k in range(4)),
            hashlib.sha256(joined(base).encode()).hexdigest(),
            [{"start": s, "kind": k, "end": e} for s, k, e in sorted(base + added)],
            len(added),
        )


def find(docs: DataFrame) -> DataFrame:
    """Counts of base finds, their digest, all spans as (start, kind, end) structs, and how many were disguised."""
    schema = (
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
        "found array<struct<start int, kind int, end int>>, n_disguised long"
    )
    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), lambda rows: flushed(_scan(rows), 8), schema)
