"""Secret scan: fixed patterns, and a randomness test battery with false-discovery control.

Each long token is given the narrowest encoding that holds it; '=' ends a token,
and one that no encoding holds is split at the characters outside each alphabet
and its long parts are taken instead. Three tests ask
whether it could be uniform noise in that alphabet: chi-squared uniformity,
runs about the middle of the alphabet, and lag-one serial correlation. Fisher's
method joins them; a token that fails is structured. For the rest, the
chi-squared value is set against what natural text of the same length would
give (a noncentral law whose excess grows with the length), and
Benjamini-Hochberg within each encoding and length band keeps the expected
share of wrong finds below `q`. Its counts cover every token of the table and
need one small histogram, whatever the table's size.

Defined cases: a null text counts as empty; tokens that a pattern already
covers are not added again; parts of one token that overlap and are both kept
make one find; a null doc_id is carried along.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .common import flushed, map_rows

# The patterns of the base scan.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+", re.ASCII)
HEX = re.compile(r"[0-9a-f]{24,}", re.ASCII)
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "random")

# '=' stands between a name and its value or pads an end, so it is never inside
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}", re.ASCII)
LEAST = 20
BANDS = (20, 32, 48, 80)
ALPHA = 0.001
Q = 0.01
STEP = 20
TOP = 40 * STEP
LETTER_COINCIDENCE = 0.0667

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: name, alphabet, chance that two symbols of natural text in it agree
ENCODINGS = (
    ("hex", DIGITS + "abcdef", 0.1),
    ("HEX", DIGITS + "ABCDEF", 0.1),
    ("base32", UPPER + "234567", LETTER_COINCIDENCE),
    ("base62", DIGITS + UPPER + LOWER, LETTER_COINCIDENCE),
    ("base64", UPPER + LOWER + DIGITS + "+/", LETTER_COINCIDENCE),
    ("base64url", UPPER + LOWER + DIGITS + "-_", LETTER_COINCIDENCE),
)


def _table(alphabet: str) -> np.ndarray:
    table = np.full(128, -1, np.int64)
    table[np.frombuffer(alphabet.encode(), np.uint8)] = np.arange(len(alphabet))
    return table


#: the long parts of a token that mixes alphabets
_PARTS = [re.compile(f"[{re.escape(alphabet)}]{{{LEAST},}}") for _, alphabet, _ in ENCODINGS]
_TABLES = [(name, len(alphabet), same, _table(alphabet)) for name, alphabet, same in ENCODINGS]


def upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi_squared(counts: np.ndarray, n: int) -> float:
    expected = n / len(counts)
    return float(((counts - expected) ** 2).sum() / expected)


def battery(x: np.ndarray, k: int) -> tuple[float, float]:
    """(probability under noise, chi-squared value) of symbols x of an alphabet of k."""
    n = len(x)
    value = chi_squared(np.bincount(x, minlength=k), n)
    df = k - 1
    z = ((value / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    tests = [2 * upper_tail(abs(z))]
    high = x >= k // 2
    ones = int(high.sum())
    zeros = n - ones
    if ones and zeros:
        mean = 1 + 2 * ones * zeros / n
        spread = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        runs = 1 + int((high[1:] != high[:-1]).sum())
        tests.append(2 * upper_tail(abs(runs - mean) / math.sqrt(spread)))
    else:
        tests.append(2.0 ** (1 - n))
    centred = x - (k - 1) / 2
    serial = float((centred[1:] * centred[:-1]).sum()) / ((k * k - 1) / 12) / math.sqrt(n - 1)
    tests.append(2 * upper_tail(abs(serial)))
    half = -sum(math.log(min(1.0, max(p, 1e-300))) for p in tests)
    return math.exp(-half) * (1 + half + half * half / 2), value


def judged(token: str) -> tuple[str, int, int] | None:
    """(encoding, length band, level) of a token; level is 0 for a structured one.

    The level is minus ten log10 of the chance that natural text of this length
    looks as uniform, in steps of 1/20 of a power of ten.
    """
    raw = np.frombuffer(token.encode(), np.uint8)
    for name, k, same, table in _TABLES:
        x = table[raw]
        if x.min() < 0:
            continue
        n = len(x)
        noise, value = battery(x, k)
        if noise < ALPHA:
            return name, band(n), 0
        excess = n * (k * same - 1)
        chance = upper_tail((k - 1 + excess - value) / math.sqrt(2 * (k - 1 + 2 * excess)))
        return name, band(n), min(TOP, int(-math.log10(max(chance, 1e-300)) * STEP))
    return None


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    core = text[start:end].strip("-_/+")
    start += text[start:end].index(core)
    return start, start + len(core)


def coverage(base: list[tuple[int, int, int]]) -> Callable[[int, int], bool]:
    """Whether one of the spans, given in order of start, holds the whole of [start, end)."""
    starts = [start for start, _, _ in base]
    reach = list(accumulate((end for _, _, end in base), max))

    def covered(start: int, end: int) -> bool:
        k = bisect.bisect_right(starts, start)
        return k > 0 and reach[k - 1] >= end

    return covered


def judgements(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, tuple[str, int, int]]]:
    """(start, end, verdict) of the long tokens outside base spans, or of the long parts of those that no encoding holds."""
    covered = coverage(base)

    def fresh(start: int, end: int) -> bool:
        return end - start >= LEAST and not covered(start, end)

    for m in TOKEN.finditer(text):
        start, end = trimmed(text, m.start(), m.end())
        if not fresh(start, end):
            continue
        if verdict := judged(text[start:end]):
            yield start, end, verdict
            continue
        parts = {trimmed(text, *p.span()) for part in _PARTS for p in part.finditer(text, start, end)}
        for a, b in sorted(parts):
            if fresh(a, b) and (verdict := judged(text[a:b])):
                yield a, b, verdict


def band(n: int) -> int:
    return max(b for b in BANDS if b <= n)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order."""
    found = []
    if any(word in (low := text.lower()) for word in KEYWORDS) and ("=" in low or ":" in low):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _scan(rows: Iterator[tuple]) -> Iterator[tuple]:
    for doc_id, text in rows:
        text = text or ""
        base = base_spans(text)
        tokens = [
            {"start": start, "end": end, "stratum": f"{name}-{length}", "level": level}
            for start, end, (name, length, level) in judgements(text, base)
        ]
        yield (
            doc_id,
            *(sum(kind == k for _, kind, _ in base) for k in range(3)),
            hashlib.sha256(joined(base).encode()).hexdigest(),
            [{"start": s, "kind": k, "end": e} for s, k, e in base],
            tokens,
        )


SCANNED = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
    "base array<struct<start int, kind int, end int>>, "
    "tokens array<struct<start int, end int, stratum string, level int>>"
)


def cutoffs(scanned: DataFrame, q: float = Q) -> dict[str, int]:
    """The least level that Benjamini-Hochberg accepts, by encoding and length band.

    At most len(ENCODINGS) * len(BANDS) entries reach the driver.
    """
    levels = scanned.select(F.explode("tokens").alias("t")).groupBy("t.stratum", "t.level").count()
    above = Window.partitionBy("stratum").orderBy(F.desc("level"))
    ranked = levels.select(
        "stratum",
        "level",
        F.sum("count").over(above).alias("rank"),
        F.sum("count").over(Window.partitionBy("stratum")).alias("total"),
    )
    chance = F.pow(F.lit(10.0), -F.col("level") / STEP)
    passing = ranked.where((F.col("level") > 0) & (chance * F.col("total") <= q * F.col("rank")))
    return {r["stratum"]: r["cut"] for r in passing.groupBy("stratum").agg(F.min("level").alias("cut")).collect()}


def apart(spans: Column) -> Column:
    """Spans in order of start, with those that overlap joined."""

    def add(done: Column, s: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        longer = F.struct(last["start"].alias("start"), last["kind"].alias("kind"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(last["end"] > s["start"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(
            F.concat(done, F.array(s))
        )

    overlaps = F.exists(F.transform(spans, lambda s, k: F.coalesce(F.get(spans, k - 1)["end"] > s["start"], F.lit(False))), lambda x: x)
    return F.when(overlaps, F.aggregate(spans, F.array().cast(SPANS), add)).otherwise(spans)


SPANS = "array<struct<start:int,kind:int,end:int>>"


def scan(docs: DataFrame, q: float = Q) -> DataFrame:
    """Base counts and digest, and `spans` as (start, kind, end) structs with the random tokens kept."""
    scanned = written(
        map_rows(docs.select(F.col("doc_id").cast("long"), "text"), lambda rows: flushed(_scan(rows), 7), SCANNED),
        "secret-tokens",
    )
    cuts = cutoffs(scanned, q)
    least = F.create_map(*[F.lit(x) for pair in cuts.items() for x in pair]) if cuts else None
    kept = (
        F.transform(
            F.filter("tokens", lambda t: t["level"] >= F.coalesce(least[t["stratum"]], F.lit(TOP + 1))),
            lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")),
        )
        if cuts
        else F.array().cast(SPANS)
    )
    kept = apart(kept)
    return scanned.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
        F.array_sort(F.concat("base", kept)).alias("spans"), F.size(kept).cast("long").alias("n_random"),
    )


def span_string(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
