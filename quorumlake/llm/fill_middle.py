"""Fill-in-middle transformation by repeated-capture matching.

A text is taken as units, by default runs of letters and single other
characters. One fullmatch of `(unit)*` with the `regex` library keeps every
repetition of the group, so `match.ends(1)` gives the number of units and the
offset of any cut; nothing is looped over. Two cuts, drawn from a hash of
doc_id, part prefix, middle and suffix, which are put together behind the
marks `<P>`, `<S>` and `<M>` with the middle last, prefix first ("psm") or
suffix first ("spm"). No mark can arise across a seam, since marks begin with
"<" and hold no other, so `restored` gives the text back from output and form.

Defined cases: a null text counts as empty; an empty text and one that holds a
mark stay plain; a null doc_id draws as the word "null"; repeated ids draw the
same numbers, each row with its own text; extra columns are kept by
`transformed`; an empty table gives an empty result. A very long text is
matched whole, at some 140 bytes a unit while it is being cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows

UNIT = "[A-Za-z]+|[^A-Za-z]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "1"
PLAIN_PERCENT = 10
SPM_PERCENT = 20

CUT = "output string, form string, n long, prefix_chars long, middle_chars long"


def draws(doc_id: Column, seed: str = SEED) -> Column:
    """Four numbers below 2**32 from a hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])


def cut(text: str, drawn: list[int], pattern: regex.Pattern, plain: int, spm: int) -> tuple:
    """(output, form, number of units, prefix length, middle length) of one text."""
    ends = pattern.fullmatch(text).ends(1)
    n = len(ends)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or drawn[2] % 100 >= 100 - plain:
        return text, "plain", n, None, None
    low, high = sorted((drawn[0] % (n + 1), drawn[1] % (n + 1)))
    a = ends[low - 1] if low else 0
    b = ends[high - 1] if high else 0
    first, last = (SUFFIX + text[b:], PREFIX + text[:a]) if drawn[3] % 100 < spm else (PREFIX + text[:a], SUFFIX + text[b:])
    form = "spm" if first.startswith(SUFFIX) else "psm"
    return first + last + MIDDLE + text[a:b], form, n, a, b - a


def transformed(
    docs: DataFrame, unit: str = UNIT, seed: str = SEED, plain: int = PLAIN_PERCENT, spm: int = SPM_PERCENT
) -> DataFrame:
    """(doc, output, form, n, prefix_chars, middle_chars): every row, kept whole in `doc`, with its training text.

    `plain` percent of the rows stay as they are, `spm` percent of the others
    put the suffix first. `unit` must match every text by repetition.
    """
    # the text travels to Python once, inside the row it comes back with
    rows = docs.select(F.struct("*").alias("doc"), F.col("text").alias("t"), draws(F.col("doc_id"), seed).alias("drawn"))
    return _mapped(rows, ["doc"], unit, plain, spm)


def outputs(docs: DataFrame, unit: str = UNIT, seed: str = SEED, plain: int = PLAIN_PERCENT, spm: int = SPM_PERCENT) -> DataFrame:
    """(doc_id, output, form, n, prefix_chars, middle_chars), other columns left behind."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("t"), draws(F.col("doc_id"), seed).alias("drawn"))
    return _mapped(rows, ["doc_id"], unit, plain, spm)


def _mapped(rows: DataFrame, kept: list[str], unit: str, plain: int, spm: int) -> DataFrame:
    def apply(tuples: Iterator[tuple]) -> Iterator[list]:
        pattern = regex.compile(f"({unit})*")
        held: list[tuple] = []
        size = 0
        for *own, text, drawn in tuples:
            made = cut(text or "", drawn, pattern, plain, spm)
            held.append((*own, *made))
            size += len(made[0])
            if size >= 1 << 20 or len(held) >= 4096:
                yield [list(c) for c in zip(*held, strict=True)]
                held, size = [], 0
        if held:
            yield [list(c) for c in zip(*held, strict=True)]

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)
    return map_rows(rows, apply, f"{kinds}, {CUT}")


def _between(text: Column, start: str, end: str) -> Column:
    return F.split_part(F.split_part(text, F.lit(start), F.lit(2)), F.lit(end), F.lit(1))


def restored(output: Column, form: Column) -> Column:
    """The exact text, from output and form alone."""
    middle = F.split_part(output, F.lit(MIDDLE), F.lit(2))
    psm = F.concat(_between(output, PREFIX, SUFFIX), middle, _between(output, SUFFIX, MIDDLE))
    spm = F.concat(_between(output, PREFIX, MIDDLE), middle, _between(output, SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


SQL = f"""
WITH texts AS (SELECT doc_id, COALESCE(text, '') AS text, SHA256('{SEED}:' || COALESCE(doc_id::VARCHAR, 'null')) AS hash FROM documents),
cut AS (
  SELECT doc_id, text, REGEXP_EXTRACT_ALL(text, '{UNIT}') AS units,
         [('0x' || SUBSTR(hash, 8 * k + 1, 8))::BIGINT FOR k IN RANGE(4)] AS h
  FROM texts),
placed AS (
  SELECT doc_id, text, LEN(units) AS n, units, h,
         LEAST(h[1] % (LEN(units) + 1), h[2] % (LEN(units) + 1)) AS low,
         GREATEST(h[1] % (LEN(units) + 1), h[2] % (LEN(units) + 1)) AS high,
         CASE WHEN text = '' OR CONTAINS(text, '<P>') OR CONTAINS(text, '<S>') OR CONTAINS(text, '<M>')
                OR h[3] % 100 >= {100 - PLAIN_PERCENT} THEN 'plain'
              WHEN h[4] % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
  FROM cut),
parts AS (
  SELECT doc_id, text, n, form, ARRAY_TO_STRING(units[1:low], '') AS prefix,
         ARRAY_TO_STRING(units[low + 1:high], '') AS middle, ARRAY_TO_STRING(units[high + 1:], '') AS suffix
  FROM placed)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN LENGTH(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN LENGTH(middle) END AS middle_chars,
       SHA256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       SHA256(text) AS restored_sha256
FROM parts
"""
