"""Context spans: a few terms of the same sentence around a position.

All of it works inside a row. Nothing is shuffled, and a sentence's terms are
sliced in place rather than copied to every term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ends_sentence

MAX_SPAN = 10

# A Unicode noncharacter, never part of real text, that stands for a sentence break.
_BREAK = "\ufdd0"


def _span(sentence: Column, i: Column, max_span: int) -> Column:
    """The span around position `i` (from 0) of one sentence's terms."""
    left, right = i, F.size(sentence) - 1 - i
    budget = max_span - 1
    before = F.least(left, F.greatest(F.lit((budget + 1) // 2), F.lit(budget) - right))
    after = F.least(right, F.lit(budget) - before)
    cut_left = left + F.least(left, right) + 1 >= max_span
    return F.concat(
        F.when(cut_left, "... ").otherwise(""),
        F.array_join(F.slice(sentence, i - before + 1, before + after + 1), " "),
        F.when(after < right, " ...").otherwise(""),
    )


def context_span(terms: Column, index: Column, max_span: int = MAX_SPAN) -> Column:
    """The span around `index` in a whole array of terms; a bad index raises."""
    closes = F.transform(terms, ends_sentence)
    earlier = F.slice(closes, 1, index)
    since_last = F.array_position(F.reverse(earlier), True).cast("int")
    left = F.when(since_last > 0, since_last - 1).otherwise(index)
    until_next = F.array_position(F.slice(closes, index + 1, F.size(terms)), True).cast("int")
    right = F.when(until_next > 0, until_next - 1).otherwise(F.size(terms) - 1 - index)
    sentence = F.slice(terms, index - left + 1, left + right + 1)
    bad = (index < 0) | (index >= F.size(terms))
    message = F.concat(F.lit("no term at position "), index.cast("string"))
    return F.when(bad, F.raise_error(message)).otherwise(_span(sentence, left, max_span))


def all_spans(docs: DataFrame, id_column: str, text: str = "text", max_span: int = MAX_SPAN) -> DataFrame:
    """The span of every space-separated term of every document.

    A term is named by its sentence and its position there, both from 0.
    """
    marked = F.regexp_replace(F.col(text), r"(?<![^ ])([^ .!?]*[.!?][^ ]*) ", f"$1{_BREAK}")
    sentences = docs.select(id_column, F.posexplode(F.split(marked, _BREAK)).alias("sentence", "_text"))
    terms = sentences.select(id_column, "sentence", F.split("_text", " ").alias("_terms"))
    spans = F.transform(F.col("_terms"), lambda term, i: F.struct(term.alias("term"), _span(F.col("_terms"), i, max_span).alias("span")))
    hit = F.posexplode(spans).alias("position", "_hit")
    return terms.select(id_column, "sentence", hit).select(id_column, "sentence", "position", "_hit.*")
