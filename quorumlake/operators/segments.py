"""Captions and words to speaker turns, sentences and transcript documents.

Rows are cues or words `(key, order, ...)`, numbered from 0 within their file.
Where a file's rows must be gathered, they are gathered in parts of a bounded
number of rows; a file shorter than that has exactly one part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import let
from ..schemas import TRANSCRIPT_FORMATS
from ..session import written
from .spread import first_per_key, running_totals

PART_ROWS = 10_000

# Limits on recogniser phrases.
PHRASE_COUNT = 500
PHRASE_LENGTH = 100
PHRASE_BUDGET = 9_900


def mark_turns(cues: DataFrame, marker: str, text: str = "text") -> DataFrame:
    """Flags cues that hold the marker and keeps only the text behind it.

    Line handling is Unix style: `.` and `$` know only the newline.
    """
    pattern = rf"(?dU)(?:{marker})+\s*(.+)$"
    starts = F.col(text).rlike(pattern)
    return cues.withColumns(
        {
            "starts_turn": starts,
            text: F.when(starts, F.regexp_extract(text, pattern, 1)).otherwise(F.col(text)),
        }
    )


def closes_sentence(text: Column) -> Column:
    """A cue that ends in `.`, `?` or `!`, trailing space aside."""
    return text.rlike(r"(?dU)^.+[.?!]\s*$")


def number_segments(cues: DataFrame, key: str, order: str, text: str = "text") -> DataFrame:
    """Adds `block`, `turn` and `closed`, the sentences closed before the cue in its file.

    Cues ahead of the first marker are turn 0. `(turn, closed)` names a sentence.
    """
    flagged = cues.withColumn("_closes", closes_sentence(F.col(text)).cast("int"))
    numbered = running_totals(
        flagged, [key], order, {"turn": F.col("starts_turn").cast("int"), "_closed": F.col("_closes")}
    )
    return numbered.withColumn("closed", F.col("_closed") - F.col("_closes")).drop("_closed", "_closes")


def _joined(order: str, text: str) -> Column:
    pieces = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.rtrim(F.col(text)).alias("t"))))
    return F.array_join(F.transform(pieces, lambda p: p.t), " ")


def _assembled(numbered: DataFrame, keys: list[str], order: str, text: str, start: Column, whole: Column) -> DataFrame:
    """Rows of a sentence put together: inside each block, which moves no row,
    then across blocks, which moves one row per sentence and block."""
    pieces = numbered.groupBy(*keys, "block").agg(
        F.min(order).alias("first"),
        F.min(start).alias("_start"),
        F.max_by("end_time", order).alias("end_time"),
        _joined(order, text).alias("text"),
        F.max(whole).alias("_whole"),
    )
    return pieces.groupBy(*keys).agg(
        F.min("first").alias("first"),
        F.min("_start").start_time.alias("start_time"),
        F.max_by("end_time", "first").alias("end_time"),
        _joined("first", "text").alias("text"),
        F.max("_whole").alias("_whole"),
    )


def sentences(numbered: DataFrame, key: str, order: str, text: str = "text") -> DataFrame:
    """One row per sentence of a turn.

    The start is the first start in the sentence that is not zero. A sentence
    is named by its turn and the order value of its first cue.
    """
    start = F.when(F.col("start_time") != 0, F.struct(order, "start_time"))
    rows = _assembled(numbered, [key, "turn", "closed"], order, text, start, F.lit(1))
    return rows.select(
        key, "turn", F.col("first").alias("first_cue"),
        F.coalesce("start_time", F.lit(0.0)).alias("start_time"), "end_time", "text",
    )


def _portions(position: str) -> Column:
    entry = F.struct(F.col(position).alias("at"), "start_time", "text", "end_time")
    ordered = F.array_sort(F.collect_list(entry))
    return F.transform(ordered, lambda p: F.struct(p.start_time, p.text, p.end_time))


def _part(position: str) -> Column:
    return F.floor(F.col(position) / PART_ROWS).alias("part")


def turn_documents(sentence_rows: DataFrame, key: str) -> DataFrame:
    """Sentences of each turn as an array, in parts; speakers are unknown."""
    return sentence_rows.groupBy(key, "turn", _part("first_cue")).agg(
        F.lit("").alias("speaker"), _portions("first_cue").alias("data")
    )


def sentence_documents(sentence_rows: DataFrame, key: str) -> DataFrame:
    """Sentences of each file as an array, in parts."""
    return sentence_rows.groupBy(key, _part("first_cue")).agg(_portions("first_cue").alias("data"))


def raw_portions(sentence_rows: DataFrame, key: str) -> DataFrame:
    """The text of each file as one portion per part, from first to last time."""
    parts = sentence_rows.groupBy(key, _part("first_cue")).agg(_portions("first_cue").alias("_data"))
    return parts.select(
        key,
        "part",
        F.col("_data")[0].start_time.alias("start_time"),
        F.array_join(F.col("_data").text, " ").alias("text"),
        F.element_at("_data", -1).end_time.alias("end_time"),
    )


def transcript_document(data: Column, transcript_format: str | Column, confidence: Column) -> Column:
    """The stored wrapper around a transcript's portions."""
    if isinstance(transcript_format, str) and transcript_format not in TRANSCRIPT_FORMATS:
        raise ValueError(f"unknown transcript format {transcript_format!r}")
    named = F.lit(transcript_format) if isinstance(transcript_format, str) else transcript_format
    return F.struct(
        named.alias("format"),
        F.array().cast("array<string>").alias("annotations"),
        confidence.cast("double").alias("confidence"),
        data.alias("data"),
    )


def flatten_words(results: DataFrame, key: str, alternatives: str = "alternatives") -> DataFrame:
    """Word rows of recogniser results, from the first alternative of each.

    `results` has one row per result, numbered in `result`.
    """
    words = F.posexplode(F.get(F.col(alternatives), F.lit(0)).words).alias("position", "_word")
    return results.select(key, "result", words).select(
        key,
        "result",
        "position",
        F.col("_word.word").alias("text"),
        (F.col("_word.start_time.seconds") + F.col("_word.start_time.nanos") * 1e-9).alias("start_time"),
        (F.col("_word.end_time.seconds") + F.col("_word.end_time.nanos") * 1e-9).alias("end_time"),
    )


def word_sentences(words: DataFrame, key: str, order: str, keep_tail: bool = False) -> DataFrame:
    """Sentences of time-stamped words, each closed by a word ending in a dot.

    Words after the last closer are dropped unless `keep_tail`.
    """
    closes = F.endswith("text", F.lit(".")).cast("int")
    flagged = words.withColumn("_closes", closes)
    numbered = running_totals(flagged, [key], order, {"_closed": F.col("_closes")})
    placed = numbered.withColumn("sentence", F.col("_closed") - F.col("_closes"))
    start = F.struct(order, "start_time")
    rows = _assembled(placed, [key, "sentence"], order, "text", start, F.col("_closes"))
    kept = rows if keep_tail else rows.where("_whole = 1")
    return kept.select(key, "sentence", F.col("first").alias("first_word"), "start_time", "end_time", "text")


def raw_from_words(words: DataFrame, sentence_rows: DataFrame, key: str, order: str) -> DataFrame:
    """Raw portions of a recognised file: from 0 to the end of its last word."""
    ends = words.groupBy(key).agg(F.max_by("end_time", order).alias("end_time"))
    parts = sentence_rows.groupBy(key, _part("first_word")).agg(_joined("first_word", "text").alias("text"))
    return parts.join(ends, key).select(key, "part", F.lit(0.0).alias("start_time"), "text", "end_time")


def split_files(files: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Files that can stay in their row, and the words of all others as rows.

    `files` is `(key, words)`, words an array of `(text, start_time, end_time)`
    numbered from 0 by their place. A file stays whose key stands in this row
    only and whose words make one part; the keys of all rows are counted, no word
    is moved for it. Rows of the first frame whose file does not stay have no words.
    """
    named = F.col(key).isNotNull()
    repeated = files.select(key).where(named).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    repeated = written(repeated.select(key, F.lit(True).alias("_again")), "repeated-files")
    marked = files.join(repeated, key, "left")

    def stays(w: Column) -> Column:
        silent = F.exists(w, lambda x: x.text.isNull())
        return named & F.col("_again").isNull() & (F.size(w) <= PART_ROWS) & ~silent

    # values and no filters: a filter would move to the scan and build the arrays there once more
    alone = marked.select(key, let(F.col("words"), lambda w: F.when(stays(w) & (F.size(w) > 0), w)).alias("words"))
    others = F.posexplode_outer(let(F.col("words"), lambda w: F.when(~stays(w), w))).alias("word", "_w")
    words = marked.select(key, others).where("word is not null").select(
        key, F.col("word").cast("long").alias("word"), "_w.text", "_w.start_time", "_w.end_time"
    )
    return alone, words


def cut_words(words: Column) -> Column:
    """The closed sentences of one file's array of words, in order, as `word_sentences` makes them of rows."""

    def sentence(words: Column, ends: Column, last: Column, k: Column) -> Column:
        first = F.coalesce(F.get(ends, k - 1) + 1, F.lit(0))
        spoken = F.transform(F.slice(words, first + 1, last - first + 1), lambda w: F.rtrim(w.text))
        return F.struct(
            first.cast("long").alias("first_word"), F.get(words, first).start_time.alias("start_time"),
            F.get(words, last).end_time.alias("end_time"), F.array_join(spoken, " ").alias("text"),
        )

    def cut(words: Column) -> Column:
        closers = F.transform(words, lambda w, i: F.when(F.endswith(w.text, F.lit(".")), i))
        closers = F.filter(closers, lambda i: i.isNotNull())
        return let(closers, lambda ends: F.transform(ends, lambda last, k: sentence(words, ends, last, k)))

    return let(words, cut)


def raw_from_files(files: DataFrame, key: str) -> DataFrame:
    """`raw_from_words` of files `(key, words)`."""
    alone, words = split_files(files, key)
    text = let(cut_words(F.col("words")), lambda cut: F.when(F.size(cut) > 0, F.array_join(cut.text, " ")))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("part"), F.lit(0.0).alias("start_time"), text.alias("text"), F.element_at("words", -1).end_time.alias("end_time")))
    here = alone.select(key, F.explode(whole).alias("_p")).where("_p.text is not null").select(key, "_p.*")
    words = written(words, "words")
    return here.unionByName(raw_from_words(words, word_sentences(words, key, "word"), key, "word"))


def mean_confidence(segments: DataFrame, key: str, confidence: str, n_words: str) -> DataFrame:
    """Mean confidence of the segments that have words; 0 where none has."""
    spoken = F.when(F.col(n_words) > 0, F.col(confidence))
    return segments.groupBy(key).agg(F.coalesce(F.avg(spoken), F.lit(0.0)).alias("confidence"))


def phrase_prefix(phrases: DataFrame, key: str, order: str, phrase: str = "phrase") -> DataFrame:
    """The phrases of each key a recogniser accepts.

    Of the first 500, nulls go; each is cut to 100 characters and back to its
    last space; phrases are taken while those before them total 9,900 or less.
    """
    first = first_per_key(phrases, [key], PHRASE_COUNT, F.col(order)).where(F.col(phrase).isNotNull())
    cut = F.regexp_replace(F.substring(phrase, 1, PHRASE_LENGTH), r"(?s) [^ ]*\z", "")
    # At most 500 rows per key reach this window.
    earlier = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    trimmed = first.withColumn(phrase, cut).withColumn(
        "_used", F.coalesce(F.sum(F.length(phrase)).over(earlier), F.lit(0))
    )
    return trimmed.where(F.col("_used") <= PHRASE_BUDGET).select(key, order, phrase)
