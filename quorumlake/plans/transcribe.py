"""From caption cues or recognised words to stored transcript documents."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fix_symbol_spacing
from ..operators import segments as sg
from ..session import written

PORTION = "struct<start_time: double, text: string, end_time: double>"
TURN = "struct<start_time: double, text: string, end_time: double, speaker: string, data: array<" + PORTION + ">>"


class TranscriptSource(Protocol):
    """Anything that turns timed pieces of speech into transcript documents.

    Documents are `(key, part, format, annotations, confidence, data)`; a file
    has one per format and part, and its parts follow each other.
    """

    def transcripts(self, pieces: DataFrame) -> DataFrame: ...


def _document(portions: DataFrame, key: str, transcript_format: str | Column, confidence: Column) -> DataFrame:
    """Documents from `(key, part, data)` rows of portions without speakers."""
    plain = F.transform(
        "data",
        lambda p: F.struct(
            p.start_time.alias("start_time"), p.text.alias("text"), p.end_time.alias("end_time"),
            F.lit(None).cast("string").alias("speaker"), F.lit(None).cast(f"array<{PORTION}>").alias("data"),
        ),
    )
    wrapped = sg.transcript_document(plain.cast(f"array<{TURN}>"), transcript_format, confidence)
    return portions.select(key, "part", wrapped.alias("d")).select(key, "part", "d.*")


def _sentences_and_raw(spoken: DataFrame, raw: DataFrame, key: str, confidence: Column) -> list[DataFrame]:
    whole = raw.select(key, "part", F.array(F.struct("start_time", "text", "end_time")).alias("data"))
    return [
        _document(sg.sentence_documents(spoken, key), key, "timestamped-sentences", confidence),
        _document(whole, key, "raw", confidence),
    ]


@dataclass(frozen=True)
class CaptionTranscripts:
    """Cues `(key, order, text, start_time, end_time)` of caption files.

    A cue holding `marker` opens a speaker turn; without a marker the cues say
    so in `starts_turn`. Turns are cut into sentences, whose symbols are set
    right, and each file is wrapped by turn, by sentence and as a whole.
    """

    key: str
    order: str
    confidence: float
    marker: str | None = None

    def transcripts(self, pieces: DataFrame) -> DataFrame:
        marked = sg.mark_turns(pieces, self.marker) if self.marker else pieces
        spoken = sg.sentences(sg.number_segments(marked, self.key, self.order), self.key, self.order)
        # all three formats are made from the sentences
        spoken = written(spoken.withColumn("text", fix_symbol_spacing(F.col("text"))), "sentences")
        confidence = F.lit(self.confidence)
        turn = F.struct(
            "turn", F.col("data")[0].start_time.alias("start_time"), F.lit(None).cast("string").alias("text"),
            F.element_at("data", -1).end_time.alias("end_time"), "speaker", "data",
        )
        turns = sg.turn_documents(spoken, self.key).groupBy(self.key, "part").agg(F.array_sort(F.collect_list(turn)).alias("data"))
        bare = F.transform("data", lambda t: F.struct(t.start_time, t.text, t.end_time, t.speaker, t.data)).cast(f"array<{TURN}>")
        wrapped = sg.transcript_document(bare, "timestamped-speaker-turns", confidence)
        by_turn = turns.select(self.key, "part", wrapped.alias("d")).select(self.key, "part", "d.*")
        others = _sentences_and_raw(spoken, sg.raw_portions(spoken, self.key), self.key, confidence)
        return reduce(DataFrame.unionByName, [by_turn, *others])


@dataclass(frozen=True)
class WordTranscripts:
    """Words `(key, order, text, start_time, end_time)` of a speech recogniser, or files `(key, words)` with arrays of them.

    Each file is wrapped by word, by sentence and as a whole. Files given as
    arrays stay in their row as far as `split_files` lets them.
    """

    key: str
    order: str
    confidence: float

    def transcripts(self, pieces: DataFrame) -> DataFrame:
        if "words" not in pieces.columns:
            return self._from_rows(pieces.select(self.key, F.col(self.order).alias("word"), "text", "start_time", "end_time"))
        alone, words = sg.split_files(pieces.select(self.key, "words"), self.key)
        return self._in_row(alone).unionByName(self._from_rows(words))

    def _from_rows(self, words: DataFrame) -> DataFrame:
        words = written(words, "words")
        spoken = sg.word_sentences(words, self.key, "word")
        spoken = written(spoken.withColumn("text", fix_symbol_spacing(F.col("text"))), "sentences")
        confidence = F.lit(self.confidence)
        raw = sg.raw_from_words(words, spoken, self.key, "word")
        placed = spoken.withColumnRenamed("first_word", "first_cue")
        by_word = _document(sg.sentence_documents(words.withColumnRenamed("word", "first_cue"), self.key), self.key, "timestamped-words", confidence)
        return reduce(DataFrame.unionByName, [by_word, *_sentences_and_raw(placed, raw, self.key, confidence)])

    def _in_row(self, files: DataFrame) -> DataFrame:
        """The documents of files of one part, whose rows are read once for all formats."""
        cut = files.select(self.key, "words", sg.cut_words(F.col("words")).alias("_cut"))
        end = F.element_at("words", -1).end_time

        def portion(start: Column, text: Column, end: Column) -> Column:
            return F.struct(start.alias("start_time"), text.alias("text"), end.alias("end_time"))

        by_sentence = F.transform("_cut", lambda s: portion(s.start_time, fix_symbol_spacing(s.text), s.end_time))
        rows = cut.select(self.key, F.transform("words", lambda w: portion(w.start_time, w.text, w.end_time)).alias("words"), by_sentence.alias("_cut"), end.alias("_end"))
        whole = F.array(portion(F.lit(0.0), F.array_join("_cut.text", " "), F.col("_end")))
        formats = {"timestamped-words": F.col("words"), "timestamped-sentences": F.col("_cut"), "raw": F.when(F.size("_cut") > 0, whole)}
        made = F.explode(F.array(*[F.struct(F.lit(name).alias("format"), data.alias("data")) for name, data in formats.items()]))
        each = rows.select(self.key, F.lit(0).cast("long").alias("part"), made.alias("_f")).where(F.size("_f.data") > 0)
        each = each.select(self.key, "part", F.col("_f.format").alias("_format"), F.col("_f.data").alias("data"))
        return _document(each, self.key, F.col("_format"), F.lit(self.confidence))
