"""Transcript documents: reading, flattening to text, writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.spread import best_per_key
from ..schemas import TRANSCRIPT_DDL, TRANSCRIPT_FORMATS

SPEAKER_TURNS = TRANSCRIPT_FORMATS[0]


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """One row per transcript file, with its `uri`."""
    documents = spark.read.schema(TRANSCRIPT_DDL).json(path, multiLine=True)
    return documents.select("*", F.col("_metadata.file_path").alias("uri"))


def known_format(transcript_format: Column) -> Column:
    return F.coalesce(transcript_format.isin(*TRANSCRIPT_FORMATS), F.lit(False))


def raw_text(transcript_format: Column, data: Column) -> Column:
    """All portions as one text; an unknown format, missing data or a portion without text raises."""
    inner = F.flatten(F.transform(data, lambda turn: turn.data))
    message = F.concat(F.lit("unknown transcript format: "), F.coalesce(transcript_format, F.lit("none")))
    turns = transcript_format == SPEAKER_TURNS
    silent = F.exists(F.when(turns, inner).otherwise(F.transform(data, lambda p: F.struct(p.start_time, p.text, p.end_time))), lambda p: p.text.isNull())
    return (
        F.when(known_format(transcript_format) & data.isNull(), F.raise_error(F.lit("transcript without data")))
        .when(known_format(transcript_format) & F.coalesce(silent, F.lit(True)), F.raise_error(F.lit("transcript portion without text")))
        .when(turns, F.array_join(F.transform(inner, lambda p: p.text), " "))
        .when(known_format(transcript_format), F.array_join(F.transform(data, lambda p: p.text), " "))
        .otherwise(F.raise_error(message))
    )


def preferred_format(documents: DataFrame, keys: list[str]) -> DataFrame:
    """Of several transcripts per key, the one in the most detailed format.

    With a column `part`, a transcript is all rows of its key, format and, if
    given, `uri`, and is kept with all its parts.
    """
    rank = F.array_position(F.array(*[F.lit(name) for name in TRANSCRIPT_FORMATS]), F.col("format"))
    ties = [F.col("uri")] if "uri" in documents.columns else []
    known = documents.where(known_format(F.col("format")))
    if "part" not in documents.columns:
        return best_per_key(known, keys, rank, *ties)
    place = F.dense_rank().over(Window.partitionBy(*keys).orderBy(rank, *ties))
    return known.withColumn("_place", place).where("_place = 1").drop("_place")


def in_one(documents: DataFrame, keys: list[str]) -> DataFrame:
    """Documents of several parts as one per key: the portions of all parts in order.

    Every other column is that of the first part. For files whose portions fit
    a row; indexing needs no such row.
    """
    others = [c for c in documents.columns if c not in (*keys, "part", "data")]
    pieces = F.array_sort(F.collect_list(F.struct("part", "data")))
    whole = documents.groupBy(*keys).agg(
        pieces.alias("_pieces"), F.min_by(F.struct(*others), F.col("part")).alias("_first")
    )
    data = F.flatten(F.transform("_pieces", lambda p: p.data))
    return whole.select(*keys, *[F.col(f"_first.{c}") for c in others], data.alias("data"))


def write_transcripts(documents: DataFrame, path: str, mode: str = "append") -> None:
    """JSON documents in one folder per format."""
    documents.write.mode(mode).partitionBy("format").json(path)
