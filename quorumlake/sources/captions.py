"""WebVTT caption files to cue rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_STAMP = r"((?:\d+:)?\d{2}:\d{2}\.\d{3})"
_CUE = rf"(?s)(?:\A|\n){_STAMP}[ \t]+-->[ \t]+{_STAMP}[^\n]*(?:\n|\z)(.*)\z"


def read_caption_files(spark: SparkSession, path: str) -> DataFrame:
    """`(file, content)`, one row per file."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("content"))


def _seconds(stamp: Column) -> Column:
    parts = F.reverse(F.split(stamp, ":"))
    hours = F.coalesce(F.get(parts, F.lit(2)), F.lit("0")).cast("double")
    return hours * 3600 + parts[1].cast("double") * 60 + parts[0].cast("double")


def cues(files: DataFrame, key: str = "file", content: str = "content") -> DataFrame:
    """`(key, cue_idx, start_time, end_time, text)`, numbered within each file.

    Settings after the times are ignored, tags in the text are removed.
    """
    lines = F.regexp_replace(content, "\r\n?", "\n")
    blocks = F.filter(F.split(lines, r"\n[ \t]*\n"), lambda block: block.rlike(_CUE))
    exploded = files.select(key, F.posexplode(blocks).alias("cue_idx", "_block"))
    text = F.regexp_replace(F.regexp_extract("_block", _CUE, 3), "<[^>]*>", "")
    return exploded.select(
        key,
        "cue_idx",
        _seconds(F.regexp_extract("_block", _CUE, 1)).alias("start_time"),
        _seconds(F.regexp_extract("_block", _CUE, 2)).alias("end_time"),
        F.regexp_replace(text, r"\n+\z", "").alias("text"),
    )
