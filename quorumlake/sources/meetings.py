"""Nested meeting documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import MEETING_DDL


def read_meetings(spark: SparkSession, path: str) -> DataFrame:
    """Meeting documents with items, attachments, votes and persons inside."""
    return spark.read.schema(MEETING_DDL).json(path, multiLine=True)
