"""Joins over the stored tables: manifests, expansions, voting records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .select import filled
from .spread import best_per_key

ORDER_FIELDS = ("confidence", "created")


def best_transcripts(transcripts: DataFrame, order_by: str = "confidence") -> DataFrame:
    """One transcript per event: the most confident or the latest."""
    if order_by not in ORDER_FIELDS:
        raise ValueError(f"transcripts are ordered by {' or '.join(ORDER_FIELDS)}, not {order_by!r}")
    return best_per_key(transcripts, ["event_id"], F.desc(order_by), F.col("transcript_id"))


def _prefixed(df: DataFrame, prefix: str, *columns: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}_{c}" for c in columns if c in df.columns})


def transcript_manifest(
    events: DataFrame,
    transcripts: DataFrame,
    files: DataFrame,
    bodies: DataFrame,
    order_by: str = "confidence",
) -> DataFrame:
    """One row per event that has a transcript, with its file and body."""
    best = _prefixed(best_transcripts(transcripts, order_by), "transcript", "created")
    return (
        _prefixed(events, "event", "created")
        .join(best, "event_id")
        .join(_prefixed(best_per_key(files, ["file_id"], F.col("uri")), "file", "created", "description"), "file_id")
        .join(_prefixed(bodies, "body", "created", "description", "name"), "body_id")
    )


def events_with_transcript(events: DataFrame, transcripts: DataFrame) -> DataFrame:
    return events.join(transcripts.select("event_id"), "event_id", "left_semi")


def expand_events(events: DataFrame, bodies: DataFrame) -> DataFrame:
    """Events with their body."""
    return _prefixed(events, "event", "created").join(
        _prefixed(bodies, "body", "created", "description", "name"), "body_id"
    )


def expand_transcripts(
    transcripts: DataFrame, files: DataFrame, events: DataFrame, bodies: DataFrame
) -> DataFrame:
    """Every transcript version with its file, event and body."""
    return (
        _prefixed(transcripts, "transcript", "created")
        .join(_prefixed(files, "file", "created", "description"), "file_id")
        .join(expand_events(events, bodies), "event_id")
    )


def voting_record(
    persons: DataFrame,
    votes: DataFrame,
    event_items: DataFrame,
    items: DataFrame,
    events: DataFrame,
    full_name: str,
) -> DataFrame:
    """All votes of one person, with item and event, in event order."""
    chosen = persons.where(F.col("full_name") == full_name).select("person_id", "full_name")
    cast = votes.withColumnRenamed("decision", "vote").select("vote_id", "person_id", "event_minutes_item_id", "vote")
    decided = event_items.select("event_minutes_item_id", "event_id", "minutes_item_id", "decision")
    return (
        chosen.join(cast, "person_id")
        .join(decided, "event_minutes_item_id")
        .join(items.select("minutes_item_id", F.col("name").alias("item_name")), "minutes_item_id")
        .join(events.select("event_id", "event_datetime"), "event_id")
        .orderBy("event_datetime", "vote_id")
    )


def decision_item_sources(
    event_items: DataFrame, items: DataFrame, transcripts: DataFrame, files: DataFrame
) -> DataFrame:
    """Items that were decided on, with the latest transcript file of the event.

    An event without a transcript contributes nothing.
    """
    decided = event_items.where(filled(F.col("decision"))).select("minutes_item_id", "event_id", "decision")
    latest = best_transcripts(transcripts, "created").select("event_id", "file_id")
    return (
        decided.join(items.select("minutes_item_id", "name"), "minutes_item_id")
        .join(latest, "event_id")
        .join(best_per_key(files, ["file_id"], F.col("uri")).select("file_id", "uri"), "file_id")
    )


def grouped_lists(rows: DataFrame, key: str, value: str, block: Column) -> DataFrame:
    """Distinct values per key as sorted lists, one per block of values.

    `block` must put a bounded number of distinct values together.
    """
    distinct = rows.select(key, value, block.alias("block")).distinct()
    return distinct.groupBy(key, "block").agg(F.array_sort(F.collect_list(value)).alias("values"))


def write_manifest(manifest: DataFrame, path: str) -> None:
    """The manifest as CSV files with headers."""
    manifest.write.mode("overwrite").option("header", True).csv(path)


def manifest_corpus(manifest: DataFrame) -> DataFrame:
    """Which transcript file stands for which event."""
    return manifest.select("event_id", "uri")
