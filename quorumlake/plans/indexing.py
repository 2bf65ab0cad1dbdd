"""The two index builds: over meetings and over agenda items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.index import Indexer, TfidfIndexer, merge_counts
from ..operators.manifest import decision_item_sources, transcript_manifest
from ..session import written
from ..sources.transcripts import raw_text


def transcript_texts(documents: DataFrame) -> DataFrame:
    """`(uri, text)` of transcript documents in any format."""
    return documents.select("uri", raw_text(F.col("format"), F.col("data")).alias("text"))


def _counts_of(wanted: DataFrame, id_column: str, texts: DataFrame, indexer: Indexer) -> DataFrame:
    """Term counts per id from `(id, uri)` rows: every text is counted once, and only counts are joined."""
    used = texts.join(wanted.select("uri"), "uri", "left_semi").select("uri", "text")
    joined = indexer.counts(used, "uri").join(wanted, "uri")
    return merge_counts(joined.select(id_column, "term", "n"), id_column)


def event_index(
    events: DataFrame,
    transcripts: DataFrame,
    files: DataFrame,
    bodies: DataFrame,
    texts: DataFrame,
    order_by: str = "confidence",
    indexer: Indexer | None = None,
) -> DataFrame:
    """`(term, event_id, value)` over the best transcript of each event."""
    manifest = transcript_manifest(events, transcripts, files, bodies, order_by)
    wanted = written(manifest.select("event_id", "uri"), "best-transcripts")
    indexer = indexer or TfidfIndexer("event_id")
    return indexer.weigh(_counts_of(wanted, "event_id", texts, indexer))


def item_index(
    event_items: DataFrame,
    items: DataFrame,
    transcripts: DataFrame,
    files: DataFrame,
    texts: DataFrame,
    attachments: DataFrame,
    indexer: Indexer | None = None,
) -> DataFrame:
    """`(term, minutes_item_id, value)` over the documents of decided items.

    `attachments` is `(minutes_item_id, uri, text)`.
    """
    sources = decision_item_sources(event_items, items, transcripts, files)
    wanted = written(sources.select("minutes_item_id", "uri").distinct(), "item-sources")
    indexer = indexer or TfidfIndexer("minutes_item_id")
    spoken = _counts_of(wanted, "minutes_item_id", texts, indexer)
    decided = attachments.join(wanted.select("minutes_item_id"), "minutes_item_id", "left_semi")
    # the portions of all attachments of an item are one document, like its transcripts
    attached = indexer.counts(decided.select("minutes_item_id", "text"), "minutes_item_id")
    return indexer.weigh(merge_counts(spoken.unionByName(attached), "minutes_item_id"))
