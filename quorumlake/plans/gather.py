"""Gathering: scraped records, matched with meetings, loaded into the tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import first_filled
from ..operators.match import match_agendas, match_names
from ..operators.meetings import normalize_meetings, star_tables
from ..operators.index import Indexer
from ..operators.select import not_status
from ..operators.spread import best_per_key
from ..operators.store import new_records
from ..session import written
from ..sources.captions import cues
from ..sources.transcripts import preferred_format
from .indexing import event_index, transcript_texts
from .transcribe import TranscriptSource


def _next_midnight(stamp: Column) -> Column:
    """The one midnight in `[stamp, stamp + 1 day)`, where meeting dates lie."""
    day = F.date_trunc("day", stamp)
    return F.when(day == stamp, day.cast("date")).otherwise(F.date_add(day.cast("date"), 1))


def _joined_agenda(items: Column) -> Column:
    return F.lower(F.array_join(items, " "))


def attach_meetings(
    records: DataFrame,
    meetings: DataFrame,
    ignored: Sequence[str | None] = (),
    single_candidate_shortcut: bool = True,
) -> DataFrame:
    """Each record with the details of the meeting it belongs to.

    A day's only meeting is taken as it is. Otherwise cancelled meetings go,
    the body name decides, and the agenda decides among meetings of that body.
    Records without a match drop out.
    """
    wanted = records.select(
        "source_uri", "video_uri", "caption_uri", "body",
        _next_midnight(F.col("event_datetime")).alias("day"),
        _joined_agenda(F.col("minutes_items")).alias("agenda"),
    )
    names = F.transform("EventItems", lambda i: first_filled(i.EventItemMatterName, i.EventItemTitle))
    options = meetings.select(
        F.to_date(F.substring_index("EventDate", "T", 1)).alias("day"),
        F.col("EventBodyName").alias("body"),
        F.col("EventId").alias("legistar_event_id"),
        F.col("EventAgendaStatusName").alias("status"),
        _joined_agenda(names).alias("meeting_agenda"),
    )
    keep = ["source_uri", "video_uri", "caption_uri", "legistar_event_id"]
    matched = None
    if single_candidate_shortcut:
        sole = options.groupBy("day").agg(
            F.count("*").alias("n"), F.min("legistar_event_id").alias("legistar_event_id")
        ).where("n = 1")
        matched = wanted.join(sole, "day").select(keep)
        wanted = wanted.join(sole, "day", "left_anti")
    live = options.where(not_status(F.col("status"), "Cancelled"))
    named = match_names(wanted, live, "day", "body")
    by_body = named.withColumn("bucket", F.struct("day", F.col("matched_name").alias("body")))
    candidates = live.withColumn("bucket", F.struct("day", "body"))
    found = match_agendas(
        by_body.drop("score"), candidates, "bucket", "agenda", "legistar_event_id", "meeting_agenda"
    )
    chosen = found.withColumnRenamed("match_id", "legistar_event_id").select(keep)
    matched = chosen if matched is None else matched.unionByName(chosen)
    return matched.join(normalize_meetings(meetings, ignored), "legistar_event_id")


def with_transcripts(events: DataFrame, captioned: DataFrame, recognised: DataFrame) -> DataFrame:
    """Adds `transcript_uri` and `confidence`: captions first, else recognition.

    `captioned` is keyed by `caption_uri`, `recognised` by `video_uri`. Events
    with neither drop out.
    """
    caps = captioned.select("caption_uri", F.struct("transcript_uri", "confidence").alias("_caption"))
    recs = recognised.select("video_uri", F.struct("transcript_uri", "confidence").alias("_speech"))
    joined = events.join(caps, "caption_uri", "left").join(recs, "video_uri", "left")
    chosen = joined.withColumn("_t", F.coalesce("_caption", "_speech")).where("_t is not null")
    return chosen.select("*", "_t.*").drop("_caption", "_speech", "_t")


def _attached(records: DataFrame, meetings: DataFrame, stored_events: DataFrame, ignored: Sequence[str | None]) -> DataFrame:
    parsed = records.where("status = 'parsed'")
    fresh = written(new_records(stored_events, parsed, ["video_uri"]), "records")
    return attach_meetings(fresh, meetings, ignored)


def gather(
    records: DataFrame,
    meetings: DataFrame,
    stored_events: DataFrame,
    captioned: DataFrame,
    recognised: DataFrame,
    ignored: Sequence[str | None] = (),
) -> dict[str, DataFrame]:
    """Rows for the nine tables from records not stored yet.

    Pages are parsed once and meetings matched once: both results are written,
    since every table is made from them.
    """
    attached = _attached(records, meetings, stored_events, ignored)
    return star_tables(written(with_transcripts(attached, captioned, recognised), "gathered"))


@dataclass(frozen=True)
class Speech:
    """What can be heard of meetings, and what makes transcripts of it.

    `caption_files` is `(caption_uri, content)`, of which `captions` gets cues
    keyed by `caption_uri` and ordered by `cue_idx`. `words` is `(video_uri, ...)`
    in whatever columns `recogniser` reads.
    """

    caption_files: DataFrame
    words: DataFrame
    captions: TranscriptSource
    recogniser: TranscriptSource


@dataclass(frozen=True)
class Gathering:
    """The table rows of a gather, the transcript documents they point at, and the index over both."""

    tables: dict[str, DataFrame]
    documents: DataFrame
    index: DataFrame


def _main_transcripts(documents: DataFrame, key: str) -> DataFrame:
    """The documents of the best format of each file, whose uri is made of format and file."""
    uri = F.concat_ws("/", F.lit("transcripts"), "format", F.sha2(key, 256))
    columns = (key, "uri", "part", "format", "confidence", "data")
    return written(preferred_format(documents.withColumn("uri", uri), [key]).select(*columns), "transcripts")


def transcribe(events: DataFrame, speech: Speech) -> tuple[DataFrame, DataFrame]:
    """Main transcripts of the events: by caption file, and by video where no caption file has a cue.

    Only files of these events are parsed, only words of uncaptioned videos
    are read. Of files that landed twice the greatest content counts.
    """
    landed = speech.caption_files.join(events.select("caption_uri"), "caption_uri", "left_semi")
    landed = best_per_key(landed, ["caption_uri"], F.desc("content"))
    captioned = _main_transcripts(speech.captions.transcripts(cues(landed, "caption_uri")), "caption_uri")
    silent = events.join(captioned.select("caption_uri"), "caption_uri", "left_anti")
    heard = written(speech.words.join(silent.select("video_uri"), "video_uri", "left_semi"), "heard")
    return captioned, _main_transcripts(speech.recogniser.transcripts(heard), "video_uri")


def gather_and_index(
    records: DataFrame,
    meetings: DataFrame,
    stored_events: DataFrame,
    speech: Speech,
    ignored: Sequence[str | None] = (),
    indexer: Indexer | None = None,
) -> Gathering:
    """From scraped records to tables, transcripts and event index.

    Records not stored yet are matched with meetings and transcribed; events
    without captions or words drop out. The index reads the transcripts that
    the new tables name.
    """
    attached = written(_attached(records, meetings, stored_events, ignored), "attached")
    captioned, recognised = transcribe(attached, speech)

    def named(documents: DataFrame, key: str) -> DataFrame:
        # the parts of a file share uri and confidence
        return documents.select(key, F.col("uri").alias("transcript_uri"), "confidence").distinct()

    events = with_transcripts(attached, named(captioned, "caption_uri"), named(recognised, "video_uri"))
    tables = star_tables(written(events, "gathered"))
    documents = captioned.drop("caption_uri").unionByName(recognised.drop("video_uri"))
    index = event_index(
        tables["event"], tables["transcript"], tables["file"], tables["body"], transcript_texts(documents), indexer=indexer
    )
    return Gathering(tables, documents, index)
