"""Nested meeting documents to flat rows and keyed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.values import first_filled, index_or_default, parse_date_and_clock
from .select import not_ignored
from .spread import best_per_key
from .store import surrogate_key


def _attachments(item: Column) -> Column:
    return F.transform(
        F.coalesce(item.EventItemMatterAttachments, F.array()),
        lambda a: F.struct(
            tx.clean_field(a.MatterAttachmentName).alias("name"),
            a.MatterAttachmentHyperlink.alias("uri"),
            a.MatterAttachmentId.alias("legistar_matter_attachment_id"),
        ),
    )


def _votes(item: Column) -> Column:
    votes = F.transform(
        F.coalesce(item.EventItemVoteInfo, F.array()),
        lambda v: F.struct(
            v.VoteValueName.alias("decision"),
            v.VoteId.alias("legistar_event_item_vote_id"),
            F.struct(
                v.PersonInfo.PersonFullName.alias("full_name"),
                v.PersonInfo.PersonEmail.alias("email"),
                v.PersonInfo.PersonPhone.alias("phone"),
                v.PersonInfo.PersonWWW.alias("website"),
                v.PersonInfo.PersonId.alias("legistar_person_id"),
            ).alias("person"),
        ),
    )
    passed = F.coalesce(item.EventItemPassedFlagName, F.lit("")) != ""
    return F.when(passed, votes).otherwise(F.slice(votes, 1, 0))


def _item(item: Column, position: Column) -> Column:
    matter = first_filled(item.EventItemMatterName, item.EventItemMatterFile)
    name = first_filled(item.EventItemTitle, item.EventItemMatterName, item.EventItemMatterFile)
    return F.struct(
        index_or_default(item.EventItemMinutesSequence).alias("index"),
        position.alias("position"),
        tx.clean_field(name).alias("name"),
        tx.clean_field(matter).alias("matter"),
        item.EventItemId.alias("legistar_event_item_id"),
        F.nullif(item.EventItemPassedFlagName, F.lit("")).alias("decision"),
        _attachments(item).alias("attachments"),
        _votes(item).alias("votes"),
    )


def normalize_meetings(
    meetings: DataFrame, ignored: Sequence[str | None] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """Header fields and cleaned items, ordered by sequence number.

    Items named in `ignored` are left out; a missing sequence sorts first.
    Columns named in `keep` are carried along. All of it stays inside the document's row.
    """
    items = F.transform(F.coalesce("EventItems", F.array()), _item)
    kept = F.filter(items, lambda i: not_ignored(i["name"], list(ignored))) if ignored else items
    shortened = F.transform(F.array_sort(kept), lambda i: i.withField("name", tx.truncate(i["name"])))
    return meetings.select(
        F.col("EventAgendaFile").alias("agenda_file_uri"),
        F.col("EventBodyName").alias("body"),
        parse_date_and_clock(F.col("EventDate"), F.col("EventTime")).alias("event_datetime"),
        shortened.alias("minutes_items"),
        F.col("EventId").alias("legistar_event_id"),
        F.col("EventInSiteURL").alias("legistar_event_link"),
        F.col("EventMinutesFile").alias("minutes_file_uri"),
        *keep,
    )


def _item_rows(normalized: DataFrame, *columns: str) -> DataFrame:
    """Columns of each meeting with the fields of each of its items.

    An inner explode would have the optimizer test the item array for rows
    below the projection that builds it, and so build it twice.
    """
    exploded = normalized.select(*columns, F.explode_outer("minutes_items").alias("item"))
    return exploded.where("item is not null").select(*columns, "item.*")


def meeting_items(normalized: DataFrame) -> DataFrame:
    """One row per item of each meeting."""
    return _item_rows(normalized, "legistar_event_id")


def item_attachments(items: DataFrame) -> DataFrame:
    """One row per attachment of each item."""
    exploded = items.select(
        "legistar_event_id", "legistar_event_item_id", F.col("name").alias("item_name"), F.explode("attachments").alias("a")
    )
    return exploded.select("legistar_event_id", "legistar_event_item_id", "item_name", "a.*")


def item_votes(items: DataFrame) -> DataFrame:
    """One row per vote on each passed item, with the person."""
    exploded = items.select(
        "legistar_event_id", "legistar_event_item_id", F.col("name").alias("item_name"), F.explode("votes").alias("v")
    )
    return exploded.select(
        "legistar_event_id", "legistar_event_item_id", "item_name",
        "v.decision", "v.legistar_event_item_vote_id", "v.person.*",
    )


def _unique(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    return best_per_key(rows, keys, *[F.col(c) for c in order])


def star_tables(gathered: DataFrame, vote_tasks: int | None = None) -> dict[str, DataFrame]:
    """The nine tables of normalised meetings with sources attached.

    `gathered` is `normalize_meetings` output with `source_uri`, `video_uri`,
    `transcript_uri` and `confidence`. Ids are hashes of natural keys, so links
    need no lookups. Of rows sharing a key, the first meeting and item wins.
    Votes are dealt to `vote_tasks` tasks, or to as many as Spark takes.
    """
    events = gathered.withColumns(
        {
            "body_id": surrogate_key("body", "body"),
            "event_id": surrogate_key("event", "video_uri"),
            "file_id": surrogate_key("file", "transcript_uri"),
        }
    )
    event = _unique(
        events.select(
            "event_id", "body_id", "agenda_file_uri", "event_datetime", "minutes_file_uri",
            "source_uri", "video_uri", "legistar_event_id", "legistar_event_link",
        ),
        ["video_uri"], "legistar_event_id",
    )
    body = events.select("body_id", F.col("body").alias("name")).distinct()
    transcript = _unique(
        events.select("event_id", "file_id", "confidence", "legistar_event_id"),
        ["event_id", "file_id"], "legistar_event_id",
    ).select(surrogate_key("transcript", "event_id", "file_id").alias("transcript_id"), "event_id", "file_id", "confidence")

    # what transcript.file_id points at
    file = events.where("transcript_uri IS NOT NULL").select("file_id", F.col("transcript_uri").alias("uri")).distinct()

    items = _item_rows(events, "event_id", "legistar_event_id")
    items = items.withColumn("minutes_item_id", surrogate_key("minutes_item", "name"))
    items = items.withColumn(
        "event_minutes_item_id", surrogate_key("event_minutes_item", "event_id", "minutes_item_id")
    )
    order = ("legistar_event_id", "index", "position")
    minutes_item = _unique(
        items.select("minutes_item_id", "name", "matter", "legistar_event_item_id", *order), ["name"], *order
    ).drop(*order)
    event_minutes_item = _unique(
        items.select("event_minutes_item_id", "event_id", "minutes_item_id", "decision", *order),
        ["event_id", "minutes_item_id"], *order,
    ).drop("legistar_event_id", "position")

    files = items.select("minutes_item_id", F.explode("attachments").alias("a")).select("minutes_item_id", "a.*")
    minutes_item_file = _unique(files, ["minutes_item_id", "uri"], "legistar_matter_attachment_id", "name")
    minutes_item_file = minutes_item_file.withColumn(
        "minutes_item_file_id", surrogate_key("minutes_item_file", "minutes_item_id", "uri")
    )

    votes = items.select("event_minutes_item_id", F.explode("votes").alias("v")).select(
        "event_minutes_item_id", "v.decision", "v.legistar_event_item_vote_id", "v.person.*"
    )
    votes = votes.withColumn("person_id", surrogate_key("person", "full_name", "email"))
    person = _unique(
        votes.select("person_id", "full_name", "email", "phone", "website", "legistar_person_id"),
        ["full_name", "email"], "legistar_person_id", "phone", "website",
    )
    # an item's votes move in one row, as lists of the natural keys that the ids are made of after it
    lists = {"full_name": "votes.person.full_name", "email": "votes.person.email", "decision": "votes.decision",
             "legistar_event_item_vote_id": "votes.legistar_event_item_vote_id"}
    ballots = items.where(F.size("votes") > 0).select("event_minutes_item_id", *[F.col(path).alias(name) for name, path in lists.items()])
    dealt = ballots.repartition(*([vote_tasks] if vote_tasks else []), "event_minutes_item_id")
    cast = dealt.select("event_minutes_item_id", F.explode_outer(F.arrays_zip(*lists)).alias("v"))
    cast = cast.where("v IS NOT NULL").select("event_minutes_item_id", "v.*")
    # by person first, which leaves the rows of a person together: equal ids take little room in a file
    cast = _unique(cast, ["full_name", "email", "event_minutes_item_id"], "legistar_event_item_vote_id", "decision")
    vote = cast.select(
        surrogate_key("person", "full_name", "email").alias("person_id"), "event_minutes_item_id", "decision", "legistar_event_item_vote_id"
    ).withColumn("vote_id", surrogate_key("vote", "person_id", "event_minutes_item_id"))
    return {
        "body": body, "event": event, "minutes_item": minutes_item,
        "minutes_item_file": minutes_item_file, "event_minutes_item": event_minutes_item,
        "person": person, "vote": vote, "transcript": transcript, "file": file,
    }
