"""Table catalogue and document schemas."""

from __future__ import annotations

from dataclasses import dataclass

# Table names, columns and natural keys of the relational model.
_TABLE_COLUMNS = {
    "body": ("body_id string, name string, description string, created timestamp", ("name",)),
    "minutes_item": (
        "minutes_item_id string, name string, matter string, title string, "
        "legistar_event_item_id long, created timestamp",
        ("name",),
    ),
    "minutes_item_file": (
        "minutes_item_file_id string, minutes_item_id string, uri string, name string, "
        "legistar_matter_attachment_id long, created timestamp",
        ("minutes_item_id", "uri"),
    ),
    "event": (
        "event_id string, body_id string, agenda_file_uri string, event_datetime timestamp, "
        "minutes_file_uri string, source_uri string, video_uri string, legistar_event_id long, "
        "legistar_event_link string, created timestamp",
        ("video_uri",),
    ),
    "event_minutes_item": (
        "event_minutes_item_id string, event_id string, minutes_item_id string, index int, "
        "decision string, created timestamp",
        ("event_id", "minutes_item_id"),
    ),
    "person": (
        "person_id string, full_name string, email string, phone string, website string, "
        "legistar_person_id long, created timestamp",
        ("full_name", "email"),
    ),
    "vote": (
        "vote_id string, person_id string, event_minutes_item_id string, decision string, "
        "legistar_event_item_vote_id long, created timestamp",
        ("person_id", "event_minutes_item_id"),
    ),
    "file": (
        "file_id string, uri string, filename string, description string, content_type string, "
        "created timestamp",
        ("uri",),
    ),
    "transcript": (
        "transcript_id string, event_id string, file_id string, confidence double, created timestamp",
        ("event_id", "file_id"),
    ),
    "algorithm": (
        "algorithm_id string, name string, version string, description string, source string, "
        "created timestamp",
        ("name", "version"),
    ),
    "run": (
        "run_id string, algorithm_id string, begin timestamp, completed timestamp",
        ("algorithm_id", "begin", "completed"),
    ),
    "run_input": ("run_input_id string, run_id string, dtype string, value string", ("run_id", "dtype", "value")),
    "run_input_file": ("run_input_file_id string, run_id string, file_id string", ("run_id", "file_id")),
    "run_output": ("run_output_id string, run_id string, dtype string, value string", ("run_id", "dtype", "value")),
    "run_output_file": ("run_output_file_id string, run_id string, file_id string", ("run_id", "file_id")),
    "indexed_event_term": (
        "indexed_event_term_id string, term string, event_id string, value double, updated timestamp",
        ("term", "event_id"),
    ),
    "indexed_minutes_item_term": (
        "indexed_minutes_item_term_id string, term string, minutes_item_id string, value double, "
        "updated timestamp",
        ("term", "minutes_item_id"),
    ),
    "event_topic": (
        "event_topic_id string, event_id string, topic string, updated timestamp",
        ("event_id", "topic"),
    ),
    "event_entity": (
        "event_entity_id string, event_id string, label string, value string, dtype string, "
        "updated timestamp",
        ("event_id", "label", "value"),
    ),
}


@dataclass(frozen=True)
class Table:
    name: str
    ddl: str
    key: tuple[str, ...]

    @property
    def id_column(self) -> str:
        return f"{self.name}_id"


TABLES = {name: Table(name, ddl, key) for name, (ddl, key) in _TABLE_COLUMNS.items()}


def table_names() -> list[str]:
    return list(TABLES)


# Transcript format names, in order of preference.
TRANSCRIPT_FORMATS = ("timestamped-speaker-turns", "timestamped-sentences", "timestamped-words", "raw")

_PORTION = "start_time: double, text: string, end_time: double"
TRANSCRIPT_DDL = (
    "format string, annotations array<string>, confidence double, "
    f"data array<struct<{_PORTION}, speaker: string, data: array<struct<{_PORTION}>>>>"
)

# Field names of the nested meeting document.
MEETING_DDL = (
    "EventId long, EventBodyName string, EventDate string, EventTime string, "
    "EventAgendaStatusName string, EventAgendaFile string, EventMinutesFile string, "
    "EventInSiteURL string, "
    "EventItems array<struct<EventItemId: long, EventItemMinutesSequence: int, "
    "EventItemTitle: string, EventItemMatterName: string, EventItemMatterFile: string, "
    "EventItemPassedFlagName: string, "
    "EventItemMatterAttachments: array<struct<MatterAttachmentId: long, "
    "MatterAttachmentName: string, MatterAttachmentHyperlink: string>>, "
    "EventItemVoteInfo: array<struct<VoteId: long, VotePersonId: long, VoteValueName: string, "
    "PersonInfo: struct<PersonId: long, PersonFullName: string, PersonEmail: string, "
    "PersonPhone: string, PersonWWW: string>>>>>"
)
