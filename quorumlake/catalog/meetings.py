"""Nested meeting documents, star load, matching and gathering.

Each document stands for a meeting whose paragraphs are its agenda items, each
page for a scraped record, and turns of a conversation for competing agendas.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.similarity import JACCARD
from ..operators import match as ma
from ..operators import meetings as mt
from ..operators.index import TfidfIndexer
from ..operators.manifest import transcript_manifest
from ..operators.select import not_status
from ..plans.gather import Speech, gather, gather_and_index
from ..plans.transcribe import CaptionTranscripts, WordTranscripts
from ..session import written
from ..sources.pages import ListingLayout, page_records
from . import score_sql
from .records import INDEX_OF
from .registry import load, load_wide, query
from .texts import _HOST, _SQL_HOST, _SQL_TITLE, TERMS, listing_pages, page_title
from .transcripts import WORD_SENTENCES, WORDS, word_array

IGNORED = ["Amen.", None]

#: Tasks of votes for each split of the documents: a file of one task holds few enough items for a dictionary of their ids.
VOTE_TASKS = 20


def meeting_documents(spark, root):
    """Documents as nested meetings, built row by row."""
    docs = load_wide(spark, root, "documents")
    doc, lines = F.col("doc_id"), F.split("text", "\n")

    def person(word, k):
        return F.struct(
            F.length(word).cast("long").alias("PersonId"), word.alias("PersonFullName"),
            F.when(k == 0, F.concat(F.lower(word), F.lit("@x.gov"))).alias("PersonEmail"),
            F.lit(None).cast("string").alias("PersonPhone"), F.lit(None).cast("string").alias("PersonWWW"),
        )

    def item(line, i):
        item_id = doc * 100_000 + i
        votes = F.transform(
            F.split(line, " "),
            lambda word, k: F.struct(
                (item_id * 100_000 + k).alias("VoteId"), F.length(word).cast("long").alias("VotePersonId"),
                F.when(k == 0, "In Favor").otherwise("Opposed").alias("VoteValueName"), person(word, k).alias("PersonInfo"),
            ),
        )
        files = F.array(
            F.struct(
                (item_id * 10).alias("MatterAttachmentId"),
                F.concat(F.lit("file_"), i.cast("string"), F.lit("\r\n")).alias("MatterAttachmentName"),
                F.concat(F.lit("http://x.gov/"), (i % 7).cast("string"), F.lit(".pdf")).alias("MatterAttachmentHyperlink"),
            )
        )
        return F.struct(
            item_id.alias("EventItemId"),
            F.when(i % 4 != 3, (F.size(lines) - i) % 5).alias("EventItemMinutesSequence"),
            line.alias("EventItemTitle"),
            F.when(i % 2 == 0, F.concat(F.lit("Matter "), i.cast("string"))).alias("EventItemMatterName"),
            F.concat(F.lit("CB_"), i.cast("string")).alias("EventItemMatterFile"),
            F.when(i % 3 == 0, "Pass").when(i % 3 == 1, "").alias("EventItemPassedFlagName"),
            F.when(i % 2 == 1, files).alias("EventItemMatterAttachments"),
            votes.alias("EventItemVoteInfo"),
        )

    day = F.date_add(F.lit("2024-01-01").cast("date"), (doc % 28).cast("int"))
    return docs.select(
        doc.alias("EventId"), F.col("source").alias("EventBodyName"),
        F.concat(day.cast("string"), F.lit("T00:00:00")).alias("EventDate"),
        F.when(doc % 2 == 0, "9:30 AM").otherwise("1:05 PM").alias("EventTime"),
        F.lit("Final").alias("EventAgendaStatusName"), F.lit(None).cast("string").alias("EventAgendaFile"),
        F.lit(None).cast("string").alias("EventMinutesFile"),
        F.concat(F.lit("http://x.gov/m/"), doc.cast("string")).alias("EventInSiteURL"),
        F.transform(lines, item).alias("EventItems"),
        F.concat(F.lit("v/"), F.col("source"), F.lit("/"), F.col("n_chars").cast("string")).alias("video_uri"),
    )


ITEMS = """
    SELECT doc_id, 'v/' || source || '/' || n_chars AS video_uri, source, i AS position, line,
      CASE WHEN i % 4 = 3 THEN -1 ELSE coalesce(nullif((n - i) % 5, 0), -1) END AS idx,
      regexp_replace(coalesce(nullif(line, ''), CASE WHEN i % 2 = 0 THEN 'Matter ' || i END, 'CB_' || i), '[\\r\\n_]', '', 'g') AS full_name,
      regexp_replace(coalesce(CASE WHEN i % 2 = 0 THEN 'Matter ' || i END, 'CB_' || i), '[\\r\\n_]', '', 'g') AS matter,
      doc_id * 100000 + i AS item_id, CASE WHEN i % 3 = 0 THEN 'Pass' END AS decision
    FROM (SELECT doc_id, source, n_chars, len(ls) AS n, unnest(range(len(ls))) AS i, unnest(ls) AS line
          FROM (SELECT *, string_split(text, chr(10)) AS ls FROM documents))"""
KEPT = f"""SELECT *, CASE WHEN length(full_name) > 800 THEN full_name[1:800] || '...' ELSE full_name END AS name
           FROM ({ITEMS}) WHERE full_name <> 'Amen.'"""


def normalized(spark, root):
    return mt.normalize_meetings(meeting_documents(spark, root), IGNORED)


@query("normalize_meeting", f"""
    SELECT doc_id AS legistar_event_id, source AS body, 'http://x.gov/m/' || doc_id AS legistar_event_link,
      TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 28 AS INTEGER))
        + CASE WHEN doc_id % 2 = 0 THEN INTERVAL 570 MINUTE ELSE INTERVAL 785 MINUTE END AS event_datetime,
      k.names FROM documents LEFT JOIN (SELECT doc_id, string_agg(name, '|' ORDER BY idx, position) AS names FROM ({KEPT}) GROUP BY doc_id) AS k USING (doc_id)""")
def normalize_meeting(spark, root):
    names = F.nullif(F.array_join("minutes_items.name", "|"), F.lit(""))
    return normalized(spark, root).select(
        "legistar_event_id", "body", "legistar_event_link",
        F.col("event_datetime").cast("timestamp_ntz").alias("event_datetime"), names.alias("names"),
    )


@query("explode_items", f"""
    SELECT doc_id AS legistar_event_id, CAST(idx AS INTEGER) AS "index", CAST(position AS INTEGER) AS position, name, matter,
      item_id AS legistar_event_item_id, decision FROM ({KEPT})""")
def explode_items(spark, root):
    return mt.meeting_items(normalized(spark, root)).drop("attachments", "votes")


@query("explode_attachments", f"""
    SELECT doc_id AS legistar_event_id, item_id AS legistar_event_item_id, name AS item_name, 'file' || position AS name,
      'http://x.gov/' || position % 7 || '.pdf' AS uri, item_id * 10 AS legistar_matter_attachment_id
    FROM ({KEPT}) WHERE position % 2 = 1""")
def explode_attachments(spark, root):
    return mt.item_attachments(mt.meeting_items(normalized(spark, root)))


VOTES = f"""
    SELECT doc_id, video_uri, item_id, name, k, word AS full_name, CASE WHEN k = 0 THEN lower(word) || '@x.gov' END AS email,
      CASE WHEN k = 0 THEN 'In Favor' ELSE 'Opposed' END AS decision, item_id * 100000 + k AS vote_id, length(word) AS person_no
    FROM (SELECT *, unnest(range(len(ws))) AS k, unnest(ws) AS word FROM (
      SELECT *, string_split(line, ' ') AS ws FROM ({KEPT}) WHERE decision = 'Pass'))"""


@query("explode_votes", f"""
    SELECT doc_id AS legistar_event_id, item_id AS legistar_event_item_id, name AS item_name, decision,
      vote_id AS legistar_event_item_vote_id, full_name, email, CAST(person_no AS BIGINT) AS legistar_person_id FROM ({VOTES})""")
def explode_votes(spark, root):
    return mt.item_votes(mt.meeting_items(normalized(spark, root))).drop("phone", "website")


def star(spark, root):
    keep = ["video_uri", "source_uri", "transcript_uri", "confidence"]
    documents = meeting_documents(spark, root).withColumns(
        {
            "source_uri": F.col("EventInSiteURL"),
            "transcript_uri": F.concat(F.lit("t/"), F.col("EventId").cast("string")),
            "confidence": F.lit(0.97),
        }
    )
    splits = load(spark, root, "documents").rdd.getNumPartitions()
    return mt.star_tables(mt.normalize_meetings(documents, IGNORED, keep), VOTE_TASKS * splits)


def _key(table, *columns):
    parts = " || chr(1) || ".join(f"coalesce(CAST({c} AS VARCHAR), chr(0))" for c in columns)
    return f"sha256('{table}' || chr(1) || {parts})"


def _star(table, sql, *columns):
    @query(f"star_load_{table}", sql)
    def run(spark, root):
        return star(spark, root)[table].select(*columns)

    return run


_EVENT, _ITEM = _key("event", "video_uri"), _key("minutes_item", "name")
_ITEM_ROWS = f"""SELECT *, {_EVENT} AS event_id, {_ITEM} AS minutes_item_id,
    row_number() OVER (PARTITION BY name ORDER BY doc_id, idx, position) AS name_rank,
    row_number() OVER (PARTITION BY video_uri, name ORDER BY doc_id, idx, position) AS emi_rank FROM ({KEPT})"""
_star("body", f"SELECT {_key('body', 'source')} AS body_id, source AS name FROM (SELECT DISTINCT source FROM documents)", "body_id", "name")
_star(
    "event",
    f"""SELECT {_EVENT} AS event_id, {_key('body', 'source')} AS body_id, video_uri, min(doc_id) AS legistar_event_id
        FROM (SELECT *, 'v/' || source || '/' || n_chars AS video_uri FROM documents) GROUP BY video_uri, source""",
    "event_id", "body_id", "video_uri", "legistar_event_id",
)
_star(
    "minutes_item",
    f"SELECT minutes_item_id, name, matter, item_id AS legistar_event_item_id FROM ({_ITEM_ROWS}) WHERE name_rank = 1",
    "minutes_item_id", "name", "matter", "legistar_event_item_id",
)
_star(
    "event_minutes_item",
    f"""SELECT {_key('event_minutes_item', 'event_id', 'minutes_item_id')} AS event_minutes_item_id, event_id, minutes_item_id,
          CAST(idx AS INTEGER) AS "index", decision FROM ({_ITEM_ROWS}) WHERE emi_rank = 1""",
    "event_minutes_item_id", "event_id", "minutes_item_id", "index", "decision",
)
_star(
    "minutes_item_file",
    f"""SELECT {_key('minutes_item_file', 'minutes_item_id', 'uri')} AS minutes_item_file_id, minutes_item_id, uri,
          min(item_id * 10) AS legistar_matter_attachment_id
        FROM (SELECT *, 'http://x.gov/' || position % 7 || '.pdf' AS uri FROM ({_ITEM_ROWS}) WHERE position % 2 = 1)
        GROUP BY minutes_item_id, uri""",
    "minutes_item_file_id", "minutes_item_id", "uri", "legistar_matter_attachment_id",
)
_star(
    "person",
    f"""SELECT {_key('person', 'full_name', 'email')} AS person_id, full_name, email, CAST(min(person_no) AS BIGINT) AS legistar_person_id
        FROM ({VOTES}) GROUP BY full_name, email""",
    "person_id", "full_name", "email", "legistar_person_id",
)
_star(
    "vote",
    f"""SELECT {_key('vote', 'person_id', 'emi_id')} AS vote_id, person_id, emi_id AS event_minutes_item_id,
          min_by(decision, v_id) AS decision, min(v_id) AS legistar_event_item_vote_id
        FROM (SELECT {_key('person', 'full_name', 'email')} AS person_id, decision, vote_id AS v_id,
                {_key('event_minutes_item', _EVENT, _ITEM)} AS emi_id FROM ({VOTES})) GROUP BY person_id, emi_id""",
    "vote_id", "person_id", "event_minutes_item_id", "decision", "legistar_event_item_vote_id",
)
_star(
    "transcript",
    f"""SELECT {_key('transcript', 'event_id', 'file_id')} AS transcript_id, event_id, file_id, 0.97::DOUBLE AS confidence
        FROM (SELECT {_EVENT} AS event_id, {_key('file', 'turi')} AS file_id FROM (
          SELECT 'v/' || source || '/' || n_chars AS video_uri, 't/' || doc_id AS turi FROM documents))""",
    "transcript_id", "event_id", "file_id", "confidence",
)


_star(
    "file",
    f"SELECT DISTINCT {_key('file', 'turi')} AS file_id, turi AS uri FROM (SELECT 't/' || doc_id AS turi FROM documents)",
    "file_id", "uri",
)


@query("interval_join_1d", """
    SELECT event_id, ts, day, n_held FROM events JOIN (SELECT date_trunc('day', ts) AS day, count(*) AS n_held FROM events GROUP BY 1)
      ON ts <= day AND day < ts + INTERVAL 1 DAY""")
def interval_join_1d(spark, root):
    records = load(spark, root, "events").select("event_id", "ts")
    held = records.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(F.count("*").alias("n_held"))
    return ma.interval_join(records, "ts", held, "day")


def named_records(spark, root):
    """Orders with the customer's nation as body name, by day."""
    nations = load(spark, root, "nation")
    homes = load(spark, root, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    homes = homes.select(F.col("c_custkey").alias("o_custkey"), F.col("n_name").alias("body"))
    orders = load(spark, root, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    return orders.join(homes, "o_custkey").select("o_orderkey", "day", "body")


def named_meetings(spark, root):
    """Nations of suppliers shipping on a day, returns left out."""
    nations = load(spark, root, "nation")
    homes = load(spark, root, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    homes = homes.select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("body"))
    lines = load(spark, root, "lineitem").where(not_status(F.col("l_returnflag"), "R")).select("l_suppkey", F.to_date("l_shipdate").alias("day"))
    return lines.distinct().join(homes, "l_suppkey").select("day", "body").distinct()


@query("match_name", f"""
    WITH held AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day, n_name AS body FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
      JOIN nation ON n_nationkey = s_nationkey WHERE l_returnflag <> 'R'),
    asked AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, n_name AS body FROM orders JOIN customer ON c_custkey = o_custkey
      JOIN nation ON n_nationkey = c_nationkey),
    pairs AS (SELECT DISTINCT asked.body AS a, held.body AS b FROM asked JOIN held USING (day) WHERE asked.body <> held.body),
    {score_sql.names('pairs')},
    scored AS (SELECT a AS body, b, name_score FROM names UNION ALL SELECT DISTINCT body, body, 100.0::DOUBLE FROM held),
    best AS (SELECT day, body, ARG_MIN(b, (b <> body, -name_score, b)) AS matched_name, MIN((b <> body, -name_score)) AS rank
      FROM (SELECT DISTINCT day, body FROM asked) JOIN (SELECT day, body AS b FROM held) USING (day) JOIN scored USING (body, b) GROUP BY ALL)
    SELECT day, body, o_orderkey, matched_name, round(-rank[2], 6) AS score FROM asked JOIN best USING (day, body) WHERE -rank[2] >= 50""")
def match_name(spark, root):
    matched = ma.match_names(named_records(spark, root), named_meetings(spark, root), "day", "body")
    return matched.withColumn("score", F.round("score", 6))


@query("match_name_exact", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, n.n_name AS body FROM orders JOIN customer ON c_custkey = o_custkey
      JOIN nation AS n ON n.n_nationkey = c_nationkey WHERE EXISTS (
        SELECT 1 FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
        WHERE l_returnflag <> 'R' AND s_nationkey = c_nationkey AND CAST(l_shipdate AS DATE) = CAST(o_orderdate AS DATE))""")
def match_name_exact(spark, root):
    matched = ma.match_names(named_records(spark, root), named_meetings(spark, root), "day", "body")
    return matched.where("matched_name = body").select("o_orderkey", "day", "body")


def agendas(spark, root, role):
    return load(spark, root, "conversations").where(F.col("role") == role).select("conv_id", "turn", "text")


def _agenda_match(spark, root, *score):
    records = agendas(spark, root, "user").select("conv_id", "turn", F.lower("text").alias("agenda"))
    options = agendas(spark, root, "assistant").select("conv_id", F.col("turn").alias("option"), F.lower("text").alias("option_agenda"))
    found = ma.match_agendas(records, options, "conv_id", "agenda", "option", "option_agenda", *score)
    return found.select("conv_id", "turn", "match_id", F.round("score", 6).alias("score"), "n_candidates")


_AGENDAS = f"""
    asked AS (SELECT conv_id, turn, lower(text) AS a FROM conversations WHERE role = 'user'),
    options AS (SELECT conv_id, turn AS option, lower(text) AS b FROM conversations WHERE role = 'assistant'),
    pairs AS (SELECT * FROM asked JOIN options USING (conv_id)), {score_sql.token_sets('pairs')},
    counted AS (SELECT conv_id, turn, option, token_set, count(*) OVER (PARTITION BY conv_id, turn) AS n_candidates
      FROM pairs JOIN token_sets USING (a, b)),
    lone AS (SELECT *, CASE WHEN n_candidates = 1 THEN 100.0::DOUBLE ELSE token_set END AS score FROM counted)"""


@query("match_scores", f"""
    WITH {_AGENDAS} SELECT conv_id, turn, option, round(score, 6) AS score FROM lone""")
def match_scores(spark, root):
    """The score of every meeting that was a candidate for a record, not just of the best."""
    records = agendas(spark, root, "user").select("conv_id", "turn", F.lower("text").alias("agenda"))
    options = agendas(spark, root, "assistant").select("conv_id", F.col("turn").alias("option"), F.lower("text").alias("option_agenda"))
    scores = ma.all_scores(records, options, "conv_id", "agenda", "option", "option_agenda")
    return records.join(scores, ["conv_id", "agenda"]).select("conv_id", "turn", "option", F.round("score", 6).alias("score"))


@query("match_agenda", f"""
    WITH {_AGENDAS},
    best AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY score DESC, option) AS rn FROM lone)
    SELECT conv_id, turn, option AS match_id, round(score, 6) AS score, n_candidates FROM best WHERE rn = 1 AND score > 0""")
def match_agenda(spark, root):
    return _agenda_match(spark, root)


@query("match_agenda_jaccard", """
    WITH t AS (SELECT conv_id, turn, role, list_distinct(string_split_regex(trim(lower(text)), '\\s+')) AS ws FROM conversations),
    p AS (SELECT r.conv_id, r.turn, c.turn AS option, count(*) OVER (PARTITION BY r.conv_id, r.turn) AS n_candidates,
            len(list_intersect(r.ws, c.ws)) / len(list_distinct(list_concat(r.ws, c.ws))) AS score
          FROM t AS r JOIN t AS c ON r.conv_id = c.conv_id WHERE r.role = 'user' AND c.role = 'assistant'),
    b AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY score DESC, option) AS rn FROM p)
    SELECT conv_id, turn, option AS match_id, round(CASE WHEN n_candidates = 1 THEN 100.0::DOUBLE ELSE score END, 6) AS score, n_candidates
    FROM b WHERE rn = 1 AND (score > 0 OR n_candidates = 1)""")
def match_agenda_jaccard(spark, root):
    return _agenda_match(spark, root, JACCARD)


def landed(spark, root):
    """Pages as listing entries, eight a day, and the meetings they show."""
    day = F.date_add(F.lit("2000-01-01").cast("date"), F.floor(F.col("page_id") / 8).cast("int"))
    pages = listing_pages(spark, root, day)
    now = F.lit("2024-01-20 12:00:00").cast("timestamp")
    records = page_records(pages, now, ListingLayout(), _HOST, "https://cc.example.gov/", backfill=True)
    body = tx.clean_web_string(F.replace(page_title(), F.lit("&amp;"), F.lit("&")))
    words = F.regexp_extract_all("html", F.lit('<li><a href="/([^"]*)"'), 1)
    null = F.lit(None).cast("string")
    items = F.transform(
        words,
        lambda word, i: F.struct(
            (F.col("page_id") * 100_000 + i).alias("EventItemId"), (i + 1).alias("EventItemMinutesSequence"),
            word.alias("EventItemTitle"), null.alias("EventItemMatterName"), null.alias("EventItemMatterFile"),
            F.lit("Pass").alias("EventItemPassedFlagName"),
            F.lit(None).cast("array<struct<MatterAttachmentId: long, MatterAttachmentName: string, MatterAttachmentHyperlink: string>>").alias("EventItemMatterAttachments"),
            F.lit(None).cast("array<struct<VoteId: long, VotePersonId: long, VoteValueName: string, PersonInfo: struct<PersonId: long, PersonFullName: string, PersonEmail: string, PersonPhone: string, PersonWWW: string>>>").alias("EventItemVoteInfo"),
        ),
    )
    # Every meeting also has a cancelled double of the same name.
    held = F.explode(F.array(F.lit("Final"), F.lit("Cancelled"))).alias("status")
    meetings = load_wide(spark, root, "pages").select("*", held).select(
        (F.col("page_id") * 2 + F.when(F.col("status") == "Final", 1).otherwise(0)).alias("EventId"), body.alias("EventBodyName"),
        F.concat(day.cast("string"), F.lit("T00:00:00")).alias("EventDate"), F.lit("2:00 PM").alias("EventTime"),
        F.col("status").alias("EventAgendaStatusName"),
        null.alias("EventAgendaFile"), null.alias("EventMinutesFile"), F.col("url").alias("EventInSiteURL"),
        items.alias("EventItems"),
    )
    return written(records, "page-records"), meetings


def nothing_stored(spark):
    return spark.createDataFrame([], "video_uri string")


def gathered(spark, root):
    records, meetings = landed(spark, root)
    captioned = records.where("caption_uri is not null").select(
        "caption_uri", F.concat(F.lit("t:"), F.col("caption_uri")).alias("transcript_uri"), F.lit(0.97).alias("confidence")
    ).distinct()
    recognised = records.where("video_uri is not null").select(
        "video_uri", F.concat(F.lit("t:"), F.col("video_uri")).alias("transcript_uri"), F.lit(0.8).alias("confidence")
    ).distinct()
    return gather(records, meetings, nothing_stored(spark), captioned, recognised)


_GATHERED = f"""
    SELECT page_id, 'https://video.example.gov:8080/media/' || {_SQL_HOST} || page_id || '.mp4' AS video_uri,
      regexp_replace(regexp_replace(url, '/$', ''), '/?[^/]*$', '') || '/watch?id=' || page_id AS source_uri, body, words,
      min(page_id) OVER (PARTITION BY page_id // 8, body, words) * 2 + 1 AS legistar_event_id
    FROM (SELECT page_id, url, regexp_extract_all(html, '<li><a href="/([^"]*)"', 1) AS words,
            regexp_replace(regexp_replace(regexp_replace(replace({_SQL_TITLE}, '&amp;', '&'), '^ ', ''), ' $', ''), '\\.$', '') AS body
          FROM pages)"""


@query("gather_events", f"""
    SELECT {_key('event', 'video_uri')} AS event_id, {_key('body', 'body')} AS body_id, video_uri, source_uri, legistar_event_id
    FROM ({_GATHERED}) WHERE page_id % 5 <> 0""")
def gather_events(spark, root):
    return gathered(spark, root)["event"].select("event_id", "body_id", "video_uri", "source_uri", "legistar_event_id")


@query("gather_event_items", f"""
    SELECT {_key('event_minutes_item', 'event_id', 'item_id')} AS event_minutes_item_id, event_id, item_id AS minutes_item_id,
      CAST(min(i) AS INTEGER) AS "index", 'Pass' AS decision
    FROM (SELECT event_id, i, {_key('minutes_item', 'word')} AS item_id FROM (
      SELECT {_key('event', 'video_uri')} AS event_id, unnest(range(1, len(words) + 1)) AS i,
        unnest(list_transform(words, lambda w: replace(w, '_', ''))) AS word FROM ({_GATHERED}) WHERE page_id % 5 <> 0))
    GROUP BY event_id, item_id""")
def gather_event_items(spark, root):
    return gathered(spark, root)["event_minutes_item"].select("event_minutes_item_id", "event_id", "minutes_item_id", "index", "decision")


@query("gather_manifest", f"""
    SELECT {_key('event', 'video_uri')} AS event_id, {_key('body', 'body')} AS body_id, TRUE AS has_file
    FROM ({_GATHERED}) WHERE page_id % 5 <> 0""")
def gather_manifest(spark, root):
    """The manifest over what a gather has just stored: every event with a transcript and its file."""
    tables = gathered(spark, root)
    manifest = transcript_manifest(tables["event"], tables["transcript"], tables["file"], tables["body"])
    return manifest.select("event_id", "body_id", F.col("uri").isNotNull().alias("has_file"))


def speech(spark, root):
    """Conversations as the caption files of pages of the same number, documents as what a recogniser heard."""
    clock = F.date_format(F.timestamp_seconds(F.col("turn") * 5), "HH:mm:ss")
    text = F.trim(F.translate("text", "\n", " "))
    said = F.when(F.col("role") == "user", F.concat(F.lit("&gt;&gt; "), text)).otherwise(text)
    cue = F.struct("turn", F.concat(clock, F.lit(".000 --> "), clock, F.lit(".900\n"), said).alias("block"))
    blocks = F.array_sort(F.collect_list(cue)).block
    caption_files = load(spark, root, "conversations").groupBy("conv_id").agg(blocks.alias("blocks")).select(
        F.concat(F.lit("https://cc.example.gov//captions/"), F.col("conv_id").cast("string"), F.lit(".vtt")).alias("caption_uri"),
        F.concat(F.lit("WEBVTT\n\n"), F.array_join("blocks", "\n\n")).alias("content"),
    )
    hosts = load(spark, root, "pages").select(F.col("page_id").alias("doc_id"), F.regexp_extract("url", "//([a-z]+)", 1).alias("host"))
    video = F.concat(F.lit("https://video.example.gov:8080/media/"), "host", F.col("doc_id").cast("string"), F.lit(".mp4"))
    heard = load_wide(spark, root, "documents").select("doc_id", "text").join(hosts, "doc_id").select(video.alias("video_uri"), word_array().alias("words"))
    return Speech(
        caption_files, heard, CaptionTranscripts("caption_uri", "cue_idx", 0.97, "&gt;"), WordTranscripts("video_uri", "word", 0.8)
    )


_SPOKEN = f"""
    SELECT {_key('event', 'video_uri')} AS id, coalesce(c.text, w.text) AS text FROM ({_GATHERED}) AS g
    LEFT JOIN (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text FROM conversations WHERE conv_id % 3 <> 0 GROUP BY conv_id) AS c
      ON c.conv_id = g.page_id
    LEFT JOIN (SELECT doc_id, coalesce(closed, heard) AS text
               FROM (SELECT doc_id, string_agg(text, ' ' ORDER BY word) AS heard FROM ({WORDS}) GROUP BY doc_id)
               LEFT JOIN (SELECT doc_id, string_agg(text, ' ' ORDER BY first_word) AS closed FROM ({WORD_SENTENCES}) GROUP BY doc_id)
               USING (doc_id)) AS w ON w.doc_id = g.page_id
    WHERE page_id % 5 <> 0"""


@query("gather_to_index", INDEX_OF.format(terms=TERMS, name="event_id", corpus=_SPOKEN))
def gather_to_index(spark, root):
    """Pages to records, meetings, captions or words, transcripts, tables and the event index, in one plan."""
    records, meetings = landed(spark, root)
    indexer = TfidfIndexer("event_id", stemmed=False)
    done = gather_and_index(records, meetings, nothing_stored(spark), speech(spark, root), indexer=indexer)
    return done.index.withColumn("value", F.round("value", 6))
