import datetime as dt
import hashlib
import json
import time
import tracemalloc

import pytest
from pyspark.sql import functions as F

from quorumlake import schemas
from quorumlake.operators import store
from quorumlake.operators.meetings import (
    item_attachments, item_votes, meeting_items, normalize_meetings, star_tables,
)
from quorumlake.operators.index import TfidfIndexer
from quorumlake.plans.gather import Speech, attach_meetings, gather_and_index
from quorumlake.plans.indexing import event_index, item_index, transcript_texts
from quorumlake.plans.runs import RunLog
from quorumlake.plans.transcribe import CaptionTranscripts, WordTranscripts
from quorumlake.sources import captions, files, pages, tables, transcripts
from quorumlake.sources.meetings import read_meetings
from quorumlake.sources.typed_docs import decode
from quorumlake.streaming import jobs

VTT = """WEBVTT

00:00:13.213 --> 00:00:15.015 align:start line:84.66% size:80.00%
&gt;&gt; GOOD MORNING, <c>COUNCIL</c>.

note without times

2
00:15.100 --> 01:00:17.000
TWO LINES
OF TEXT """


def test_caption_files(spark, tmp_path):
    (tmp_path / "a.vtt").write_text(VTT)
    got = captions.cues(captions.read_caption_files(spark, str(tmp_path))).orderBy("cue_idx").collect()
    assert [(r.cue_idx, r.start_time, r.end_time, r.text) for r in got] == [
        (0, 13.213, 15.015, "&gt;&gt; GOOD MORNING, COUNCIL."), (1, 15.1, 3617.0, "TWO LINES\nOF TEXT "),
    ]


def portion(text):
    return {"start_time": 0, "text": text, "end_time": 1}


DOCS = {
    "raw.json": {"format": "raw", "annotations": [], "confidence": 1, "data": [portion("one two")]},
    "sentences.json": {"format": "timestamped-sentences", "annotations": [], "confidence": 0.5, "data": [portion("a."), portion("b.")]},
    "turns.json": {"format": "timestamped-speaker-turns", "annotations": [], "confidence": 0.9,
                   "data": [{"speaker": "", "data": [portion("x"), portion("y")]}, {"speaker": "s", "data": [portion("z")]}]},
}


def test_transcripts_round_trip(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for name, document in DOCS.items():
        (source / name).write_text(json.dumps(document, indent=1))
    read = transcripts.read_transcripts(spark, str(source))
    texts = {r.uri.split("/")[-1]: r.text for r in transcript_texts(read).collect()}
    assert texts == {"raw.json": "one two", "sentences.json": "a. b.", "turns.json": "x y z"}
    best = transcripts.preferred_format(read.withColumn("event", F.lit(1)), ["event"]).first()
    assert best.format == "timestamped-speaker-turns"
    transcripts.write_transcripts(read.drop("uri"), str(tmp_path / "out"))
    again = spark.read.schema(schemas.TRANSCRIPT_DDL).json(str(tmp_path / "out"))
    assert again.count() == 3 and {p.name for p in (tmp_path / "out").glob("format=*")} == {f"format={d['format']}" for d in DOCS.values()}
    (source / "bad.json").write_text(json.dumps({"format": "invalid", "data": []}))
    with pytest.raises(Exception, match="unknown transcript format: invalid"):
        transcript_texts(transcripts.read_transcripts(spark, str(source))).collect()


def test_typed_documents(spark):
    fields = {"a": {"stringValue": "x"}, "n": {"integerValue": "12"}, "d": {"doubleValue": 0.2}, "t": {"timestampValue": "2020-01-02T03:04:05Z"},
              "u": {"timestampValue": "2020-01-02T03:04:05.120000Z"}, "b": {"booleanValue": True}, "z": {"nullValue": None}}
    frame = spark.createDataFrame([("p/d/event/abc", json.dumps(fields))], "name string, fields string")
    row = decode(frame, "event_id", {"a": "string", "n": "long", "d": "double", "t": "timestamp", "u": "timestamp", "b": "boolean", "z": "string"}).first()
    assert (row.event_id, row.a, row.n, row.d, row.b, row.z) == ("abc", "x", 12, 0.2, True, None)
    assert row.t == dt.datetime(2020, 1, 2, 3, 4, 5) and row.u.microsecond == 120000


ENTRY = """<div class="row borderBottomNone paginationItem"><div class="col-xs-12 col-sm-4 col-md-3">
<a href="/testing?videoid=x1" onclick="load('http://{host}:8080/media/a b_032919.mp4','/captions/2019/a_1.vtt')"><img src="i.jpg"></a></div>
<div class="col-xs-12 col-sm-8 col-md-9"><h2><a>Parks &amp; Levy - Special Meeting</a></h2><div class="videoDate">{date}</div>
<div class="titleExcerptText"><p>Agenda: Public Comment; CB 999999.</p><p></p></div></div></div>"""
SINGLE = """<html><div id="mainContent"><script>play("{host}/media/x.flv", "cc/2019/x.vtt")</script></div>
<div class="programDescription col-xs-12 col-sm-4"><div class="episodeTitle">Council 12/4/19</div>
<div class="episodeDate">12/4/2019<span>more</span></div><div class="episodeDescription">One, Two.</div></div></html>"""
NOW = dt.datetime(2019, 12, 6)
HOST = r"video\.x\.gov[:0-9]*"


def test_listing_and_single_pages(spark):
    listing = "<html><p>open" + "".join(
        ENTRY.format(host=h, date=d) for h, d in [("video.x.gov", "12/4/2019"), ("video.x.gov", "1/4/2019"), ("elsewhere.gov", "12/4/2019")]
    )
    html = spark.createDataFrame([("http://c.gov/Council", listing)], "url string, html string")
    got = pages.page_records(html, F.lit(NOW), pages.ListingLayout(), HOST, "https://cc.gov/").orderBy("position").collect()
    assert [r.status for r in got] == ["parsed", "out-of-bounds", "unparseable"]
    first = got[0]
    assert (first.body, first.minutes_items) == ("Parks & Levy", ["Public Comment", "CB 999999"])
    assert first.video_uri == "https://video.x.gov:8080/media/ab_032919.mp4"
    assert first.caption_uri == "https://cc.gov//captions/2019/a_1.vtt"
    assert first.source_uri == "http://c.gov/testing?videoid=x1"
    counts = pages.outcome_counts(pages.page_records(html, F.lit(NOW), pages.ListingLayout(), HOST, ""), "url").first()
    assert (counts.success, counts.warning, counts.error) == (1, 1, 1)
    backfill = pages.page_records(html, F.lit(NOW), pages.ListingLayout(), HOST, "", backfill=True)
    assert backfill.where("status = 'parsed'").count() == 2

    single = spark.createDataFrame([("http://c.gov/?id=1", SINGLE.format(host="video.x.gov"))], "url string, html string")
    row = pages.page_records(single, F.lit(NOW), pages.SingleLayout(), HOST, "https://cc.gov/").first()
    assert (row.status, row.body, row.minutes_items) == ("parsed", "Council", ["One", "Two"])
    assert (row.video_uri, row.caption_uri) == ("https://video.x.gov/media/x.flv", "https://cc.gov/cc/2019/x.vtt")
    assert row.event_datetime == dt.datetime(2019, 12, 4)


def item(key, **values):
    base = {"EventItemId": key, "EventItemMinutesSequence": None, "EventItemTitle": None, "EventItemMatterName": None, "EventItemMatterFile": None,
            "EventItemPassedFlagName": None, "EventItemMatterAttachments": [], "EventItemVoteInfo": []}
    return base | values


PERSON = {"PersonId": 9, "PersonFullName": "A B", "PersonEmail": None, "PersonPhone": "1", "PersonWWW": "w"}
MEETING = {
    "EventId": 1, "EventBodyName": "Council", "EventDate": "2019-12-04T00:00:00", "EventTime": "1:30 PM", "EventAgendaStatusName": "Final",
    "EventAgendaFile": "f", "EventMinutesFile": None, "EventInSiteURL": "http://m/1",
    "EventItems": [
        item(11, EventItemMinutesSequence=3, EventItemTitle="Long\r\n__ title", EventItemMatterFile="CB 1", EventItemPassedFlagName="Pass",
             EventItemMatterAttachments=[{"MatterAttachmentId": 5, "MatterAttachmentName": "a_b", "MatterAttachmentHyperlink": "http://f/5"}],
             EventItemVoteInfo=[{"VoteId": 7, "VotePersonId": 9, "VoteValueName": "In Favor", "PersonInfo": PERSON}]),
        item(12, EventItemMinutesSequence=1, EventItemMatterName="Matter", EventItemMatterFile="CB 2", EventItemPassedFlagName="Pass"),
        item(13, EventItemMatterFile="CB 3", EventItemVoteInfo=[{"VoteId": 8, "VotePersonId": 9, "VoteValueName": "Opposed", "PersonInfo": PERSON}]),
        item(14, EventItemMinutesSequence=2, EventItemTitle="Adjournment"),
    ],
}


@pytest.fixture()
def meetings(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps([MEETING], indent=1))
    return read_meetings(spark, str(tmp_path / "m.json"))


def test_meeting_document(meetings):
    normalized = normalize_meetings(meetings, ["Adjournment", None])
    row = normalized.first()
    assert row.event_datetime == dt.datetime(2019, 12, 4, 13, 30)
    assert [(i["index"], i["name"], i["matter"], i["decision"]) for i in row.minutes_items] == [
        (-1, "CB 3", "CB 3", None), (1, "Matter", "Matter", "Pass"), (3, "Long title", "CB 1", "Pass"),
    ]
    items = meeting_items(normalized)
    assert [tuple(r)[3:] for r in item_attachments(items).collect()] == [("ab", "http://f/5", 5)]
    votes = item_votes(items).collect()
    assert [(v.legistar_event_item_vote_id, v.decision, v.full_name, v.email) for v in votes] == [(7, "In Favor", "A B", None)]


def test_star_tables_link_up_and_store(spark, meetings, tmp_path):
    gathered = normalize_meetings(meetings).withColumns(
        {"source_uri": F.lit("s"), "video_uri": F.lit("v"), "transcript_uri": F.lit("t"), "confidence": F.lit(0.97)}
    )
    root = str(tmp_path / "db")
    for name, frame in star_tables(gathered).items():
        tables.write_table(frame, root, name)
    stored = {n: tables.read_table(spark, root, n) for n in ("event", "body", "minutes_item", "event_minutes_item", "person", "vote", "minutes_item_file", "transcript")}
    assert {n: f.count() for n, f in stored.items()} == {
        "event": 1, "body": 1, "minutes_item": 4, "event_minutes_item": 4, "person": 1, "vote": 1, "minutes_item_file": 1, "transcript": 1}
    linked = (stored["vote"].join(stored["person"], "person_id").join(stored["event_minutes_item"], "event_minutes_item_id")
              .join(stored["event"], "event_id").join(stored["body"], "body_id"))
    assert linked.count() == 1
    tables.clone_tables(spark, root, str(tmp_path / "copy"), ["event", "body"])
    copied = tables.read_table(spark, str(tmp_path / "copy"), "event").join(tables.read_table(spark, str(tmp_path / "copy"), "body"), "body_id")
    assert copied.count() == 1
    tables.wipe_table(spark, str(tmp_path / "copy"), "event")
    assert tables.read_table(spark, str(tmp_path / "copy"), "event").count() == 0


def test_attach_meetings(spark, tmp_path):
    def held(key, date, body, status="Final", title="x"):
        return MEETING | {"EventId": key, "EventDate": f"{date}T00:00:00", "EventBodyName": body, "EventAgendaStatusName": status,
                          "EventItems": [item(key, EventItemTitle=title)]}

    documents = [
        held(1, "2020-01-01", "Other body", "Cancelled"),
        held(2, "2020-01-02", "Parks", title="trees"), held(3, "2020-01-02", "Parks", title="levy budget"), held(4, "2020-01-02", "Finance"),
        held(5, "2020-01-03", "Parks", "Cancelled"), held(6, "2020-01-03", "qqqq zzzz"),
    ]
    (tmp_path / "m.json").write_text(json.dumps(documents))
    records = spark.createDataFrame(
        [(f"s{d}", f"v{d}", None, "Parks", dt.datetime(2020, 1, d), ["Levy Budget"]) for d in (1, 2, 3, 4)],
        "source_uri string, video_uri string, caption_uri string, body string, event_datetime timestamp, minutes_items array<string>",
    )
    got = attach_meetings(records, read_meetings(spark, str(tmp_path / "m.json")))
    # Day 1 has one meeting, day 2 goes by agenda, day 3 has no name near enough, day 4 has no meeting.
    assert {(r.source_uri, r.legistar_event_id) for r in got.collect()} == {("s1", 1), ("s2", 3)}
    strict = attach_meetings(records, read_meetings(spark, str(tmp_path / "m.json")), single_candidate_shortcut=False)
    assert {r.source_uri for r in strict.collect()} == {"s2"}


def test_index_builds(spark):
    events = spark.createDataFrame([("e1", "b"), ("e2", "b"), ("e3", "b")], "event_id string, body_id string")
    spoken = spark.createDataFrame(
        [("t1", "e1", "f1", 0.5, 2), ("t2", "e1", "f2", 0.9, 1), ("t3", "e2", "f3", 0.9, 1)],
        "transcript_id string, event_id string, file_id string, confidence double, created int",
    )
    stored = spark.createDataFrame([(f"f{i}", f"u{i}") for i in (1, 2, 3)], "file_id string, uri string")
    texts = spark.createDataFrame([("u1", "latest words"), ("u2", "confident words"), ("u3", "other words")], "uri string, text string")
    bodies = spark.createDataFrame([("b", "Council")], "body_id string, name string")
    got = {(r.term, r.event_id) for r in event_index(events, spoken, stored, bodies, texts).collect()}
    # The confident transcript is taken; "words" is in both events and drops out, "other" is a stop word.
    assert got == {("confid", "e1")}
    decided = spark.createDataFrame([("e1", "i1", "Pass"), ("e2", "i2", "Pass"), ("e2", "i3", ""), ("e3", "i4", "Pass")],
                                    "event_id string, minutes_item_id string, decision string")
    items = spark.createDataFrame([(f"i{n}", f"n{n}") for n in range(1, 5)], "minutes_item_id string, name string")
    attached = spark.createDataFrame([("i1", "a1", "annex annex"), ("i3", "a3", "undecided")], "minutes_item_id string, uri string, text string")
    got = {(r.term, r.minutes_item_id): round(r.value, 6) for r in item_index(decided, items, spoken, stored, texts, attached).collect()}
    assert got == {("latest", "i1"): 0.693147, ("annex", "i1"): 1.386294}


def test_attachments_and_inventory(spark, tmp_path):
    wanted = spark.createDataFrame([("i1", "a"), ("i1", "b"), ("i2", "c")], "minutes_item_id string, uri string")
    extracted = spark.createDataFrame([("a", "text"), ("b", "")], "uri string, content string")
    assert [tuple(r) for r in files.attachment_texts(wanted, extracted).collect()] == [("i1", "a", "text")]
    (tmp_path / "x.txt").write_text("abc")
    row = files.digests(spark, str(tmp_path)).first()
    assert row.sha256 == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    assert files.inventory(spark, str(tmp_path)).select("name", "length").first() == ("x.txt", 3)


def test_digest_of_a_file_beyond_a_row(spark, tmp_path):
    """2.2 GB, most of it a hole; names with blanks and signs; files without bytes are not listed."""
    large = tmp_path / "a file + 100%.bin"
    with large.open("wb") as f:
        f.truncate(2_200_000_000)
        f.seek(0)
        f.write(b"start")
    (tmp_path / "empty").write_bytes(b"")
    (tmp_path / "packed.gz").write_bytes(b"\x1f\x8b not unpacked")
    expected = hashlib.sha256(b"start")
    for _ in range(2_199_999_995 // 5_000_000):
        expected.update(bytes(5_000_000))
    expected.update(bytes(2_199_999_995 % 5_000_000))
    got = {r.path.split("/")[-1]: (r.length, r.sha256) for r in files.digests(spark, str(tmp_path)).collect()}
    assert sorted(got.values()) == sorted([
        (2_200_000_000, expected.hexdigest()),
        (15, hashlib.sha256(b"\x1f\x8b not unpacked").hexdigest()),
    ])
    assert files.inventory(spark, str(tmp_path)).count() == 2 and files.block_digest(str(tmp_path / "empty")) == hashlib.sha256().hexdigest()
    tracemalloc.start()
    files.block_digest(str(large))
    assert tracemalloc.get_traced_memory()[1] < 50_000_000
    tracemalloc.stop()


def test_run_log(spark, tmp_path):
    root = str(tmp_path)
    with RunLog(spark, root, "job", "1.0", inputs=("hello", 0, None)) as run:
        run.input_files.append("http://f/1")
        run.add_output(2.5)
    with pytest.raises(RuntimeError):
        with RunLog(spark, root, "job", "1.0"):
            raise RuntimeError("broken")
    assert tables.read_table(spark, root, "run").count() == 2
    assert {(r.dtype, r.value) for r in tables.read_table(spark, root, "run_input").collect()} == {("str", "hello"), ("int", "0")}
    assert {(r.dtype, r.value) for r in tables.read_table(spark, root, "run_output").collect()} == {("float", "2.5"), ("RuntimeError", "broken")}
    assert tables.read_table(spark, root, "run_input_file").count() == 1
    assert tables.read_table(spark, root, "algorithm").count() == tables.read_table(spark, root, "file").count() == 1


def test_catalogue():
    assert {"event", "vote", "indexed_event_term"} <= set(schemas.table_names())
    assert schemas.TABLES["person"].key == ("full_name", "email")
    assert schemas.TABLES["event"].id_column == "event_id"


def test_stream_inserts_once_over_batches(spark, small, tmp_path):
    """Many small files, then the same files again: every key is stored once."""
    events = spark.read.parquet(f"{small}/events.parquet").select("user_id", "event_type", "event_id", "ts")
    for n in range(2):
        events.repartition(5).write.mode("append").parquet(str(tmp_path / "in"))
        stream = jobs.file_stream(spark, str(tmp_path / "in"), events.schema, files_per_batch=2)
        jobs.insert_new(stream, ["user_id", "event_type"], ["ts"], str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "out")).select("user_id", "event_type")
    assert stored.count() == stored.distinct().count() == events.select("user_id", "event_type").distinct().count()


def test_remembered_keys_equal_the_batch_over_restarts(spark, tmp_path):
    """Copies within a batch, in a later batch, after a restart, and records older than all before."""
    rows = [(k % 40, k, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=(k * 37) % 4000)) for k in range(120)]
    frame = spark.createDataFrame(rows, "key int, n int, ts timestamp")
    deliveries = [frame.where("n < 50"), frame.where("n >= 30 AND n < 90"), frame.where("n < 20").union(frame.where("n >= 80"))]
    source, target, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))
    for delivery in deliveries:
        delivery.repartition(3).write.mode("append").parquet(source)
        stream = jobs.file_stream(spark, source, frame.schema, files_per_batch=1)
        query = jobs.insert_new(stream, ["key"], ["n"], target, checkpoint, remember="10 minutes")
        query.awaitTermination()
        # keys that the state knows never reach the table again
        assert any(p["stateOperators"] and p["stateOperators"][0]["numRowsTotal"] > 0 for p in map(lambda x: json.loads(x.json), query.recentProgress))
    stored = spark.read.schema(frame.schema).parquet(target)
    assert sorted(r["key"] for r in stored.collect()) == list(range(40))
    again = jobs.insert_new(jobs.file_stream(spark, source, frame.schema), ["key"], ["n"], target, str(tmp_path / "cp2"), remember="1 hour")
    again.awaitTermination()
    assert spark.read.parquet(target).count() == 40


def test_a_job_on_a_timer_takes_what_arrives_between_its_runs(spark, tmp_path):
    frame = spark.range(6).selectExpr("CAST(id AS INT) AS key", "CAST(id AS INT) AS n")
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    frame.where("key < 3").coalesce(1).write.parquet(source)
    query = jobs.insert_new(jobs.file_stream(spark, source, frame.schema), ["key"], ["n"], target, str(tmp_path / "cp"), minutes=1 / 60)

    def waits_for(count: int) -> bool:
        end = time.monotonic() + 60
        while time.monotonic() < end:
            if spark.read.schema(frame.schema).parquet(target).count() == count:
                return True
            time.sleep(0.2)
        return False

    try:
        assert waits_for(3) and query.isActive
        frame.coalesce(1).write.mode("append").parquet(source)
        assert waits_for(6) and query.isActive
        assert len({p["batchId"] for p in map(lambda x: json.loads(x.json), query.recentProgress) if p["numInputRows"]}) == 2
    finally:
        query.stop()
    assert not query.isActive


def test_inserts_read_only_the_buckets_of_their_keys(spark, tmp_path):
    root = str(tmp_path / "db")
    people = spark.range(400).selectExpr("CAST(id AS STRING) AS full_name", "CAST(NULL AS STRING) AS email", "'1' AS phone")
    tables.create_tables(spark, root, ["person"])
    tables.insert_rows(spark, root, "person", people)
    assert tables.read_table(spark, root, "person").count() == 400
    batch = people.where("full_name IN ('7', '8')").union(spark.sql("SELECT 'new', NULL, '2'"))
    touched = store.touched_buckets(batch, ("full_name", "email"))
    assert 1 <= len(touched) <= 3
    part = tables.read_table(spark, root, "person", touched)
    assert 2 <= part.count() < 40
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [key_bucket" in plan
    read = {r[0].split("key_bucket=")[1][:2] for r in part.select(F.input_file_name()).collect()}
    assert read and read <= set(touched)
    tables.insert_rows(spark, root, "person", batch)
    assert tables.read_table(spark, root, "person").count() == 401


def test_stream_index_equals_batch(spark, small, tmp_path):
    """Parts spread over batches; some come again unchanged, some replaced by a later delivery."""
    from quorumlake.operators import index as ix

    docs = spark.read.parquet(f"{small}/documents.parquet")
    docs = docs.select(F.col("source").alias("doc_id"), F.col("doc_id").alias("part"), "text")
    old = docs.withColumn("text", F.when(F.col("part") % 5 == 0, "an earlier wording").otherwise(F.col("text")))
    deliveries = [old.where("part % 2 = 0"), old.where("part % 2 = 1"), docs.where("part % 3 = 0"), docs.where("part % 5 = 0")]
    deliveries += [deliveries[2].union(deliveries[2])]
    for k, delivery in enumerate(deliveries):
        delivery.coalesce(1).write.parquet(str(tmp_path / f"in{k}"))
        stream = jobs.file_stream(spark, str(tmp_path / "in*"), docs.schema, files_per_batch=1)
        jobs.count_terms(stream, "doc_id", str(tmp_path / "counts"), str(tmp_path / "cp")).awaitTermination()
    counts = spark.read.parquet(str(tmp_path / "counts"))
    streamed = ix.tfidf(ix.latest_counts(counts, "doc_id", "part"), "doc_id")
    batch = ix.tfidf(ix.term_counts(docs, "doc_id"), "doc_id")
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_live_index_follows_deliveries(spark, tmp_path):
    """After each delivery the index equals one built anew from the latest parts; a part that comes again as it was changes nothing."""
    from quorumlake.operators import index as ix
    from quorumlake.streaming.live_index import keep_index, live_index

    ddl, table = "doc_id long, part int, text string", str(tmp_path / "live")
    deliveries = [
        [(1, 0, "trees bikes"), (1, 1, "budget"), (2, 0, "trees trees"), (3, 0, "parks"), (None, 0, "lost"), (7, None, "lost")],
        [(1, 1, "bikes parks"), (3, 0, None), (4, 0, "trees budget parks")],
        [(2, 0, "of"), (3, 0, "parks again"), (3, 0, "again"), (4, 0, "trees budget parks")],
        [],
    ]
    latest = {}
    for k, rows in enumerate(deliveries):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(str(tmp_path / f"in{k}"))
        stream = jobs.file_stream(spark, str(tmp_path / "in*"), ddl, files_per_batch=1)
        keep_index(stream, "doc_id", table, str(tmp_path / "cp"), stemmed=False).awaitTermination()
        for doc, part, text in sorted((r for r in rows if None not in r[:2]), key=lambda r: r[2] or ""):
            latest[doc, part] = text
        docs = spark.createDataFrame([(d, t) for (d, _), t in latest.items()], "doc_id long, text string")
        anew = {(r.term, r.doc_id): round(r.value, 9) for r in ix.tfidf(ix.term_counts(docs, "doc_id", stemmed=False), "doc_id").collect()}
        live = live_index(spark, table, "doc_id long, part int")
        assert {(r.term, r.doc_id): round(r.value, 9) for r in live.collect()} == anew
        some = live_index(spark, table, "doc_id long, part int", ["trees", "absent"])
        assert {(r.term, r.doc_id) for r in some.collect()} == {key for key in anew if key[0] == "trees"}
    plan = spark.read.schema("term string, change long, batch long").parquet(f"{table}/changes").where("batch = 1")
    # delivery 1: document 3 goes and 4 comes, so the number of documents stands; of "parks" one goes and two come
    assert {r.term: r.change for r in plan.collect()} == {"parks": 1, "trees": 1}


def test_live_index_keeps_one_row_for_each_delivered_part(spark, tmp_path):
    """Parts are stored and moved as rows of their own, not as rows of terms; stems are kept the same way."""
    from quorumlake.operators import index as ix
    from quorumlake.streaming.live_index import keep_index, live_index

    ddl = "doc_id long, part int, text string"
    rows = [(1, 0, "running bikes run"), (1, 1, "bike"), (2, 0, "budget budgets"), (3, 0, None)]
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(str(tmp_path / "in"))
    docs = spark.createDataFrame([(d, t) for d, _, t in rows], "doc_id long, text string")
    for stemmed in (False, True):
        table = str(tmp_path / f"live-{stemmed}")
        stream = jobs.file_stream(spark, str(tmp_path / "in"), ddl)
        keep_index(stream, "doc_id", table, str(tmp_path / f"cp-{stemmed}"), stemmed=stemmed).awaitTermination()
        assert spark.read.parquet(f"{table}/counts").count() == len(rows)
        got = live_index(spark, table, "doc_id long, part int").select("doc_id", "term", F.round("value", 9)).collect()
        anew = ix.tfidf(ix.term_counts(docs, "doc_id", stemmed=stemmed), "doc_id").select("doc_id", "term", F.round("value", 9))
        assert sorted(map(tuple, got)) == sorted(map(tuple, anew.collect()))


@pytest.mark.parametrize("document", ['{"format": "raw"}', '{"format": "raw", "data": [{"start_time": 1.0}]}', '{"format": "other", "data": []}'])
def test_malformed_transcripts_raise(spark, tmp_path, document):
    from quorumlake.plans.indexing import transcript_texts

    (tmp_path / "t.json").write_text(document)
    with pytest.raises(Exception, match="transcript"):
        transcript_texts(transcripts.read_transcripts(spark, str(tmp_path))).collect()


def test_stored_rows(spark, tmp_path):
    root = str(tmp_path / "db")
    tables.create_tables(spark, root)
    batch = spark.createDataFrame([("A B", None, "1"), ("A B", None, "2"), ("C", "c@x", None)], "full_name string, email string, phone string")
    for _ in range(2):
        tables.insert_rows(spark, root, "person", batch, F.col("phone"))
        tables.create_tables(spark, root)
    stored = tables.read_table(spark, root, "person")
    assert {(r.full_name, r.email, r.phone) for r in stored.collect()} == {("A B", None, "1"), ("C", "c@x", None)}
    assert stored.where("person_id is null or created is null").isEmpty()
    tables.write_table(stored, root, "person")
    with pytest.raises(Exception, match="person has 2 rows"):
        tables.insert_rows(spark, root, "person", batch)

    first = spark.createDataFrame([("levy", "e1", 1.0), ("park", "e1", 2.0)], "term string, event_id string, value double")
    tables.upsert_rows(spark, root, "indexed_event_term", first, str(tmp_path / "v1"))
    second = spark.createDataFrame([("levy", "e1", 5.0), ("bike", "e2", 3.0)], first.schema)
    tables.upsert_rows(spark, str(tmp_path / "v1"), "indexed_event_term", second, str(tmp_path / "v2"))
    got = tables.read_table(spark, str(tmp_path / "v2"), "indexed_event_term").collect()
    assert {(r.term, r.event_id): r.value for r in got} == {("levy", "e1"): 5.0, ("park", "e1"): 2.0, ("bike", "e2"): 3.0}
    assert len({r.indexed_event_term_id for r in got}) == 3


def test_star_load_twice_adds_nothing(spark, meetings, tmp_path):
    gathered = normalize_meetings(meetings).withColumns(
        {"source_uri": F.lit("s"), "video_uri": F.lit("v"), "transcript_uri": F.lit("t"), "confidence": F.lit(0.97)}
    )
    root = str(tmp_path / "db")
    tables.create_tables(spark, root)
    counts = []
    for _ in range(2):
        tables.insert_star(spark, root, star_tables(gathered))
        counts.append({n: tables.read_table(spark, root, n).count() for n in star_tables(gathered)})
    assert counts[0] == counts[1] and counts[0]["minutes_item"] == 4


def test_gather_to_index(spark):
    vtt = "WEBVTT\n\n00:00:01.000 --> 00:00:02.000\n&gt;&gt; Budget of\n\n00:00:03.000 --> 00:00:04.000\nbikes.\n\n00:00:05.000 --> 00:00:06.000\n&gt;&gt; Open tail"
    day = dt.datetime(2024, 1, 2)
    record = "source_uri string, video_uri string, caption_uri string, body string, event_datetime timestamp, minutes_items array<string>, status string"
    rows = [
        ("s1", "v1", "c1", "Council", day, ["a"], "parsed"),
        ("s2", "v2", "c2", "Parks", day + dt.timedelta(1), ["b"], "parsed"),  # caption file without a cue
        ("s3", "v3", None, "Arts", day + dt.timedelta(2), ["c"], "parsed"),
        ("s4", "v4", None, "Mute", day + dt.timedelta(3), ["d"], "parsed"),  # neither captions nor words
        ("s5", "v5", "c1", "Late", day + dt.timedelta(4), ["e"], "unparseable"),
        ("s6", "v6", "c1", "Known", day + dt.timedelta(5), ["f"], "parsed"),
    ]
    empty = {f: None for f in ("EventAgendaFile", "EventMinutesFile", "EventInSiteURL")}
    held = [
        {"EventId": n, "EventBodyName": r[3], "EventDate": r[4].strftime("%Y-%m-%dT00:00:00"), "EventTime": "9:30 AM",
         "EventAgendaStatusName": "Final", "EventItems": [], **empty}
        for n, r in enumerate(rows)
    ]
    meetings = spark.createDataFrame(held, schemas.MEETING_DDL)
    files_landed = spark.createDataFrame([("c1", vtt), ("c1", ""), ("c2", "WEBVTT\n"), ("c9", vtt)], "caption_uri string, content string")
    said = [("v1", 0, "unheard."), ("v2", 0, "Trees"), ("v2", 1, "grow."), ("v2", 2, "cut"), ("v3", 0, "painting"), ("v9", 0, "other.")]
    heard = spark.createDataFrame([(v, i, t, i + 0.0, i + 0.5) for v, i, t in said], "video_uri string, word long, text string, start_time double, end_time double")
    speech = Speech(files_landed, heard, CaptionTranscripts("caption_uri", "cue_idx", 0.97, "&gt;"), WordTranscripts("video_uri", "word", 0.8))
    stored = spark.createDataFrame([("v6",)], "video_uri string")
    done = gather_and_index(spark.createDataFrame(rows, record), meetings, stored, speech, indexer=TfidfIndexer("event_id", stemmed=False))
    videos = {r.event_id: r.video_uri for r in done.tables["event"].collect()}
    assert sorted(videos.values()) == ["v1", "v2", "v3"]
    assert sorted(r.confidence for r in done.tables["transcript"].collect()) == [0.8, 0.8, 0.97]
    formats = sorted((r.format, r.part) for r in done.documents.collect())
    assert formats == [("timestamped-sentences", 0), ("timestamped-speaker-turns", 0), ("timestamped-words", 0)]
    terms = {(videos[r.event_id], r.term) for r in done.index.collect()}
    assert terms == {("v1", t) for t in ("budget", "bikes", "open", "tail")} | {("v2", "trees"), ("v2", "grow"), ("v3", "painting")}
    assert {r.uri for r in done.tables["file"].collect()} == {r.uri for r in done.documents.collect()}


def test_transcripts_of_several_parts(spark):
    """A file of 25,000 sentences keeps them all, in order, in its best format."""
    lines = spark.range(25_000).select(F.lit("f").alias("file"), F.col("id").alias("line"), F.concat(F.lit("line "), F.col("id").cast("string"), F.lit(".")).alias("text"))
    pieces = lines.selectExpr("file", "line", "line % 40 = 0 AS starts_turn", "text", "line * 2.0D AS start_time", "line * 2.0D + 1 AS end_time")
    documents = CaptionTranscripts("file", "line", 0.9).transcripts(pieces)
    kept = transcripts.preferred_format(documents, ["file"])
    assert sorted((r.format, r.part) for r in kept.select("format", "part").collect()) == [("timestamped-speaker-turns", n) for n in range(3)]
    whole = transcripts.in_one(kept, ["file"]).select("file", "confidence", transcripts.raw_text(F.col("format"), F.col("data")).alias("text"), F.col("data")[0].start_time.alias("a"), F.element_at("data", -1).end_time.alias("b")).collect()
    assert len(whole) == 1 and whole[0].confidence == 0.9 and (whole[0].a, whole[0].b) == (0.0, 49_999.0)
    assert whole[0].text == " ".join(f"line {n}." for n in range(25_000))
    again = transcripts.preferred_format(kept.where("part = 7"), ["file"])
    assert again.count() == 0


def test_rows_stored_as_files_lie_in_a_bounded_number_of_folders(spark, tmp_path):
    texts = [(f"page_id={i % 290}", f"text {i}" if i else None) for i in range(300)]
    rows = spark.createDataFrame(texts, "name string, html string").repartition(3)
    files.store_files(rows, str(tmp_path / "stored"), "name", "html")
    assert len(list((tmp_path / "stored").iterdir())) <= files.FOLDERS
    found = sorted(r.sha256 for r in files.digests(spark, str(tmp_path / "stored")).collect())
    assert found == sorted(hashlib.sha256(((t or "") + "\n").encode()).hexdigest() for _, t in texts)
