"""Stored tables: joins, manifests, keyed writes. Customers stand for events,
orders for transcripts, regions for files, nations for bodies; suppliers, parts
and line items for persons, agenda items and votes."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..operators import manifest as mf
from ..operators import store as st
from ..operators.index import TfidfIndexer
from ..operators.spread import best_per_key
from ..plans.indexing import event_index, item_index
from ..plans.runs import RunLog
from ..session import work_path
from ..sources.files import digests, inventory, missing_files, store_files
from ..sources.tables import clone_tables, read_table, write_table
from .registry import load, load_wide, query
from .texts import TERMS


def events(spark, root):
    return load(spark, root, "customer").select(
        F.col("c_custkey").alias("event_id"), F.col("c_nationkey").alias("body_id"), F.col("c_name").alias("video_uri")
    )


def transcripts(spark, root):
    return load(spark, root, "orders").select(
        F.col("o_orderkey").alias("transcript_id"), F.col("o_custkey").alias("event_id"),
        (F.col("o_orderkey") % 5).cast("int").alias("file_id"),
        F.col("o_totalprice").alias("confidence"), F.col("o_orderdate").alias("created"),
    )


def files(spark, root):
    return load(spark, root, "region").select(F.col("r_regionkey").alias("file_id"), F.col("r_name").alias("uri"))


def bodies(spark, root):
    return load(spark, root, "nation").select(F.col("n_nationkey").alias("body_id"), F.col("n_name").alias("name"))


_BEST = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY {0} DESC, o_orderkey) AS rn
             FROM orders) WHERE rn = 1"""
_BEST_CONFIDENCE = _BEST.format("o_totalprice")
_BEST_CREATED = _BEST.format("o_orderdate")


@query("best_per_key", f"SELECT o_custkey, o_orderkey, o_totalprice FROM ({_BEST_CONFIDENCE})")
def best_per_key_query(spark, root):
    best = mf.best_transcripts(transcripts(spark, root))
    return best.select(
        F.col("event_id").alias("o_custkey"), F.col("transcript_id").alias("o_orderkey"),
        F.col("confidence").alias("o_totalprice"),
    )


_MANIFEST_SQL = """SELECT c_custkey AS event_id, c_nationkey AS body_id, c_name AS video_uri, o_orderkey AS transcript_id,
      CAST(o_orderkey % 5 AS INTEGER) AS file_id, o_totalprice AS confidence, o_orderdate AS transcript_created,
      r_name AS uri, n_name AS body_name
    FROM customer JOIN ({0}) ON o_custkey = c_custkey JOIN region ON r_regionkey = o_orderkey % 5
      JOIN nation ON n_nationkey = c_nationkey"""


@query("transcript_manifest", _MANIFEST_SQL.format(_BEST_CONFIDENCE))
def transcript_manifest(spark, root):
    return mf.transcript_manifest(
        events(spark, root), transcripts(spark, root), files(spark, root), bodies(spark, root)
    )


@query("manifest_corpus", f"SELECT event_id, uri FROM ({_MANIFEST_SQL.format(_BEST_CREATED)})")
def manifest_corpus(spark, root):
    manifest = mf.transcript_manifest(
        events(spark, root), transcripts(spark, root), files(spark, root), bodies(spark, root), "created"
    )
    path = work_path(spark, "manifest")
    mf.write_manifest(manifest, path)
    schema = ", ".join(f"{name} {dtype}" for name, dtype in manifest.dtypes)
    return mf.manifest_corpus(spark.read.schema(schema).option("header", True).csv(path))


@query("events_with_transcript", "SELECT c_custkey AS event_id, c_name AS video_uri FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def events_with_transcript(spark, root):
    return mf.events_with_transcript(events(spark, root), transcripts(spark, root)).select("event_id", "video_uri")


@query("expand_event_body", "SELECT c_custkey AS event_id, c_name AS video_uri, n_name AS body_name FROM customer JOIN nation ON n_nationkey = c_nationkey")
def expand_event_body(spark, root):
    return mf.expand_events(events(spark, root), bodies(spark, root)).select("event_id", "video_uri", "body_name")


@query(
    "expand_all_transcripts",
    """SELECT o_orderkey AS transcript_id, o_totalprice AS confidence, r_name AS uri, c_name AS video_uri, n_name AS body_name
       FROM orders JOIN region ON r_regionkey = o_orderkey % 5 JOIN customer ON c_custkey = o_custkey
         JOIN nation ON n_nationkey = c_nationkey""",
)
def expand_all_transcripts(spark, root):
    expanded = mf.expand_transcripts(
        transcripts(spark, root), files(spark, root), events(spark, root), bodies(spark, root)
    )
    return expanded.select("transcript_id", "confidence", "uri", "video_uri", "body_name")


@query(
    "voting_record",
    """WITH decided AS (SELECT l_orderkey, l_partkey, min(l_linestatus) AS decision FROM lineitem GROUP BY ALL)
       SELECT s_suppkey AS person_id, l_returnflag AS vote, d.decision, p_name AS item_name,
         o_orderkey AS event_id, o_orderdate AS event_datetime
       FROM supplier JOIN lineitem AS l ON l_suppkey = s_suppkey JOIN decided AS d USING (l_orderkey, l_partkey)
         JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
       WHERE s_name = 'Supplier#000000007'""",
)
def voting_record(spark, root):
    """A part on an order is an item at an event, each line item a vote on it."""
    lines = load(spark, root, "lineitem").withColumn("emi", F.struct("l_orderkey", "l_partkey"))
    persons = load(spark, root, "supplier").select(F.col("s_suppkey").alias("person_id"), F.col("s_name").alias("full_name"))
    votes = lines.select(
        F.struct("l_orderkey", "l_linenumber", "l_suppkey").alias("vote_id"), F.col("l_suppkey").alias("person_id"),
        F.col("emi").alias("event_minutes_item_id"), F.col("l_returnflag").alias("decision"),
    )
    decided = lines.groupBy("l_orderkey", "l_partkey").agg(F.min("l_linestatus").alias("decision"))
    event_items = decided.select(
        F.struct("l_orderkey", "l_partkey").alias("event_minutes_item_id"), F.col("l_orderkey").alias("event_id"),
        F.col("l_partkey").alias("minutes_item_id"), "decision",
    )
    items = load(spark, root, "part").select(F.col("p_partkey").alias("minutes_item_id"), F.col("p_name").alias("name"))
    held = load(spark, root, "orders").select(F.col("o_orderkey").alias("event_id"), F.col("o_orderdate").alias("event_datetime"))
    record = mf.voting_record(persons, votes, event_items, items, held, "Supplier#000000007")
    return record.select("person_id", "vote", "decision", "item_name", "event_id", "event_datetime")


def decided_items(spark, root):
    """Line items with a decision, on the customer's event of their order."""
    lines = load(spark, root, "lineitem").join(
        load(spark, root, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("event_id")), "l_orderkey"
    )
    return lines.select(
        "event_id", F.col("l_partkey").alias("minutes_item_id"),
        F.when(F.col("l_returnflag") == "R", "Pass").when(F.col("l_returnflag") == "A", "").alias("decision"),
    )


_DECIDED = """SELECT o_custkey AS event_id, l_partkey AS minutes_item_id FROM lineitem JOIN orders ON o_orderkey = l_orderkey
              WHERE l_returnflag = 'R'"""


@query(
    "decision_item_sources",
    f"""SELECT d.minutes_item_id, d.event_id, p_name AS name, r_name AS uri FROM ({_DECIDED}) AS d
        JOIN part ON p_partkey = minutes_item_id JOIN ({_BEST_CREATED}) AS b ON b.o_custkey = d.event_id
        JOIN region ON r_regionkey = b.o_orderkey % 5""",
)
def decision_item_sources(spark, root):
    items = load(spark, root, "part").select(F.col("p_partkey").alias("minutes_item_id"), F.col("p_name").alias("name"))
    sources = mf.decision_item_sources(decided_items(spark, root), items, transcripts(spark, root), files(spark, root))
    return sources.select("minutes_item_id", "event_id", "name", "uri")


@query(
    "group_to_list",
    """SELECT l_partkey, l_orderkey // 1000 AS block, string_agg(l_orderkey, ',' ORDER BY l_orderkey) AS orders
       FROM (SELECT DISTINCT l_partkey, l_orderkey FROM lineitem) GROUP BY ALL""",
)
def group_to_list(spark, root):
    lists = mf.grouped_lists(load(spark, root, "lineitem"), "l_partkey", "l_orderkey", F.floor(F.col("l_orderkey") / 1000))
    text = F.array_join(F.transform("values", lambda v: v.cast("string")), ",")
    return lists.select("l_partkey", "block", text.alias("orders"))


@query(
    "latest_per_group",
    f"SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM ({_BEST_CREATED})",
)
def latest_per_group(spark, root):
    best = best_per_key(load(spark, root, "orders"), ["o_custkey"], F.desc("o_orderdate"), F.col("o_orderkey"))
    return best.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")


@query("uniqueness_violations", "SELECT o_custkey, o_orderstatus, count(*) AS n_rows FROM orders GROUP BY ALL HAVING count(*) > 2")
def uniqueness_violations(spark, root):
    return st.uniqueness_violations(load(spark, root, "orders"), ["o_custkey", "o_orderstatus"], 2)


@query(
    "new_records_only",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)",
)
def new_records_only(spark, root):
    stored = load(spark, root, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return st.new_records(stored, load(spark, root, "orders"), ["o_custkey"]).select("o_orderkey", "o_custkey")


@query(
    "surrogate_key",
    """SELECT c_custkey, sha256('customer' || chr(1) || c_name || chr(1) || c_nationkey) AS id,
         sha256('segment' || chr(1) || c_mktsegment) AS segment_id FROM customer""",
)
def surrogate_key(spark, root):
    return load(spark, root, "customer").select(
        "c_custkey", st.surrogate_key("customer", "c_name", "c_nationkey").alias("id"),
        st.surrogate_key("segment", "c_mktsegment").alias("segment_id"),
    )


@query(
    "insert_if_absent",
    """WITH stored AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r
                        FROM orders WHERE o_orderstatus = 'F') WHERE r = 1),
       batch AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r
                        FROM orders) WHERE r = 1)
       SELECT o_custkey, o_orderkey, 'stored' AS origin FROM stored UNION ALL
       SELECT o_custkey, o_orderkey, 'new' FROM batch WHERE o_custkey NOT IN (SELECT o_custkey FROM stored)""",
)
def insert_if_absent(spark, root):
    orders = load(spark, root, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    stored = best_per_key(orders.where("o_orderstatus = 'F'"), ["o_custkey"], F.col("o_orderkey"))
    fresh = st.insert_if_absent(stored, orders, ["o_custkey"], F.col("o_orderdate"), F.col("o_orderkey"))
    columns = ["o_custkey", "o_orderkey"]
    return stored.select(*columns, F.lit("stored").alias("origin")).unionByName(
        fresh.select(*columns, F.lit("new").alias("origin"))
    )


@query(
    "clone_table",
    "SELECT sha256('body' || chr(1) || n_name) AS body_id, n_name AS name FROM nation",
)
def clone_table(spark, root):
    source, target = work_path(spark, "source"), work_path(spark, "target")
    rows = load(spark, root, "nation").select(st.surrogate_key("body", "n_name").alias("body_id"), F.col("n_name").alias("name"))
    write_table(rows, source, "body")
    clone_tables(spark, source, target, ["body"])
    return read_table(spark, target, "body").select("body_id", "name")


@query(
    "inventory_diff",
    """SELECT page_id, regexp_extract(url, '[^/]*$') AS name FROM pages WHERE regexp_extract(url, '[^/]*$') NOT IN (
         SELECT regexp_extract(url, '[^/]*$') FROM pages WHERE starts_with(url, 'https'))""",
)
def inventory_diff(spark, root):
    pages = load_wide(spark, root, "pages").select("page_id", "url", F.substring_index("url", "/", -1).alias("name"))
    target = pages.where(F.startswith("url", F.lit("https"))).select("name")
    return missing_files(pages, target).select("page_id", "name")


_ENTITY_SQL = """SELECT DISTINCT event_id, label, value, dtype FROM (
      SELECT user_id AS event_id, 'event_type' AS label, event_type AS value, 'STRING' AS dtype FROM events UNION ALL
      SELECT user_id, 'day', CAST(day(ts) AS VARCHAR), 'INTEGER' FROM events)"""


@query(
    "entity_rows",
    f"""SELECT *, sha256('event_entity' || chr(1) || event_id || chr(1) || label || chr(1) || value) AS event_entity_id
        FROM ({_ENTITY_SQL})""",
)
def entity_rows(spark, root):
    values = load(spark, root, "events").select("user_id", "event_type", F.dayofmonth("ts").alias("day"))
    return st.entity_rows(values, "user_id", ["event_type", "day"])


@query("file_inventory")
def file_inventory(spark, root):
    return inventory(spark, root).select("name", "length")


@query("content_digest")
def content_digest(spark, root):
    return digests(spark, root).select(F.substring_index("path", "/", -1).alias("name"), "length", "sha256")


@query("page_file_digests", """
    SELECT page_id, CAST(octet_length(encode(html || chr(10))) AS BIGINT) AS length, sha256(html || chr(10)) AS sha256 FROM pages""")
def page_file_digests(spark, root):
    """Every page stored as a file of its own, then listed and digested."""
    target = work_path(spark, "page-files")
    pages = load_wide(spark, root, "pages").select(F.concat(F.lit("page_id="), "page_id").alias("name"), "html")
    store_files(pages, target, "name", "html")
    page = F.nullif(F.regexp_extract("path", r"page_id=(-?\d+)-\d+-\d+$", 1), F.lit("")).cast("long").alias("page_id")
    return digests(spark, target).select(page, "length", "sha256")


# Documents are the transcript texts: each labelled document is a file, its
# label row the transcript, its source the body of the event it stands for.
def corpus_tables(spark, root):
    docs = load_wide(spark, root, "documents")
    labels = load(spark, root, "labels")
    held = docs.select(F.col("doc_id").alias("event_id"), F.col("source").alias("body_id"))
    bodies_ = docs.select(F.col("source").alias("body_id")).distinct()
    spoken = labels.select(
        F.col("doc_id").alias("transcript_id"), F.col("doc_id").alias("event_id"), F.col("doc_id").alias("file_id"),
        F.col("quality").cast("double").alias("confidence"), F.col("toxic").alias("created"),
    )
    stored = docs.select(F.col("doc_id").alias("file_id"), F.col("doc_id").cast("string").alias("uri"))
    texts = docs.select(F.col("doc_id").cast("string").alias("uri"), "text")
    return held, spoken, stored, bodies_, texts


INDEX_OF = """WITH counts AS (SELECT id, term, count(*) AS n FROM (SELECT id, unnest({terms}) AS term FROM ({corpus})) GROUP BY ALL),
    frequency AS (SELECT term, count(*) AS df FROM counts GROUP BY term),
    total AS (SELECT count(DISTINCT id) AS n_ids FROM counts)
    SELECT term, id AS {name}, round(n * ln(n_ids / df), 6) AS value
    FROM counts JOIN frequency USING (term) CROSS JOIN total WHERE n * ln(n_ids / df) > 0"""


@query("event_index", INDEX_OF.format(
    terms=TERMS, name="event_id", corpus="SELECT doc_id AS id, text FROM documents JOIN labels USING (doc_id)"))
def event_index_query(spark, root):
    held, spoken, stored, bodies_, texts = corpus_tables(spark, root)
    indexer = TfidfIndexer("event_id", stemmed=False)
    built = event_index(held, spoken, stored, bodies_, texts, indexer=indexer)
    return built.withColumn("value", F.round("value", 6))


@query("event_index_best", INDEX_OF.format(
    terms=TERMS, name="event_id", corpus="SELECT doc_id // 3 AS id, arg_min(text, (-quality, doc_id)) AS text "
                                         "FROM documents JOIN labels USING (doc_id) GROUP BY 1"))
def event_index_best(spark, root):
    """Three documents are the transcripts of one event, of which the most confident is indexed."""
    _, spoken, stored, _, texts = corpus_tables(spark, root)
    event = F.floor(F.col("event_id") / 3).alias("event_id")
    held = spoken.select(event, F.lit("all").alias("body_id")).distinct()
    versions = spoken.select("transcript_id", event, "file_id", "confidence", "created")
    bodies_ = held.select("body_id").distinct()
    built = event_index(held, versions, stored, bodies_, texts, indexer=TfidfIndexer("event_id", stemmed=False))
    return built.withColumn("value", F.round("value", 6))


@query("item_index", INDEX_OF.format(
    terms=TERMS, name="minutes_item_id",
    corpus="SELECT source AS id, text FROM documents JOIN labels USING (doc_id) WHERE quality = 1 UNION ALL "
           "SELECT source, text FROM documents JOIN labels USING (doc_id) WHERE quality = 0 AND source IN "
           "(SELECT source FROM documents JOIN labels USING (doc_id) WHERE quality = 1)"))
def item_index_query(spark, root):
    """Sources are agenda items; good documents are transcripts of meetings
    that decided on them, the other labelled ones are attachments."""
    held, spoken, stored, _, texts = corpus_tables(spark, root)
    labelled = load_wide(spark, root, "documents").join(load(spark, root, "labels"), "doc_id")
    decided = labelled.select(
        F.col("source").alias("minutes_item_id"), F.col("doc_id").alias("event_id"),
        F.when(F.col("quality") == 1, "Pass").alias("decision"),
    )
    items = load_wide(spark, root, "documents").select(F.col("source").alias("minutes_item_id"), F.col("source").alias("name")).distinct()
    attachments = labelled.where("quality = 0").select(
        F.col("source").alias("minutes_item_id"), F.col("doc_id").cast("string").alias("uri"), "text"
    )
    indexer = TfidfIndexer("minutes_item_id", stemmed=False)
    built = item_index(decided, items, spoken, stored, texts, attachments, indexer=indexer)
    return built.withColumn("value", F.round("value", 6))


_RUN_LOG = """
    SELECT 'row-count' AS name, '1.0' AS version, 'run_input' AS side, 'str' AS dtype, '{0}' AS value UNION ALL
    SELECT 'row-count', '1.0', 'run_input_file', 'file', 'tables/{0}' UNION ALL
    SELECT 'row-count', '1.0', 'run_output', 'int', CAST(count(*) AS VARCHAR) FROM {0}"""


@query("run_log", _RUN_LOG.format("orders") + " UNION ALL " + _RUN_LOG.format("lineitem"))
def run_log(spark, root):
    """Two runs of one algorithm that count rows on their way to a sink, and their lineage."""
    log = work_path(spark, "runs")
    for table in ("orders", "lineitem"):
        with RunLog(spark, log, "row-count", "1.0", inputs=(table, None)) as run:
            run.input_files.append(f"tables/{table}")
            seen = Observation()
            counted = load(spark, root, table).select(F.lit(1)).observe(seen, F.count("*").alias("n"))
            counted.write.format("noop").mode("overwrite").save()
            run.add_output(seen.get["n"])

    def values(side):
        return read_table(spark, log, side).select("run_id", F.lit(side).alias("side"), "dtype", "value")

    files = read_table(spark, log, "run_input_file").join(read_table(spark, log, "file"), "file_id")
    named = files.select("run_id", F.lit("run_input_file").alias("side"), F.lit("file").alias("dtype"), F.col("uri").alias("value"))
    everything = values("run_input").unionByName(values("run_output")).unionByName(named)
    runs = read_table(spark, log, "run").join(read_table(spark, log, "algorithm"), "algorithm_id")
    return everything.join(runs.select("run_id", "name", "version"), "run_id").drop("run_id")
