"""The streaming jobs, each run to the end of what has arrived."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import index as ix
from ..session import work_path
from ..streaming import jobs
from ..streaming.live_index import keep_index, live_index
from .indexes import INDEX
from .registry import load, query

NOW = dt.datetime(2024, 1, 20, 12)


def _stream(spark, root, table):
    # As a pattern the path may be one file or a folder of files.
    schema = load(spark, root, table).schema
    return jobs.file_stream(spark, f"{root}/{table}.parque[t]", schema)


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, root):
    table, checkpoint = work_path(spark, "stream-dedup"), work_path(spark, "checkpoint")
    records = _stream(spark, root, "events").select("user_id", "event_type", "event_id", "ts")
    keys = ["user_id", "event_type"]
    jobs.insert_new(records, keys, ["ts", "event_id"], table, checkpoint, remember="1 hour").awaitTermination()
    return spark.read.schema(records.schema).parquet(table).select(*keys)


@query(
    "stream_timebound",
    "SELECT event_id, user_id, ts FROM events "
    "WHERE ts > TIMESTAMP '2024-01-06 12:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00'",
)
def stream_timebound(spark, root):
    table, checkpoint = work_path(spark, "stream-timebound"), work_path(spark, "checkpoint")
    now = F.lit(NOW).cast("timestamp_ntz")
    records = jobs.admitted(_stream(spark, root, "events").select("event_id", "user_id", "ts"), "ts", now, 14)
    writer = records.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint)
    jobs.scheduled(writer, None).start().awaitTermination()
    return spark.read.schema(records.schema).parquet(table)


@query(
    "stream_side_outputs",
    """SELECT event_id, CASE WHEN value <= 1 THEN 'unparseable'
         WHEN ts > TIMESTAMP '2024-01-12 12:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00' THEN 'parsed'
         ELSE 'out-of-bounds' END AS status FROM events""",
)
def stream_side_outputs(spark, root):
    target, checkpoint = work_path(spark, "stream-sides"), work_path(spark, "checkpoint")
    inside = jobs.within_window(F.col("ts"), F.lit(NOW).cast("timestamp_ntz"), 8)
    status = F.when(F.col("value") <= 1, "unparseable").when(inside, "parsed").otherwise("out-of-bounds")
    records = _stream(spark, root, "events").select("event_id", status.alias("status"))
    jobs.side_outputs(records, "status", target, checkpoint).awaitTermination()
    return spark.read.schema("event_id long, batch long, status string").parquet(target).drop("batch")


@query("stream_index", f"{INDEX} SELECT term, doc_id, round(value, 6) AS value FROM idx WHERE value > 0")
def stream_index(spark, root):
    table, checkpoint = work_path(spark, "stream-counts"), work_path(spark, "checkpoint")
    documents = _stream(spark, root, "documents").select("doc_id", F.lit(0).alias("part"), "text")
    jobs.count_terms(documents, "doc_id", table, checkpoint, stemmed=False).awaitTermination()
    counts = spark.read.schema("doc_id long, part int, term string, n long, batch long").parquet(table)
    return ix.prune(ix.tfidf(ix.latest_counts(counts, "doc_id", "part"), "doc_id")).withColumn("value", F.round("value", 6))


@query("stream_live_index", f"{INDEX} SELECT term, doc_id, round(value, 6) AS value FROM idx WHERE value > 0")
def stream_live_index(spark, root):
    """Half of every text first, all of it later: the index follows by the changes of its frequencies."""
    landing, table, checkpoint = (work_path(spark, name) for name in ("landing", "live-index", "checkpoint"))
    documents = load(spark, root, "documents").select("doc_id", F.lit(0).alias("part"), "text")
    half = F.expr("substring(text, 1, length(text) div 2)")
    for delivery in (documents.withColumn("text", half), documents):
        delivery.write.mode("append").parquet(landing)
        stream = jobs.file_stream(spark, landing, "doc_id long, part int, text string")
        keep_index(stream, "doc_id", table, checkpoint, stemmed=False).awaitTermination()
    return ix.prune(live_index(spark, table, "doc_id long, part int")).withColumn("value", F.round("value", 6))
