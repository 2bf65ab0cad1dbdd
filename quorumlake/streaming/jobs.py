"""Polling jobs as streams: admission, deduplication, side outputs, indexing.

Sinks write through `foreachBatch`. A batch that is replayed after a failure
leaves the tables as they were: inserts check the stored keys, other outputs
overwrite the folder of their batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.index import term_counts
from ..operators.select import within_window
from ..operators.spread import best_per_key
from ..operators.store import insert_if_absent, read_bucketed, touched_buckets, write_bucketed


def scheduled(writer: DataStreamWriter, minutes: float | None) -> DataStreamWriter:
    """Run every `minutes`, or once over what has arrived."""
    if minutes is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{round(60 * minutes)} seconds")


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Records from Parquet files as they arrive."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def admitted(records: DataFrame, stamp: str, now: Column, days: int, backfill: bool = False) -> DataFrame:
    """Records inside the time window."""
    return records.where(within_window(F.col(stamp), now, days, backfill))


def insert_new(
    records: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    table: str,
    checkpoint: str,
    minutes: float | None = None,
    remember: str | None = None,
):
    """Append records whose key the table does not hold yet.

    The stored table decides, so a record delivered again is recognised however
    late it comes; a batch reads only the buckets its keys fall in. With
    `remember`, an interval such as "1 hour", keyed state drops what came within
    that time before, so that busy keys reach the table once. State goes by the
    time of arrival and not by any time in the record: no record is ever late,
    and none is lost. Of rows of a key in one batch the first in `order` is
    stored, with `remember` any of them.
    """
    spark = records.sparkSession
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in records.schema)
    write_bucketed(spark.createDataFrame([], records.schema), keys, table)

    def append(batch: DataFrame, batch_id: int) -> None:
        kept = batch.select(*records.columns).persist()
        stored = read_bucketed(batch.sparkSession, ddl, table, touched_buckets(kept, keys))
        write_bucketed(insert_if_absent(stored, kept, keys, *[F.col(c) for c in order]), keys, table)
        kept.unpersist()

    arrived = records
    if remember:
        arrived = records.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", remember)
        arrived = arrived.dropDuplicatesWithinWatermark(list(keys))
    writer = arrived.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return scheduled(writer, minutes).start()


def side_outputs(records: DataFrame, status: str, root: str, checkpoint: str, minutes: float | None = None):
    """Records parted by status, in one folder per status and batch."""

    def part(batch: DataFrame, batch_id: int) -> None:
        target = f"{root}/batch={batch_id}"
        batch.write.mode("overwrite").partitionBy(status).parquet(target)

    writer = records.writeStream.foreachBatch(part).option("checkpointLocation", checkpoint)
    return scheduled(writer, minutes).start()


def count_terms(
    documents: DataFrame,
    id_column: str,
    table: str,
    checkpoint: str,
    stemmed: bool = True,
    minutes: float | None = None,
    part: str = "part",
):
    """Term counts of arriving documents, from which the index is refreshed.

    A document comes in one part or several, each known by the column `part`,
    in any batches. `index.latest_counts` takes each part as delivered last, so
    a part that comes again, the same or changed, replaces the one before; of
    parts that come twice in one batch the greatest text counts. `index.tfidf`
    over these counts equals a full rebuild, and no text is read again.
    """

    def count(batch: DataFrame, batch_id: int) -> None:
        once = best_per_key(batch.select(id_column, part, "text"), [id_column, part], F.desc("text"))
        counts = term_counts(once, [id_column, part], stemmed=stemmed)
        counts.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    writer = documents.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint)
    return scheduled(writer, minutes).start()
