"""A term index kept current by what arrives, at the cost of what arrives.

Two tables lie below `root`. `counts` has one row for every part as delivered,
by batch and bucket of the document id, with its terms and their counts as two
lists; those of a part that comes again without text are empty. `changes` has
what each batch did to the document frequency of terms and, in a row without
term, to the number of documents.

Parts are moved and compared as such rows. Terms become rows where they
change a frequency, and where documents of several parts add theirs up.

A batch compares its documents before and after, for which it reads only their
buckets. Weights are taken when the index is read: a new document alters the
weight of every term, but only frequencies and their sum have to be stored.
Rows without id or part are left out; a batch that is replayed replaces itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.index import merge_counts, row_counts, row_entries, term_counts, term_join
from ..operators.spread import best_per_key
from ..operators.store import BUCKET, bucketed, touched_buckets
from ..session import written
from .jobs import scheduled


def _stored_counts(spark: SparkSession, root: str, key: str) -> DataFrame:
    """`key` names id and part with their types, as in a schema."""
    return spark.read.schema(f"{key}, terms array<string>, ns array<long>, batch long, {BUCKET} string").parquet(f"{root}/counts")


def _dealt(rows: DataFrame, id_column: str) -> DataFrame:
    """Stored rows brought together by document, the one time that they are moved."""
    return rows.repartition(id_column)


def _part_counts(texts: DataFrame, ids: Sequence[str], stemmed: bool) -> DataFrame:
    """`(ids, terms, ns)` of each text, where `ids` are unique."""
    if not stemmed:
        return row_counts(texts, ids)
    texts = texts.persist()
    counts = term_counts(texts, ids, stemmed=True)
    marks = texts.select(*ids, F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"))
    entry = F.when(F.col("term").isNotNull(), F.struct("term", "n"))
    lists = counts.unionByName(marks).groupBy(*ids).agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
    return lists.select(*ids, F.col("_entries.term").alias("terms"), F.col("_entries.n").alias("ns"))


def _changes(rows: DataFrame, id_column: str, part: str, batch_id: int) -> DataFrame:
    """(term, change) of the documents of `rows` by a batch, in a row without term that of their number.

    The lists of a document of one part are compared in its row. Those of several parts are taken apart,
    since a term that one part loses may stand in another.
    """
    none = F.array().cast("array<string>")
    parts = rows.groupBy(id_column, part).agg(
        F.coalesce(F.max_by("terms", "batch"), none).alias("_after"),
        F.coalesce(F.max_by("terms", F.when(F.col("batch") < batch_id, F.col("batch"))), none).alias("_before"),
    )
    parts = parts.withColumn("_parts", F.count("*").over(Window.partitionBy(id_column)))

    def changed(terms: Column, change: int) -> Column:
        return F.transform(terms, lambda term: F.struct(term.alias("term"), F.lit(change).alias("change")))

    number = (F.size("_after") > 0).cast("int") - (F.size("_before") > 0).cast("int")
    alone = parts.where("_parts = 1").select(F.explode_outer(F.concat(
        changed(F.array_except("_after", "_before"), 1),
        changed(F.array_except("_before", "_after"), -1),
        F.array(F.struct(F.lit(None).cast("string").alias("term"), number.alias("change"))),
    )).alias("c")).select("c.*")

    def held(terms: Column, after: int) -> Column:
        """The terms, and after them a null for the document."""
        rows = F.transform(terms, lambda term: F.struct(term.alias("term"), F.lit(after).alias("_after"), F.lit(1 - after).alias("_before")))
        whole = F.struct(F.lit(None).cast("string").alias("term"), F.lit(after).alias("_after"), F.lit(1 - after).alias("_before"))
        return F.when(F.size(terms) > 0, F.concat(rows, F.array(whole))).otherwise(rows)

    several = parts.where("_parts > 1").select(id_column, F.explode_outer(F.concat(held(F.col("_after"), 1), held(F.col("_before"), 0))).alias("h"))
    several = several.where("h IS NOT NULL").select(id_column, "h.*").groupBy(id_column, "term").agg(
        (F.max("_after") - F.max("_before")).alias("change")
    )
    shared = several.select("term", "change")
    moved = alone.unionByName(shared).where("change <> 0")
    return moved.groupBy("term").agg(F.sum("change").alias("change")).where("change <> 0")


def keep_index(
    documents: DataFrame,
    id_column: str,
    root: str,
    checkpoint: str,
    stemmed: bool = True,
    minutes: float | None = None,
    part: str = "part",
):
    """Follow arriving `(id, part, text)` rows; of a part that comes twice in a batch the greatest text counts."""
    fields = documents.schema
    key = ", ".join(f"`{c}` {fields[c].dataType.simpleString()}" for c in (id_column, part))

    def apply(batch: DataFrame, batch_id: int) -> None:
        known = batch.where(F.col(id_column).isNotNull() & F.col(part).isNotNull())
        # dealt by bucket as texts, which are counted in their rows and written where they lie
        dealt = bucketed(known.select(id_column, part, "text"), [id_column]).repartition(BUCKET)
        once = best_per_key(dealt, [BUCKET, id_column, part], F.desc("text"))
        counted = _part_counts(once, [BUCKET, id_column, part], stemmed)
        counted.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{root}/counts/batch={batch_id}")
        stored = _stored_counts(batch.sparkSession, root, key).where(F.col("batch") <= batch_id)
        arrived = stored.where(F.col("batch") == batch_id).select(id_column)
        buckets = touched_buckets(arrived, [id_column])
        touched = stored.where(F.col(BUCKET).isin(*buckets)).drop("ns", BUCKET).join(arrived, id_column, "left_semi")
        changes = _changes(_dealt(touched, id_column), id_column, part, batch_id)
        changes.write.mode("overwrite").parquet(f"{root}/changes/batch={batch_id}")

    writer = documents.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return scheduled(writer, minutes).start()


def live_index(
    spark: SparkSession, root: str, key: str, terms: Sequence[str] | None = None
) -> DataFrame:
    """`(term, id, value)` of all that has arrived, or of some terms, whose entries alone then leave their rows.

    `key` is the schema of id and part, such as "doc_id long, part int".
    """
    stored = _stored_counts(spark, root, key)
    id_column, part = stored.columns[:2]
    changes = spark.read.schema("term string, change long, batch long").parquet(f"{root}/changes")
    total = changes.where("term IS NULL").agg(F.sum("change").alias("n_ids"))
    asked = changes.where("term IS NOT NULL")
    if terms is not None:
        asked = asked.where(F.col("term").isin(*terms))
    frequency = written(asked.groupBy("term").agg(F.sum("change").alias("df")), "live-frequency")
    last = F.max("batch").over(Window.partitionBy(id_column, part))
    latest = _dealt(stored.drop(BUCKET), id_column).withColumn("_now", last).where("batch = _now")
    latest = latest.withColumn("_parts", F.count("*").over(Window.partitionBy(id_column)))
    latest = written(latest.select(id_column, "_parts", "terms", "ns"), "live-parts")
    several = written(merge_counts(_entries(latest.where("_parts > 1"), id_column, terms), id_column), "live-counts")
    counts = _entries(latest.where("_parts = 1"), id_column, terms).unionByName(several)
    weighted = term_join(counts, frequency, frequency)
    return weighted.select("term", id_column, (F.col("n") * F.log(total.scalar() / F.col("df"))).alias("value"))


def _entries(latest: DataFrame, id_column: str, terms: Sequence[str] | None) -> DataFrame:
    found = row_entries(latest, id_column)
    return found if terms is None else found.where(F.col("term").isin(*terms))
