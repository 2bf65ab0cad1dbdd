"""Small helpers that several operators share.

Every operator reads only the columns it needs, so extra columns of any name
do no harm. A document is known by `rid`: its doc_id, or a hash of its text
where doc_id is null. Rows with the same rid count as one document wherever
decisions are stored by rid.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written

WORD = "[^\\x20\\x09-\\x0D]+"
PIECE_BYTES = 1_000_000
SIEVE_BITS = 23


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def rid() -> Column:
    """doc_id as a long, or a negative hash of the text where it is null."""
    hashed = F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseOR(F.lit(-(1 << 63)))
    return F.coalesce(F.col("doc_id").cast("long"), hashed)


def told_apart(docs: DataFrame) -> DataFrame:
    """(doc, doc_id, text): rows kept whole in `doc`, with ids that name one text each.

    Where different texts share an id, each gets a number of its own, a hash of
    id and text behind all other ids; rows equal in both keep sharing one.
    """
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    hashed = rows.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    extremes = hashed.groupBy("doc_id").agg(F.min("h").alias("low"), F.max("h").alias("high"))
    shared = written(extremes.where("low <> high").select("doc_id"), "shared-ids")
    if shared.isEmpty():
        return rows
    held = sieve(shared, "doc_id")
    named = F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    again = sifted(rows, "doc_id", held).join(shared.withColumn("again", F.lit(True)), "doc_id", "left")
    told = again.select("doc", F.when(F.col("again"), named).otherwise(F.col("doc_id")).alias("doc_id"), "text")
    return sifted(rows, "doc_id", held, inside=False).unionByName(told)


def words_of(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def map_rows(df: DataFrame, rows: Callable[[Iterator[tuple]], Iterator[list]], schema: str) -> DataFrame:
    """mapInArrow with plain Python rows in and lists of column values out.

    `rows` gets the tuples of one batch after the other and yields column
    lists; it may hold state for a whole partition.
    """
    target = schema_of(df.sparkSession, schema)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tuples() -> Iterator[tuple]:
            for batch in batches:
                for piece in pieces(batch):
                    yield from zip(*(c.to_pylist() for c in piece.columns), strict=True)

        for columns in rows(tuples()):
            yield record_batch(columns, target)

    return df.mapInArrow(apply, schema)


def schema_of(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def record_batch(columns: list, target: pa.Schema) -> pa.RecordBatch:
    made = [
        c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type, from_pandas=False)
        for c, f in zip(columns, target, strict=True)
    ]
    return pa.RecordBatch.from_arrays(made, schema=target)


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of a few megabytes each, so that long texts don't pile up."""
    count = batch.num_rows
    step = max(1, min(count, int(count * PIECE_BYTES / max(1, batch.nbytes))))
    for at in range(0, count, step):
        yield batch.slice(at, step)
    pa.default_memory_pool().release_unused()


def flushed(rows: Iterator[tuple], width: int, size: int = 5000) -> Iterator[list]:
    """Rows gathered into column lists of at most `size` rows."""
    kept: list[tuple] = []
    for row in rows:
        kept.append(row)
        if len(kept) >= size:
            yield [list(c) for c in zip(*kept, strict=True)]
            kept = []
    if kept:
        yield [list(c) for c in zip(*kept, strict=True)]


def sieve(df: DataFrame, column: str) -> DataFrame:
    """A bit set of fixed size that holds at least the values of a long column, as (w, v) words.

    It has 2**18 rows at most, whatever the input, so it may be broadcast. It
    only thins what a join would drop anyway; a join must follow.
    """
    words = df.select(_sieve_bit(column).alias("b")).groupBy(F.shiftright("b", 5).alias("w"))
    return written(words.agg(F.expr("bit_or(shiftleft(1L, CAST(b & 31 AS INT)))").alias("v")), "sieve")


def sifted(df: DataFrame, column: str, words: DataFrame, inside: bool = True) -> DataFrame:
    """The rows whose value may be in the sieve, or the others."""
    keyed = df.withColumn("sieve_bit", _sieve_bit(column))
    joined = keyed.join(F.broadcast(words), F.shiftright(keyed["sieve_bit"], 5) == words["w"], "left")
    hit = F.coalesce(F.expr("shiftright(v, CAST(sieve_bit & 31 AS INT)) & 1"), F.lit(0)) == 1
    return joined.where(hit if inside else ~hit).select(*df.columns)


def _sieve_bit(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(1 << SIEVE_BITS))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of (a, b) edges; root is the least node of its component.

    Labels spread over the edges and are then followed once more (pointer
    jumping), each round cut into a written table, until none changes.
    """
    both = written(
        edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct().toDF("node", "other"),
        "edges",
    )
    labels = written(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("root")), "labels")
    while True:
        seen = both.join(labels.withColumnsRenamed({"node": "other"}), "other").groupBy("node").agg(F.min("root").alias("near"))
        hooked = labels.join(seen, "node").select("node", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        roots = labels.select(F.col("node").alias("root"), F.col("root").alias("far"))
        jumped = hooked.join(roots, "root", "left").select("node", "was", F.least("root", F.coalesce("far", "root")).alias("root"))
        labels_next = written(jumped, "labels")
        if labels_next.where("was <> root").isEmpty():
            return labels_next.select("node", "root")
        labels = labels_next.select("node", "root")
