"""Stored tables of the relational model, one folder each, partitioned by a bucket of the natural key.

An insert reads and checks only the buckets that the keys of its batch fall in.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.index import upsert
from ..operators.store import insert_if_absent, read_bucketed, require_unique, surrogate_key, touched_buckets, write_bucketed
from ..schemas import TABLES
from ..session import written


def read_table(spark: SparkSession, root: str, name: str, buckets: Sequence[str] | None = None) -> DataFrame:
    """The table with its fixed schema, its id column first; whole, or only some buckets of keys."""
    return read_bucketed(spark, TABLES[name].ddl, f"{root}/{name}", buckets)


def _typed(df: DataFrame, name: str) -> DataFrame:
    """Rows in the table's column order and types."""
    fields = T.StructType.fromDDL(TABLES[name].ddl).fields
    return df.select(
        *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )


def write_table(df: DataFrame, root: str, name: str, mode: str = "append") -> None:
    write_bucketed(_typed(df, name), TABLES[name].key, f"{root}/{name}", mode)


def wipe_table(spark: SparkSession, root: str, name: str) -> None:
    """Replace a table by an empty one of the same schema."""
    write_table(spark.createDataFrame([], TABLES[name].ddl), root, name, mode="overwrite")


def create_tables(spark: SparkSession, root: str, names: Iterable[str] = TABLES) -> None:
    """Make each table that is not there yet; rows already stored stay."""
    for name in names:
        write_table(spark.createDataFrame([], TABLES[name].ddl), root, name)


def clone_tables(spark: SparkSession, source: str, target: str, names: Iterable[str]) -> None:
    """Copy tables to another root, replacing them; ids and links are kept."""
    for name in names:
        write_table(read_table(spark, source, name), target, name, mode="overwrite")


def insert_rows(spark: SparkSession, root: str, name: str, batch: DataFrame, *order: Column) -> None:
    """Append the batch rows whose natural key the table does not hold.

    Of batch rows sharing a key the first in `order` is taken. A key stored
    more than once is an error, where the batch touches its bucket. Rows get
    their id and time of creation.
    """
    table = TABLES[name]
    batch = written(batch, "batch")
    buckets = touched_buckets(_typed(batch, name), table.key)
    stored = require_unique(read_table(spark, root, name, buckets), name, table.key)
    rows = insert_if_absent(stored, batch, table.key, *(order or [F.col(k) for k in table.key]))
    stamp = "updated" if "updated" in stored.columns else "created"
    if stamp in stored.columns and stamp not in rows.columns:
        rows = rows.withColumn(stamp, F.current_timestamp())
    write_table(rows.withColumn(table.id_column, surrogate_key(name, *table.key)), root, name)


def insert_star(spark: SparkSession, root: str, frames: Mapping[str, DataFrame]) -> None:
    """Insert the frames of a star load, each into its table."""
    for name, frame in frames.items():
        insert_rows(spark, root, name, frame)


def upsert_rows(spark: SparkSession, root: str, name: str, batch: DataFrame, target: str) -> None:
    """Write a snapshot of an index table below `target`, with the batch's
    values in place of stored ones of the same key. The source is not changed."""
    table = TABLES[name]
    new = batch.withColumns(
        {table.id_column: surrogate_key(name, *table.key), "updated": F.current_timestamp()}
    )
    merged = upsert(read_table(spark, root, name), new, list(table.key), table.id_column)
    write_table(merged, target, name, mode="overwrite")
