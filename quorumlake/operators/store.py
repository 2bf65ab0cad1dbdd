"""Keyed tables: deterministic ids, insert if absent, uniqueness, entities."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import as_stored_text, type_tag
from .spread import best_per_key


class UniquenessError(ValueError):
    """A key that should name at most `limit` rows names more; `rows` shows limit + 1 of them."""

    def __init__(self, table: str, keys: Sequence[str], row: dict, rows: Sequence[dict] = ()):
        self.table, self.keys, self.row, self.rows = table, list(keys), row, list(rows)
        super().__init__(f"{table} has {row['n_rows']} rows for {({k: row[k] for k in keys})}")


def surrogate_key(table: str, *columns: str | Column) -> Column:
    """A row id from its natural key, the same on every retry.

    A null key part differs from an empty one.
    """
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    texts = [F.coalesce(c.cast("string"), F.lit("\u0000")) for c in parts]
    return F.sha2(F.concat_ws("\u0001", F.lit(table), *texts), 256)


#: Digits of a key's hash that name its bucket: 16 ** BUCKET_DIGITS folders at most.
BUCKET_DIGITS = 2
BUCKET = "key_bucket"


def bucketed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds the bucket of the row's key, by which keyed tables are partitioned."""
    return df.withColumn(BUCKET, F.left(surrogate_key("", *keys), F.lit(BUCKET_DIGITS)))


def write_bucketed(df: DataFrame, keys: Sequence[str], path: str, mode: str = "append") -> None:
    """Rows in one folder for each bucket of keys, one file for each bucket written to."""
    bucketed(df, keys).repartition(BUCKET).write.mode(mode).partitionBy(BUCKET).parquet(path)


def touched_buckets(batch: DataFrame, keys: Sequence[str]) -> list[str]:
    """The buckets that a batch's keys fall in: a bounded number, whatever the batch."""
    return sorted(r[0] for r in bucketed(batch, keys).select(BUCKET).distinct().collect())


def read_bucketed(spark: SparkSession, ddl: str, path: str, buckets: Sequence[str] | None = None) -> DataFrame:
    """A keyed table, or those of its buckets that are asked for: the other folders are not read."""
    stored = spark.read.schema(f"{ddl}, {BUCKET} string").parquet(path)
    return (stored if buckets is None else stored.where(F.col(BUCKET).isin(*buckets))).drop(BUCKET)


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality of all keys, null matching null."""
    return functools.reduce(operator.and_, [left[k].eqNullSafe(right[k]) for k in keys])


def new_records(stored: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key is not stored yet."""
    known = stored.select(*keys).alias("known")
    return batch.join(known, same_key(batch, known, keys), "left_anti")


def insert_if_absent(
    stored: DataFrame, batch: DataFrame, keys: Sequence[str], *order: Column
) -> DataFrame:
    """The rows to append: the first in `order` of each key not stored yet.

    Stored rows are never changed, so running the same batch again adds nothing.
    """
    return best_per_key(new_records(stored, batch, keys), keys, *order)


def uniqueness_violations(df: DataFrame, keys: Sequence[str], limit: int = 1) -> DataFrame:
    """Keys with more than `limit` rows, and how many."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > limit)


def require_unique(df: DataFrame, table: str, keys: Sequence[str], limit: int = 1) -> DataFrame:
    """`df` itself, or an error naming one key that has too many rows."""
    broken = uniqueness_violations(df, keys, limit).limit(1).collect()
    if broken:
        same = functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.lit(broken[0][k])) for k in keys])
        shown = df.where(same).limit(limit + 1).collect()
        raise UniquenessError(table, keys, broken[0].asDict(), [r.asDict() for r in shown])
    return df


def entity_rows(values: DataFrame, event_id: str, value_columns: Sequence[str]) -> DataFrame:
    """One `(event_id, label, value, dtype)` row per filled value column."""
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("label"),
                as_stored_text(values, c).alias("value"),
                type_tag(values, c).alias("dtype"),
            )
            for c in value_columns
        ]
    )
    exploded = values.select(F.col(event_id).alias("event_id"), F.explode(entries).alias("e"))
    rows = exploded.select("event_id", "e.*").where("value is not null").distinct()
    return rows.withColumn("event_entity_id", surrogate_key("event_entity", "event_id", "label", "value"))
