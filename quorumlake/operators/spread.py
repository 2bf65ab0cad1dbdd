"""Building blocks that hold up when one key owns a large share of the rows.

* `best_per_key` keeps one row per key; Spark limits each key before the shuffle.
* `running_totals` sums along an ordered key in blocks, so no task ever holds a
  whole key.
* `spread_join` scatters the keys that would overfill a task of a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

BLOCK_ROWS = 32_768
BUCKET_ROWS = 5_000_000


def task_count(df: DataFrame) -> int:
    """Tasks to deal few rows of much work to, which adaptive execution would put together by their size."""
    spark = df.sparkSession
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def best_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of every key in `order`.

    The rank filter is planned as a group limit on both sides of the shuffle,
    so at most one row per key leaves a task, whatever the key's size.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def first_per_key(df: DataFrame, keys: Sequence[str], limit: int, *order: Column) -> DataFrame:
    """The first `limit` rows of every key, numbered from 1 in `position`."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("position", F.row_number().over(window)).where(F.col("position") <= limit)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    totals: dict[str, Column],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Running sums along the integer column `order` within `keys`.

    Each entry of `totals` names a column and what it sums, up to and including
    the row itself. Rows are summed inside blocks of `block_rows` order values;
    block totals, a table smaller by that factor, carry the sums across blocks.
    The result keeps `block`, by which it stays partitioned.
    """
    parts = [*keys, "block"]
    blocked = df.withColumns(
        {"block": F.floor(F.col(order) / block_rows)}
        | {f"_add_{name}": value.cast("long") for name, value in totals.items()}
    )
    before = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocked.groupBy(*parts).agg(*[F.sum(f"_add_{n}").alias(f"_sum_{n}") for n in totals])
    carried = carried.select(
        *parts, *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_carry_{n}") for n in totals]
    )
    upto = Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = blocked.withColumns({f"_in_{n}": F.sum(f"_add_{n}").over(upto) for n in totals})
    return summed.join(carried, parts).select(
        *df.columns, "block", *[(F.col(f"_in_{n}") + F.col(f"_carry_{n}")).alias(n) for n in totals]
    )


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    scatter_on: Sequence[str],
    counts: DataFrame | None = None,
    how: str = "inner",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Inner or left equi-join on `key` that splits every key of `left` beyond `bucket_rows`.

    `counts` is `(key, rows)` of `left`, where the caller has it already. A key
    of n rows is scattered over ceil(n / bucket_rows) buckets by a hash of
    `scatter_on`; its right rows are repeated once per bucket. The plan is the
    same at every size: the table of large keys is written, so that Spark knows
    its size, and joined to both sides, be it empty or too large to broadcast.
    """
    if counts is None:
        counts = left.groupBy(key).agg(F.count("*").alias("rows"))
    large = counts.where(F.col("rows") > bucket_rows).select(key, F.ceil(F.col("rows") / bucket_rows).cast("int").alias("_buckets"))
    large = written(large, "large-keys")
    buckets = F.coalesce("_buckets", F.lit(1))
    scattered = left.join(large, key, "left").withColumn("_bucket", F.pmod(F.xxhash64(*scatter_on), buckets).cast("int"))
    repeated = right.join(large, key, "left").withColumn("_bucket", F.explode(F.sequence(F.lit(0), buckets - 1)))
    return scattered.drop("_buckets").join(repeated.drop("_buckets"), [key, "_bucket"], how).drop("_bucket")
