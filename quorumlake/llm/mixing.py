"""Mixing sources to target weights (native).

Sizes are summed per source, targets are shared out by weight, and the
repetition rate of a source is target over size. Each document is taken
floor(rate) times, and once more if a hash of its id and text falls below the
fraction. Only DataFrame functions run here.

Defined cases: a null or blank text has size 0 and is never taken; a null
source is a source of its own, last in order; documents without an id, or with
the id of another, are drawn each by its own text, so that only rows equal in
id and text share a coin; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .common import words_of

CAP = 3
WEIGHTS = 3
BROADCAST_SOURCES = 10_000
SEED = "mix-1"


def coin(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from 52 bits of an md5 of seed, id and text."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Weights 1, 2, 3 repeat in code point order. A source stops at CAP times
    its size and its excess goes to the others by weight: with sources in
    order of cap over weight, the capped ones are the first whose cap lies
    under their share of what the ones before have left.
    """
    # one row per source from here on, so the unpartitioned windows see few rows
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weighed = sums.withColumn("weight", F.pmod(F.row_number().over(order) - 1, F.lit(WEIGHTS)) + 1)
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(0, Window.unboundedFollowing)
    shared = weighed.select(
        "source",
        "source_size",
        "weight",
        (F.sum("source_size").over(everything) - CAP * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("left"),
        F.sum("weight").over(after).alias("weights"),
    )
    cap = (CAP * F.col("source_size")).cast("double")
    level = F.col("left") / F.col("weights")
    # the level at the first source that keeps under its cap holds for all behind it
    marked = shared.withColumn("under", F.when(cap >= F.col("weight") * level, level))
    final = F.first("under", ignorenulls=True).over(filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return marked.withColumn("final", final).select(
        "source",
        "source_size",
        F.least(cap, F.coalesce(F.col("weight") * F.col("final"), cap)).alias("target"),
    )


def rated(docs: DataFrame, shares: DataFrame) -> DataFrame:
    """Columns source_size, target and copies added to docs that have source, size and coin."""
    if shares.count() <= BROADCAST_SOURCES:
        shares = F.broadcast(shares)
    joined = docs.alias("d").join(shares.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    rate = F.when(F.col("s.source_size") > 0, F.col("s.target") / F.col("s.source_size")).otherwise(0.0)
    whole = F.floor(rate)
    extra = (F.col("d.coin") < rate - whole).cast("long")
    copies = F.when(F.col("d.size") > 0, whole + extra).otherwise(F.lit(0)).cast("long")
    return joined.select("d.*", "s.source_size", "s.target", copies.alias("copies"))


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) of every document."""
    drawn = coin(F.col("doc_id"), F.col("text")).alias("coin")
    sized = written(docs.select("doc_id", "source", words_of(F.col("text")).alias("size"), drawn), "mix-sizes")
    shares = written(targets(sized), "mix-targets")
    return rated(sized, shares).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def emit(docs: DataFrame) -> DataFrame:
    """The mixed corpus: every document as often as it is taken, all its columns kept."""
    sized = docs.select("source", words_of(F.col("text")).alias("size"))
    shares = written(targets(sized), "mix-targets")
    drawn = coin(F.col("doc_id"), F.col("text")).alias("coin")
    packed = docs.select(F.struct("*").alias("doc"), "source", words_of(F.col("text")).alias("size"), drawn)
    taken = rated(packed, shares).where("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")


SQL = f"""
WITH sized AS (
  SELECT doc_id, source,
         COALESCE(LEN(REGEXP_EXTRACT_ALL(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || SUBSTR(MD5('{SEED}:' || COALESCE(doc_id::VARCHAR, 'null') || ':' || MD5(COALESCE(text, ''))), 1, 13))::BIGINT::DOUBLE
           / 4503599627370496.0::DOUBLE AS coin
  FROM documents),
sums AS (SELECT source, SUM(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, (ROW_NUMBER() OVER (ORDER BY source IS NULL, source) - 1) % {WEIGHTS} + 1 AS weight FROM sums),
shared AS (
  SELECT source, source_size, weight,
    SUM(source_size) OVER () - {CAP} * COALESCE(SUM(source_size) OVER (filling ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    SUM(weight) OVER (filling ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM weighed
  WINDOW filling AS (ORDER BY source_size::DOUBLE / weight, source IS NULL, source)),
marked AS (
  SELECT *, CASE WHEN {CAP}.0::DOUBLE * source_size >= weight * (rest::DOUBLE / weights) THEN rest::DOUBLE / weights END AS under,
         source_size::DOUBLE / weight AS place
  FROM shared),
level AS (SELECT MIN_BY(under, (place, source IS NULL, source)) AS final FROM marked WHERE under IS NOT NULL),
shares AS (
  SELECT source, source_size,
    LEAST({CAP}.0::DOUBLE * source_size, COALESCE(weight * final, {CAP}.0::DOUBLE * source_size)) AS target
  FROM marked, level),
rates AS (
  SELECT d.doc_id, d.size, s.source_size, s.target, d.coin,
    CASE WHEN s.source_size > 0 THEN s.target / s.source_size ELSE 0 END AS rate
  FROM sized d JOIN shares s ON d.source IS NOT DISTINCT FROM s.source),
counted AS (
  SELECT *, CASE WHEN size > 0 THEN FLOOR(rate)::BIGINT + (coin < rate - FLOOR(rate))::BIGINT ELSE 0 END AS copies FROM rates)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM counted
"""
