"""Plain-text search over a term index, for one query or a table of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .index import FREQUENT_TERMS, term_counts
from .spread import spread_join


def query_terms(queries: DataFrame, query_id: str, text: str = "text", stemmed: bool = True) -> DataFrame:
    """Distinct terms of each query, cleaned as documents are."""
    return term_counts(queries, query_id, text, stemmed).select(query_id, "term")


def _matches(hits: DataFrame, query_id: str, id_column: str) -> DataFrame:
    # A group holds at most the distinct terms of one query text.
    contributions = F.collect_list(F.struct("term", F.col("value").alias("contribution")))
    return hits.groupBy(query_id, id_column).agg(
        F.sum("value").alias("relevance"), F.array_sort(contributions).alias("terms")
    )


def search(
    index: DataFrame,
    queries: DataFrame,
    query_id: str,
    id_column: str,
    text: str = "text",
    stemmed: bool = True,
    frequency: DataFrame | None = None,
) -> DataFrame:
    """Every query against the index: `(query, id, relevance, terms)`.

    `frequency` is the entries per term as `(term, df)`; left out they are counted.
    """
    wanted = written(query_terms(queries, query_id, text, stemmed), "query-terms")
    return search_terms(index, wanted, query_id, id_column, frequency)


def entries_asked(entries: DataFrame, wanted: DataFrame) -> DataFrame:
    """Entries, or counts, of the terms that some query has."""
    return entries.join(wanted.select("term").distinct(), "term", "left_semi")


def search_terms(
    index: DataFrame, wanted: DataFrame, query_id: str, id_column: str, frequency: DataFrame | None = None
) -> DataFrame:
    """`search` by a stored table of the distinct terms of each query.

    Query terms of a bounded number are broadcast: the entries of an id are
    brought together once, before each of them meets every query that has its
    term, so that no match is moved. More query terms are joined by term.
    """
    if wanted.count() <= FREQUENT_TERMS:
        hits = entries_asked(index, wanted).repartition(id_column).join(F.broadcast(wanted), "term")
    else:
        rows = None if frequency is None else frequency.withColumnRenamed("df", "rows")
        hits = spread_join(index, wanted, "term", [id_column], counts=rows)
    return _matches(hits, query_id, id_column)


def search_text(index: DataFrame, text: str, id_column: str, stemmed: bool = True) -> DataFrame:
    """One query string, best match first.

    The terms come from a single string, so broadcasting them is bounded.
    """
    query = index.sparkSession.createDataFrame([(0, text)], "query_id int, text string")
    wanted = F.broadcast(query_terms(query, "query_id", stemmed=stemmed))
    found = _matches(index.join(wanted, "term"), "query_id", id_column).drop("query_id")
    return found.orderBy(F.desc("relevance"), id_column)


def ordered(matches: DataFrame, query_id: str, id_column: str) -> DataFrame:
    """Matches query by query, best first; equal relevance goes to the lowest id. A range sort, no task holds a query."""
    return matches.orderBy(query_id, F.desc("relevance"), id_column)


def numbered(matches: DataFrame, query_id: str, id_column: str) -> DataFrame:
    """Ordered matches with their `position` over all, from 1.

    Each range of the sort is numbered on its own; the counts of the ranges
    before it, one row per task, are added.
    """
    ranges = written(
        ordered(matches, query_id, id_column).withColumn("_at", F.monotonically_increasing_id()), "ordered-matches"
    )
    # the upper bits of the id are the number of the range, the lower ones the place in it
    part = F.shiftright("_at", 33)
    sizes = ranges.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    placed = ranges.withColumn("_part", part).join(starts, "_part")
    position = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.withColumn("position", position.cast("long")).drop("_at", "_part", "_start")


def attach_rows(matches: DataFrame, data: DataFrame, id_column: str) -> DataFrame:
    """The source row of each match; a match whose row is gone keeps a null."""
    rows = data.select(id_column, F.struct(*[c for c in data.columns if c != id_column]).alias("data"))
    return matches.join(rows, id_column, "left")
