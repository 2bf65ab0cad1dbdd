"""Term indexes: counts, frequencies, TF-IDF weights and their upkeep.

An index is a long table `(term, <id>, value)`. A corpus is any frame of
`(id, text)` rows; an id may have many rows, whose terms add up.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Protocol

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.stem import stem
from ..functions.text import STOP_WORDS, index_term, index_tokens
from ..session import written
from .spread import task_count


#: Fewer terms than this stand in more than one of so many parts of the counts; they are sent to every executor: some 20 MB.
FREQUENT_TERMS = 200_000


class Indexer(Protocol):
    """Anything that counts the terms of a corpus and weighs the counts into an index."""

    def counts(self, corpus: DataFrame, id_column: str) -> DataFrame: ...

    def weigh(self, counts: DataFrame) -> DataFrame: ...


def term_rows(corpus: DataFrame, id_column: str | Sequence[str], text: str = "text") -> DataFrame:
    """One row per term occurrence, cleaned but not stemmed."""
    ids = [id_column] if isinstance(id_column, str) else list(id_column)
    tokens = corpus.select(*ids, F.explode(index_tokens(F.col(text))).alias("token"))
    return tokens.select(*ids, index_term(F.col("token")).alias("term")).where("term != ''")


def row_counts(corpus: DataFrame, id_column: str | Sequence[str], text: str = "text") -> DataFrame:
    """The unstemmed counts of every text inside its row: `(id, terms, ns)`, terms in order, none of them twice.

    Rows that share an id are not added up, and a row without terms has empty lists.
    """
    ids = [id_column] if isinstance(id_column, str) else list(id_column)
    # each step is a projection of its own, or the lambdas would build the lists anew for every element
    tokens = corpus.select(*ids, index_tokens(F.col(text)).alias("_tokens"), F.col(text).rlike("[^ -~\n\t]").alias("_odd"))
    # without other characters than these a token is a plain word, which only the set of stop words is asked for
    plain = F.filter("_tokens", lambda token: (token != "") & ~token.isin(STOP_WORDS))
    mixed = F.filter(F.transform("_tokens", index_term), lambda term: term != "")
    found = F.coalesce(F.when(F.col("_odd"), mixed).otherwise(plain), F.array().cast("array<string>"))
    ordered = tokens.select(*ids, F.sort_array(found).alias("_all"))
    begins = F.transform("_all", lambda term, i: F.when(~term.eqNullSafe(F.get("_all", i - 1)), i))
    runs = ordered.withColumn("_begins", F.array_compact(begins))
    return runs.select(
        *ids,
        F.transform("_begins", lambda begin: F.get("_all", begin)).alias("terms"),
        F.transform(
            "_begins", lambda begin, k: (F.coalesce(F.get("_begins", k + 1), F.size("_all")) - begin).cast("long")
        ).alias("ns"),
    )


def row_entries(counted: DataFrame, *columns: str) -> DataFrame:
    """`(columns, term, n)` of rows with `terms` and `ns`, one row for each term."""
    exploded = counted.select(*columns, F.explode_outer(F.arrays_zip("terms", "ns")).alias("_entry"))
    return exploded.where("_entry IS NOT NULL").select(*columns, F.col("_entry.terms").alias("term"), F.col("_entry.ns").alias("n"))


def term_counts(
    corpus: DataFrame,
    id_column: str | Sequence[str],
    text: str = "text",
    stemmed: bool = True,
    together: str | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """How often each term occurs for each id: `(id, term, n)`; an id may be of several columns.

    A corpus that is partitioned by columns of the id is counted where it lies. With `together`, a column of the id, unstemmed
    counts lie together by it: the texts move once, and what is grouped by that column and others need not move again.
    Terms are much larger than the texts that Spark measures, so `tasks` says how many share them.
    """
    ids = [id_column] if isinstance(id_column, str) else list(id_column)
    if together is not None and not stemmed:
        dealt = row_counts(corpus.select(*ids, text).repartition(*([tasks] if tasks else []), together), ids, text)
        return row_entries(dealt, *ids).groupBy(*ids, "term").agg(F.sum("n").alias("n"))
    counts = term_rows(corpus, ids, text).groupBy(*ids, "term").agg(F.count("*").alias("n"))
    if not stemmed:
        return counts
    # each distinct term is stemmed once; the counts are read again, the text once
    counts = written(counts, "plain-counts")
    frequency = written(document_frequency(counts), "plain-frequency")
    stems = vocabulary_stems(frequency)
    stemmed_counts = term_join(counts, stems, frequency).select(*ids, F.col("stem").alias("term"), "n")
    return stemmed_counts.groupBy(*ids, "term").agg(F.sum("n").alias("n"))


def term_join(counts: DataFrame, table: DataFrame, frequency: DataFrame) -> DataFrame:
    """Stored `counts` joined to a stored table of their terms, one row each, by term.

    `frequency` is `(term, df)` of the counts, stored. Terms that stand in more
    than one of FREQUENT_TERMS parts of the counts are fewer than that many and
    have most of the rows: these are broadcast, so that their rows stay where
    they are. Only rows of the other terms are shuffled, none of them by a key
    that could overfill a task.
    """
    least = frequency.agg(F.coalesce(F.sum("df"), F.lit(0)).cast("long")).first()[0] / FREQUENT_TERMS
    frequent = frequency.where(F.col("df") > least).select("term")
    often = counts.join(F.broadcast(table.join(F.broadcast(frequent), "term", "left_semi")), "term")
    seldom = counts.join(F.broadcast(frequent), "term", "left_anti")
    return often.unionByName(seldom.join(table.join(F.broadcast(frequent), "term", "left_anti"), "term"))


def vocabulary_stems(counts: DataFrame) -> DataFrame:
    """(term, stem) of every distinct term, as a stored table."""
    terms = counts.select("term").distinct()
    return written(terms.repartition(task_count(terms)).select("term", stem("term").alias("stem")), "stems")


def merge_counts(counts: DataFrame, id_column: str) -> DataFrame:
    """Counts gathered piece by piece as one row per id and term."""
    return counts.groupBy(id_column, "term").agg(F.sum("n").alias("n"))


def latest_counts(counts: DataFrame, id_column: str, part: str) -> DataFrame:
    """Counts of `(batch, id, part, term, n)` rows, of each part only as its latest batch delivered it.

    What is left out are the deliveries replaced by a later one: where few or
    none were, their table is small and the counts stay where they are.
    """
    named = counts.where(F.col(id_column).isNotNull() & F.col(part).isNotNull() & F.col("batch").isNotNull())
    delivered = named.select(id_column, part, "batch").distinct()
    last = F.max("batch").over(Window.partitionBy(id_column, part))
    replaced = delivered.withColumn("_last", last).where(F.col("batch") < F.col("_last")).drop("_last")
    kept = named.join(written(replaced, "replaced-parts"), [id_column, part, "batch"], "left_anti")
    return merge_counts(kept, id_column)


def document_frequency(counts: DataFrame) -> DataFrame:
    """In how many ids each term occurs: `(term, df)`."""
    return counts.groupBy("term").agg(F.count("*").alias("df"))


def corpus_size(counts: DataFrame, id_column: str) -> DataFrame:
    """One row: the number of ids having at least one term."""
    return counts.agg(F.count_distinct(id_column).alias("n_ids"))


def tfidf(counts: DataFrame, id_column: str, stored: bool = False, total: DataFrame | None = None) -> DataFrame:
    """`n * ln(ids / df)`, neither smoothed nor normalised.

    The counts are needed three times and are much smaller than the text, so
    unless they are `stored` already they are written once and read back, each
    time only the columns needed. So are the frequencies, which `term_join`
    takes to the counts. `total` is the corpus size where the counts are only
    those of some terms.
    """
    if not stored:
        counts = written(counts, "term-counts")
    frequency = written(document_frequency(counts), "frequency")
    ids = (corpus_size(counts, id_column) if total is None else total).scalar()
    weighted = term_join(counts, frequency, frequency)
    return weighted.select("term", id_column, (F.col("n") * F.log(ids / F.col("df"))).alias("value"))


def prune(index: DataFrame, minimum: float = 0.0, observation: Observation | None = None) -> DataFrame:
    """Entries above `minimum`; an observation gets the number dropped."""
    if observation is not None:
        index = index.observe(observation, F.count_if(F.col("value") <= minimum).alias("dropped"))
    return index.where(F.col("value") > minimum)


def term_entries(corpus: DataFrame, id_column: str, terms: Sequence[str], text: str = "text") -> DataFrame:
    """The entries of some terms, as the index of the whole corpus has them; the counts of other terms are not made."""
    known = corpus.where(F.exists(index_tokens(F.col(text)), lambda token: index_term(token) != ""))
    asked = term_rows(corpus, id_column, text).where(F.col("term").isin(*terms))
    counts = asked.groupBy(id_column, "term").agg(F.count("*").alias("n"))
    return tfidf(counts, id_column, total=corpus_size(known, id_column))


class TfidfIndexer:
    """The default indexer: stemmed TF-IDF without entries at or below `minimum`."""

    def __init__(self, id_column: str, minimum: float = 0.0, stemmed: bool = True):
        self.id_column = id_column
        self.minimum = minimum
        self.stemmed = stemmed

    def counts(self, corpus: DataFrame, id_column: str) -> DataFrame:
        return term_counts(corpus, id_column, stemmed=self.stemmed)

    def weigh(self, counts: DataFrame) -> DataFrame:
        return prune(tfidf(counts, self.id_column), self.minimum)

    def build(self, corpus: DataFrame) -> DataFrame:
        return self.weigh(self.counts(corpus, self.id_column))


def postings_blocks(index: DataFrame, id_column: str, block: Column, value: str = "value") -> DataFrame:
    """Postings as maps `{id: value}`, one per term and block of ids.

    `block` must put a bounded number of ids together, so that the map of a
    term found everywhere is split too.
    """
    entries = F.collect_list(F.struct(id_column, value))
    return index.groupBy("term", block.alias("block")).agg(F.map_from_entries(entries).alias("postings"))


def upsert(stored: DataFrame, new: DataFrame, keys: list[str], id_column: str, derived: Column | None = None) -> DataFrame:
    """Stored rows with value and time replaced by new ones of the same key.

    Keys are unique on each side. The id of a stored row is kept. Ids that are
    `derived` from the keys are no columns of either side: they are taken of
    the kept rows and not sent with them, and sides that lie together by one
    of the keys are not moved.
    """
    if derived is not None:
        return _upsert_derived(stored, new, keys, id_column, derived)
    carried = [id_column, "value", "updated"]
    old = stored.select(*keys, F.struct(*carried).alias("_old"))
    fresh = new.select(*keys, F.struct(*carried).alias("_new"))
    joined = old.join(fresh, keys, "full_outer")
    return joined.select(
        F.coalesce(f"_old.{id_column}", f"_new.{id_column}").alias(id_column),
        *keys,
        F.coalesce("_new.value", "_old.value").alias("value"),
        F.coalesce("_new.updated", "_old.updated").alias("updated"),
    )


def _upsert_derived(stored: DataFrame, new: DataFrame, keys: list[str], id_column: str, derived: Column) -> DataFrame:
    """The rows of the full outer join by keys: a join would deal both sides by all keys, a window takes them as they lie."""
    columns = [*keys, "value", "updated"]
    both = stored.select(*columns, F.lit(0).alias("_new")).unionByName(new.select(*columns, F.lit(1).alias("_new")))
    same = Window.partitionBy(*keys)
    held = both.withColumns({"_fresh": F.sum("_new").over(same), "_old": F.sum(1 - F.col("_new")).over(same)})
    # null keys match nothing; a new row of a key stored more than once stands for each of its rows
    named = F.lit(True)
    for key in keys:
        named &= F.col(key).isNotNull()
    times = F.when(~named, 1).when(F.col("_new") == 1, F.greatest("_old", F.lit(1))).when(F.col("_fresh") > 0, 0).otherwise(1)
    kept = held.withColumn("_times", times.cast("int")).where("_times > 0")
    kept = kept.select(*columns, F.explode_outer(F.array_repeat(F.lit(0), F.col("_times"))).alias("_time"))
    return kept.select(derived.alias(id_column), *columns)


def write_index(index: DataFrame, path: str, id_column: str) -> None:
    """Replace the index stored at `path`.

    Range partitions over term and id keep each term together in the files, so
    that lookups prune row groups, and split a term too large for one task.
    """
    ordered = index.repartitionByRange("term", id_column).sortWithinPartitions("term", id_column)
    ordered.write.mode("overwrite").parquet(path)
