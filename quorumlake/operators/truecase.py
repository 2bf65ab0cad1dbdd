"""Casing learned from a corpus and put back on upper-case captions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spread import best_per_key, spread_join


def placed_tokens(docs: DataFrame, id_column: str, text: str = "text") -> DataFrame:
    """Tokens with position, and whether each opens a sentence."""
    tokens = F.split(F.translate(F.col(text), "\n\t", "  "), " ")
    split = docs.select(id_column, tokens.alias("_tokens"))
    opens = F.transform(
        F.col("_tokens"),
        lambda token, i: F.struct(
            token.alias("token"),
            ((i == 0) | F.get(F.col("_tokens"), i - 1).rlike(r"[.?!]\z")).alias("opens"),
        ),
    )
    return split.select(id_column, F.posexplode(opens).alias("position", "_t")).select(id_column, "position", "_t.*")


def fit_casing(tokens: DataFrame) -> DataFrame:
    """The most frequent form of each lower-cased token inside sentences."""
    inner = tokens.where(~F.col("opens") & (F.col("token") != ""))
    counts = inner.groupBy(F.lower("token").alias("lowered"), F.col("token").alias("form")).agg(
        F.count("*").alias("n")
    )
    return best_per_key(counts, ["lowered"], F.desc("n"), F.col("form"))


def apply_casing(tokens: DataFrame, model: DataFrame, id_column: str) -> DataFrame:
    """The text of each document with learned casing and capital openings."""
    lowered = tokens.withColumn("lowered", F.lower("token"))
    known = spread_join(lowered, model.select("lowered", "form"), "lowered", [id_column, "position"], how="left")
    cased = F.coalesce("form", "lowered")
    opened = F.concat(F.upper(F.substring(cased, 1, 1)), F.expr("substring(coalesce(form, lowered), 2)"))
    final = known.withColumn("cased", F.when(F.col("opens"), opened).otherwise(cased))
    # A group is the tokens of one document, which came from one row.
    pieces = F.array_sort(F.collect_list(F.struct("position", "cased")))
    return final.groupBy(id_column).agg(F.array_join(F.transform(pieces, lambda p: p.cased), " ").alias("text"))
