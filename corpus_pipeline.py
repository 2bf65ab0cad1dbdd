"""A training corpus from `documents`: language filter, line dedup, near-duplicate removal, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs. All but the last
return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumlake.llm import jaccard, langid, lines, mixing, packing
from quorumlake.llm.common import documents
from quorumlake.session import written_alone

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: No SQL can express the learned classifier, nor the edit join at full size.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those the classifier rejects go."""
    return langid.predict(docs, langid.fitted(docs)).where(~F.col("rejected")).select("doc.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand, up to two edits, earlier; documents left blank go."""
    kept = lines.rewritten(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.thinned(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.emit(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with the sequence each goes to."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over `documents`; what a stage wrote on its way goes once its result is stored."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written_alone(spark, partial(stage, spark, docs, sf_dir), name)
    return docs
