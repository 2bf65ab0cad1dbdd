"""The registered queries of the operators, as their contracts name them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact, fill_middle, fingerprint, jaccard, langid, lines, mixing, neighbours, packing, pii, powers_of_two, secret_scan, variants
from .common import documents


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir))
    return found.withColumn("spans", secret_scan.span_string(F.col("spans")))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes_of(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links")


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.deduplicated(documents(spark, sf_dir))
    numbers = [F.concat_ws(",", F.col(c).cast("array<string>")).alias(c) for c in ("removed", "short_repeats")]
    return found.select("doc_id", "n_lines", "n_removed", "n_near", *numbers, F.size("short_repeats").cast("long").alias("n_short_repeats"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir))
    names = F.array(*[F.lit(k) for k in pii.KINDS])
    spans = F.transform("found", lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string")))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", F.array_join(spans, ",").alias("spans"), "n_disguised"
    )


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op9_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.strip(documents(spark, sf_dir))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(documents(spark, sf_dir))


def op11_powers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return powers_of_two.decomposed(documents(spark, sf_dir), with_ids=False)


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.grouped(variants.word_counts(documents(spark, sf_dir), typo_every=variants.TYPO_EVERY))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.outputs(documents(spark, sf_dir))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_jaccard": op2_jaccard,
    "op3_mix": op3_mix,
    "op4_langid": op4_langid,
    "op5_lines": op5_lines,
    "op6_packing": op6_packing,
    "op7_pii": op7_pii,
    "op8_neighbours": op8_neighbours,
    "op9_exact": op9_exact,
    "op10_fingerprints": op10_fingerprints,
    "op11_powers": op11_powers,
    "op12_variants": op12_variants,
    "op13_fim": op13_fim,
}
SQL: dict[str, str] = {"op3_mix": mixing.SQL, "op12_variants": variants.SQL, "op13_fim": fill_middle.SQL}
