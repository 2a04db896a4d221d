"""Registered queries of this package, each over whole tables, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weekloom.llm import (decontaminate, jaccard, lines, mixing, periodic, quality, repeats, secrets, sharding, spelling, surrogates,
                          topk, wrapper)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixture_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior, rate and copies of every document."""
    rows = mixing.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "tokens", "p", "rate", "copies")


def op2_wrapper_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return wrapper.extract(table(spark, sf_dir, "pages"))


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates in place of personal data."""
    return surrogates.pseudonymise(table(spark, sf_dir, "documents"))


def op4_histogram_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best vectors for each query vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op5_guess_cost_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op6_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document."""
    return sharding.shards(table(spark, sf_dir, "documents"))


def op7_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that an earlier line makes superfluous."""
    return lines.removed_lines(table(spark, sf_dir, "documents"))


def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a test item, with the item and the overlaps."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document: three-word shingles, similarity 0.9."""
    return jaccard.link_components(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, one letter dropped here and there, with their forms and roots."""
    return spelling.spelling_groups(spelling.count_words(table(spark, sf_dir, "documents"), planted=True))


def op12_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the digest of its words outside repeated passages of 35 words."""
    return repeats.kept_digests(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, the tail of every tenth one repeated."""
    return periodic.run_digests(table(spark, sf_dir, "documents"), planted=True)


QUERIES = {
    f.__name__: f
    for f in (
        op1_mixture_rates, op2_wrapper_extract, op3_pii_surrogates, op4_histogram_topk, op5_guess_cost_secrets,
        op6_extendible_shards, op7_fuzzy_lines, op8_benchmark_leaks, op9_quality_scores, op10_jaccard_components, op11_spelling_variants,
        op12_repeated_passages, op13_periodic_runs,
    )
}
ORACLE_SQL = {"op6_extendible_shards": sharding.SQL.format(documents="documents", limit=sharding.LIMIT_BYTES)}
