"""The corpus pipeline: five stages over ``documents``, each written and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm import decontaminate, jaccard, mixing, quality, scan, sharding
from weekloom.staging import stage

#: A document goes if its quality score is below this.
KEEP_SCORE = 0.7
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
#: What is left after the classifier is good text: mostly that, and few toxic tokens.
MIX = {"good": 0.975, "good_toxic": 0.02, "poor": 0.004, "poor_toxic": 0.001}


KEY = "__row_key"


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a name for each row that depends on its id and text alone; never null."""
    return docs.withColumn(KEY, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))


def _without(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    gone = stage(keys.select(F.col("doc_id").alias(KEY)).distinct(), "dropped")
    return scan.only_ids(keyed, gone, KEY, "left_anti").drop(KEY)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; each row is scored by its own text."""
    net = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.with_score(docs, net, "__quality")
    return scored.where(F.col("__quality") >= KEEP_SCORE).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of the smallest id.

    Rows are told apart by id and text: of rows equal in both one stays, rows that share an id but
    not their text are compared like any others. A row without an id is compared too and gives way
    to one with an id. A null or empty text is like no other.
    """
    keyed = _keyed(docs)
    groups = stage(jaccard.link_components(keyed, SHINGLE_WORDS, SIMILAR_PERCENT, id_col=KEY), "groups")
    rows = keyed.groupBy(KEY).agg(F.first("doc_id").cast("long").alias("doc_id"), F.count(F.lit(1)).alias("n"))
    rows = stage(rows, "rows")
    linked = groups.select(F.col("doc_id").alias(KEY), "component_id").distinct().join(rows, KEY)
    order = F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), KEY)
    # minima by partial sums, so that a large group is no hot spot
    keeper = linked.groupBy("component_id").agg(F.min(order).alias("keeper"), F.count(F.lit(1)).alias("rows"))
    keeper = keeper.where("rows > 1").select("component_id", F.col(f"keeper.{KEY}").alias("kept"))
    gone = linked.join(keeper, "component_id").where(f"{KEY} != kept").select(F.col(KEY).alias("doc_id"))
    repeated = stage(rows.where("n > 1").select(KEY), "repeated")
    single = scan.only_ids(keyed, repeated, KEY, "left_anti")
    return _without(single.unionByName(scan.only_ids(keyed, repeated, KEY).dropDuplicates([KEY])), gone)


def no_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark; decided by row, with or without an id."""
    keyed = _keyed(docs)
    named = keyed.select(F.col(KEY).alias("doc_id"), "text")
    return _without(keyed, decontaminate.leaks(named, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its fitted rate says."""
    return mixing.mix(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), MIX)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with the name of its shard."""
    return sharding.with_shard(docs)


STAGES = [
    ("quality_classifier", good_quality),
    ("ngram_jaccard_join", one_of_each),
    ("benchmark_decontamination", no_test_items),
    ("target_weights", mixed),
    ("sharding", sharded),
]

#: The learned stages cannot be told in SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
