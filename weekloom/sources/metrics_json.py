"""Nested metrics as JSON, and back as one row per model or per k."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weekloom.roles import CONFUSION

ENTRY = T.StructType(
    [
        *[T.StructField(m, T.DoubleType()) for m in ("accuracy", "precision", "recall", "f1", "auc")],
        T.StructField("confusion", CONFUSION),
    ]
)
BY_K = T.StructType([T.StructField("wssse", T.DoubleType()), T.StructField("silhouette", T.DoubleType())])


def write_metrics(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per row, structs, maps and arrays nested."""
    df.write.mode(mode).json(path)


def models_document(metrics: DataFrame) -> DataFrame:
    """Model rows as one row with a map model -> measures (a few rows in)."""
    entry = F.struct(*[F.col(f.name) for f in ENTRY.fields])
    return metrics.agg(F.map_from_entries(F.collect_list(F.struct("model", entry))).alias("models"))


def sweep_document(sweep: DataFrame) -> DataFrame:
    """k rows as one row with a map k -> measures."""
    entry = F.struct("wssse", "silhouette")
    pairs = F.collect_list(F.struct(F.col("k").cast("string"), entry))
    return sweep.agg(F.map_from_entries(pairs).alias("k_selection"))


def write_published(document: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A one-row models document as one JSON object in the published layout: each model at the top, beside ``_meta``."""
    rest = [c for c in document.columns if c != "models"]
    pairs = F.transform(F.map_entries("models"), lambda e: F.struct(e["key"].alias("key"), F.to_json(e["value"]).alias("value")))
    others = [F.struct(F.lit(c).alias("key"), F.to_json(F.col(c)).alias("value")) for c in rest]
    members = F.concat(pairs, F.array(*others)) if others else pairs
    listed = lambda key: F.to_json(F.array(key))
    # a name as JSON text is that of a list of one without its brackets
    text = lambda key: F.substr(listed(key), F.lit(2), F.length(listed(key)) - 2)
    line = F.array_join(F.transform(members, lambda m: F.concat(text(m["key"]), F.lit(":"), m["value"])), ",")
    document.select(F.concat(F.lit("{"), line, F.lit("}")).alias("value")).coalesce(1).write.mode(mode).text(path)


def _members(spark: SparkSession, path: str) -> DataFrame:
    """``(name, body)``: the members of the one document at ``path``, each body still JSON."""
    document = spark.read.text(path, wholetext=True).where("trim(value) != ''")
    return document.select(F.explode(F.from_json("value", "map<string,string>")).alias("name", "body"))


def read_models(spark: SparkSession, path: str) -> DataFrame:
    """One row per model of a models document, confusion counts as columns.

    Models stand under ``models`` or at the top, beside ``_meta``. A document without any raises.
    """
    top = _members(spark, path)
    inner = top.where("name = 'models'").select(
        F.explode(F.from_json("body", "map<string,string>")).alias("name", "body")
    )
    rows = top.where("name != 'models' and not startswith(name, '_')").unionByName(inner)
    rows = rows.select(F.col("name").alias("model"), F.from_json("body", ENTRY).alias("m"))
    rows = rows.where("m.accuracy is not null")
    if rows.isEmpty():
        raise ValueError(f"no model in {path}")
    return rows.select("model", "m.accuracy", "m.precision", "m.recall", "m.f1", "m.auc", "m.confusion.*")


def read_meta(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The ``_meta`` member of a document as one row of ``schema``; no row if there is none."""
    meta = _members(spark, path).where("name = '_meta'")
    return meta.select(F.from_json("body", schema).alias("m")).select("m.*")


def read_sweep(spark: SparkSession, path: str) -> DataFrame:
    """One row per k of a sweep document."""
    schema = T.StructType([T.StructField("k_selection", T.MapType(T.StringType(), BY_K))])
    return (
        spark.read.schema(schema)
        .json(path, multiLine=True)
        .select(F.explode("k_selection").alias("k", "m"))
        .select(F.col("k").cast("int").alias("k"), "m.wssse", "m.silhouette")
    )
