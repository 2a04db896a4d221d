"""Sharding by extendible hashing, with DataFrame functions only.

A document's hash is 60 bits of an md5 of its id and text. A shard is a bucket of a hash prefix;
only a bucket over the byte limit is split on another bit. The directory maps every prefix to its
bucket. Sizes of all prefixes up to some depth come from one aggregation of the fine cells, so a
pass settles ``STEP_BITS`` bits at once; only rows of buckets that are still too large go on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.llm import scan
from weekloom.staging import stage

HASH_BITS = 60
STEP_BITS = 12
LIMIT_BYTES = 64 << 20


def document_hash() -> Column:
    """60 bits that any engine can compute: the first 15 hex digits of an md5."""
    text = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col("text"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def document_bytes() -> Column:
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")


def prefix(depth: int | Column, of: str = "__h") -> Column:
    """The first ``depth`` bits."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", F.col(of), (F.lit(HASH_BITS) - depth).cast("int"))


def directory(rows: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """For each pass its depth and its entries ``(cell, depth, size, n_docs)``.

    ``rows`` is a stored table with ``__h`` and ``__bytes``. An entry maps a prefix of the pass's
    depth to its bucket: the shallowest prefix of it whose bytes are within the limit. Prefixes
    that are too large even at that depth have no entry here but in the next pass, at 60 bits in
    any case. No rows give no entries.
    """
    levels = []
    cells, at = rows, 0
    while at < HASH_BITS:
        deep = min(at + STEP_BITS, HASH_BITS)
        fine = stage(cells.groupBy(prefix(deep).alias("cell")).agg(
            F.sum("__bytes").alias("bytes"), F.count(F.lit(1)).alias("n")), "cells")
        path = fine.withColumn("depth", F.explode(F.sequence(F.lit(at + 1 if at else 0), F.lit(deep))))
        path = path.withColumn("bits", F.call_function("shiftright", F.col("cell"), (F.lit(deep) - F.col("depth")).cast("int")))
        tree = path.groupBy("depth", "bits").agg(F.sum("bytes").alias("size"), F.sum("n").alias("n_docs"))
        fits = tree.where((F.col("size") <= limit) | (F.col("depth") == HASH_BITS))
        entries = path.select("cell", "depth", "bits").join(fits, ["depth", "bits"])
        first = F.min(F.struct("depth", "size", "n_docs")).alias("b")
        entries = stage(entries.groupBy("cell").agg(first).select("cell", "b.*"), "directory")
        levels.append((deep, entries))
        large = stage(fine.join(entries, "cell", "left_anti").select(F.col("cell").alias("__cell")), "large")
        if large.isEmpty():
            break
        cells = stage(scan.only_ids(cells.withColumn("__cell", prefix(deep)), large, "__cell").drop("__cell"), "open")
        at = deep
    return levels


def attach(df: DataFrame, levels: list[tuple[int, DataFrame]], limit: int) -> DataFrame:
    """``df``, which has ``__h`` and ``__bytes``, with ``__depth``, ``__bits`` and ``__page``.

    A row looks its prefix up pass by pass; a directory is a table of a few rows per shard, and
    Spark picks the join by its stored size. Rows of one hash that exceed the limit together are
    equal, so any order will do for their pages: a row's number is its place among the rows of
    its hash in its stored part, plus the rows of the parts before. No window holds more.
    """
    found = []
    for i, (level, entries) in enumerate(levels):
        side = entries.select(F.col("cell").alias("__cell"), F.struct("depth", "size", "n_docs").alias(f"__b{i}"))
        df = df.withColumn("__cell", prefix(level)).join(side, "__cell", "left").drop("__cell")
        found.append(f"__b{i}")
    none = F.struct(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("size"), F.lit(0).cast("long").alias("n_docs"))
    df = df.withColumn("__b", F.coalesce(*found, none)).drop(*found)
    df = df.withColumn("__depth", F.col("__b.depth")).withColumn("__bits", prefix(F.col("__depth")))
    crowd = f"__b.depth = {HASH_BITS} and __b.size > {limit} and __b.n_docs > 1"
    plain = df.where(f"not ({crowd})").drop("__b").withColumn("__page", F.lit(0))
    level, entries = levels[-1] if levels else (0, None)
    if level < HASH_BITS or entries.where(f"size > {limit} and n_docs > 1").isEmpty():
        return plain
    mine = df.where(crowd).drop("__b").withColumn("__part", F.spark_partition_id())
    mine = stage(mine.withColumn("__m", F.monotonically_increasing_id()), "crowded")
    parts = mine.groupBy("__h", "__part").agg(F.count(F.lit(1)).alias("n"), F.max("__bytes").alias("one"))
    of = Window.partitionBy("__h")
    skip = F.coalesce(F.sum("n").over(of.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    room = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.max("one").over(of), F.lit(1))))
    parts = parts.select("__h", "__part", skip.alias("__skip"), room.alias("__room"))
    place = F.row_number().over(Window.partitionBy("__h", "__part").orderBy("__m"))
    paged = mine.withColumn("__place", place).join(parts, ["__h", "__part"])
    paged = paged.withColumn("__page", F.floor((F.col("__skip") + F.col("__place") - 1) / F.col("__room")).cast("int"))
    return plain.unionByName(paged.select(*plain.columns))


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("__h", document_hash()).withColumn("__bytes", document_bytes())


def shards(docs: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """``(doc_id, bytes, depth, prefix, page)``: the shard of every row of ``docs``.

    A shard is named by ``depth`` and ``prefix``; ``page`` is 0 but for equal rows that exceed
    the limit together, which fill numbered pages. A row larger than the limit has a shard of its
    own once its prefix is unique. Null ids and texts hash as empty ones, a null or empty text
    has 0 bytes, repeated rows share a shard. Other columns are not read. No rows, no shards.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stage(_hashed(rows).drop("text"), "hashes")
    out = attach(rows, directory(rows, limit), limit)
    return out.select("doc_id", F.col("__bytes").alias("bytes"), F.col("__depth").alias("depth"),
                      F.col("__bits").alias("prefix"), F.col("__page").alias("page"))


def shard_name(depth: Column, bits: Column, page: Column) -> Column:
    """``root`` or the prefix in binary, with the page behind a dash unless it is 0."""
    name = F.when(depth == 0, F.lit("root")).otherwise(F.lpad(F.bin(bits), depth, "0"))
    return F.concat(name, F.when(page > 0, F.concat(F.lit("-"), page.cast("string"))).otherwise(F.lit("")))


def with_shard(docs: DataFrame, name: str = "shard", limit: int = LIMIT_BYTES) -> DataFrame:
    """``docs`` with all its columns and the name of its shard; ``name`` must be new."""
    if name in docs.columns:
        raise ValueError(f"a column named {name} is there already")
    rows = stage(_hashed(docs).select("__h", "__bytes"), "hashes")
    out = attach(_hashed(docs), directory(rows, limit), limit)
    return out.withColumn(name, shard_name(F.col("__depth"), F.col("__bits"), F.col("__page"))).select(*docs.columns, name)


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT_BYTES) -> DataFrame:
    """Write ``docs`` as one folder per shard below ``path``; returns the shards' rows and bytes."""
    with_shard(docs, "shard", limit).repartition("shard").write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.parquet(path).groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(document_bytes()).alias("bytes"))


SQL = """
WITH d AS (
  SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h,
         CAST(coalesce(strlen(text), 0) AS BIGINT) AS bytes
  FROM {documents}
),
tree AS (
  SELECT depth, h >> (60 - depth) AS prefix, sum(bytes) AS size
  FROM d, (SELECT CAST(unnest(range(0, 61)) AS INTEGER) AS depth) GROUP BY ALL
),
leaf AS (
  SELECT d.doc_id, d.h, d.bytes, min(t.depth) AS depth
  FROM (SELECT *, row_number() OVER () AS n FROM d) d JOIN tree t ON t.prefix = d.h >> (60 - t.depth)
  WHERE t.size <= {limit} OR t.depth = 60 GROUP BY d.n, d.doc_id, d.h, d.bytes
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY h) - 1 AS place,
         greatest(1, {limit} // greatest(max(bytes) OVER (PARTITION BY h), 1)) AS room,
         sum(bytes) OVER (PARTITION BY h) AS total
  FROM leaf
)
SELECT doc_id, bytes, depth, h >> (60 - depth) AS prefix,
       CAST(CASE WHEN depth = 60 AND total > {limit} THEN place // room ELSE 0 END AS INTEGER) AS page
FROM numbered
"""
