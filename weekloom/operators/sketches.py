"""Stored sketches that are merged later: distinct counts and quantiles per part of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weekloom.staging import stage

#: HyperLogLog: 2 ** 14 registers, a relative standard error of 1.04 / 128 = 0.8 %; three of it are allowed.
DISTINCT_BITS = 14
DISTINCT_ERROR = 3 * 1.04 / 2 ** (DISTINCT_BITS / 2)
#: KLL: size 1000, a rank error of about 0.3 % of the rows; 1 % is allowed.
QUANTILE_SIZE = 1000
RANK_ERROR = 0.01


def stored_distinct(rows: DataFrame, part: Column, column: str, bits: int = DISTINCT_BITS) -> DataFrame:
    """(part, sketch): one stored sketch of the distinct values of ``column`` for each part. Nulls do not count."""
    return stage(rows.groupBy(part.alias("part")).agg(F.hll_sketch_agg(column, bits).alias("sketch")), "distinct-sketches")


def merged_distinct(sketches: DataFrame) -> DataFrame:
    """n_distinct over all parts, from their sketches alone; sketches overlap freely. No parts give 0."""
    return sketches.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).cast("long").alias("n_distinct"))


def distinct_check(sketches: DataFrame, exact: DataFrame, error: float = DISTINCT_ERROR) -> DataFrame:
    """The exact number, and 1 if the merged estimate is within the relative error of it. Two one-row tables."""
    both = exact.select(F.col("n_entities").alias("n_exact"), merged_distinct(sketches).scalar().alias("n_distinct"))
    near = F.abs(F.col("n_distinct") - F.col("n_exact")) <= F.lit(error) * F.col("n_exact")
    return both.select("n_exact", near.cast("int").alias("within_error"))


def stored_quantiles(rows: DataFrame, part: Column, column: str, size: int = QUANTILE_SIZE) -> DataFrame:
    """(part, sketch): one stored quantile sketch of ``column`` for each part. Nulls do not count."""
    value = F.col(column).cast("double")
    return stage(rows.groupBy(part.alias("part")).agg(F.kll_sketch_agg_double(value, F.lit(size)).alias("sketch")), "quantile-sketches")


def merged_quantiles(sketches: DataFrame, shares: tuple[float, ...]) -> DataFrame:
    """(q, value): quantiles over all parts, from their sketches alone."""
    merged = sketches.agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select(F.explode(F.array(*[F.struct(F.lit(q).alias("q"), F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias("value"))
                                             for q in shares])).alias("x")).select("x.*")


def quantile_check(rows: DataFrame, sketches: DataFrame, column: str, shares: tuple[float, ...], error: float = RANK_ERROR) -> DataFrame:
    """(q, n_rows, within_error): 1 if the share of rows at or below each merged quantile is within ``error`` of q.

    A value that many rows share covers a range of ranks; the nearest end counts.
    """
    found = merged_quantiles(sketches, shares).collect()
    row = rows.select(F.col(column).cast("double").alias("v")).where("v is not null").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("v") <= r["value"]).alias(f"le{i}") for i, r in enumerate(found)],
        *[F.count_if(F.col("v") < r["value"]).alias(f"lt{i}") for i, r in enumerate(found)]).first()
    gap = lambda i, q: max(0.0, row[f"lt{i}"] / row["n"] - q, q - row[f"le{i}"] / row["n"])
    table = [(r["q"], row["n"], int(gap(i, r["q"]) <= error)) for i, r in enumerate(found)] if row["n"] else []
    return rows.sparkSession.createDataFrame(table, "q double, n_rows long, within_error int")
