"""Daily tables and result tables on storage. Nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from weekloom.roles import Roles


def read_panel(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    fmt: str = "csv",
    roles: Roles = Roles(),
    date_format: str = "yyyy-MM-dd",
    infer: bool = False,
) -> DataFrame:
    """A daily table. The schema is declared; ``infer`` reads it from the file instead."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(header=True, dateFormat=date_format)
        if infer:
            return reader.options(inferSchema=True).load(path)
    if fmt == "csv" or schema is not None:
        reader = reader.schema(schema or roles.schema())
    return reader.load(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Write every partition from its task; CSV files carry a header."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.options(header=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, fmt: str = "csv"
) -> DataFrame:
    """Read a result table back."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(header=True, inferSchema=schema is None)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
