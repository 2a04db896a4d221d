"""Category encoding, scaling and vector assembly: MLlib stages and column forms."""

from __future__ import annotations

from pyspark.ml.feature import (
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import DataFrame, Window, functions as F

from weekloom.functions import prefixed
from weekloom.operators.features import NUMERIC
from weekloom.roles import Roles

#: Categories that may be sent to every task: a name and a number each, a few MB together.
BROADCAST_ROWS = 100_000


def category_index(df: DataFrame, column: str, index: str = "loc_idx") -> DataFrame:
    """One row per category: rows and index by descending frequency, ties alphabetical.

    Rows are counted before they are ranked; the ranking sees one row per category.
    """
    order = Window.orderBy(F.desc("n_rows"), column)
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn(index, (F.row_number().over(order) - 1).cast("double"))
    )


def with_category_index(df: DataFrame, categories: DataFrame, column: str, index: str = "loc_idx") -> DataFrame:
    """Attach the index. Spark picks the join by the measured size of ``categories``."""
    return df.join(categories.select(column, index), column, "left")


def checked_category_index(
    df: DataFrame, categories: DataFrame, column: str, index: str = "loc_idx", most: int = BROADCAST_ROWS
) -> DataFrame:
    """Attach the index; a row whose category is null or not in ``categories`` raises when it is read.

    ``categories`` has one row per category. It is counted first: up to ``most`` rows go to every
    task, so that the rows of ``df`` stay where they are; beyond that Spark chooses the join.
    """
    side = categories.select(column, index)
    known = F.broadcast(side) if side.count() <= most else side
    unseen = F.raise_error(F.concat(F.lit(f"unseen {column}: "), F.coalesce(F.col(column).cast("string"), F.lit("NULL"))))
    return df.join(known, column, "left").withColumn(index, F.coalesce(F.col(index), unseen.cast("double")))


def one_hot_columns(df: DataFrame, n: int, index: str = "loc_idx", prefix: str = "loc_") -> DataFrame:
    """``n - 1`` 0/1 columns; the last (rarest) category is all zeros."""
    return df.withColumns({f"{prefix}{i}": (F.col(index) == i).cast("int") for i in range(n - 1)})


def category_names(categories: DataFrame, column: str, index: str = "loc_idx", prefix: str = "loc_") -> DataFrame:
    """Position and display name of the one-hot columns (all but the last category)."""
    top = categories.agg(F.max(index)).first()[0]
    return categories.where(F.col(index) < F.lit(top)).select(
        F.col(index).cast("int").alias("pos"), prefixed(F.col(column), prefix).alias("feature")
    )


def column_moments(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and sample deviation per column, from one aggregation."""
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}


def scale_columns(
    df: DataFrame,
    moments: dict[str, tuple[float, float]],
    center: bool = False,
    suffix: str = "_scaled",
) -> DataFrame:
    """Divide by the deviation, after centring if asked; a constant column becomes 0."""
    out = {}
    for c, (mean, std) in moments.items():
        shifted = F.col(c) - F.lit(mean) if center else F.col(c)
        out[c + suffix] = shifted / F.lit(std) if std else F.lit(0.0)
    return df.withColumns(out)


def log_columns(df: DataFrame, columns: list[str], prefix: str = "log_") -> DataFrame:
    """log(1 + x) of every listed column."""
    return df.withColumns({prefix + c: F.log1p(c) for c in columns})


def encoding_stages(roles: Roles = Roles(), numeric: list[str] = NUMERIC) -> list:
    """Index, one-hot and assemble into ``raw``; an unseen category is an error."""
    return [
        StringIndexer(inputCol=roles.segment, outputCol="loc_idx"),
        OneHotEncoder(inputCols=["loc_idx"], outputCols=["loc_vec"], dropLast=True),
        VectorAssembler(inputCols=[*numeric, "loc_vec"], outputCol="raw"),
    ]


def unit_std_stage() -> StandardScaler:
    """Scale ``raw`` to unit deviation without centring."""
    return StandardScaler(inputCol="raw", outputCol="features", withMean=False, withStd=True)


def standardise(df: DataFrame, columns: list[str], output: str = "features") -> DataFrame:
    """Centred, unit-deviation vector of the columns."""
    raw = VectorAssembler(inputCols=columns, outputCol="raw").transform(df)
    scaler = StandardScaler(inputCol="raw", outputCol=output, withMean=True, withStd=True)
    return scaler.fit(raw).transform(raw)
