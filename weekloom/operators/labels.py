"""Time split, label threshold and HIGH/LOW label."""

from __future__ import annotations

from math import isfinite

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F

from weekloom import constants as K
from weekloom.operators.calendar import Date, to_date
from weekloom.roles import Roles
from weekloom.staging import stage


def is_train(cut: Date, roles: Roles = Roles()) -> Column:
    """True for weeks that start before the cut. Compares the week start only."""
    return F.col(roles.week) < F.lit(to_date(cut))


def time_split(features: DataFrame, cut: Date, roles: Roles = Roles()) -> tuple[DataFrame, DataFrame]:
    """(train, test): weeks starting before the cut, and the others."""
    before = is_train(cut, roles)
    return features.where(before), features.where(~before)


def sketch_threshold(
    train: DataFrame, column: str = "wd", q: float = 0.5, error: float = K.THRESHOLD_ERROR
) -> float:
    """Quantile from a mergeable sketch; one pass, one number back."""
    return train.approxQuantile(column, [q], error)[0]


def exact_threshold(train: DataFrame, column: str = "wd", q: float = 0.5, cells: int = 256) -> float | None:
    """The smallest value with at least a share ``q`` of the rows at or below it.

    The rows are counted per distinct value, once; the counts are staged. Each pass splits
    the remaining values into ``cells`` by a sketch, adds up the counts of every cell, and
    keeps the cell that holds the wanted rank. Values equal to a split point are counted
    apart and leave the range, so every pass answers or shrinks it. The driver sees only
    split points and counts, whatever the size. Nulls and NaN are ignored.
    """
    values = train.select(F.col(column).cast("double").alias("v")).dropna()
    left = stage(values.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "values")
    total = left.agg(F.sum("n")).first()[0]
    if not total:
        return None
    rank = max(1, -int(-q * total // 1))  # 1-based
    probs = [i / cells for i in range(1, cells)]
    while True:
        splits = [x for x in sorted(set(left.approxQuantile("v", probs, 0.5 / cells))) if isfinite(x)]
        if not splits:  # infinities only
            ends = left.orderBy("v").limit(2).collect()
            return ends[0]["v"] if rank <= ends[0]["n"] else ends[1]["v"]
        ranged = Bucketizer(
            splits=[float("-inf"), *splits, float("inf")], inputCol="v", outputCol="b"
        ).transform(left)
        # cell b starts at split b: even = rows equal to it, odd = rows between it and the next
        at_split = F.when(F.col("b") > 0, F.element_at(F.lit(splits), F.col("b").cast("int")))
        cell = 2 * F.col("b") + F.when(at_split == F.col("v"), 0).otherwise(1)
        counts = dict(ranged.groupBy(cell.cast("int").alias("cell")).agg(F.sum("n")).collect())
        for c in sorted(counts):
            if rank <= counts[c]:
                break
            rank -= counts[c]
        b = c // 2
        if c % 2 == 0:
            return splits[b - 1]
        if b > 0:
            left = left.where(F.col("v") > splits[b - 1])
        if b < len(splits):
            left = left.where(F.col("v") < splits[b])


def label_high(features: DataFrame, threshold: float, column: str = "wd", name: str = "label") -> DataFrame:
    """1.0 where ``column`` is strictly above the threshold, else 0.0."""
    return features.withColumn(name, (F.col(column) > F.lit(threshold)).cast("double"))


def persistence(labelled: DataFrame, threshold: float, column: str = "lag1_wd") -> DataFrame:
    """Naive prediction: last week's class, by the same threshold."""
    return label_high(labelled, threshold, column, "prediction")


def split_stats(labelled: DataFrame, cut: Date, roles: Roles = Roles()) -> DataFrame:
    """Rows, HIGH rows and HIGH share of train and test, in one aggregation."""
    part = F.when(is_train(cut, roles), F.lit("train")).otherwise(F.lit("test"))
    return labelled.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("label").cast("bigint").alias("n_high"),
        F.avg("label").alias("high_share"),
    )
