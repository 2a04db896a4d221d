"""Exact best split of a two-class table, over all distinct values, and losses of boosted rounds."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

from weekloom.staging import stage

CELLS = 256


def _counts(rows: DataFrame, columns: list[str], label: str) -> DataFrame:
    """(feature, v, n, pos): rows and positives per distinct value, one pass for all columns."""
    one = F.struct
    long = rows.select(F.col(label).cast("double").alias("y"), F.explode(F.array(*[
        one(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in columns])).alias("x"))
    return long.select("x.*", "y").dropna().groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))


def _celled(counts: DataFrame, columns: list[str], cells: int) -> DataFrame:
    """Each feature's values cut into ranges by a sketch, so that no window holds a whole feature."""
    parts = []
    for c in columns:
        own = counts.where(F.col("feature") == c)
        found = own.approxQuantile("v", [i / cells for i in range(1, cells)], 0.5 / cells) if cells > 1 else []
        splits = sorted(set(found))
        cut = Bucketizer(splits=[float("-inf"), *splits, float("inf")], inputCol="v", outputCol="cell")
        parts.append(cut.transform(own) if splits else own.withColumn("cell", F.lit(0.0)))
    return reduce(DataFrame.unionByName, parts)


def split_gains(rows: DataFrame, columns: list[str], label: str = "label", cells: int = CELLS) -> DataFrame:
    """(feature, threshold, gain, n_left, pos_left, n, pos) for every place between two distinct values.

    Rows are counted per distinct value; class counts left of a place are prefix sums inside
    value ranges plus the totals of earlier ranges (at most ``cells`` a feature). ``gain`` is the
    fall of the Gini impurity, ``threshold`` the middle of two neighbouring values: rows at or
    below it go left. Rows with a null or NaN label or value take no part in that feature.
    """
    celled = stage(_celled(stage(_counts(rows, columns, label), "values"), columns, cells), "cells")
    per = celled.groupBy("feature", "cell").agg(F.sum("n").alias("cn"), F.sum("pos").alias("cp"), F.min("v").alias("low"))
    before = Window.partitionBy("feature").orderBy("cell")  # at most one row a range
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("feature")
    offsets = per.select("feature", "cell", F.coalesce(F.sum("cn").over(earlier), F.lit(0)).alias("n0"),
                         F.coalesce(F.sum("cp").over(earlier), F.lit(0.0)).alias("p0"), F.lead("low").over(before).alias("after"),
                         F.sum("cn").over(whole).alias("total"), F.sum("cp").over(whole).alias("positives"))
    inside = Window.partitionBy("feature", "cell").orderBy("v")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    ranked = celled.select("feature", "cell", "v", F.lead("v").over(inside).alias("next"), F.sum("n").over(so_far).alias("rn"),
                           F.sum("pos").over(so_far).alias("rp"))
    placed = ranked.join(offsets, ["feature", "cell"]).select(
        "feature", ((F.col("v") + F.coalesce("next", "after")) / 2).alias("threshold"),
        (F.col("rn") + F.col("n0")).alias("n_left"), (F.col("rp") + F.col("p0")).alias("pos_left"),
        F.col("total").alias("n"), F.col("positives").alias("pos")).where("threshold is not null")
    gini = lambda pos, n: 2.0 * (pos / n) * (1.0 - pos / n)
    left, right = F.col("n_left") / F.col("n"), 1.0 - F.col("n_left") / F.col("n")
    gain = gini(F.col("pos"), F.col("n")) - left * gini(F.col("pos_left"), F.col("n_left")) - right * gini(
        F.col("pos") - F.col("pos_left"), F.col("n") - F.col("n_left"))
    return placed.withColumn("gain", gain)


def best_splits(rows: DataFrame, columns: list[str], label: str = "label", cells: int = CELLS) -> DataFrame:
    """The place of largest gain of every feature; the smallest threshold wins a tie.

    Gains are compared to 12 digits, so that the order of additions decides nothing. A feature
    with fewer than two values has no row.
    """
    best = F.max_by(F.struct("threshold", "gain", "n_left", "pos_left", "n", "pos"), F.struct(F.round("gain", 12), -F.col("threshold")))
    return split_gains(rows, columns, label, cells).groupBy("feature").agg(best.alias("b")).select("feature", "b.*")


def boosting_losses(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    """(round, loss, fell): mean loss after every round on ``rows``, and 1 unless it rose by over 1e-9.

    The loss is the one that the fit lowers: 2 ln(1 + exp(-2 y F)) with labels -1 and 1.
    """
    losses = [float(x) for x in model.evaluateEachIteration(rows)]
    table = [(i + 1, x, int(i == 0 or x <= losses[i - 1] + 1e-9)) for i, x in enumerate(losses)]
    return rows.sparkSession.createDataFrame(table, "round int, loss double, fell int")
