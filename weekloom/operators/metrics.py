"""Classifier and cluster measures, all as DataFrames.

Everything that follows a confusion table is plain arithmetic on its one row, so a
model costs one pass over its predictions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.ml.feature import Bucketizer

from weekloom.staging import stage
from weekloom.functions import safe_ratio


def _cells(label: Column, predicted: Column) -> dict[str, Column]:
    return {
        "TN": F.count_if((label == 0) & (predicted == 0)),
        "FP": F.count_if((label == 0) & (predicted == 1)),
        "FN": F.count_if((label == 1) & (predicted == 0)),
        "TP": F.count_if((label == 1) & (predicted == 1)),
    }


def confusion(predictions: DataFrame, label: str = "label", predicted: str = "prediction") -> DataFrame:
    """One row TN, FP, FN, TP; pairs that do not occur count 0."""
    cells = _cells(F.col(label), F.col(predicted))
    return predictions.agg(*[expr.alias(name) for name, expr in cells.items()])


def class_metrics(conf: DataFrame) -> DataFrame:
    """Add accuracy, support-weighted precision / recall / F1 and HIGH-class measures.

    A class that is never predicted has precision 0; F1 follows.
    """
    zero = lambda ratio: F.coalesce(ratio, F.lit(0.0))
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("TN", "FP", "FN", "TP"))
    n = tn + fp + fn + tp
    low_share, high_share = safe_ratio(tn + fp, n), safe_ratio(tp + fn, n)
    low_p, high_p = zero(safe_ratio(tn, tn + fn)), zero(safe_ratio(tp, tp + fp))
    low_r, high_r = zero(safe_ratio(tn, tn + fp)), zero(safe_ratio(tp, tp + fn))
    f1 = lambda p, r: zero(safe_ratio(2 * p * r, p + r))
    return conf.select(
        "*",
        safe_ratio(tn + tp, n).alias("accuracy"),
        (low_share * low_p + high_share * high_p).alias("precision"),
        (low_share * low_r + high_share * high_r).alias("recall"),
        (low_share * f1(low_p, low_r) + high_share * f1(high_p, high_r)).alias("f1"),
        high_p.alias("high_precision"),
        high_r.alias("high_recall"),
        (1 - safe_ratio(tp, tp + fn)).alias("high_miss_rate"),
    )


def threshold_sweep(
    scored: DataFrame, score: str, thresholds: Iterable[float], label: str = "label"
) -> DataFrame:
    """Confusion counts of ``score > t`` for every t, from one pass over the rows."""
    cuts = list(thresholds)
    rows = []
    for t in cuts:
        cells = _cells(F.col(label), (F.col(score) > F.lit(t)).cast("int"))
        rows.append(F.struct(F.lit(float(t)).alias("threshold"), *[e.alias(n) for n, e in cells.items()]))
    return scored.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def roc_auc(
    scored: DataFrame, score: str, label: str = "label", cells: int | None = None
) -> DataFrame:
    """Exact area under the ROC curve: one row n_pos, n_neg, auc (ties count half).

    Rows are first counted per distinct score, so a score held by many rows is one
    row. Distinct scores are put into value ranges taken from a sketch; a window adds
    up positives inside a range, and the ranges' totals (one row each) are combined at
    the end. No window sees more than one range, so no task sees the whole table.
    """
    rows = scored.select(F.col(score).cast("double").alias("s"), F.col(label).cast("bigint").alias("y")).dropna()
    n_cells = cells or 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    probs = [i / n_cells for i in range(1, n_cells)]
    cuts = sorted(set(rows.approxQuantile("s", probs, 0.5 / n_cells))) if probs else []
    per_score = rows.groupBy("s").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    ranged = Bucketizer(
        splits=[float("-inf"), *cuts, float("inf")] if cuts else [float("-inf"), 0.0, float("inf")],
        inputCol="s",
        outputCol="cell",
    ).transform(per_score)

    higher = Window.partitionBy("cell").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, -1)
    pos_above = F.coalesce(F.sum("pos").over(higher), F.lit(0))
    pairs = F.col("neg").cast("double") * (pos_above + F.col("pos") / 2)
    per_cell = (
        ranged.select("cell", "pos", "neg", pairs.alias("won"))
        .groupBy("cell")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("won").alias("won"))
    )
    # at most n_cells + 1 rows from here on
    later = Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    across = F.col("neg").cast("double") * F.coalesce(F.sum("pos").over(later), F.lit(0))
    return (
        per_cell.select("pos", "neg", (F.col("won") + across).alias("won"))
        .agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum("won").alias("won"))
        .select("n_pos", "n_neg", safe_ratio(F.col("won"), F.col("n_pos").cast("double") * F.col("n_neg")).alias("auc"))
    )


def curve_areas(scored: DataFrame, score: str, label: str = "label", bins: int = 1000, cells: int | None = None) -> DataFrame:
    """One row n_pos, n_neg, n_scores, auc and binned_auc, both from one staged count per distinct score.

    The binned curve joins ceil(n_scores / bins) neighbouring scores to one point, highest first, so it has
    at most ``bins`` points; with as many bins as scores it is the exact curve. Scores get their rank from
    their value range's offset and their place in the range, so no window sees more than one range.
    NULL areas if a class is absent; rows with a null or NaN score or label take no part.
    """
    rows = scored.select(F.col(score).cast("double").alias("s"), F.col(label).cast("bigint").alias("y")).dropna()
    counts = stage(rows.groupBy("s").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")), "scores")
    n_cells = cells or 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(counts.approxQuantile("s", [i / n_cells for i in range(1, n_cells)], 0.5 / n_cells))) if n_cells > 1 else []
    ranged = Bucketizer(splits=[float("-inf"), *(cuts or [0.0]), float("inf")], inputCol="s", outputCol="cell").transform(counts)
    per = ranged.groupBy("cell").agg(F.count(F.lit(1)).alias("m"), F.sum("pos").alias("cp"))
    above = Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = per.select("cell", F.coalesce(F.sum("m").over(above), F.lit(0)).alias("m0"), F.coalesce(F.sum("cp").over(above), F.lit(0)).alias("p0"),
                         F.sum("m").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("cell").orderBy(F.desc("s"))
    placed = ranged.select("cell", "pos", "neg", F.row_number().over(inside).alias("k"),
                           F.coalesce(F.sum("pos").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("higher")).join(offsets, "cell")
    size = F.ceil(F.col("total") / F.lit(bins))
    won = F.col("neg").cast("double") * (F.col("p0") + F.col("higher") + F.col("pos") / 2)
    points = placed.select(F.floor((F.col("m0") + F.col("k") - 1) / size).alias("bin"), "pos", "neg", won.alias("won"))
    points = points.groupBy("bin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("won").alias("won"), F.count(F.lit(1)).alias("m"))
    earlier = F.coalesce(F.sum("pos").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a bin
    points = points.withColumn("binned", F.col("neg").cast("double") * (earlier + F.col("pos") / 2))
    one = points.agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum("m").alias("n_scores"), F.sum("won").alias("won"), F.sum("binned").alias("binned"))
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return one.select("n_pos", "n_neg", "n_scores", safe_ratio(F.col("won"), pairs).alias("auc"), safe_ratio(F.col("binned"), pairs).alias("binned_auc"))


# ---- clusters -------------------------------------------------------------------


def squared_distance(columns: list[str], center: list[float]) -> Column:
    """Squared Euclidean distance of the row to a fixed point."""
    total = F.lit(0.0)
    for c, x in zip(columns, center):
        gap = F.col(c) - F.lit(float(x))
        total = total + gap * gap
    return total


def cluster_sse(assigned: DataFrame, columns: list[str], centers: list[list[float]]) -> DataFrame:
    """Sum over rows of the squared distance to the nearest center."""
    nearest = F.array_min(F.array(*[squared_distance(columns, c) for c in centers]))
    return assigned.agg(F.sum(nearest).alias("wssse"))


def silhouette(assigned: DataFrame, columns: list[str], cluster: str = "prediction") -> DataFrame:
    """Mean silhouette with squared Euclidean distance, in O(rows x clusters).

    The mean squared distance of a point to a cluster needs only the cluster's size,
    its coordinate sums and its sum of squared norms. These few numbers per cluster
    (k rows) are read back and become constants of the second pass. A cluster with one
    member scores 0, and so does a clustering with fewer than two clusters.
    """
    norm = sum((F.col(c) * F.col(c) for c in columns[1:]), F.col(columns[0]) * F.col(columns[0]))
    stats = assigned.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(norm).alias("q"),
        *[F.sum(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).collect()

    def mean_distance(row) -> Column:
        dot = sum((F.col(c) * F.lit(row[f"s{i}"]) for i, c in enumerate(columns)), F.lit(0.0))
        return norm + F.lit(row["q"] / row["n"]) - 2 * dot / F.lit(float(row["n"]))

    score = F.lit(0.0)
    for own in stats:
        others = [mean_distance(r) for r in stats if r[cluster] != own[cluster]]
        if not others or own["n"] == 1:
            continue
        a = mean_distance(own) * F.lit(own["n"] / (own["n"] - 1))
        b = F.array_min(F.array(*others))
        value = F.coalesce(safe_ratio(b - a, F.greatest(a, b)), F.lit(0.0))
        score = F.when(F.col(cluster) == own[cluster], value).otherwise(score)
    return assigned.agg(F.avg(score).alias("silhouette"), F.count(F.lit(1)).alias("n_rows"))
