"""Cluster entity profiles and name the clusters as ordered tiers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from weekloom import constants as K
from weekloom.operators.classify import pinned
from weekloom.operators.encode import log_columns, standardise
from weekloom.operators.metrics import squared_distance
from weekloom.operators.profile import PROFILE
from weekloom.roles import Roles

VOLUME = ["avg_daily_wd", "p90_daily_wd", "avg_daily_tx"]


def cluster_frame(profile: DataFrame, log: bool = True, roles: Roles = Roles()) -> DataFrame:
    """Profiles with the standardised volume vector ``features``, in a pinned layout."""
    rows = pinned(profile, [roles.entity])
    if not log:
        return standardise(rows, VOLUME)
    return standardise(log_columns(rows, VOLUME), [f"log_{c}" for c in VOLUME])


def kmeans(k: int = 3, seed: int = K.CLUSTER_SEED, max_iter: int = K.MAX_ITER) -> KMeans:
    return KMeans(k=k, seed=seed, maxIter=max_iter, initMode="k-means||")


def mean_silhouette(assigned: DataFrame) -> float | None:
    """Silhouette with squared distance; None if all rows share one cluster."""
    if assigned.select("prediction").distinct().limit(2).count() < 2:
        return None
    evaluator = ClusteringEvaluator(
        featuresCol="features", metricName="silhouette", distanceMeasure="squaredEuclidean"
    )
    return evaluator.evaluate(assigned.select("features", "prediction"))


def kmeans_sweep(frame: DataFrame, ks: Iterable[int] = range(2, 8)) -> DataFrame:
    """k, within-cluster SSE and silhouette for every k."""
    rows = []
    for k in ks:
        model = kmeans(k).fit(frame)
        rows.append((k, model.summary.trainingCost, mean_silhouette(model.transform(frame))))
    return frame.sparkSession.createDataFrame(rows, "k int, wssse double, silhouette double")


def compare_algorithms(frame: DataFrame, k: int = 3, bisecting: bool = False) -> DataFrame:
    """Silhouette of K-Means and a Gaussian mixture (and bisecting K-Means if asked)."""
    candidates = {
        f"K-Means (k={k})": kmeans(k),
        f"Gaussian Mixture (k={k})": GaussianMixture(k=k, seed=K.CLUSTER_SEED),
    }
    if bisecting:
        candidates[f"Bisecting K-Means (k={k})"] = BisectingKMeans(k=k, seed=K.CLUSTER_SEED, maxIter=K.MAX_ITER)
    rows = [(name, mean_silhouette(est.fit(frame).transform(frame))) for name, est in candidates.items()]
    return frame.sparkSession.createDataFrame(rows, "algorithm string, silhouette double")


def nearest_center(df: DataFrame, columns: list[str], centers: list[list[float]]) -> DataFrame:
    """Assign every row to its nearest fixed center; the lower id wins a tie."""
    options = [
        F.struct(squared_distance(columns, c).alias("d"), F.lit(i).alias("id"))
        for i, c in enumerate(centers)
    ]
    return df.withColumn("prediction", F.array_min(F.array(*options))["id"])


def tier_names(
    assigned: DataFrame,
    names: Iterable[str] = K.TIERS,
    metric: str = "avg_daily_wd",
    cluster: str = "prediction",
) -> DataFrame:
    """One row per cluster: mean of the ranking metric, tier rank and tier name.

    The ranking window sees one row per cluster.
    """
    means = assigned.groupBy(cluster).agg(F.avg(metric).alias("mean_metric"))
    rank = F.row_number().over(Window.orderBy("mean_metric", cluster))
    return means.select(cluster, "mean_metric", rank.alias("tier_rank")).withColumn(
        "demand_tier", F.element_at(F.lit(list(names)), F.col("tier_rank"))
    )


def assign_tiers(assigned: DataFrame, tiers: DataFrame, cluster: str = "prediction") -> DataFrame:
    """Attach the tier by cluster id. ``tiers`` has one row per cluster, so it is broadcast."""
    return assigned.join(F.broadcast(tiers.select(cluster, "tier_rank", "demand_tier")), cluster)


def demand_tiers(frame: DataFrame, k: int = 3, names: Iterable[str] = K.TIERS) -> DataFrame:
    """Fit K-Means and name its clusters by ascending mean demand, one name for each cluster."""
    names = list(names)
    if len(names) != k:
        raise ValueError(f"{k} clusters need {k} names, not {len(names)}")
    assigned = kmeans(k).fit(frame).transform(frame)
    return assign_tiers(assigned, tier_names(assigned, names))


def assignments(tiered: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """entity, segment, tier and the nine profile measures."""
    return tiered.select(roles.entity, roles.segment, "demand_tier", *PROFILE)


def pca_projection(frame: DataFrame, k: int = 2) -> tuple[DataFrame, list[float]]:
    """Rows with components pc1..pck, and the explained-variance ratios."""
    model = PCA(k=k, inputCol="features", outputCol="pc").fit(frame)
    parts = vector_to_array("pc")
    rows = model.transform(frame).withColumns({f"pc{i + 1}": parts[i] for i in range(k)})
    return rows.drop("pc"), [float(v) for v in model.explainedVariance.toArray()]
