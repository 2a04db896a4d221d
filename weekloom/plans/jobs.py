"""The two whole jobs on a daily table: weekly demand classes and demand tiers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from weekloom.operators import classify, cluster, features, labels, metrics, report, rollup
from weekloom.operators.calendar import Date
from weekloom.operators.labels import is_train
from weekloom.operators.profile import entity_profile
from weekloom.roles import Roles
from weekloom.sources.metrics_json import ENTRY, sweep_document, write_metrics
from weekloom.sources.tables import write_table
from weekloom.staging import stage

BASELINE = "Baseline (last week's class)"


@dataclass(frozen=True)
class Classification:
    scores: DataFrame  # one row per model and the baseline
    importances: DataFrame  # forest weights
    document: DataFrame  # everything in one nested row


@dataclass(frozen=True)
class Segmentation:
    sweep: DataFrame
    algorithms: DataFrame
    tiered: DataFrame
    summary: DataFrame
    mix: DataFrame
    projection: DataFrame
    document: DataFrame


def row_counts(features_table: DataFrame, daily: DataFrame, cut: Date, roles: Roles = Roles()) -> dict:
    """Rows of train, test, the weekly table and the daily table, and the test HIGH share."""
    train = is_train(cut, roles)
    one = features_table.agg(
        F.count_if(train).alias("train_rows"),
        F.count_if(~train).alias("test_rows"),
        F.count(F.lit(1)).alias("weekly_rows"),
        F.avg(F.when(~train, F.col("label"))).alias("test_high_share"),
    ).first()
    return {**one.asDict(), "daily_rows": daily.count()}


def classify_demand(
    panel: DataFrame,
    cut: Date,
    out: str | None = None,
    models: dict[str, classify.Entry] | None = None,
    roles: Roles = Roles(),
) -> Classification:
    """Roll up, build features, label by the training median, compare models and baseline."""
    spark = panel.sparkSession
    models = classify.default_models() if models is None else models
    table = stage(features.weekly_features(rollup.weekly_rollup(panel, roles), roles), "features")
    threshold = labels.sketch_threshold(labels.time_split(table, cut, roles)[0])
    table = labels.label_high(table, threshold)
    train, test = labels.time_split(table, cut, roles)

    scores, fitted = classify.compare_models(train, test, models, roles)
    naive = metrics.class_metrics(metrics.confusion(labels.persistence(test, threshold)))
    baseline = naive.select(F.lit(BASELINE).alias("model"), "accuracy", "f1")
    best = classify.best_model(scores, list(models)).first()
    conf = best["confusion"]
    counts = row_counts(table, panel, cut, roles)
    importances = (
        classify.feature_importance(fitted[classify.FOREST], features.NUMERIC)
        if classify.FOREST in fitted
        else None
    )

    per = lambda hit, miss: hit / (hit + miss) if hit + miss else 0.0
    meta = {
        "best_model": best["model"],
        "high_class_recall": per(conf["TP"], conf["FN"]),
        "high_class_precision": per(conf["TP"], conf["FP"]),
        "threshold_per_week": threshold,
        **counts,
        "split": str(cut),
    }
    rows = report.append_baseline(scores, baseline)
    entry = F.struct(*[f.name for f in ENTRY.fields])
    document = rows.agg(F.map_from_entries(F.collect_list(F.struct("model", entry))).alias("models"))
    document = document.withColumn("_meta", F.struct(*[F.lit(v).alias(k) for k, v in meta.items()]))
    if importances is not None:
        weights = importances.select("rank", "feature", "importance").agg(
            F.array_sort(F.collect_list(F.struct("rank", "feature", "importance"))).alias("feature_importance")
        )
        document = document.withColumn("feature_importance", weights.scalar())
    if out:
        write_metrics(document, f"{out}/classification_results")
    return Classification(rows, importances, document)


def segment_demand(
    panel: DataFrame,
    out: str | None = None,
    ks=range(2, 8),
    log: bool = True,
    roles: Roles = Roles(),
) -> Segmentation:
    """Profile every entity, sweep k, cluster into named tiers, summarise and project."""
    profiles = stage(entity_profile(panel, roles), "profile")
    frame = cluster.cluster_frame(profiles, log, roles).persist()
    sweep = cluster.kmeans_sweep(frame, ks)
    algorithms = cluster.compare_algorithms(frame)
    tiered = cluster.demand_tiers(frame).persist()
    summary = report.tier_summary(tiered)
    mix = report.tier_mix(tiered, roles=roles)
    projection, explained = cluster.pca_projection(tiered)

    # each part is one row of k or segment entries
    as_list = lambda df: df.agg(F.collect_list(F.struct(*df.columns)))
    silhouettes = algorithms.agg(F.map_from_entries(F.collect_list(F.struct("algorithm", "silhouette"))))
    document = sweep_document(sweep).withColumns(
        {
            "algorithm_comparison_silhouette": silhouettes.scalar(),
            "profile": as_list(summary).scalar(),
            "segment_mix": as_list(mix).scalar(),
            "pca_explained_variance": F.lit(explained),
            "n_entities": F.lit(profiles.count()),
        }
    )
    if out:
        write_table(cluster.assignments(tiered, roles), f"{out}/entity_tiers", "csv")
        write_table(summary, f"{out}/tier_profile", "csv")
        write_table(mix, f"{out}/tier_segment_mix", "csv")
        write_metrics(document, f"{out}/clustering_results")
    return Segmentation(sweep, algorithms, tiered, summary, mix, projection, document)
