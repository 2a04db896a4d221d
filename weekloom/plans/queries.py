"""Registered queries over the star-schema tables, one per operator or operator group.

Panel: supplier x day from line items (see ``sources.star_schema``). Rounding is for
display only, after all computation.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weekloom import constants as K
from weekloom.functions import grouped, percent, season_cos, season_sin, week_of_year, week_start
from weekloom.operators import calendar as cal
from weekloom.operators import centers, classify, cluster, encode, features, intervals, labels, logistic, metrics
from weekloom.operators import panel, profile, quality, report, rollup, sketches, splits
from weekloom.plans import jobs
from weekloom.sources import metrics_json, star_schema as star, tables
from weekloom.sources.star_schema import CUT, END, EVENTS, ROLES, START
from weekloom.staging import new_folder, stage

SWEEP = (0.8, 0.9, 1.0, 1.1, 1.2)
CENTERS = [[-1.0, -1.0, -1.0], [0.0, 0.0, 0.0], [1.0, 1.0, 1.0]]
LOGGED = [f"log_{c}" for c in cluster.VOLUME]
SCALED = [f"{c}_scaled" for c in LOGGED]
TICKET = 3200.0
DEARER = {"ASIA": 1.25}
NEWTON_INPUTS = ["lag1_wd", "roll4_wd"]
SPLIT_INPUTS = ["lag1_wd", "lag2_wd", "lag1_tx", "lag1_outage_days", "payday_days", "festival_days"]
STUMP_INPUTS = ["lag1_outage_days", "payday_days", "festival_days"]
MOST_BINS = 4096
CURVE_BINS = 100
LLOYD_STEPS, EM_STEPS = 12, 5
EM_INPUTS = SCALED[::2]
EM_START = ([0.5, 0.5], [[-1.0, -1.0], [1.0, 1.0]], [[[1.0, 0.0], [0.0, 1.0]]] * 2)

# columns whose last bits depend on the order of additions or on the math library
DIGITS = {
    **dict.fromkeys(["roll4_wd", "roll4_std"], 4),
    **dict.fromkeys(["woy_sin", "woy_cos"], 8),
    **dict.fromkeys(["cv_wd", "weekend_ratio", "payday_uplift"], 6),
}


def shown(df: DataFrame, digits: dict[str, int] = DIGITS) -> DataFrame:
    """Round the named columns, keep the others. Plain double arithmetic, and no -0.0."""

    def cell(c: str):
        if c not in digits:
            return F.col(c)
        unit = F.lit(float(10 ** digits[c]))
        return (F.rint(F.col(c) * unit) / unit + F.lit(0.0)).alias(c)

    return df.select(*map(cell, df.columns))


def rounded_all(df: DataFrame, columns: list[str], digits: int) -> DataFrame:
    return shown(df, dict.fromkeys(columns, digits))


# ---- inputs -----------------------------------------------------------------------


def days(spark: SparkSession) -> DataFrame:
    return cal.calendar(spark, START, END, EVENTS, ROLES)


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return panel.daily_totals(star.supplier_records(spark, sf), ROLES)


def dense(spark: SparkSession, sf: str) -> DataFrame:
    return panel.densify(daily(spark, sf), star.suppliers(spark, sf), days(spark), START, END, ROLES)


def weekly(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.weekly_from_records(
        star.supplier_records(spark, sf), star.suppliers(spark, sf), days(spark), START, END, ROLES
    )


def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    return features.weekly_features(weekly(spark, sf), ROLES)


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    return profile.profile_from_daily(daily(spark, sf), star.suppliers(spark, sf), START, END, ROLES)


def labelled(spark: SparkSession, sf: str, *extra: str) -> tuple[DataFrame, float]:
    """Labelled features, written once because threshold and label read them in turn."""
    kept = feature_table(spark, sf).select(ROLES.entity, ROLES.segment, ROLES.week, "wd", "lag1_wd", *extra)
    table = stage(kept, "features")
    train, _ = labels.time_split(table, CUT, ROLES)
    threshold = labels.exact_threshold(train)
    return labels.label_high(table, threshold), threshold


def test_persistence(spark: SparkSession, sf: str) -> DataFrame:
    table, threshold = labelled(spark, sf)
    _, test = labels.time_split(table, CUT, ROLES)
    return labels.persistence(test, threshold)


# ---- calendar and panel -------------------------------------------------------------


def calendar_flags(spark, sf):
    """Flags of every calendar day and the number of records shipped on it."""
    per_day = star.supplier_records(spark, sf).groupBy("day").agg(F.count(F.lit(1)).alias("n_records"))
    return days(spark).join(per_day, "day", "left").withColumn("n_records", F.coalesce("n_records", F.lit(0)))


def event_window_totals(spark, sf):
    """Value and records inside event windows, per day."""
    opened = cal.event_days(spark, EVENTS, day=ROLES.day)
    hit = cal.event_rows(star.supplier_records(spark, sf), opened, ROLES.day)
    return hit.groupBy("day").agg(
        panel.exact_sum(F.col("value"), ROLES.scale).alias("value"), F.count(F.lit(1)).alias("n_records")
    )


def trend_index(spark, sf):
    """Daily value next to the linear trend index, and the value without the trend."""
    trend = cal.trend_index("day", START, END)
    return daily(spark, sf).select(
        "entity_id", "day", "value", trend.alias("trend"), (F.col("value") / trend).alias("level")
    )


def entity_day_panel(spark, sf):
    return dense(spark, sf).withColumn("is_outage", panel.outage_flag(ROLES).cast("int"))


def panel_union(spark, sf):
    """Supplier and user panels in one table; users have no segment."""
    suppliers = daily(spark, sf).join(star.suppliers(spark, sf).select("entity_id", "segment"), "entity_id")
    users = panel.daily_totals(star.user_records(spark, sf), ROLES)
    tag = lambda df, kind: df.withColumn("entity_id", F.concat(F.lit(kind), F.col("entity_id").cast("string")))
    return panel.union_panels([tag(suppliers, "S"), tag(users, "U")]).select(
        "entity_id", "segment", "day", "value", "n_ok", "n_failed"
    )


def expected_panel(spark, sf):
    """Dense panel with the entity scale column and the expected level."""
    people = star.suppliers(spark, sf).withColumn("scale", 1 + F.col("acctbal") / 100000)
    region = star.table(spark, sf, "region")
    levels = region.select(
        F.col("r_name").alias("segment"),
        (F.col("r_regionkey") * 25000.0 + 60000.0).alias("base"),
        (F.col("r_regionkey") * 0.125 + 0.75).alias("weekend_factor"),
        (F.col("r_regionkey") * 0.0625 + 1.0625).alias("payday_factor"),
    )
    scaled = panel.densify(daily(spark, sf), people, days(spark), START, END, ROLES, carry=("scale",))
    return panel.expected_level(scaled, levels, START, END, "scale", roles=ROLES)


def expected_level(spark, sf):
    """Expected level of every supplier and day."""
    return expected_panel(spark, sf).select("entity_id", "day", "expected")


def learned_levels(spark, sf):
    """Plain-day mean, factors of flagged days and ticket of every region, learned from the line items."""
    out = panel.learned_levels(daily(spark, sf), star.suppliers(spark, sf), days(spark), ROLES)
    return out.select("segment", "entities", *[F.round(c, 4).alias(c) for c in out.columns[2:]])


def derived_count(spark, sf):
    """Transactions behind each observed daily value at a fixed ticket."""
    rows = daily(spark, sf).join(star.suppliers(spark, sf).select("entity_id", "segment"), "entity_id")
    count = panel.derived_count(F.col("value"), F.lit(TICKET), F.col("segment"), DEARER)
    return rows.select("entity_id", "day", "value", count.alias("n_derived"))


def masked_measures(spark, sf):
    """Daily totals after zeroing value and count of returned records."""
    records = star.supplier_records(spark, sf)
    return panel.daily_totals(panel.mask_measures(records, F.col("n_failed") == 1, ["value", "n_ok"]), ROLES)


# ---- weeks --------------------------------------------------------------------------


def weekly_rollup(spark, sf):
    """Roll-up of the dense daily panel."""
    return rollup.weekly_rollup(dense(spark, sf), ROLES)


def weekly_from_records(spark, sf):
    """The same weeks straight from records."""
    return weekly(spark, sf)


def _feature_query(names: list[str]) -> Callable[[SparkSession, str], DataFrame]:
    """The named features of every week, warm-up rows with their NULLs included."""

    def run(spark, sf):
        table = features.add_features(weekly(spark, sf), names, ROLES)
        return shown(table.select("entity_id", "week_start", *[F.col(n).cast("double").alias(n) for n in names]))

    return run


def season_encoding(spark, sf):
    """Season columns of every shipping week and its number of records."""
    weeks = star.supplier_records(spark, sf).groupBy(week_start("day").alias("week_start")).agg(
        F.count(F.lit(1)).alias("n_records")
    )
    return shown(
        weeks.select(
            "week_start",
            "n_records",
            week_of_year("week_start").cast("bigint").alias("woy"),
            season_sin("week_start").alias("woy_sin"),
            season_cos("week_start").alias("woy_cos"),
        )
    )


def weekly_features(spark, sf):
    return shown(feature_table(spark, sf))


def weekly_features_recent(spark, sf):
    """Features of the weeks from the cut on, reading no older days than they need."""
    table = features.recent_features(
        star.supplier_records(spark, sf), star.suppliers(spark, sf), days(spark), CUT, START, END, ROLES
    )
    return shown(table)


def user_weekly_features(spark, sf):
    """The feature table of the user panel: one month of events."""
    first, last = star.USER_START, star.USER_END
    records = star.user_records(spark, sf)
    calendar = cal.calendar(spark, first, last, (), ROLES)
    users = panel.entities_of(records, "user", ROLES)
    return shown(features.weekly_features(rollup.weekly_from_records(records, users, calendar, first, last, ROLES), ROLES))


# ---- labels and measures --------------------------------------------------------------


def train_threshold(spark, sf):
    """Exact training median of the weekly value."""
    train, _ = labels.time_split(stage(feature_table(spark, sf).select("week_start", "wd"), "wd"), CUT, ROLES)
    threshold = labels.exact_threshold(train)
    return train.agg(F.count(F.lit(1)).alias("n_train")).withColumn("threshold", F.lit(threshold))


def labelled_split_stats(spark, sf):
    table, _ = labelled(spark, sf)
    return rounded_all(labels.split_stats(table, CUT, ROLES), ["high_share"], 8)


def persistence_confusion(spark, sf):
    return metrics.confusion(test_persistence(spark, sf))


def persistence_metrics(spark, sf):
    out = metrics.class_metrics(metrics.confusion(test_persistence(spark, sf)))
    return rounded_all(out, out.columns[4:], 8)


def _scored(spark, sf):
    table, threshold = labelled(spark, sf, "roll4_wd")
    _, test = labels.time_split(table, CUT, ROLES)
    return test.withColumn("score", F.round("roll4_wd", 4)), threshold


def score_auc(spark, sf):
    scored, _ = _scored(spark, sf)
    return rounded_all(metrics.roc_auc(scored, "score"), ["auc"], 8)


def threshold_sweep(spark, sf):
    scored, threshold = _scored(spark, sf)
    out = metrics.threshold_sweep(scored, "score", [threshold * f for f in SWEEP])
    return rounded_all(out, ["threshold"], 6)


def rule_comparison(spark, sf):
    """Two threshold rules next to persistence: measures, AUC, lift in points, best rule."""
    rules = {"rolling mean": "roll4_wd", "two weeks back": "lag2_wd"}
    table, threshold = labelled(spark, sf, "lag2_wd", "roll4_wd")
    _, test = labels.time_split(table, CUT, ROLES)
    test = test.withColumn("roll4_wd", F.round("roll4_wd", 4))

    def measured(name: str, column: str) -> DataFrame:
        rows = metrics.class_metrics(metrics.confusion(labels.persistence(test, threshold, column)))
        return rows.select(F.lit(name).alias("model"), "accuracy", "precision", "recall", "f1")

    auc = lambda column: metrics.roc_auc(test, column).select("auc").scalar()
    scores = panel.union_panels([measured(n, c).withColumn("auc", auc(c)) for n, c in rules.items()])
    baseline = measured("persistence", "lag1_wd").select("model", "accuracy", "f1")
    # one row per rule: fetched once, then only small tables are left
    table = report.append_baseline(scores, baseline)
    table = spark.createDataFrame(table.collect(), table.schema)
    scores, baseline = table.where(F.col("model") != "persistence"), table.where(F.col("model") == "persistence")
    best = classify.best_model(scores, list(rules)).first()["model"]
    lift = report.lift_over_baseline(scores, baseline)
    out = table.join(F.broadcast(lift), "model", "left").withColumn("is_best", (F.col("model") == best).cast("int"))
    return rounded_all(out, ["accuracy", "precision", "recall", "f1", "auc", "accuracy_lift", "f1_lift"], 8)


# ---- encoding -------------------------------------------------------------------------


def _train_categories(table: DataFrame) -> DataFrame:
    train, _ = labels.time_split(table, CUT, ROLES)
    return encode.category_index(train, ROLES.segment)


def segment_index(spark, sf):
    """Category index learned on the training weeks."""
    return _train_categories(feature_table(spark, sf).select("segment", "week_start"))


def segment_one_hot(spark, sf):
    """Index and one-hot columns of every feature row."""
    table = stage(feature_table(spark, sf).select("entity_id", "segment", "week_start"), "segments")
    categories = _train_categories(table).persist()
    indexed = encode.with_category_index(table, categories, ROLES.segment)
    return encode.one_hot_columns(indexed, categories.count()).drop("segment")


def unit_std_features(spark, sf):
    """Numeric inputs divided by their training deviation, all weeks."""
    table = stage(feature_table(spark, sf).select("entity_id", "week_start", *features.NUMERIC), "numeric")
    train, _ = labels.time_split(table, CUT, ROLES)
    scaled = encode.scale_columns(table, encode.column_moments(train, features.NUMERIC))
    names = [f"{c}_scaled" for c in features.NUMERIC]
    return rounded_all(scaled.select("entity_id", "week_start", *names), names, 4)


# ---- profiles and quality ---------------------------------------------------------------


def entity_profile(spark, sf):
    """Profiles of the dense panel."""
    return shown(profile.entity_profile(dense(spark, sf), ROLES))


def profile_from_daily(spark, sf):
    """The same profiles from the observed days."""
    return shown(profiles(spark, sf))


def entity_profile_live(spark, sf):
    """Profiles over active days only."""
    rows = daily(spark, sf).join(star.suppliers(spark, sf).select("entity_id", "segment"), "entity_id")
    flagged = rows.join(cal.bounded(days(spark), START, END), "day")
    return shown(profile.entity_profile(flagged, ROLES, live_only=True))


def data_quality(spark, sf):
    """Quality figures of the raw records; a returned record counts as failed, not as ok."""
    records = star.supplier_records(spark, sf).withColumn("n_ok", 1 - F.col("n_failed"))
    out = quality.data_quality(records, ROLES)
    return rounded_all(out, ["outage_share", "failed_rate", "mean_count"], 8).withColumn(
        "mean_value", F.round("mean_value", 4)
    )


def median_value(spark, sf):
    return quality.median_value(star.supplier_records(spark, sf), ROLES)


def segment_summary(spark, sf):
    return quality.segment_summary(dense(spark, sf), ROLES, digits=4)


def entity_count(spark, sf):
    """Distinct users of the event stream."""
    return quality.entity_count(star.user_records(spark, sf), ROLES)


def panel_preview(spark, sf):
    """First five daily rows by key."""
    return quality.preview(daily(spark, sf), ["entity_id", "day"], 5)


# ---- clusters ---------------------------------------------------------------------------


def _standardised(spark, sf) -> DataFrame:
    """Profiles with standardised log volumes as columns."""
    table = stage(encode.log_columns(profiles(spark, sf), cluster.VOLUME), "profile")
    return encode.scale_columns(table, encode.column_moments(table, LOGGED), center=True)


def _assigned(spark, sf) -> DataFrame:
    return cluster.nearest_center(_standardised(spark, sf), SCALED, CENTERS)


def _tiered(spark, sf) -> DataFrame:
    assigned = _assigned(spark, sf)
    return cluster.assign_tiers(assigned, cluster.tier_names(assigned))


def log_standardised_profile(spark, sf):
    return rounded_all(_standardised(spark, sf).select("entity_id", *LOGGED, *SCALED), LOGGED + SCALED, 6)


def kmeans_assign(spark, sf):
    """Nearest fixed center of every profile."""
    return _assigned(spark, sf).select("entity_id", "prediction")


def cluster_quality(spark, sf):
    """Within-cluster SSE and silhouette of the fixed-center assignment."""
    assigned = stage(_assigned(spark, sf).select("entity_id", "prediction", *SCALED), "assigned")
    sse = metrics.cluster_sse(assigned, SCALED, CENTERS).first()[0]
    out = metrics.silhouette(assigned, SCALED).withColumn("wssse", F.lit(sse))
    return rounded_all(out, ["silhouette", "wssse"], 6)


def tier_names(spark, sf):
    return rounded_all(cluster.tier_names(_assigned(spark, sf)), ["mean_metric"], 4)


def tier_assignments(spark, sf):
    return shown(cluster.assignments(_tiered(spark, sf), ROLES))


def tier_summary(spark, sf):
    return report.tier_summary(_tiered(spark, sf), digits=4)


def tier_mix(spark, sf):
    return report.tier_mix(_tiered(spark, sf), roles=ROLES)


def tier_ratio(spark, sf):
    summary = report.tier_summary(_tiered(spark, sf), ["avg_daily_wd"], digits=8)
    return rounded_all(report.tier_ratio(summary), ["tier_ratio"], 6)


def segment_usual_tier(spark, sf):
    return rounded_all(report.usual_tier(_tiered(spark, sf), ROLES), ["tier_share"], 8)


def tier_policy(spark, sf):
    return report.with_policy(_tiered(spark, sf), report.policy_table(spark)).select(
        "entity_id", "demand_tier", "policy"
    )


def _cluster_frame(spark, sf, log: bool = True) -> DataFrame:
    return cluster.cluster_frame(stage(profiles(spark, sf), "profile"), log, ROLES).persist()


def kmeans_sweep(spark, sf):
    """Within-cluster SSE and silhouette for k = 2 .. 7."""
    frame = _cluster_frame(spark, sf)
    out = cluster.kmeans_sweep(frame)
    frame.unpersist()
    return out


def cluster_compare(spark, sf):
    """Silhouette of three algorithms at k = 3."""
    frame = _cluster_frame(spark, sf)
    out = cluster.compare_algorithms(frame, bisecting=True)
    frame.unpersist()
    return out


def demand_tiers(spark, sf):
    """Summary of the fitted tiers."""
    return report.tier_summary(cluster.demand_tiers(_cluster_frame(spark, sf)))


def demand_tiers_unlogged(spark, sf):
    """The same without the log step."""
    return report.tier_summary(cluster.demand_tiers(_cluster_frame(spark, sf, log=False)))


def pca_projection(spark, sf):
    """Two principal components of every profile with its fitted tier."""
    frame = _cluster_frame(spark, sf)
    rows, explained = cluster.pca_projection(cluster.demand_tiers(frame))
    ratios = {f"explained{i + 1}": F.lit(v) for i, v in enumerate(explained)}
    return rows.select("entity_id", "demand_tier", "pc1", "pc2").withColumns(ratios)


# ---- models -----------------------------------------------------------------------------


def _train_test(spark, sf) -> tuple[DataFrame, DataFrame, float]:
    inputs = [ROLES.entity, ROLES.segment, ROLES.week, "wd", *features.NUMERIC]
    table = stage(feature_table(spark, sf).select(*inputs), "inputs")
    train, _ = labels.time_split(table, CUT, ROLES)
    threshold = labels.exact_threshold(train)
    train, test = labels.time_split(labels.label_high(table, threshold), CUT, ROLES)
    return train, test, threshold


def model_comparison(spark, sf):
    """Three classifiers and the naive baseline, with lift and the best model marked."""
    train, test, threshold = _train_test(spark, sf)
    models = classify.default_models()
    scores, _ = classify.compare_models(train, test, models, ROLES)
    naive = metrics.class_metrics(metrics.confusion(labels.persistence(test, threshold)))
    baseline = naive.select(F.lit("Persistence").alias("model"), "accuracy", "f1")
    best = classify.best_model(scores, list(models)).first()["model"]
    lift = report.lift_over_baseline(scores, baseline)
    rows = report.append_baseline(scores.select("model", "accuracy", "precision", "recall", "f1", "auc"), baseline)
    return rows.join(F.broadcast(lift), "model", "left").withColumn("is_best", F.col("model") == best)


def feature_importance(spark, sf):
    """Forest weights by feature with rank and running share."""
    train, test, _ = _train_test(spark, sf)
    only = {classify.FOREST: classify.default_models()[classify.FOREST]}
    _, fitted = classify.compare_models(train, test, only, ROLES)
    return classify.feature_importance(fitted[classify.FOREST], features.NUMERIC)


# ---- what holds for every fit -------------------------------------------------------------
#
# The fits are seeded MLlib fits, which SQL cannot repeat. These queries run them and return
# what the data alone decides, next to 1 for each property of the fit that holds.


def model_test_counts(spark, sf):
    """LOW and HIGH rows of the test weeks as each model's confusion cells count them."""
    train, test, _ = _train_test(spark, sf)
    scores, _ = classify.compare_models(train, test, classify.default_models(), ROLES)
    cell = lambda c: F.col(f"confusion.{c}").cast("long")
    return scores.select(
        "model",
        (cell("TN") + cell("FP")).alias("n_low"),
        (cell("FN") + cell("TP")).alias("n_high"),
        F.col("auc").between(0, 1).cast("int").alias("auc_in_range"),
    )


def importance_names(spark, sf):
    """Names of the weighed features, the sum of the weights, and the ends of rank and share."""
    table = stage(feature_importance(spark, sf), "importance")
    n_top = classify.top_features(table).count()
    whole = Window.partitionBy()  # one row per feature
    out = table.select(
        "feature",
        F.count(F.lit(1)).over(whole).alias("n_features"),
        F.sum("importance").over(whole).alias("total"),
        F.max("rank").over(whole).alias("last_rank"),
        F.max("running_share").over(whole).alias("last_share"),
        F.lit(n_top).cast("long").alias("n_top"),
    )
    return rounded_all(out, ["total", "last_share"], 6)


def kmeans_sweep_spread(spark, sf):
    """The SSE of every k against the spread of all rows around their mean."""
    frame = _cluster_frame(spark, sf)
    squares = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda s, x: s + x * x)
    spread = frame.agg(F.sum(squares)).first()[0]
    out = cluster.kmeans_sweep(frame)
    frame.unpersist()
    out = out.select(
        "k",
        (F.col("wssse") < spread).cast("int").alias("below_spread"),
        F.col("silhouette").between(-1, 1).cast("int").alias("silhouette_in_range"),
        F.lit(spread).alias("spread"),
    )
    return rounded_all(out, ["spread"], 4)


def cluster_compare_range(spark, sf):
    """The compared algorithms, and 1 for a silhouette out of range; one that finds a single cluster has none."""
    outside = ~F.col("silhouette").between(-1, 1)
    return cluster_compare(spark, sf).select(
        "algorithm", F.coalesce(outside, F.lit(False)).cast("int").alias("out_of_range")
    )


def fitted_tier_totals(spark, sf):
    """Entities and overall mean as the fitted tiers add up to them, with and without logs."""

    def totals(form: str, log: bool) -> DataFrame:
        rows = cluster.demand_tiers(_cluster_frame(spark, sf, log))
        per = rows.groupBy("demand_tier", "tier_rank").agg(
            F.count(F.lit(1)).alias("n"), F.avg("avg_daily_wd").alias("mean")
        )
        by_rank = F.transform(F.sort_array(F.collect_list(F.struct("tier_rank", "mean"))), lambda x: x["mean"])
        by_name = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("tier_rank", "demand_tier"))),
                                           lambda x: x["demand_tier"]), " ")
        out = per.agg(
            F.sum("n").alias("n_entities"),
            (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("avg_daily_wd"),
            by_name.alias("tiers"),
            (by_rank == F.sort_array(by_rank)).cast("int").alias("ascending"),
        )
        return out.select(F.lit(form).alias("form"), "*")

    return rounded_all(totals("log", True).unionByName(totals("plain", False)), ["avg_daily_wd"], 4)


def pca_scores(spark, sf):
    """Distances from the mean along both components, whose signs are free, and the explained shares."""
    frame = _cluster_frame(spark, sf)
    rows, explained = cluster.pca_projection(frame)
    ratios = {f"explained{i + 1}": F.lit(v) for i, v in enumerate(explained)}
    out = rows.select("entity_id", F.abs("pc1").alias("pc1"), F.abs("pc2").alias("pc2")).withColumns(ratios)
    return rounded_all(out, ["pc1", "pc2", "explained1", "explained2"], 5)


# ---- proofs of the fits -------------------------------------------------------------------


def logistic_newton(spark, sf):
    """Weights of two standardised inputs by Newton steps, and whether the MLlib fit has the same."""
    train, _, _ = _train_test(spark, sf)
    moments = encode.column_moments(train, NEWTON_INPUTS)
    names = [f"{c}_scaled" for c in NEWTON_INPUTS]
    rows = stage(encode.scale_columns(train.select("label", *NEWTON_INPUTS), moments, center=True), "two-inputs")
    last = logistic.newton_steps(rows, names).orderBy(F.desc("step")).first()
    fit = LogisticRegression(tol=1e-9).fit(VectorAssembler(inputCols=names, outputCol="features").transform(rows))
    fitted = [fit.intercept, *fit.coefficients.toArray().tolist()]
    table = [(t, w, int(abs(w - v) < 1e-4)) for t, w, v in zip(["intercept", *NEWTON_INPUTS], last["weights"], fitted, strict=True)]
    return rounded_all(spark.createDataFrame(table, "term string, weight double, fit_agrees int"), ["weight"], 6)


def logistic_certificate(spark, sf):
    """The compared logistic fit on all inputs: rows, and 1 if the slope of its log loss vanishes (1e-4 in unit-deviation inputs)."""
    train, _, _ = _train_test(spark, sf)
    entry = classify.default_models()["Logistic Regression"]
    stages = [*encode.encoding_stages(ROLES), encode.unit_std_stage(), entry.estimator.copy({entry.estimator.featuresCol: "features"})]
    model = Pipeline(stages=stages).fit(classify.pinned(train, [ROLES.entity, ROLES.week]))
    own = model.stages[-1]
    scored = model.transform(train).select("label", "features")
    proof = logistic.optimality(scored, own.coefficients.toArray().tolist(), own.intercept)
    return proof.select("n_rows", (F.col("gradient") < 1e-4).cast("int").alias("optimal"), (F.col("loss") <= math.log(2)).cast("int").alias("informs"))


def best_splits(spark, sf):
    """The exact best split of every input over all distinct training values."""
    train, _, _ = _train_test(spark, sf)
    return rounded_all(splits.best_splits(train, SPLIT_INPUTS).withColumn("pos_left", F.col("pos_left").cast("long")).drop("n", "pos"),
                       ["gain"], 9)


def _stump_rows(spark, sf) -> DataFrame:
    train, _, _ = _train_test(spark, sf)
    rows = VectorAssembler(inputCols=STUMP_INPUTS, outputCol="raw").transform(classify.pinned(train, [ROLES.entity, ROLES.week]))
    return rows.select("label", "raw").persist()


def forest_stump(spark, sf):
    """Feature, threshold and gain of a forest of one unsampled tree of depth one."""
    rows = _stump_rows(spark, sf)
    forest = RandomForestClassifier(featuresCol="raw", numTrees=1, maxDepth=1, maxBins=MOST_BINS, featureSubsetStrategy="all",
                                    bootstrap=False, seed=K.CLASSIFIER_SEED)
    root = forest.fit(rows)._java_obj.trees()[0].rootNode()
    rows.unpersist()
    table = [(STUMP_INPUTS[root.split().featureIndex()], float(root.split().threshold()), float(root.gain()))]
    return rounded_all(spark.createDataFrame(table, "feature string, threshold double, gain double"), ["gain"], 9)


def boosting_rounds(spark, sf):
    """Training loss of boosted stumps: the first round's, and for each round 1 unless the loss rose."""
    rows = _stump_rows(spark, sf)
    model = GBTClassifier(featuresCol="raw", maxIter=8, maxDepth=1, maxBins=MOST_BINS, seed=K.CLASSIFIER_SEED).fit(rows)
    out = splits.boosting_losses(model, rows)
    rows.unpersist()
    return rounded_all(out.select("round", F.when(F.col("round") == 1, F.col("loss")).alias("first_loss"), "fell"), ["first_loss"], 8)


def lloyd_centers(spark, sf):
    """Centers, rows and SSE after a fixed number of Lloyd steps from fixed centers."""
    out = centers.lloyd(stage(_standardised(spark, sf).select(*SCALED), "points"), SCALED, CENTERS, LLOYD_STEPS, tolerance=-1.0)
    parts = [F.col("center")[i].alias(f"c{i}") for i in range(len(SCALED))]
    return rounded_all(out.select("cluster", "n_rows", "sse", *parts), ["sse", "c0", "c1", "c2"], 6)


def kmeans_certificate(spark, sf):
    """Every fit of the sweep: rows, 1 if its centers are the means of their rows, 1 if its cost is their SSE."""
    frame = _cluster_frame(spark, sf)
    names = [f"x{i}" for i in range(len(SCALED))]
    rows = stage(frame.select(*[vector_to_array("features")[i].alias(c) for i, c in enumerate(names)]), "points")
    table = []
    for k in range(2, 8):
        model = cluster.kmeans(k).fit(frame)
        proof = centers.fixed_point(rows, names, [c.tolist() for c in model.clusterCenters()]).first()
        table.append((k, proof["n_rows"], int(proof["shift"] < 1e-3), int(abs(proof["sse"] - model.summary.trainingCost) <= 1e-6 * proof["sse"] + 1e-9)))
    frame.unpersist()
    return spark.createDataFrame(table, "k int, n_rows long, fixed int, cost_agrees int")


def bisecting_tree(spark, sf):
    """Splits of the bisection: rows add up, SSE falls, and the root's rows and SSE."""
    rows = stage(_standardised(spark, sf).select(*SCALED), "points")
    tree = centers.bisect(rows, SCALED, 4)[1].persist()
    kids = tree.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.sum("n_rows").alias("below"), F.sum("sse").alias("sse_below"))
    root = tree.where("parent is null")
    out = kids.join(tree, "node").agg(
        root.select("n_rows").scalar().alias("n_all"), root.select("sse").scalar().alias("sse_all"),
        F.count(F.lit(1)).alias("n_splits"), F.min((F.col("below") == F.col("n_rows")).cast("int")).alias("rows_add_up"),
        F.min((F.col("sse_below") < F.col("sse")).cast("int")).alias("sse_falls"))
    return rounded_all(out, ["sse_all"], 4)


def mixture_em(spark, sf):
    """Weight, mean and covariance of two components after fixed EM steps from a fixed start."""
    rows = stage(_standardised(spark, sf).select(*EM_INPUTS), "points")
    weights, means, covariances = EM_START
    for _ in range(EM_STEPS):
        out = centers.mixture_step(rows, EM_INPUTS, weights, means, covariances).orderBy("component")
        found = out.collect()
        weights, means = [r["weight"] for r in found], [r["mean"] for r in found]
        covariances = [[r["covariance"][:2], r["covariance"][2:]] for r in found]
    parts = {"m0": F.col("mean")[0], "m1": F.col("mean")[1], "v00": F.col("covariance")[0], "v01": F.col("covariance")[1], "v11": F.col("covariance")[3]}
    return rounded_all(out.select("component", "weight", *[v.alias(c) for c, v in parts.items()]), ["weight", *parts], 6)


def distinct_sketch(spark, sf):
    """Distinct users from stored weekly sketches, merged: exact figure, and 1 if the estimate is within the stated error."""
    kept = sketches.stored_distinct(star.user_records(spark, sf), week_start("day"), "entity_id")
    return sketches.distinct_check(kept, quality.entity_count(star.user_records(spark, sf), ROLES))


def quantile_sketch(spark, sf):
    """Median and 90th percentile of the training weeks from stored weekly sketches, merged: 1 if the rank error is within the stated error."""
    train, _ = labels.time_split(stage(feature_table(spark, sf).select("week_start", "wd"), "wd"), CUT, ROLES)
    return sketches.quantile_check(train, sketches.stored_quantiles(train, F.col("week_start"), "wd"), "wd", (0.5, 0.9))


# ---- curves, windows, ranges and orders -----------------------------------------------------


def auc_curves(spark, sf):
    """Exact and binned area under the curve of last week's value, unrounded."""
    table, _ = labelled(spark, sf)
    _, test = labels.time_split(table, CUT, ROLES)
    return rounded_all(metrics.curve_areas(test, "lag1_wd", bins=CURVE_BINS), ["auc", "binned_auc"], 9)


def error_windows(spark, sf):
    """Events of each user that lie around any of the user's errors: two hours before, up to 30 hours after."""
    hour = 3_600_000_000
    events = star.table(spark, sf, "events").select("user_id", "event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    errors = events.where("event_type = 'error'").select(
        "user_id", (F.col("at") - 2 * hour).alias("opens"), (F.col("at") + (1 + F.col("event_id") % 30) * hour).alias("closes"))
    hit = intervals.covered(events, errors, "at", "opens", "closes", 24 * hour, ["user_id"])
    return hit.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"), F.count_if(F.col("event_type") == "error").alias("n_errors"))


def encoded_split(spark, sf):
    """Rows of train and test weeks per category index, learned on train; an unseen segment would raise."""
    table = stage(feature_table(spark, sf).select("segment", "week_start"), "segments")
    categories = stage(_train_categories(table), "categories")
    part = F.when(labels.is_train(CUT, ROLES), "train").otherwise("test")
    return encode.checked_category_index(table, categories, ROLES.segment).groupBy(part.alias("part"), "loc_idx").agg(F.count(F.lit(1)).alias("n_rows"))


def range_report(spark, sf):
    """All line items against the panel's range: the span they have, and the rows that the range leaves out."""
    items = star.table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias(ROLES.day))
    return quality.dropped_rows(items, START, END, ROLES)


def weekly_span(spark, sf):
    """Weekly totals over every whole week that the line items span, found in the data."""
    items = star.supplier_records(spark, sf, dt.date(1, 1, 1), dt.date(9998, 12, 31))
    first, last = quality.whole_weeks(*quality.day_span(items, ROLES))
    if first is None:
        first = last = dt.date(1970, 1, 1)
    inside = items.where(F.col(ROLES.day).between(F.lit(first), F.lit(last)))
    return inside.groupBy(week_start("day").alias("week_start")).agg(
        panel.exact_sum(F.col("value"), ROLES.scale).alias("wd"), F.count(F.lit(1)).alias("n_records"))


def gap_quality(spark, sf):
    """Missing cells of a table that has them: prices NULL or NaN and flags NULL by line number."""
    records = star.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("entity_id"), F.col("l_shipdate").cast("date").alias("day"),
        F.when(F.col("l_linenumber") == 3, F.lit(None)).when(F.col("l_linenumber") == 5, F.lit(float("nan"))).otherwise(F.col("l_extendedprice")).alias("value"),
        F.when(F.col("l_linenumber") != 2, F.lit(1)).alias("n_ok"), F.when(F.col("l_linenumber") < 6, F.lit(0)).alias("n_failed"))
    return quality.data_quality(records, ROLES).select("n_rows", "n_entities", "missing_cells", "duplicate_rows")


def panel_quality(spark, sf):
    """Quality figures of the dense panel with the shares of its flags."""
    shares = [f"is_{c}_share" for c in ("weekend", "payday", "event")]
    out = quality.data_quality(dense(spark, sf).select("entity_id", "day", "value", "n_ok", "n_failed", "is_weekend", "is_payday", "is_event"), ROLES)
    return rounded_all(out.select("n_rows", "n_entities", "outage_rows", "outage_share", *shares), ["outage_share", *shares], 8)


def segment_ranking(spark, sf):
    """Segments with their place by mean value, from sums and the number of days, without the dense panel."""
    per = daily(spark, sf).groupBy("entity_id").agg(panel.exact_sum(F.col("value"), ROLES.scale).alias("total"), F.sum("n_ok").alias("ok"))
    people = star.suppliers(spark, sf).select("entity_id", "segment").join(per, "entity_id", "left")
    days_each = cal.days_between(START, END)
    summary = people.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n_entities"), (panel.exact_sum(F.col("total"), ROLES.scale) / (F.count(F.lit(1)) * days_each)).alias("avg_daily_value"),
        (F.coalesce(F.sum("ok"), F.lit(0)) / (F.count(F.lit(1)) * days_each)).alias("avg_daily_count"))
    return rounded_all(quality.ranked(summary, "avg_daily_value", "segment"), ["avg_daily_value", "avg_daily_count"], 4)


def tier_order(spark, sf):
    """Tiers with their business rank next to their size."""
    return _tiered(spark, sf).groupBy("tier_rank", "demand_tier").agg(F.count(F.lit(1)).alias("n_entities"))


# ---- whole jobs ----------------------------------------------------------------------------


def segmentation_job(spark, sf):
    """The whole segmentation on the supplier panel: its summary and mix files read back, added up per segment."""
    path = new_folder(spark, "segmentation-job")
    done = jobs.segment_demand(dense(spark, sf), path, ks=range(2, 4), roles=ROLES)
    mix = tables.read_table(spark, f"{path}/tier_segment_mix", done.mix.schema)
    summary = tables.read_table(spark, f"{path}/tier_profile", done.summary.schema)
    return mix.select("segment", F.expr("Low + Medium + High").alias("n_entities"), summary.agg(F.sum("n_entities")).scalar().alias("n_all"),
                      summary.agg(F.count(F.lit(1))).scalar().alias("n_tiers"))


def classification_job(spark, sf):
    """The whole classification on the supplier panel, one model: the counts of its results file in the published layout."""
    path = new_folder(spark, "classification-job")
    only = {"Logistic Regression": classify.default_models()["Logistic Regression"]}
    done = jobs.classify_demand(dense(spark, sf), CUT, None, only, ROLES)
    metrics_json.write_published(done.document, path)
    meta = metrics_json.read_meta(spark, path, done.document.schema["_meta"].dataType)
    models = metrics_json.read_models(spark, path).where("TN is not null")
    n = models.agg(F.sum(F.expr("TN + FP + FN + TP")))
    counts = [F.col(c).cast("long").alias(c) for c in ("train_rows", "test_rows", "weekly_rows", "daily_rows")]
    return meta.select(*counts, "best_model", n.scalar().alias("n_scored"))


# ---- storage ------------------------------------------------------------------------------


def table_roundtrip(spark, sf):
    """Daily table with segments to CSV and back under the declared schema."""
    rows = daily(spark, sf).join(star.suppliers(spark, sf).select("entity_id", "segment"), "entity_id")
    out = rows.select("entity_id", "day", "segment", "value", "n_ok", "n_failed")
    path = new_folder(spark, "daily-csv")
    tables.write_table(out, path, "csv")
    return tables.read_panel(spark, path, out.schema, "csv", ROLES)


def tier_sink_roundtrip(spark, sf):
    """Tier assignments to CSV, one folder per tier, and back."""
    rows = cluster.assignments(_tiered(spark, sf), ROLES)
    path = new_folder(spark, "tiers-csv")
    tables.write_table(rows, path, "csv", partition_by=["demand_tier"])
    return shown(tables.read_table(spark, path, rows.schema).select(*rows.columns))


def metrics_roundtrip(spark, sf):
    """Persistence measures to nested JSON and back, with report formatting."""
    measured = metrics.class_metrics(metrics.confusion(test_persistence(spark, sf)))
    record = measured.select(
        F.lit("Persistence").alias("model"),
        "accuracy",
        "precision",
        "recall",
        "f1",
        F.lit(None).cast("double").alias("auc"),
        F.struct("TN", "FP", "FN", "TP").alias("confusion"),
    )
    path = new_folder(spark, "metrics-json")
    metrics_json.write_metrics(metrics_json.models_document(record), path)
    back = metrics_json.read_models(spark, path).drop("auc")
    return rounded_all(back, ["accuracy", "precision", "recall", "f1"], 8).withColumns(
        {"accuracy_text": percent(F.col("accuracy")), "n_text": grouped(F.col("TN") + F.col("TP"))}
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "calendar_flags": calendar_flags,
    "event_window_totals": event_window_totals,
    "trend_index": trend_index,
    "entity_day_panel": entity_day_panel,
    "panel_union": panel_union,
    "expected_level": expected_level,
    "learned_levels": learned_levels,
    "derived_count": derived_count,
    "masked_measures": masked_measures,
    "weekly_rollup": weekly_rollup,
    "weekly_from_records": weekly_from_records,
    "weekly_lags": _feature_query(features.LAGS),
    "weekly_rolling": _feature_query(features.ROLLING),
    "weekly_lag_ratios": _feature_query(features.LAG_RATIOS),
    "season_encoding": season_encoding,
    "weekly_features": weekly_features,
    "weekly_features_recent": weekly_features_recent,
    "user_weekly_features": user_weekly_features,
    "train_threshold": train_threshold,
    "labelled_split_stats": labelled_split_stats,
    "persistence_confusion": persistence_confusion,
    "persistence_metrics": persistence_metrics,
    "score_auc": score_auc,
    "threshold_sweep": threshold_sweep,
    "rule_comparison": rule_comparison,
    "segment_index": segment_index,
    "segment_one_hot": segment_one_hot,
    "unit_std_features": unit_std_features,
    "log_standardised_profile": log_standardised_profile,
    "entity_profile": entity_profile,
    "profile_from_daily": profile_from_daily,
    "entity_profile_live": entity_profile_live,
    "data_quality": data_quality,
    "median_value": median_value,
    "segment_summary": segment_summary,
    "entity_count": entity_count,
    "panel_preview": panel_preview,
    "kmeans_assign": kmeans_assign,
    "cluster_quality": cluster_quality,
    "tier_names": tier_names,
    "tier_assignments": tier_assignments,
    "tier_summary": tier_summary,
    "tier_mix": tier_mix,
    "tier_ratio": tier_ratio,
    "segment_usual_tier": segment_usual_tier,
    "tier_policy": tier_policy,
    "kmeans_sweep": kmeans_sweep,
    "cluster_compare": cluster_compare,
    "demand_tiers": demand_tiers,
    "demand_tiers_unlogged": demand_tiers_unlogged,
    "pca_projection": pca_projection,
    "model_comparison": model_comparison,
    "feature_importance": feature_importance,
    "model_test_counts": model_test_counts,
    "importance_names": importance_names,
    "kmeans_sweep_spread": kmeans_sweep_spread,
    "cluster_compare_range": cluster_compare_range,
    "fitted_tier_totals": fitted_tier_totals,
    "pca_scores": pca_scores,
    "logistic_newton": logistic_newton,
    "logistic_certificate": logistic_certificate,
    "best_splits": best_splits,
    "forest_stump": forest_stump,
    "boosting_rounds": boosting_rounds,
    "lloyd_centers": lloyd_centers,
    "kmeans_certificate": kmeans_certificate,
    "bisecting_tree": bisecting_tree,
    "mixture_em": mixture_em,
    "distinct_sketch": distinct_sketch,
    "quantile_sketch": quantile_sketch,
    "auc_curves": auc_curves,
    "error_windows": error_windows,
    "encoded_split": encoded_split,
    "range_report": range_report,
    "weekly_span": weekly_span,
    "gap_quality": gap_quality,
    "panel_quality": panel_quality,
    "segment_ranking": segment_ranking,
    "tier_order": tier_order,
    "segmentation_job": segmentation_job,
    "classification_job": classification_job,
    "table_roundtrip": table_roundtrip,
    "tier_sink_roundtrip": tier_sink_roundtrip,
    "metrics_roundtrip": metrics_roundtrip,
}
