import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import structured
from weekloom.operators import classify as CL, cluster as CU, encode as EN, features as FE, labels as L, profile as PR
from weekloom.operators import report as RE, rollup as R
from weekloom.plans import jobs
from weekloom.sources import metrics_json, tables
from weekloom.staging import new_folder, stage


@pytest.fixture(scope="module")
def panel(spark):
    return stage(structured.daily_table(spark), "structured")


@pytest.fixture(scope="module")
def profiles(panel):
    return stage(PR.entity_profile(panel), "profiles")


@pytest.fixture(scope="module")
def table(panel):
    return stage(FE.weekly_features(R.weekly_rollup(panel)), "features")


def test_category_index(spark):
    df = spark.createDataFrame([(c,) for c in "baccd"], "segment string")
    idx = EN.category_index(df, "segment")
    assert {r.segment: r.loc_idx for r in idx.collect()} == {"c": 0, "a": 1, "b": 2, "d": 3}
    hot = EN.one_hot_columns(EN.with_category_index(df, idx, "segment"), 4)
    for r in hot.collect():
        ones = [r.loc_0, r.loc_1, r.loc_2]
        assert sum(ones) == (r.segment != "d")
    assert [r.feature for r in EN.category_names(idx, "segment").orderBy("pos").collect()] == ["loc_c", "loc_a", "loc_b"]


def test_column_forms_equal_the_stages(table):
    from weekloom import Roles

    stages = [*EN.encoding_stages(), EN.unit_std_stage()]
    model = Pipeline(stages=stages).fit(table)
    n = len(FE.NUMERIC)
    rows = model.transform(table)
    arr = vector_to_array("features")
    vec = rows.select("entity_id", "week_start", *[arr[i].alias(f"v{i}") for i in range(n)], "loc_idx")
    scaled = EN.scale_columns(table, EN.column_moments(table, FE.NUMERIC))
    idx = EN.with_category_index(scaled, EN.category_index(table, "segment").withColumnRenamed("loc_idx", "idx"), "segment", "idx")
    both = idx.join(vec, ["entity_id", "week_start"])
    gaps = [F.max(F.abs(F.col(f"{c}_scaled") - F.col(f"v{i}"))).alias(c) for i, c in enumerate(FE.NUMERIC)]
    gaps.append(F.max(F.abs(F.col("idx") - F.col("loc_idx"))).alias("idx"))
    row = both.agg(*gaps).first()
    assert max(row) < 1e-9
    assert Roles().segment == "segment"


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0)], "a double, b double")
    out = EN.scale_columns(df, EN.column_moments(df, ["a", "b"]), center=True)
    assert [r.b_scaled for r in out.collect()] == [0.0, 0.0]


def test_standardised_vector(profiles):
    x = np.array([r.features.toArray() for r in CU.cluster_frame(profiles).collect()])
    assert np.allclose(x.mean(axis=0), 0, atol=1e-9) and np.allclose(x.std(axis=0, ddof=1), 1)


def test_models_beat_persistence(panel, spark):
    out = new_folder(spark, "job1")
    small = CL.default_models(max_iter=50, trees=20, rounds=10)
    result = jobs.classify_demand(panel, structured.CUT, out, small)
    rows = {r.model: r for r in result.scores.collect()}
    naive = rows[jobs.BASELINE].accuracy
    assert set(rows) == {*small, jobs.BASELINE}
    for name in small:
        assert rows[name].accuracy > naive > 0.7 and rows[name].auc > 0.95
        assert sum(rows[name].confusion) > 0
    assert rows[jobs.BASELINE].auc is None
    imp = result.importances.orderBy("rank").collect()
    assert len(imp) == 13 + 6 and imp[-1].running_share == pytest.approx(1)
    assert imp[0].feature in ("roll4_wd", "lag1_wd", "lag1_tx", "lag2_wd")
    assert [r["rank"] for r in CL.top_features(result.importances, 6).collect()] == list(range(1, 7))

    doc = spark.read.json(f"{out}/classification_results").first()
    meta = doc["_meta"]
    assert meta.daily_rows == panel.count() == 70 * 425
    assert meta.train_rows + meta.test_rows == meta.weekly_rows
    assert len(doc.feature_importance) == 19
    back = {r.model: r for r in metrics_json.read_models(spark, f"{out}/classification_results").collect()}
    assert back[jobs.BASELINE].precision is None and back[jobs.BASELINE].TP is None
    best = rows[meta.best_model]
    assert back[meta.best_model].auc == best.auc == max(rows[n].auc for n in small)
    assert back[meta.best_model].TP == best.confusion.TP


def test_fit_is_repeatable(table):
    train, test = L.time_split(L.label_high(table, L.sketch_threshold(table)), structured.CUT)
    models = {CL.FOREST: CL.default_models(trees=5)[CL.FOREST]}
    auc = lambda t: CL.compare_models(t, test, models)[0].first().auc
    assert auc(train) == auc(train.repartition(3, "week_start"))


def test_best_model_tie_goes_to_the_first(spark):
    df = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", 0.1)], "model string, auc double")
    assert CL.best_model(df, ["b", "a", "c"]).first().model == "b"
    assert CL.best_model(df, ["a", "b", "c"]).first().model == "a"


def test_segmentation_job(panel, spark):
    out = new_folder(spark, "job2")
    result = jobs.segment_demand(panel, out, ks=range(2, 5))
    sweep = result.sweep.orderBy("k").collect()
    assert [r.k for r in sweep] == [2, 3, 4]
    assert sweep[0].wssse > sweep[1].wssse > sweep[2].wssse
    assert all(0 < r.silhouette < 1 for r in sweep)
    summary = result.summary.collect()
    assert [r.demand_tier for r in summary] == ["Low", "Medium", "High"]
    assert summary[0].avg_daily_wd < summary[1].avg_daily_wd < summary[2].avg_daily_wd
    sizes = {r.demand_tier: r.n_entities for r in summary}
    assert sum(sizes.values()) == 70
    mix = result.mix.collect()
    assert {t: sum(r[t] for r in mix) for t in sizes} == sizes and len(mix) == 7
    doc = spark.read.json(f"{out}/clustering_results").first()
    assert doc.n_entities == 70 and len(doc.segment_mix) == 7
    assert sum(doc.pca_explained_variance) == pytest.approx(1, abs=0.05)
    back = metrics_json.read_sweep(spark, f"{out}/clustering_results").orderBy("k").collect()
    assert [(r.k, r.wssse) for r in back] == [(r.k, pytest.approx(r.wssse)) for r in sweep]
    saved = tables.read_table(spark, f"{out}/entity_tiers")
    assert saved.count() == 70 and saved.columns == ["entity_id", "segment", "demand_tier", *PR.PROFILE]
    ratio = RE.tier_ratio(result.summary).first().tier_ratio
    assert ratio == pytest.approx(summary[2].avg_daily_wd / summary[0].avg_daily_wd)


def test_kmeans_does_not_depend_on_input_layout(profiles):
    def sizes(rows):
        frame = CU.cluster_frame(rows)
        return sorted(r["count"] for r in CU.kmeans(3).fit(frame).transform(frame).groupBy("prediction").count().collect())

    assert sizes(profiles.repartition(1)) == sizes(profiles.repartition(8))


def test_unlogged_and_compare(profiles):
    frame = CU.cluster_frame(profiles, log=False).persist()
    assert CU.demand_tiers(frame).count() == 70
    rows = CU.compare_algorithms(frame, bisecting=True).collect()
    assert [r.algorithm.split(" (")[0] for r in rows] == ["K-Means", "Gaussian Mixture", "Bisecting K-Means"]


def test_nearest_center_equals_model(profiles):
    frame = CU.cluster_frame(profiles)
    model = CU.kmeans(3).fit(frame)
    arr = vector_to_array("features")
    cols = frame.select("entity_id", *[arr[i].alias(f"x{i}") for i in range(3)])
    ours = CU.nearest_center(cols, ["x0", "x1", "x2"], [c.tolist() for c in model.clusterCenters()])
    theirs = model.transform(frame).select("entity_id", F.col("prediction").alias("p"))
    assert ours.join(theirs, "entity_id").where("prediction <> p").count() == 0


def test_usual_tier_tie_and_policy(spark):
    rows = [("a", 1, "Low"), ("a", 3, "High"), ("b", 3, "High"), ("b", 3, "High"), ("b", 1, "Low")]
    df = spark.createDataFrame(rows, "segment string, tier_rank int, demand_tier string")
    got = {r.segment: (r.usual_tier, round(r.tier_share, 4)) for r in RE.usual_tier(df).collect()}
    assert got == {"a": ("Low", 0.5), "b": ("High", 0.6667)}
    named = RE.with_policy(df, RE.policy_table(spark))
    assert named.where("policy IS NULL").count() == 0 and named.count() == 5


def test_lift(spark):
    m = spark.createDataFrame([("x", 0.95, 0.9)], "model string, accuracy double, f1 double")
    b = spark.createDataFrame([("n", 0.9, 0.8)], "model string, accuracy double, f1 double")
    r = RE.lift_over_baseline(m, b).first()
    assert (r.accuracy_lift, r.f1_lift) == (pytest.approx(5), pytest.approx(10))
