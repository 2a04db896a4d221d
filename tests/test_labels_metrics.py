import datetime as dt
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from weekloom.operators import labels as L, metrics as M


def pairs(spark, rows):
    return spark.createDataFrame([(float(a), float(b)) for a, b in rows], "label double, prediction double")


def test_binary_metrics(spark):
    df = pairs(spark, [(0, 0)] * 2 + [(0, 1)] + [(1, 1)] * 4 + [(1, 0)])
    r = M.class_metrics(M.confusion(df)).first()
    assert (r.TN, r.FP, r.FN, r.TP) == (2, 1, 1, 4)
    assert [r.accuracy, r.precision, r.recall, r.f1] == pytest.approx([0.75] * 4)


def test_absent_class(spark):
    r = M.class_metrics(M.confusion(pairs(spark, [(0, 1), (1, 1)]))).first()
    assert [r.accuracy, r.precision, r.recall, r.f1] == pytest.approx([0.5, 0.25, 0.5, 1 / 3])


def test_metrics_equal_evaluators(spark):
    rng = random.Random(5)
    df = pairs(spark, [(rng.random() < 0.3, rng.random() < 0.4) for _ in range(500)])
    r = M.class_metrics(M.confusion(df)).first()
    for ours, name in (("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1")):
        assert r[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=name).evaluate(df))
    assert r.TN + r.FP + r.FN + r.TP == 500


@pytest.mark.parametrize("cells", [None, 1, 7])
@pytest.mark.parametrize("levels", [5, 100000])
def test_auc_is_exact(spark, cells, levels):
    rng = random.Random(levels)
    rows = []
    for _ in range(800):
        y = rng.random() < 0.4
        s = 3.0 if rng.random() < 1 / 3 else float(int((rng.random() + 0.3 * y) * levels))  # one hot score
        rows.append((s, float(y)))
    df = spark.createDataFrame(rows, "rawPrediction double, label double")
    won = sum((a > b) + 0.5 * (a == b) for a, y in rows if y for b, z in rows if not z)
    n_pos = sum(y for _, y in rows)
    r = M.roc_auc(df, "rawPrediction", cells=cells).first()
    assert (r.n_pos, r.n_neg) == (n_pos, len(rows) - n_pos)
    assert r.auc == pytest.approx(won / (n_pos * (len(rows) - n_pos)))
    assert r.auc == pytest.approx(BinaryClassificationEvaluator(numBins=0).evaluate(df))


def test_auc_without_a_class(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0)], "s double, label double")
    assert M.roc_auc(df, "s").first().auc is None


def test_threshold_sweep(spark):
    rows = [(0.2, 0.0), (0.5, 1.0), (0.7, 0.0), (0.9, 1.0)]
    df = spark.createDataFrame(rows, "s double, label double")
    got = {r.threshold: (r.TN, r.FP, r.FN, r.TP) for r in M.threshold_sweep(df, "s", [0.4, 0.5, 1.0]).collect()}
    assert got == {0.4: (1, 1, 0, 2), 0.5: (1, 1, 1, 1), 1.0: (2, 0, 2, 0)}


def test_silhouette(spark):
    points = [(0.0, 0), (1.0, 0), (10.0, 1), (12.0, 1), (50.0, 2)]
    df = spark.createDataFrame(points, "x double, prediction int")
    assert M.silhouette(df, ["x"]).first().silhouette == pytest.approx(0.781503, abs=1e-6)
    assert M.silhouette(df.where("prediction = 0"), ["x"]).first().silhouette == 0


def test_cluster_sse(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (5.0, 5.0)], "x double, y double")
    assert M.cluster_sse(df, ["x", "y"], [[0, 0], [5, 4]]).first().wssse == pytest.approx(3.0)


def brute(values, q):
    import math

    s = sorted(values)
    return s[max(1, math.ceil(q * len(s))) - 1]


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.9, 1.0])
def test_exact_threshold_equals_sorting(spark, q):
    rng = random.Random(7)
    # a third of the rows share one value
    values = [50.0 if rng.random() < 1 / 3 else round(rng.random() * 100, 3) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "wd double")
    assert L.exact_threshold(df, q=q, cells=20) == brute(values, q)
    assert L.exact_threshold(df, q=q) == brute(values, q)


def test_exact_threshold_of_one_value_and_none(spark):
    df = spark.createDataFrame([(1.5,)] * 300, "wd double")
    assert L.exact_threshold(df, cells=5) == 1.5
    assert L.exact_threshold(df.where("wd > 9")) is None
    ends = df.sparkSession.sql("select * from values (double('-inf')), (double('inf')), (double('inf')), (null) as t(wd)")
    assert L.exact_threshold(ends) == float("inf")
    assert L.exact_threshold(ends, q=0.1) == float("-inf")


def test_sketch_threshold_is_close(spark):
    df = spark.range(1, 10001).select(F.col("id").cast("double").alias("wd"))
    assert abs(L.sketch_threshold(df) - 5000) <= 11


def test_split_compares_week_start(spark):
    weeks = [dt.date(2025, 6, 23) + dt.timedelta(7 * i) for i in range(4)]
    df = spark.createDataFrame([(w, 1.0) for w in weeks], "week_start date, wd double")
    train, test = L.time_split(df, "2025-07-01")
    assert [r.week_start for r in train.orderBy("week_start").collect()] == weeks[:2]
    assert test.count() == 2


def test_label_is_strictly_above(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, 3.0)], "wd double, lag1_wd double")
    out = L.persistence(L.label_high(df, 2.0), 2.0).orderBy("wd").collect()
    assert [(r.label, r.prediction) for r in out] == [(0.0, 0.0), (0.0, 0.0), (1.0, 1.0)]
