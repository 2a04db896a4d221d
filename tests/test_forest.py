"""The forest on binned rows against MLlib's, and what it holds in tasks."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from weekloom.operators import classify as CL, forest as FO


def rows_(spark, n=900, inputs=4, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, inputs)).round(3)
    x[:, 1] = rng.integers(0, 5, n)
    x[: n // 2, 2] = 0.0
    y = (x[:, 0] + 0.3 * x[:, 1] + (x[:, 2] > 0.4) + rng.normal(size=n) > 0.8).astype(float)
    return spark.createDataFrame([(float(c), Vectors.dense(v)) for c, v in zip(y, x, strict=True)], ["label", "raw"]).repartition(3).persist()


def shown(predictions):
    parts = [vector_to_array(c)[1].alias(c) for c in ("rawPrediction", "probability")]
    return [tuple(r) for r in predictions.select("label", *parts, "prediction", "raw").orderBy(vector_to_array("raw"), "label").collect()]


@pytest.mark.parametrize("depth", [1, 4, 8])
def test_a_tree_equals_mllib(spark, depth):
    df = rows_(spark)
    theirs = RandomForestClassifier(featuresCol="raw", numTrees=1, maxDepth=depth, featureSubsetStrategy="all", bootstrap=False).fit(df)
    ours = FO.Forest("raw", 1, depth, bootstrap=False).fit(df)
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=1e-9)
    for a, b in zip(shown(ours.transform(df)), shown(theirs.transform(df)), strict=True):
        assert a[:4] == pytest.approx(b[:4], abs=1e-9) and a[4] == b[4]


def test_split_points_are_those_of_mllib(spark):
    """Many values, few values and one value of most rows: a stump's threshold is one of the split points."""
    df = rows_(spark)
    x = np.array([r.raw.toArray() for r in df.collect()])
    given = df.select(vector_to_array("raw").alias("x"), F.col("label").alias("y"))
    cuts = FO.thresholds(given, 31)
    assert [len(c) <= 31 for c in cuts] == [True] * 4 and cuts[1].tolist() == [0.5, 1.5, 2.5, 3.5]
    for j, cut in enumerate(cuts):
        points, n = np.unique(x[:, j], return_counts=True)
        assert cut.tolist() == FO.split_points(points, n, 31).tolist()


def test_summaries_of_many_values_keep_the_ranks():
    rng = np.random.default_rng(5)
    parts = [np.concatenate([np.zeros(20_000), rng.normal(size=30_000)]) for _ in range(4)]
    points, n = (np.concatenate(c) for c in zip(*map(FO._summary, parts), strict=True))
    cut = FO.split_points(points, n, 31)
    whole = np.concatenate(parts)
    share = np.array([(whole <= c).mean() for c in cut])
    assert n.sum() == len(whole) and (np.diff(share) < 1 / 32 + 0.41).all() and (np.diff(share)[np.diff(share) < 0.3] < 0.04).all()
    assert ((cut > -0.05) & (cut < 0.05)).any()


def test_bootstrap_counts_are_poisson():
    n = FO._poisson_table()
    assert n.mean() == pytest.approx(1, abs=1e-3) and n.var() == pytest.approx(1, abs=2e-3)
    assert (n == 0).mean() == pytest.approx(np.exp(-1), abs=1e-4)


def test_forest_is_as_good_as_mllib_and_repeatable(spark):
    df, other = rows_(spark, 4000), rows_(spark, 4000, seed=4)
    theirs = RandomForestClassifier(featuresCol="raw", numTrees=40, maxDepth=6, seed=1).fit(df)
    ours = FO.Forest("raw", 40, 6, seed=1).fit(df)
    assert CL.model_auc(ours.transform(other)) == pytest.approx(CL.model_auc(theirs.transform(other)), abs=0.01)
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=0.05)
    again = FO.Forest("raw", 40, 6, seed=1).fit(df)
    assert np.array_equal(ours.threshold, again.threshold) and np.array_equal(ours.feature, again.feature)
    assert not np.array_equal(ours.feature, FO.Forest("raw", 40, 6, seed=2).fit(df).feature)


def test_many_blocks_count_as_one(spark, monkeypatch):
    df = rows_(spark)
    whole = FO.Forest("raw", 1, 5, bootstrap=False).fit(df)
    monkeypatch.setattr(FO, "BLOCK", 64)
    monkeypatch.setattr(FO, "CHUNK", 100)
    cut = FO.Forest("raw", 1, 5, bootstrap=False).fit(df)
    assert np.array_equal(whole.feature, cut.feature) and np.array_equal(whole.threshold, cut.threshold)


def test_rows_that_cannot_be_fitted(spark):
    with pytest.raises(ValueError, match="needs rows"):
        FO.Forest("raw", 2, 2).fit(rows_(spark).where("false"))
    one = FO.Forest("raw", 3, 3).fit(rows_(spark).where("label = 0"))
    assert not one.featureImportances.toArray().any()
    assert one.transform(rows_(spark)).where("prediction != 0").count() == 0
    with pytest.raises(Exception, match="labels 0 and 1"):
        FO.Forest("raw", 2, 2).fit(rows_(spark).withColumn("label", F.lit(2.0)))


def test_the_compared_forest_sends_a_byte_an_input(spark):
    """Before, MLlib kept a sample count of every tree with each row."""
    estimator = CL.default_models()[CL.FOREST].estimator
    assert isinstance(estimator, FO.Forest) and (estimator.trees, estimator.depth, estimator.seed) == (150, 8, 7)
    given = rows_(spark).select(vector_to_array("raw").alias("x"), F.col("label").alias("y"))
    table = FO.blocks(given, FO.thresholds(given, 31))
    assert table.agg(F.sum(F.length("bins")), F.sum(F.length("y"))).first() == (900 * 4, 900)


@pytest.mark.parametrize("rounds, depth", [(1, 4), (8, 3)])
def test_boosted_rounds_equal_mllib(spark, rounds, depth):
    df = rows_(spark)
    theirs = GBTClassifier(featuresCol="raw", maxIter=rounds, maxDepth=depth).fit(df)
    ours = FO.Boosted("raw", rounds, depth).fit(df)
    for a, b in zip(shown(ours.transform(df)), shown(theirs.transform(df)), strict=True):
        assert a[:4] == pytest.approx(b[:4], abs=1e-9) and a[4] == b[4]


def test_boosted_blocks_and_checkpoints(spark, monkeypatch):
    df, other = rows_(spark, 3000), rows_(spark, 3000, seed=4)
    whole = FO.Boosted("raw", 12, 4).fit(df)
    monkeypatch.setattr(FO, "BLOCK", 200)
    monkeypatch.setattr(FO, "CHECKPOINT_ROUNDS", 3)
    cut = FO.Boosted("raw", 12, 4).fit(df)
    assert np.array_equal(whole.feature, cut.feature) and np.allclose(whole.value, cut.value)
    theirs = GBTClassifier(featuresCol="raw", maxIter=12, maxDepth=4).fit(df)
    assert CL.model_auc(whole.transform(other)) == pytest.approx(CL.model_auc(theirs.transform(other)), abs=0.005)


def test_boosted_rows_of_one_class(spark):
    for label in (0.0, 1.0):
        one = FO.Boosted("raw", 3, 3).fit(rows_(spark).where(F.col("label") == label))
        assert one.transform(rows_(spark)).where(F.col("prediction") != label).count() == 0
    with pytest.raises(ValueError, match="needs rows"):
        FO.Boosted("raw", 2, 2).fit(rows_(spark).where("false"))


def test_the_compared_boosted_trees_are_binned():
    estimator = CL.default_models()["Gradient-Boosted Trees"].estimator
    assert isinstance(estimator, FO.Boosted) and (estimator.rounds, estimator.depth, estimator.max_bins) == (60, 5, 32)
