"""Proofs of the fits: Newton steps, split search, centers, mixtures and sketches against plain computations."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from weekloom.operators import centers, logistic, sketches, splits


@pytest.fixture(scope="module")
def points(spark):
    r = np.random.default_rng(5)
    x = np.concatenate([r.normal(m, 0.4, (60, 2)) for m in (-2, 0, 3)])
    y = (r.random(len(x)) < 1 / (1 + np.exp(-(0.3 + x[:, 0] - 0.5 * x[:, 1])))).astype(float)
    return x, y, spark.createDataFrame([(*map(float, a), float(b), "s") for a, b in zip(x, y, strict=True)], "a double, b double, label double, loss string").persist()


def test_newton_weights_are_the_optimum(spark, points):
    x, y, df = points
    steps = logistic.newton_steps(df, ["a", "b"]).orderBy("step").collect()
    losses = [s.loss for s in steps]
    assert losses == sorted(losses, reverse=True) and steps[-1].gradient < 1e-10 and steps[0].loss == pytest.approx(math.log(2))
    w = np.array(steps[-1].weights)
    z = np.column_stack([np.ones(len(x)), x])
    p = 1 / (1 + np.exp(-z @ w))
    assert np.abs(z.T @ (y - p)).max() / len(x) < 1e-9
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    fit = LogisticRegression(tol=1e-10).fit(rows)
    assert np.allclose([fit.intercept, *fit.coefficients.toArray()], w, atol=1e-4)
    proof = logistic.optimality(rows, fit.coefficients.toArray().tolist(), fit.intercept).first()
    assert proof.n_rows == len(x) and proof.gradient < 1e-5 and proof.loss == pytest.approx(losses[-1], abs=1e-8)
    wrong = logistic.optimality(rows, [1.2 * w[1], w[2]], w[0]).first()
    assert wrong.gradient > 1e-3 and wrong.loss > losses[-1]


def test_newton_without_an_optimum(spark):
    apart = spark.createDataFrame([(float(i), float(i > 5), 2.0 * i) for i in range(10)], "a double, label double, b double")
    with pytest.raises(ValueError):
        logistic.newton_steps(apart, ["a"], steps=200)
    with pytest.raises(ValueError):
        logistic.newton_steps(apart, ["a", "b"])
    none = logistic.newton_steps(apart.where("false"), ["a"]).collect()
    assert len(none) == 1 and none[0].loss is None
    holes = spark.createDataFrame([(1.0, None), (None, 1.0), (float("nan"), 1.0)], "a double, label double")
    assert logistic.newton_steps(holes, ["a"]).first().weights is None


def brute_splits(values, labels):
    gini = lambda part: 2 * (sum(part) / len(part)) * (1 - sum(part) / len(part))
    out = []
    distinct = sorted(set(values))
    for lo, hi in zip(distinct, distinct[1:]):
        left = [y for v, y in zip(values, labels, strict=True) if v <= lo]
        right = [y for v, y in zip(values, labels, strict=True) if v > lo]
        gain = gini(labels) - len(left) / len(labels) * gini(left) - len(right) / len(labels) * gini(right)
        out.append(((lo + hi) / 2, gain, len(left), sum(left)))
    return out


@pytest.mark.parametrize("cells", [1, 2, 7, 256])
def test_splits_equal_a_search_of_all_places(spark, cells):
    r = random.Random(3)
    rows = [(r.choice([1.0, 2.0, 2.5, 9.0]), r.gauss(0, 1), 4.0, float(r.random() < 0.4)) for _ in range(150)]
    df = spark.createDataFrame([*rows, (None, 1.0, 4.0, None)], "few double, many double, one double, label double")
    got = splits.split_gains(df, ["few", "many", "one"], cells=cells).collect()
    for i, name in enumerate(["few", "many", "one"]):
        want = brute_splits([x[i] for x in rows], [x[3] for x in rows])
        own = sorted((x.threshold, x.gain, x.n_left, x.pos_left) for x in got if x.feature == name)
        assert np.allclose(own, want, atol=1e-12) if want else not own
    best = {x.feature: x.threshold for x in splits.best_splits(df, ["few", "many", "one"], cells=cells).collect()}
    top = max(brute_splits([x[1] for x in rows], [x[3] for x in rows]), key=lambda x: (round(x[1], 12), -x[0]))
    assert best["many"] == pytest.approx(top[0]) and "one" not in best
    assert splits.split_gains(df.where("false"), ["few"], cells=cells).count() == 0


def test_hot_value_is_one_row(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.col("id").cast("double")).alias("v"), (F.col("id") % 2).cast("double").alias("label"))
    got = splits.split_gains(df, ["v"], cells=16)
    assert got.count() == 2000 and got.agg(F.max("n_left")).first()[0] == 2999


def test_fitted_centers_in_sql(spark, points, tmp_path):
    """The fitted centers are staged, SQL assigns the rows anew: means, sizes and SSE agree."""
    x, _, df = points
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    model = KMeans(k=3, seed=11, tol=0.0, maxIter=100).fit(rows)
    fitted = [c.tolist() for c in model.clusterCenters()]
    spark.createDataFrame([(i, *c) for i, c in enumerate(fitted)], "id int, ca double, cb double").write.parquet(f"{tmp_path}/centers")
    df.select("a", "b").write.parquet(f"{tmp_path}/rows")
    again = duckdb.sql(f"""
        WITH near AS (SELECT a, b, id, ca, cb, (a - ca) ** 2 + (b - cb) ** 2 AS d
                      FROM '{tmp_path}/rows/*.parquet', '{tmp_path}/centers/*.parquet'
                      QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY d, id) = 1)
        SELECT id, count(*), sum(d), avg(a) - any_value(ca), avg(b) - any_value(cb) FROM near GROUP BY id ORDER BY id""").fetchall()
    assert all(abs(r[3]) < 1e-9 and abs(r[4]) < 1e-9 for r in again)
    assert sum(r[2] for r in again) == pytest.approx(model.summary.trainingCost)
    assert [r[1] for r in again] == model.summary.clusterSizes
    proof = centers.fixed_point(df, ["a", "b"], fitted).first()
    assert proof.n_rows == len(x) and proof.shift < 1e-9 and proof.sse == pytest.approx(model.summary.trainingCost)
    moved = [[c[0] + 0.2, c[1]] for c in fitted]
    assert centers.fixed_point(df, ["a", "b"], moved).first().shift > 0.1


def test_lloyd_ends_at_a_fixed_point_and_keeps_empty_clusters(spark, points):
    _, _, df = points
    out = centers.lloyd(df, ["a", "b"], [[-1.0, -1.0], [0.1, 0.0], [1.0, 1.0], [99.0, 99.0]]).orderBy("cluster").collect()
    assert out[3].n_rows == 0 and out[3].center == [99.0, 99.0] and sum(r.n_rows for r in out) == 180
    assert centers.fixed_point(df, ["a", "b"], [r.center for r in out]).first().shift == 0
    assert sum(r.n_rows for r in centers.lloyd(df.where("false"), ["a", "b"], [[0.0, 0.0]]).collect()) == 0


def test_bisection_tree(spark, points):
    x, _, df = points
    rows, tree = centers.bisect(df, ["a", "b"], 4)
    tree = {r.node: r for r in tree.collect()}
    leaves = {i for i, r in tree.items() if r.is_leaf}
    assert len(leaves) == 4 and tree[0].n_rows == len(x)
    assert tree[0].sse == pytest.approx(((x - x.mean(0)) ** 2).sum())
    for i in set(tree) - leaves:
        kids = [r for r in tree.values() if r.parent == i]
        assert len(kids) == 2 and sum(r.n_rows for r in kids) == tree[i].n_rows and sum(r.sse for r in kids) < tree[i].sse
    per = rows.groupBy("leaf").agg(F.count("a").alias("n"), ((F.var_pop("a") + F.var_pop("b")) * F.count("a")).alias("sse")).collect()
    assert {r.leaf for r in per} == leaves
    assert all(r.n == tree[r.leaf].n_rows and r.sse == pytest.approx(tree[r.leaf].sse) for r in per)
    same = spark.createDataFrame([(1.0, 1.0)] * 5, "a double, b double")
    assert centers.bisect(same, ["a", "b"], 3)[1].count() == 1


def test_mixture_step_equals_numpy(spark, points):
    x, _, df = points
    w, m = np.array([0.3, 0.7]), np.array([[-1.0, -1.0], [1.0, 2.0]])
    cov = np.array([[[1.0, 0.2], [0.2, 0.7]], [[2.0, -0.3], [-0.3, 1.0]]])
    for _ in range(150):
        dens = np.stack([w[k] * np.exp(-0.5 * np.einsum("ni,ij,nj->n", x - m[k], np.linalg.inv(cov[k]), x - m[k])) / np.linalg.det(cov[k]) ** 0.5 for k in (0, 1)])
        r = dens / dens.sum(0)
        new_w = r.mean(1)
        new_m = (r @ x) / r.sum(1)[:, None]
        new_cov = np.stack([((x - new_m[k]).T * r[k]) @ (x - new_m[k]) / r[k].sum() for k in (0, 1)])
        if _ == 0:
            got = centers.mixture_step(df, ["a", "b"], w.tolist(), m.tolist(), cov.tolist()).orderBy("component").collect()
            assert np.allclose([g.weight for g in got], new_w) and np.allclose([g["mean"] for g in got], new_m)
            assert np.allclose([g.covariance for g in got], new_cov.reshape(2, 4))
        w, m, cov = new_w, new_m, new_cov
    still = centers.mixture_step(df, ["a", "b"], w.tolist(), m.tolist(), cov.tolist()).orderBy("component").collect()
    assert np.allclose([g["mean"] for g in still], m, atol=1e-5)  # stationary
    none = centers.mixture_step(df.where("false"), ["a", "b"], w.tolist(), m.tolist(), cov.tolist()).collect()
    assert [g.weight for g in none] == [None, None]


def test_sketches_merge(spark):
    rows = spark.range(20_000).select((F.col("id") % 7000).alias("u"), (F.col("id") % 13).alias("week"), F.sqrt("id").alias("x"))
    kept = sketches.stored_distinct(rows, F.col("week"), "u")
    assert kept.count() == 13
    n = sketches.merged_distinct(kept).first().n_distinct
    assert abs(n - 7000) <= sketches.DISTINCT_ERROR * 7000
    assert sketches.merged_distinct(kept.where("false")).first().n_distinct == 0
    exact = spark.createDataFrame([(7000,)], "n_entities long")
    assert sketches.distinct_check(kept, exact).first().within_error == 1
    assert sketches.distinct_check(kept.where("part < 3"), exact).first().within_error == 0
    held = sketches.stored_quantiles(rows, F.col("week"), "x")
    assert [r.within_error for r in sketches.quantile_check(rows, held, "x", (0.1, 0.5, 0.9)).collect()] == [1, 1, 1]
    wrong = sketches.stored_quantiles(rows.where("x < 50"), F.col("week"), "x")
    assert [r.within_error for r in sketches.quantile_check(rows, wrong, "x", (0.5, 0.9)).collect()] == [0, 0]
