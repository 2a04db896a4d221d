"""Centers as DataFrame aggregations: Lloyd steps, fixed points of a fit, bisection, mixture steps."""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from weekloom.operators.metrics import squared_distance

CENTER_SCHEMA = "cluster int, n_rows long, sse double, center array<double>"


def _nearest(columns: list[str], centers: list[list[float]]) -> Column:
    return F.array_min(F.array(*[F.struct(squared_distance(columns, c).alias("d"), F.lit(i).alias("id")) for i, c in enumerate(centers)]))


def lloyd_step(rows: DataFrame, columns: list[str], centers: list[list[float]]) -> list[tuple[int, int, float, list[float]]]:
    """``(cluster, rows, SSE to the given center, mean)`` by one aggregation; an empty cluster keeps its center."""
    near = rows.select(*columns, _nearest(columns, centers).alias("__near"))
    found = near.groupBy(F.col("__near.id").alias("id")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("__near.d").alias("sse"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]).collect()
    by = {r["id"]: (i, r["n"], r["sse"], [r[f"m{j}"] for j in range(len(columns))]) for i, r in ((r["id"], r) for r in found)}
    return [by.get(i, (i, 0, 0.0, list(c))) for i, c in enumerate(centers)]


def lloyd(rows: DataFrame, columns: list[str], centers: list[list[float]], steps: int = 100, tolerance: float = 0.0) -> DataFrame:
    """Centers after up to ``steps`` Lloyd steps from given ones: one row per cluster, SSE to the centers returned.

    Ends when no center moves by more than ``tolerance``. One aggregation a step, k rows read
    back. Rows with nulls or NaN take no part; the lower id wins a tie; an empty cluster stays where it is.
    """
    rows = rows.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    centers = [[float(x) for x in c] for c in centers]
    for _ in range(steps):
        moved = [m for _, _, _, m in lloyd_step(rows, columns, centers)]
        gap = max((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)) for x, y in zip(moved, centers, strict=True)), default=0.0)
        centers = moved
        if gap**0.5 <= tolerance:
            break
    last = lloyd_step(rows, columns, centers)
    table = [(i, n, sse, c) for (i, n, sse, _), c in zip(last, centers, strict=True)]
    return rows.sparkSession.createDataFrame(table, CENTER_SCHEMA)


def fixed_point(rows: DataFrame, columns: list[str], centers: list[list[float]]) -> DataFrame:
    """n_rows, SSE, and the longest way from a center to the mean of the rows nearest to it, by one aggregation.

    A K-Means result is a fixed point exactly if that way is zero.
    """
    step = lloyd_step(rows, columns, centers)
    shift = max(sum((a - b) ** 2 for a, b in zip(m, c, strict=True)) ** 0.5 for (_, _, _, m), c in zip(step, centers, strict=True))
    return rows.sparkSession.createDataFrame(
        [(sum(s[1] for s in step), float(sum(s[2] for s in step)), float(shift))], "n_rows long, sse double, shift double")


TREE_SCHEMA = "node int, parent int, n_rows long, sse double, center array<double>, is_leaf int"


def bisect(rows: DataFrame, columns: list[str], k: int = 3, steps: int = 50) -> tuple[DataFrame, DataFrame]:
    """Bisecting K-Means with its split tree: ``(rows with their leaf, tree)``.

    The leaf of largest SSE is split by two centers one deviation to either side along its widest
    column and Lloyd steps, until there are ``k`` leaves or none has any spread. The tree has a row
    for each node: parent, rows, SSE around its mean. Rows with a null or NaN take no part; the tree
    travels as one column expression, a few splits long.
    """
    rows = rows.where(F.expr(" and ".join(f"`{c}` is not null and not isnan(`{c}`)" for c in columns)))

    def figures(part: DataFrame):
        r = part.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                     *[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(columns)]).first()
        size = len(columns)
        return r["n"], [r[f"m{i}"] or 0.0 for i in range(size)], [r[f"v{i}"] or 0.0 for i in range(size)]

    def node(part: DataFrame, parent: int | None):
        n, mean, var = figures(part)
        return {"parent": parent, "n": n, "sse": n * sum(var), "center": mean, "var": var, "leaf": 1}

    leaf = F.lit(0)
    tree = [node(rows, None)]
    while sum(t["leaf"] for t in tree) < k:
        i = max((j for j, t in enumerate(tree) if t["leaf"]), key=lambda j: (tree[j]["sse"], -j))
        if tree[i]["sse"] <= 0:
            break
        own = rows.where(leaf == i)
        wide = int(np.argmax(tree[i]["var"]))
        start = []
        for sign in (-1, 1):
            c = list(tree[i]["center"])
            c[wide] += sign * tree[i]["var"][wide] ** 0.5
            start.append(c)
        two = [r["center"] for r in lloyd(own, columns, start, steps).orderBy("cluster").collect()]
        a, b = len(tree), len(tree) + 1
        leaf = F.when(leaf == i, F.when(_nearest(columns, two)["id"] == 0, a).otherwise(b)).otherwise(leaf)
        tree[i]["leaf"] = 0
        tree += [node(rows.where(leaf == a), i), node(rows.where(leaf == b), i)]
    table = [(j, t["parent"], t["n"], float(t["sse"]), t["center"], t["leaf"]) for j, t in enumerate(tree)]
    return rows.withColumn("leaf", leaf), rows.sparkSession.createDataFrame(table, TREE_SCHEMA)


MIXTURE_SCHEMA = "component int, weight double, mean array<double>, covariance array<double>"


def mixture_step(rows: DataFrame, columns: list[str], weights: list[float], means: list[list[float]], covariances: list[list[list[float]]]) -> DataFrame:
    """One EM step of a Gaussian mixture by one aggregation: weight, mean and covariance (row by row) of every component.

    Responsibilities are column expressions of the given parameters; a component's new figures are its
    responsibility-weighted moments. Parameters are stationary, a maximum of the likelihood for
    EM, exactly if they come back unchanged. Rows with a null or NaN take no part.
    """
    rows = rows.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    size, logs = len(columns), []
    for w, m, cov in zip(weights, means, covariances, strict=True):
        inverse = np.linalg.inv(np.array(cov, float))
        quad = F.lit(0.0)
        for i in range(size):
            for j in range(size):
                quad = quad + F.lit(float(inverse[i, j])) * (F.col(columns[i]) - F.lit(float(m[i]))) * (F.col(columns[j]) - F.lit(float(m[j])))
        logs.append(F.lit(float(np.log(w) - 0.5 * np.linalg.slogdet(np.array(cov, float))[1])) - 0.5 * quad)
    scored = rows.select(*columns, F.array(*logs).alias("__l"))
    top = F.array_max("__l")
    shares = F.transform("__l", lambda x: F.exp(x - top))
    scored = scored.withColumn("__e", shares).withColumn("__s", F.aggregate("__e", F.lit(0.0), lambda s, x: s + x))
    pairs = list(combinations_with_replacement(range(size), 2))
    sums = []
    for k in range(len(weights)):
        r = F.col("__e")[k] / F.col("__s")
        sums.append(F.sum(r).alias(f"n{k}"))
        sums += [F.sum(r * F.col(c)).alias(f"s{k}_{i}") for i, c in enumerate(columns)]
        # around the old mean, which keeps the digits
        sums += [F.sum(r * (F.col(columns[i]) - F.lit(float(means[k][i]))) * (F.col(columns[j]) - F.lit(float(means[k][j])))).alias(f"q{k}_{i}_{j}")
                 for i, j in pairs]
    row = scored.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    table = []
    for k in range(len(weights)):
        n = row[f"n{k}"]
        if not n:
            table.append((k, 0.0 if row["n"] else None, None, None))
            continue
        mean = [row[f"s{k}_{i}"] / n for i in range(size)]
        gap = [a - b for a, b in zip(mean, means[k], strict=True)]
        cov = {(i, j): row[f"q{k}_{i}_{j}"] / n - gap[i] * gap[j] for i, j in pairs}
        table.append((k, n / row["n"], mean, [cov[min(i, j), max(i, j)] for i in range(size) for j in range(size)]))
    return rows.sparkSession.createDataFrame(table, MIXTURE_SCHEMA)
