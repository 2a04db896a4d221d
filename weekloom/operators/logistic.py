"""Logistic regression by Newton steps, and the proof that given weights are optimal."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

STEPS, TOLERANCE = 25, 1e-10
#: Mean p(1-p) below which every row's class is taken as certain: the weights then grow without end.
NO_DOUBT = 1e-9
STEP_SCHEMA = "step int, loss double, gradient double, weights array<double>"


def _total(terms: list[Column]) -> Column:
    total = F.lit(0.0)
    for t in terms:
        total = total + t
    return total


def _loss(eta: Column, y: Column) -> Column:
    """Log loss of one row, safe for large scores."""
    return F.greatest(eta, F.lit(0.0)) - y * eta + F.log1p(F.exp(-F.abs(eta)))


def _sums(rows: DataFrame, columns: list[str], label: str, weights: list[float]):
    """n, loss, X'(y-p) and the upper triangle of X'WX at the weights (intercept first), in one aggregation."""
    inputs = [F.lit(1.0), *[F.col(c) for c in columns]]
    eta = _total([F.lit(float(w)) * x for w, x in zip(weights, inputs, strict=True)])
    y = F.col(label)
    scored = rows.select(y.alias("__y"), eta.alias("__eta"), *[x.alias(f"__x{i}") for i, x in enumerate(inputs)])
    p = F.lit(1.0) / (1.0 + F.exp(-F.col("__eta")))
    scored = scored.withColumn("__p", p)
    v, r = F.col("__p") * (1.0 - F.col("__p")), F.col("__y") - F.col("__p")
    x = [F.col(f"__x{i}") for i in range(len(inputs))]
    pairs = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    row = scored.agg(
        F.count("__y").alias("n"), F.sum(_loss(F.col("__eta"), F.col("__y"))).alias("loss"),
        *[F.sum(r * c).alias(f"g{i}") for i, c in enumerate(x)], *[F.sum(v * x[i] * x[j]).alias(f"h{i}_{j}") for i, j in pairs],
    ).first()
    if not row["n"]:
        return 0, 0.0, np.zeros(len(x)), np.zeros((len(x), len(x)))
    curve = np.zeros((len(x), len(x)))
    for i, j in pairs:
        curve[i, j] = curve[j, i] = row[f"h{i}_{j}"]
    return row["n"], row["loss"], np.array([row[f"g{i}"] for i in range(len(x))]), curve


def newton_steps(
    rows: DataFrame, columns: list[str], label: str = "label", steps: int = STEPS, tolerance: float = TOLERANCE
) -> DataFrame:
    """One row per step: mean log loss and largest mean gradient at the step's weights, intercept first.

    Iteratively reweighted least squares: a step is one distributed sum of X'WX and X'(y-p), and a
    small linear system on the driver. Ends when the gradient is at most ``tolerance`` or after
    ``steps``; the last row's gradient tells which. Rows with a null or NaN input or label take no part;
    no rows give one step of null figures. Dependent columns and a label without both classes
    have no single optimum and raise.
    """
    rows = rows.select(F.col(label).cast("double").alias(label), *[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    weights, out = np.zeros(len(columns) + 1), []
    for step in range(steps + 1):
        n, loss, gradient, curve = _sums(rows, columns, label, weights.tolist())
        if not n:
            out.append((step, None, None, None))
            break
        out.append((step, loss / n, float(np.abs(gradient).max() / n), weights.tolist()))
        flat = curve[0, 0] / n < NO_DOUBT or np.linalg.matrix_rank(curve / n) < len(weights)
        if out[-1][2] <= tolerance and not flat:
            break
        if flat:
            raise ValueError("no single optimum: dependent columns, or classes that a plane separates")
        weights = weights + np.linalg.solve(curve, gradient)
    return rows.sparkSession.createDataFrame(out, STEP_SCHEMA)


def optimality(rows: DataFrame, coefficients: list[float], intercept: float, vector: str = "features", label: str = "label") -> DataFrame:
    """n_rows, mean log loss and largest mean gradient of given weights on a vector column.

    The log loss is convex: weights are optimal exactly where the gradient is zero.
    """
    size = len(coefficients)
    rows = rows.select(F.col(label).cast("double").alias("y"), vector_to_array(vector).alias("x"))
    eta = F.lit(float(intercept)) + _total([F.lit(float(w)) * F.col("x")[i] for i, w in enumerate(coefficients)])
    scored = rows.withColumn("eta", eta).withColumn("r", F.col("y") - F.lit(1.0) / (1.0 + F.exp(-F.col("eta"))))
    slopes = [F.abs(F.avg("r"))] + [F.abs(F.avg(F.col("r") * F.col("x")[i])) for i in range(size)]
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), F.avg(_loss(F.col("eta"), F.col("y"))).alias("loss"),
                      F.greatest(*slopes).alias("gradient") if size else slopes[0].alias("gradient"))
