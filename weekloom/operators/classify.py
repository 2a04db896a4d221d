"""Train, score and compare classifiers on one labelled feature table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, Window, functions as F

from weekloom import constants as K
from weekloom.operators.encode import encoding_stages, unit_std_stage
from weekloom.operators.forest import Boosted, Forest
from weekloom.operators.metrics import class_metrics, confusion
from weekloom.roles import MODEL_METRICS, Roles

FOREST = "Random Forest"

#: Rows that one task of a fit reads, and the fewest tasks.
FIT_ROWS = 250_000
LEAST_PARTITIONS = 24


@dataclass(frozen=True)
class Entry:
    """A classifier and the vector column it reads."""

    estimator: object
    scaled: bool = False


def default_models(
    max_iter: int = K.MAX_ITER,
    trees: int = K.FOREST_TREES,
    rounds: int = K.BOOST_ROUNDS,
    seed: int = K.CLASSIFIER_SEED,
) -> dict[str, Entry]:
    """The three compared classifiers. Trees read the unscaled vector directly."""
    forest = Forest("raw", trees, K.FOREST_DEPTH, seed=seed)
    boosted = Boosted("raw", rounds, K.BOOST_DEPTH)
    return {
        "Logistic Regression": Entry(LogisticRegression(maxIter=max_iter), scaled=True),
        FOREST: Entry(forest),
        "Gradient-Boosted Trees": Entry(boosted),
    }


def fit_partitions(n_rows: int, most: int) -> int:
    """Tasks of a fit: about ``FIT_ROWS`` rows each, not under ``LEAST_PARTITIONS``, not over ``most``."""
    return min(most, max(LEAST_PARTITIONS, -(-n_rows // FIT_ROWS)))


def pinned(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """Rows in a layout that depends on the keys alone, so seeded fits repeat.

    Without ``partitions`` the rows are counted, as a fit runs hundreds of jobs of one task a
    partition, and each task of a forest sends the statistics of all its nodes.
    """
    n = partitions or fit_partitions(df.count(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, *keys).sortWithinPartitions(*keys)


def model_auc(predictions: DataFrame, bins: int = 1000) -> float:
    """Area under ROC from at most ``bins`` score groups (0 = every score)."""
    return BinaryClassificationEvaluator(
        labelCol="label", metricName="areaUnderROC", numBins=bins
    ).evaluate(predictions)


def score_model(name: str, predictions: DataFrame) -> dict:
    """One metrics record: a confusion pass and an AUC pass. The rows are scored once for both."""
    kept = predictions.select("label", "prediction", "rawPrediction").persist()
    row = class_metrics(confusion(kept)).first()
    auc = model_auc(kept)
    kept.unpersist()
    return {
        "model": name,
        **{m: row[m] for m in ("accuracy", "precision", "recall", "f1")},
        "auc": auc,
        "confusion": {c: row[c] for c in ("TN", "FP", "FN", "TP")},
    }


def compare_models(
    train: DataFrame,
    test: DataFrame,
    models: dict[str, Entry] | None = None,
    roles: Roles = Roles(),
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit every model on ``train``, score on ``test``: (metrics table, fitted models).

    ``train`` and ``test`` are read several times, so pass staged tables. The encoding is
    fitted once and shared. Encoded rows are kept in memory and on disk while the models
    iterate over them; a lost block is rebuilt from its input.
    """
    spark = train.sparkSession
    models = default_models() if models is None else models
    keys = [roles.entity, roles.week]
    encoder = Pipeline(stages=encoding_stages(roles)).fit(train)
    parts = fit_partitions(train.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    encoded = encoder.transform(train).select(*keys, "label", "raw")
    fit_rows = pinned(encoded, keys, parts).select("label", "raw").persist()
    test_rows = encoder.transform(test).select("label", "raw").persist()
    records, fitted = [], {}
    for name, entry in models.items():
        if entry.scaled:
            stages = [unit_std_stage(), entry.estimator.copy({entry.estimator.featuresCol: "features"})]
        else:
            stages = [entry.estimator]
        model = Pipeline(stages=stages).fit(fit_rows)
        records.append(score_model(name, model.transform(test_rows)))
        fitted[name] = PipelineModel([*encoder.stages, *model.stages])
    fit_rows.unpersist()
    test_rows.unpersist()
    return spark.createDataFrame(records, MODEL_METRICS), fitted


def best_model(metrics: DataFrame, order: list[str]) -> DataFrame:
    """The row with the highest AUC; the first in ``order`` wins a tie."""
    position = F.array_position(F.lit(order), F.col("model"))
    return metrics.orderBy(F.desc("auc"), position).limit(1)


def feature_importance(model: PipelineModel, numeric: list[str]) -> DataFrame:
    """feature, importance, rank and running share of a fitted forest.

    Names and weights are matched by position. One row per feature, so the ranking
    window is as small as the vector.
    """
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    labels = model.stages[0].labelsArray[0]
    names = [*numeric, *[f"loc_{c}" for c in labels[:-1]]]
    weights = [float(w) for w in model.stages[-1].featureImportances.toArray()]
    one = spark.range(1)
    named = one.select(F.posexplode(F.lit(names)).alias("pos", "feature"))
    weighed = one.select(F.posexplode(F.lit(weights)).alias("pos", "importance"))
    table = named.join(weighed, "pos").select("feature", "importance")
    return with_running_share(table)


def with_running_share(importances: DataFrame) -> DataFrame:
    """Rank by weight and the share of the total held by the features so far."""
    order = Window.orderBy(F.desc("importance"), "feature")
    total = Window.partitionBy()
    return importances.select(
        "feature",
        "importance",
        F.row_number().over(order).alias("rank"),
        (F.sum("importance").over(order.rowsBetween(Window.unboundedPreceding, 0)) / F.sum("importance").over(total)).alias(
            "running_share"
        ),
    )


def top_features(importances: DataFrame, k: int = 10) -> DataFrame:
    return importances.orderBy("rank").limit(k)
