import json

import pytest
from pyspark.sql import functions as F

from weekloom.operators import cluster, metrics, quality
from weekloom.roles import Roles
from weekloom.sources import metrics_json


def test_models_at_the_top_beside_meta(spark, tmp_path):
    entry = {"accuracy": 0.9, "precision": 0.8, "recall": 0.7, "f1": 0.75, "auc": 0.95, "confusion": {"TN": 5, "FP": 1, "FN": 2, "TP": 6}}
    path = tmp_path / "models.json"
    path.write_text(json.dumps({"A": entry, "B": entry, "Base": {"accuracy": 0.6, "f1": 0.6}, "_meta": {"best_model": "A", "train_rows": 9}}, indent=2))
    rows = {r.model: r for r in metrics_json.read_models(spark, str(path)).collect()}
    assert set(rows) == {"A", "B", "Base"} and rows["A"].TP == 6 and rows["Base"].auc is None
    meta = metrics_json.read_meta(spark, str(path), "best_model string, train_rows long").first()
    assert (meta.best_model, meta.train_rows) == ("A", 9)
    (tmp_path / "none.json").write_text("{}")
    with pytest.raises(ValueError):
        metrics_json.read_models(spark, str(tmp_path / "none.json"))


def test_nan_is_a_missing_cell(spark):
    r = Roles()
    row = {f.name: None for f in r.schema()}
    daily = spark.createDataFrame([tuple(row.values())], r.schema())
    holes = quality.data_quality(daily.withColumn("extra", F.lit(float("nan"))), r).first()["missing_cells"]
    assert holes == len(row) + 1


def test_names_for_every_cluster(spark):
    with pytest.raises(ValueError):
        cluster.demand_tiers(spark.range(3), k=4)
