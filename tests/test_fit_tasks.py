"""Tasks of a fit follow the rows, not the setting alone."""

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from weekloom.operators import classify as CL


def test_few_rows_make_few_fit_tasks(spark):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        rows = spark.range(1000).withColumnRenamed("id", "entity_id")
        laid = CL.pinned(rows, ["entity_id"])
        assert laid.rdd.getNumPartitions() == CL.LEAST_PARTITIONS
        assert laid.agg(F.sum("entity_id"), F.count("*")).first() == (499500, 1000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_fit_tasks_grow_with_rows_up_to_the_setting():
    assert CL.fit_partitions(0, 8) == 8
    assert CL.fit_partitions(6_000, 200) == CL.LEAST_PARTITIONS
    assert CL.fit_partitions(100 * CL.FIT_ROWS + 1, 200) == 101
    assert CL.fit_partitions(1000 * CL.FIT_ROWS, 200) == 200


def test_rows_are_scored_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def score(label):
        seen.add(1)
        return float(label > 0)

    rows = spark.createDataFrame([(float(i % 2),) for i in range(40)], "label double").coalesce(2)
    scored = rows.withColumn("prediction", F.udf(score, "double")("label"))
    scored = scored.withColumn("rawPrediction", array_to_vector(F.array(-F.col("prediction"), F.col("prediction"))))
    record = CL.score_model("m", scored)
    assert record["auc"] == record["accuracy"] == 1.0 and record["confusion"] == {"TN": 20, "FP": 0, "FN": 0, "TP": 20}
    assert seen.value == 40
