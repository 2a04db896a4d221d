"""Tasks of the dense panel follow entities and days."""

import datetime as dt

from pyspark.sql import functions as F

from weekloom import Roles
from weekloom.operators import calendar as C, panel as P, quality as Q, rollup as R

START, END = dt.date(2024, 1, 1), dt.date(2024, 1, 28)


def _panel(spark, n):
    entities = spark.range(n).select(F.col("id").alias("entity_id"), F.lit("all").alias("segment"))
    daily = entities.select("entity_id", F.lit(START).alias("day"), F.lit(1.0).alias("value"), F.lit(1).alias("n_ok"), F.lit(0).alias("n_failed"))
    return P.densify(daily, entities, C.calendar(spark, START, END, ()), START, END)


def test_a_task_of_the_dense_panel_stays_bounded(spark, monkeypatch):
    monkeypatch.setattr(P, "PANEL_ROWS", 2_800)
    for n in (1_000, 4_000):
        dense = _panel(spark, n)
        sizes = [r["count"] for r in dense.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 28 * n and max(sizes) <= 2 * P.PANEL_ROWS
        one = Q.data_quality(dense, Roles()).first()
        assert (one.n_rows, one.n_entities, one.duplicate_rows, one.outage_rows) == (28 * n, n, 0, 27 * n)


def test_panel_tasks_follow_entities_and_days():
    assert P.panel_partitions(0, START, END) == P.LEAST_PARTITIONS
    assert P.panel_partitions(10 * P.PANEL_ROWS, START, START) == 10


def test_a_task_of_the_weekly_rollup_stays_bounded(spark, monkeypatch):
    monkeypatch.setattr(P, "PANEL_ROWS", 2_800)
    weekly = R.weekly_rollup(_panel(spark, 4_000))
    sizes = [r["count"] for r in weekly.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 4 * 4_000 and max(sizes) <= 2 * P.PANEL_ROWS // 7
    assert weekly.agg(F.sum("wd"), F.sum("outage_days")).first() == (4_000.0, 27 * 4_000)
