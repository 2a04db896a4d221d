"""What the physical plans must look like for the work to hold at scale."""

import re

import pytest

from compare import TESTDATA
from weekloom.plans import queries as Q

SF = f"{TESTDATA}/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(plan: str, key: str = "") -> list[str]:
    return [keys for keys in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan) if key in keys]


def test_weekly_features_plan(spark):
    plan = plan_of(Q.weekly_features(spark, SF))
    assert len(shuffles(plan, "entity_id")) == 2  # (entity, week) after partial sums, then entity
    assert len(shuffles(plan)) == 2
    assert "partial_sum" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    scan = next(line for line in plan.splitlines() if "l_shipdate" in line and "FileScan" in line)
    assert "GreaterThanOrEqual(l_shipdate" in scan
    assert scan[scan.index("ReadSchema") :].count(":") == 5  # "ReadSchema:" and four columns


def test_recent_features_read_fewer_days(spark):
    plan = plan_of(Q.weekly_features_recent(spark, SF))
    assert "l_shipdate#" in plan and "2000-05-29 00:00:00" in plan  # four weeks before the cut's Monday


@pytest.mark.parametrize("name", ["weekly_rollup", "entity_profile", "segment_summary"])
def test_dense_panel_is_not_shuffled(spark, name):
    plan = plan_of(Q.QUERIES[name](spark, SF))
    above = plan[: plan.index("Generate explode")]
    assert "hashpartitioning(entity_id" not in above


@pytest.mark.parametrize("name", ["weekly_from_records", "profile_from_daily", "data_quality", "segment_summary"])
def test_no_python_in_the_plan(spark, name):
    plan = plan_of(Q.QUERIES[name](spark, SF))
    assert "Python" not in plan and "ArrowEval" not in plan


def test_only_the_calendar_is_broadcast_by_hint(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastExchange" not in plan_of(Q.profile_from_daily(spark, SF))
        hinted = plan_of(Q.weekly_features(spark, SF)).split("BroadcastExchange")[1:]
        assert len(hinted) == 2  # weeks of the calendar, and the listed event days inside it
        assert all("FileScan" not in part for part in hinted)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
