import datetime as dt

import pytest
from pyspark.sql import functions as F

from weekloom import Roles
from weekloom import constants as K
from weekloom.operators import calendar as C, panel as P

D = dt.date
ROLES = Roles()


def dates(df, flag):
    return [r[0] for r in df.where(F.col(flag) == 1).orderBy("day").select("day").collect()]


def test_default_two_years(spark):
    cal = C.calendar(spark, "2024-01-01", "2025-12-31", K.DEFAULT_EVENTS).cache()
    assert cal.count() == 731
    assert len(dates(cal, "is_weekend")) == 208
    assert len(dates(cal, "is_event")) == 50
    assert C.day_counts("2024-01-01", "2025-12-31") == {
        "days": 731,
        "weekend": 208,
        "payday": len(dates(cal, "is_payday")),
    }


def test_one_event_opens_five_days(spark):
    cal = C.calendar(spark, "2024-03-01", "2024-04-30", ["2024-03-25"])
    assert dates(cal, "is_event") == [D(2024, 3, d) for d in range(22, 27)]


def test_event_table_equals_event_list(spark):
    events = ["2024-03-25", "2024-03-26", "2024-03-25"]
    table = spark.createDataFrame([(e,) for e in events], "e string")
    listed = C.event_days(spark, events).collect()
    opened = C.event_days(spark, table).collect()
    assert sorted(listed) == sorted(opened) and len(listed) == 6


def test_no_events(spark):
    assert dates(C.calendar(spark, "2024-03-01", "2024-03-31"), "is_event") == []


def test_payday_and_weekend(spark):
    cal = C.calendar(spark, "2024-03-01", "2024-03-31").cache()
    assert [d.day for d in dates(cal, "is_payday")] == [1, 2, 3, 28, 29, 30, 31]
    assert D(2024, 3, 1) not in dates(cal, "is_weekend")
    assert {D(2024, 3, 2), D(2024, 3, 3)} <= set(dates(cal, "is_weekend"))


def test_event_rows_is_a_semi_join(spark):
    rows = spark.createDataFrame([(D(2024, 3, 22), 1), (D(2024, 3, 22), 2), (D(2024, 3, 27), 3)], "day date, x int")
    kept = C.event_rows(rows, C.event_days(spark, ["2024-03-25"]))
    assert sorted(r.x for r in kept.collect()) == [1, 2]


def test_trend(spark):
    spine = C.date_spine(spark, "2024-01-01", "2024-01-10")
    got = [r[0] for r in spine.select("day", C.trend_index("day", "2024-01-01", "2024-01-10").alias("t")).orderBy("day").select("t").collect()]
    assert got[0] == 1.0 and got[5] == pytest.approx(1.05)


@pytest.fixture
def observed(spark):
    rows = [
        (1, D(2024, 1, 1), 10.0, 1, 0),
        (1, D(2024, 1, 3), 30.0, 2, 1),
        (2, D(2024, 1, 5), 50.0, 1, 1),
        (9, D(2024, 1, 2), 90.0, 1, 0),  # not a known entity
        (1, D(2024, 2, 9), 70.0, 1, 0),  # outside the range
    ]
    daily = spark.createDataFrame(rows, "entity_id long, day date, value double, n_ok long, n_failed long")
    known = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "entity_id long, segment string")
    return daily, known


def test_densify_against_brute_force(spark, observed):
    daily, known = observed
    start, end = D(2024, 1, 1), D(2024, 1, 5)
    cal = C.calendar(spark, start, end)
    dense = P.densify(daily, known, cal, start, end)
    got = {(r.entity_id, r.segment, r.day): (r.value, r.n_ok, r.n_failed) for r in dense.collect()}
    seen = {(r.entity_id, r.day): (r.value, r.n_ok, r.n_failed) for r in daily.collect()}
    want = {
        (e, s, start + dt.timedelta(i)): seen.get((e, start + dt.timedelta(i)), (0.0, 0, 0))
        for e, s in ((1, "a"), (2, "b"), (3, "a"))
        for i in range(5)
    }
    assert got == want and dense.count() == 15


def test_dense_rows_are_not_shuffled(spark, observed):
    daily, known = observed
    plan = P.fill_slots(daily, known, "day", "2024-01-01", "2024-01-05", 1, ["value"])._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Generate")]
    assert "Exchange" not in above


def test_mask_and_outage(spark):
    df = spark.createDataFrame([(0, 5.0), (3, 7.0)], "n_ok int, value double")
    out = P.mask_measures(df, P.outage_flag(ROLES), ["value"])
    assert sorted(r.value for r in out.collect()) == [0.0, 7.0]
    assert out.dtypes == df.dtypes


def test_expected_level_and_count(spark):
    levels = spark.createDataFrame([list(r) for r in K.DEFAULT_SEGMENT_LEVELS], "segment string, b double, w double, p double")
    day = lambda d, we, pay, ev: (1, "Mall", D(2024, 1, d), we, pay, ev, 2.0)
    panel = spark.createDataFrame(
        [day(1, 0, 0, 0), day(6, 1, 0, 0), day(2, 0, 1, 1)],
        "entity_id int, segment string, day date, is_weekend int, is_payday int, is_event int, scale double",
    )
    out = P.expected_level(panel, levels, "2024-01-01", "2024-01-10", "scale")
    got = {r.day.day: r.expected for r in out.collect()}
    assert got[1] == pytest.approx(640000)
    assert got[6] == pytest.approx(640000 * 1.35 * 1.05)
    assert got[2] == pytest.approx(640000 * 1.15 * 1.35 * 1.01)
    n = spark.createDataFrame([("Mall", 6500.0), ("Transit_Hub", 6500.0), ("Mall", 10.0)], "s string, v double")
    counts = [r[0] for r in n.select(P.derived_count(F.col("v"), F.lit(3200.0), F.col("s"))).collect()]
    assert counts == [2, 1, 1]


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "entity_id int, segment string")
    b = spark.createDataFrame([(2,)], "entity_id int")
    assert sorted((r.entity_id, r.segment or "") for r in P.union_panels([a, b]).collect()) == [(1, "x"), (2, "")]


def test_learned_levels(spark):
    days = spark.createDataFrame(
        [(D(2024, 1, 1), 0, 0, 0), (D(2024, 1, 2), 0, 0, 0), (D(2024, 1, 6), 1, 0, 0), (D(2024, 1, 28), 1, 1, 0)],
        "day date, is_weekend int, is_payday int, is_event int")
    entities = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "entity_id int, segment string")
    daily = spark.createDataFrame(
        [(1, D(2024, 1, 1), 8.0, 2), (1, D(2024, 1, 6), 4.0, 1), (2, D(2024, 1, 28), 12.0, 3)],
        "entity_id int, day date, value double, n_ok long")
    got = {r.segment: tuple(r)[1:] for r in P.learned_levels(daily, entities, days, ROLES).collect()}
    # two entities and two plain days: 8 / 4; weekends 16 / 4; paydays 12 / 2; no event days at all
    assert got["a"] == (2, 2.0, 2.0, 3.0, None, 4.0)
    assert got["b"] == (1, 0.0, None, None, None, None)
    assert P.learned_levels(daily, entities.where("false"), days, ROLES).count() == 0
