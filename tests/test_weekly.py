import datetime as dt

import pytest
from pyspark.sql import functions as F

from weekloom import Roles
from weekloom.operators import calendar as C, features as FE, panel as P, rollup as R

D = dt.date
PANEL = (
    "entity_id string, segment string, day date, value double, n_ok int, n_failed int, "
    "is_weekend int, is_payday int, is_event int"
)


def fixture_rows(entity="A"):
    rows = []
    for i in range(42):
        day = D(2024, 1, 1) + dt.timedelta(i)
        if day == D(2024, 1, 24):
            continue
        zero = day == D(2024, 1, 8)
        week = i // 7 + 1
        rows.append(
            (entity, "Mall", day, 0.0 if zero else 100.0 * week, 0 if zero else 10, 0 if zero else 1,
             int(day.weekday() >= 5), int(day.day <= 3 or day.day >= 28), 0)
        )
    return rows


@pytest.fixture(scope="module")
def weekly(spark):
    return R.weekly_rollup(spark.createDataFrame(fixture_rows(), PANEL)).cache()


def test_rollup_values(weekly):
    got = {r.week_start: (r.wd, r.tx, r.failed, r.wd_weekend, r.outage_days) for r in weekly.collect()}
    assert got == {
        D(2024, 1, 1): (700, 70, 7, 200, 0),
        D(2024, 1, 8): (1200, 60, 6, 400, 1),
        D(2024, 1, 15): (2100, 70, 7, 600, 0),
        D(2024, 1, 29): (3500, 70, 7, 1000, 0),
        D(2024, 2, 5): (4200, 70, 7, 1200, 0),
    }


def test_features_skip_the_incomplete_week(weekly):
    rows = FE.weekly_features(weekly).orderBy("week_start").collect()
    cols = ["lag1_wd", "lag2_wd", "roll4_wd", "roll4_std", "lag1_fail_rate", "lag1_weekend_share", "lag1_outage_days"]
    want = {
        D(2024, 1, 15): [1200, 700, 950, 353.553391, 0.1, 0.333333, 1],
        D(2024, 1, 29): [2100, 1200, 1333.333333, 709.459888, 0.1, 0.285714, 0],
        D(2024, 2, 5): [3500, 2100, 1875, 1228.481447, 0.1, 0.285714, 0],
    }
    assert [r.week_start for r in rows] == list(want)
    for r in rows:
        assert [r[c] for c in cols] == pytest.approx(want[r.week_start], abs=1e-6)


def test_warmup_rows(weekly):
    second = FE.add_features(weekly).where("week_start = '2024-01-08'").first()
    assert second.lag1_wd == 700 and second.lag2_wd is None
    assert second.roll4_wd == 700 and second.roll4_std is None


def test_segment_change_inside_a_week_drops_it(spark):
    rows = [r if r[2] < D(2024, 1, 18) else (r[0], "Rural", *r[2:]) for r in fixture_rows()]
    weeks = {r.week_start for r in R.weekly_rollup(spark.createDataFrame(rows, PANEL)).collect()}
    assert D(2024, 1, 15) not in weeks and len(weeks) == 4


def test_duplicate_day_breaks_completeness(spark):
    rows = fixture_rows()
    weeks = {r.week_start for r in R.weekly_rollup(spark.createDataFrame(rows + [rows[0]], PANEL)).collect()}
    assert D(2024, 1, 1) not in weeks


def test_no_leakage(spark, weekly):
    cut = D(2024, 1, 29)
    base = FE.weekly_features(weekly)
    changed = [(*r[:3], r[3] * 9, *r[4:]) if r[2] >= cut else r for r in fixture_rows()]
    other = FE.weekly_features(R.weekly_rollup(spark.createDataFrame(changed, PANEL)))
    past_only = [*FE.NUMERIC]
    pick = lambda df: [tuple(r) for r in df.where(F.col("week_start") <= F.lit(cut)).orderBy("week_start").select(*past_only).collect()]
    assert pick(base) == pick(other)


def test_nan_is_dropped(spark):
    df = spark.createDataFrame([(1.0, 1), (float("nan"), 2), (None, 3)], "x double, i int")
    assert [r.i for r in FE.drop_warmup(df).collect()] == [1]


def test_week_53_wraps(spark):
    from weekloom.functions import season_cos, season_sin, week_of_year, week_start

    df = spark.createDataFrame([(D(2020, 12, 28),), (D(2021, 1, 3),), (D(2021, 1, 4),)], "day date")
    rows = df.select(week_start("day").alias("w"), week_of_year("day").alias("n"), season_sin("day").alias("s"), season_cos("day").alias("c")).collect()
    assert [r.n for r in rows] == [53, 53, 1]
    assert [r.w for r in rows] == [D(2020, 12, 28), D(2020, 12, 28), D(2021, 1, 4)]
    assert rows[0].s == pytest.approx(rows[2].s) and rows[0].c == pytest.approx(rows[2].c)


def records(spark, n=3000, hot=0.4):
    """Random records over 12 entities; entity 0 holds a large share of them."""
    entity = F.when(F.rand(1) < hot, 0).otherwise((F.rand(2) * 12).cast("int")).cast("bigint")
    return spark.range(n).select(
        entity.alias("entity_id"),
        F.date_add(F.lit(D(2024, 1, 3)), (F.rand(3) * 100).cast("int")).alias("day"),
        F.round(F.rand(4) * 1000, 2).alias("value"),
        (F.rand(5) < 0.8).cast("int").alias("n_ok"),
        (F.rand(6) < 0.1).cast("int").alias("n_failed"),
    )


@pytest.mark.parametrize("start,end", [("2024-01-01", "2024-04-28"), ("2024-01-10", "2024-03-29")])
def test_weeks_from_records_equal_dense_rollup(spark, start, end):
    roles = Roles(scale=2)
    rows = records(spark).cache()
    known = spark.range(14).select(F.col("id").alias("entity_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("segment"))
    cal = C.calendar(spark, start, end, ["2024-02-14"])
    fast = R.weekly_from_records(rows, known, cal, start, end, roles)
    slow = R.weekly_rollup(P.densify(P.daily_totals(rows, roles), known, cal, start, end, roles), roles)
    assert fast.columns == slow.columns
    a = {tuple(r) for r in fast.collect()}
    assert a == {tuple(r) for r in slow.collect()} and len(a) == fast.count() > 14 * 8


def test_rollup_sums_equal_daily_sums(spark):
    roles = Roles(scale=2)
    start, end = "2024-01-01", "2024-04-28"
    rows = records(spark)
    known = spark.range(12).select(F.col("id").alias("entity_id"), F.lit("s").alias("segment"))
    cal = C.calendar(spark, start, end)
    weekly = R.weekly_from_records(rows, known, cal, start, end, roles)
    assert weekly.agg(F.sum("wd")).first()[0] == pytest.approx(rows.agg(F.sum("value")).first()[0])


def test_partition_count_does_not_matter(spark):
    roles = Roles(scale=2)
    rows = records(spark).cache()
    totals = lambda df: {tuple(r) for r in P.daily_totals(df, roles).collect()}
    assert totals(rows.repartition(1)) == totals(rows.repartition(13))
