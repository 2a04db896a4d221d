import datetime as dt

import pytest
from pyspark.sql import functions as F

from weekloom import Roles
from weekloom.operators import calendar as C, panel as P, profile as PR, quality as Q

D = dt.date
COLS = "entity_id string, segment string, day date, value double, n_ok int, n_failed int, is_weekend int, is_payday int"
ROWS = [
    ("A", "Mall", D(2024, 3, 1), 100.0, 10, 1, 0, 1),
    ("A", "Mall", D(2024, 3, 2), 200.0, 20, 0, 1, 1),
    ("A", "Mall", D(2024, 3, 3), 300.0, 30, 1, 1, 1),
    ("A", "Mall", D(2024, 3, 4), 0.0, 0, 0, 0, 0),
    ("A", "Mall", D(2024, 3, 5), 100.0, 10, 0, 0, 0),
    ("B", "Rural", D(2024, 3, 4), 50.0, 5, 0, 0, 0),
    ("B", "Rural", D(2024, 3, 5), 70.0, 7, 1, 0, 0),
    ("C", "Rural", D(2024, 3, 4), 0.0, 0, 0, 0, 0),
]


@pytest.fixture(scope="module")
def panel(spark):
    return spark.createDataFrame(ROWS, COLS).cache()


def test_profile_fixture(panel):
    cols = ["avg_daily_wd", "p90_daily_wd", "cv_wd", "avg_daily_tx", "avg_txn_amount", "weekend_ratio",
            "payday_uplift", "peak_to_mean", "fail_rate"]
    want = {
        "A": [140, 300, 0.814411, 14, 10, 3.75, 4, 2.142857, 0.028571],
        "B": [60, 70, 0.235702, 6, 10, None, None, 1.166667, 0.083333],
        "C": [0, 0, None, 0, None, None, None, None, None],
    }
    for r in PR.entity_profile(panel).collect():
        for c, w in zip(cols, want[r.entity_id]):
            assert (r[c] is None) if w is None else r[c] == pytest.approx(w, abs=1e-6), (r.entity_id, c)


def test_live_profile_leaves_out_idle_days(panel):
    got = {r.entity_id: r.avg_daily_wd for r in PR.entity_profile(panel, live_only=True).collect()}
    assert got == {"A": 175.0, "B": 60.0}


@pytest.mark.parametrize("end", ["2024-03-01", "2024-03-02", "2024-05-20"])
def test_profile_from_daily_equals_dense_profile(spark, end):
    start = "2024-03-01"
    roles = Roles(scale=2)
    daily = P.daily_totals(
        spark.range(2000).select(
            F.when(F.rand(1) < 0.4, 0).otherwise((F.rand(2) * 30).cast("int")).alias("entity_id"),
            F.date_add(F.lit(D(2024, 2, 25)), (F.rand(3) * 100).cast("int")).alias("day"),
            F.round(F.rand(4) * 1000, 2).alias("value"),
            (F.rand(5) < 0.7).cast("int").alias("n_ok"),
            F.lit(1).alias("n_failed"),
        ),
        roles,
    ).cache()
    known = spark.range(32).select(F.col("id").cast("int").alias("entity_id"), F.lit("s").alias("segment"))
    cal = C.calendar(spark, start, end)
    want = PR.entity_profile(P.densify(daily, known, cal, start, end, roles), roles)
    got = PR.profile_from_daily(daily, known, start, end, roles)
    assert got.columns[:2] == want.columns[:2] and sorted(got.columns) == sorted(want.columns)
    a = {r.entity_id: r.asDict() for r in got.collect()}
    b = {r.entity_id: r.asDict() for r in want.collect()}
    assert set(a) == set(b) == set(range(32))
    for e in a:
        for c in PR.PROFILE:
            x, y = a[e][c], b[e][c]
            assert (x is None) == (y is None) and (x is None or x == pytest.approx(y)), (e, c, x, y)


def test_data_quality(spark):
    rows = [
        ("a", D(2024, 1, 1), 10.0, 2, 1),
        ("a", D(2024, 1, 1), 12.0, 0, 0),
        ("a", D(2024, 1, 1), None, 0, 0),
        ("b", D(2024, 1, 4), 8.0, 2, None),
        ("b", None, 8.0, 4, 0),
        ("b", None, 8.0, 0, 1),
        (None, D(2024, 1, 2), 8.0, 0, 0),
    ]
    df = spark.createDataFrame(rows, "entity_id string, day date, value double, n_ok int, n_failed int")
    r = Q.data_quality(df).first()
    pdf = df.toPandas()
    assert r.n_rows == 7 and r.n_columns == 5
    assert r.n_entities == 2
    assert (r.first_day, r.last_day) == (D(2024, 1, 1), D(2024, 1, 4))
    assert r.missing_cells == int(pdf.isna().sum().sum()) == 5
    assert r.duplicate_rows == int(pdf.duplicated(["entity_id", "day"]).sum()) == 3
    assert r.outage_rows == 4 and r.outage_share == pytest.approx(4 / 7)
    assert r.failed_rate == pytest.approx(2 / 8)
    assert r.max_value == 12.0 and r.total_value == 54.0
    assert Q.median_value(df).first()[0] == 8.0


def test_segment_summary_and_counts(panel):
    rows = Q.segment_summary(panel, digits=2).collect()
    assert [(r.segment, r.n_entities, r.avg_daily_value, r.avg_daily_count) for r in rows] == [
        ("Mall", 1, 140.0, 14.0),
        ("Rural", 2, 40.0, 4.0),
    ]
    assert Q.entity_count(panel).first()[0] == 3
    assert Q.entity_count(panel, error=0.01).first()[0] == 3
    assert [(r.entity_id, r.day.day) for r in Q.preview(panel, ["entity_id", "day"], 2).collect()] == [("A", 1), ("A", 2)]
