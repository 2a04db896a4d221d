"""Interval joins, checked encoding, binned curves, ranges of days and the published layout, odd rows included."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from weekloom.operators import encode, intervals, metrics, quality
from weekloom.roles import Roles
from weekloom.sources import metrics_json


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_covered_rows_equal_a_scan_of_all_windows(spark, width):
    r = random.Random(width)
    windows = [(r.choice("ab"), s, s + r.choice([-3, 0, 4, 90])) for s in (r.randrange(-50, 400) for _ in range(60))]
    rows = [(r.choice("abc"), r.randrange(-80, 500), i) for i in range(400)]
    odd = [("a", None, 9001), (None, 10, 9002)]
    left = spark.createDataFrame(rows + odd + rows[:3], "k string, t long, cell int")
    right = spark.createDataFrame(windows + [("a", None, 4), ("a", 4, None), (None, 0, 400)], "k string, s long, e long")
    got = sorted((x.k, x.t, x.cell) for x in intervals.covered(left, right, "t", "s", "e", width, ["k"]).collect())
    want = sorted(x for x in rows + rows[:3] if any(k == x[0] and s <= x[1] <= e for k, s, e in windows))
    assert got == want
    assert intervals.covered(left, right, "t", "s", "e", width).count() >= len(want)
    assert intervals.covered(left, right.where("false"), "t", "s", "e", width, ["k"]).count() == 0


def test_a_row_in_many_windows_comes_once(spark):
    right = spark.range(5000).select(F.lit(0).alias("s"), (F.col("id") + 10).alias("e"))
    assert intervals.islands(right, "s", "e", 100_000, []).collect()[0][1:] == (0, 5009)
    assert intervals.covered(spark.range(20), right, "id", "s", "e", 100_000).count() == 20


def test_an_unseen_category_raises(spark):
    train = spark.createDataFrame([("x",), ("x",), ("y",)], "seg string")
    cats = encode.category_index(train, "seg")
    assert [r.loc_idx for r in encode.checked_category_index(train, cats, "seg").orderBy("seg").collect()] == [0.0, 0.0, 1.0]
    plan = encode.checked_category_index(train, cats, "seg")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    for value in ("z", None):
        bad = spark.createDataFrame([("x",), (value,)], "seg string")
        with pytest.raises(Exception, match="unseen seg"):
            encode.checked_category_index(bad, cats, "seg", most=0 if value else 10).collect()


def brute_area(points):
    won, above = 0.0, 0
    for pos, neg in points:
        won += neg * (above + pos / 2)
        above += pos
    return won / (sum(p for p, _ in points) * sum(n for _, n in points))


@pytest.mark.parametrize("bins,cells", [(5, 1), (5, 4), (100, 8), (1, 3)])
def test_curve_areas(spark, bins, cells):
    r = random.Random(4)
    rows = [(float(r.randrange(60)), r.randrange(2)) for _ in range(500)]
    scores = sorted({s for s, _ in rows}, reverse=True)
    points = [(sum(s == x and y for x, y in rows), sum(s == x and not y for x, y in rows)) for s in scores]
    size = -(-len(points) // bins)
    joined = [tuple(map(sum, zip(*points[i : i + size]))) for i in range(0, len(points), size)]
    df = spark.createDataFrame(rows + [(None, 1), (float("nan"), 0)], "score double, label int")
    got = metrics.curve_areas(df, "score", bins=bins, cells=cells).first()
    assert got.auc == pytest.approx(brute_area(points)) and got.binned_auc == pytest.approx(brute_area(joined)) and got.n_scores == len(points)
    assert metrics.curve_areas(df.where("label = 1"), "score", bins=bins, cells=cells).first().auc is None


def test_span_and_dropped_rows(spark):
    roles = Roles()
    days = [dt.date(2024, 1, 3), dt.date(2024, 1, 8), dt.date(2024, 1, 31), None]
    df = spark.createDataFrame([(d,) for d in days], f"{roles.day} date")
    assert quality.day_span(df, roles) == (days[0], days[2])
    start, end = quality.whole_weeks(*quality.day_span(df, roles))
    assert (start, end) == (dt.date(2024, 1, 8), dt.date(2024, 1, 28)) and start.weekday() == 0 and end.weekday() == 6
    got = quality.dropped_rows(df, start, end, roles).first()
    assert (got.n_rows, got.n_before, got.n_after, got.n_undated) == (4, 1, 1, 1)
    assert quality.day_span(df.where("false"), roles) == (None, None)
    assert quality.whole_weeks(None, None) == (None, None) and quality.whole_weeks(days[0], dt.date(2024, 1, 7)) == (None, None)


def test_published_layout_is_written(spark, tmp_path):
    entry = "struct<accuracy:double,precision:double,recall:double,f1:double,auc:double,confusion:struct<TN:int,FP:int,FN:int,TP:int>>"
    name = 'Model "A"]: x'
    df = spark.createDataFrame([({name: (0.5, 0.5, 0.5, 0.5, 0.6, (1, 2, 3, 4)), "B": (0.1, 0.1, 0.1, 0.1, None, (1, 1, 1, 1))}, {"split": "2025"}, [1, 2])],
                               f"models map<string,{entry}>, _meta map<string,string>, extra array<int>")
    path = f"{tmp_path}/out"
    metrics_json.write_published(df, path)
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    held = json.loads(text)
    assert set(held) == {name, "B", "_meta", "extra"} and held[name]["confusion"]["TP"] == 4 and held["_meta"] == {"split": "2025"}
    assert {r.model for r in metrics_json.read_models(spark, path).collect()} == {name, "B"}
    assert metrics_json.read_meta(spark, path, spark.createDataFrame([], "split string").schema).first().split == "2025"
