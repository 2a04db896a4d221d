import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from weekloom import Roles, functions as W
from weekloom.sources import tables
from weekloom.staging import FREE_KEY, new_folder, stage, staging_root

ROWS = [("E0001", dt.date(2024, 1, 1), "Mall", 100.0, 3, 0, 0, 1, 0), ("E0002", dt.date(2024, 1, 2), "Rural", 0.0, 0, 0, 0, 1, 0)]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
@pytest.mark.parametrize("by", [None, ["segment"]])
def test_daily_table_roundtrip(spark, fmt, by):
    roles = Roles()
    df = spark.createDataFrame(ROWS, roles.schema())
    path = new_folder(spark, "daily")
    tables.write_table(df, path, fmt, by)
    back = tables.read_panel(spark, path, roles.schema(), fmt)
    assert sorted(map(tuple, back.select(*df.columns).collect())) == ROWS


def test_inferred_schema_and_date_format(spark):
    path = new_folder(spark, "daily")
    spark.createDataFrame([("x", "31/01/2024")], "entity_id string, day string").write.option("header", True).csv(path)
    read = tables.read_panel(spark, path, "entity_id string, day date", date_format="dd/MM/yyyy")
    assert read.first().day == dt.date(2024, 1, 31)
    inferred = tables.read_panel(spark, path, infer=True, date_format="dd/MM/yyyy")
    assert dict(inferred.dtypes) == {"entity_id": "string", "day": "date"}


def test_other_column_names(spark):
    roles = Roles(entity="machine_id", segment="site", day="date", value="cash")
    assert roles.schema().names[:4] == ["machine_id", "date", "site", "cash"]


def test_stage_keeps_rows_and_schema(spark):
    df = spark.range(10).withColumn("x", F.col("id") / 3)
    out = stage(df)
    assert out.schema.names == df.schema.names and out.count() == 10
    assert staging_root(spark) == staging_root(spark)


def test_text_and_numbers(spark):
    one = spark.range(1)
    row = one.select(
        W.padded_id(F.lit(7), "E"),
        W.padded_id(F.lit(12345), "E"),
        W.prefixed(F.lit("Mall"), "loc_"),
        W.percent(F.lit(0.9583)),
        W.thousands(F.lit(95964.21)),
        W.grouped(F.lit(1432552.4)),
        W.rounded(F.lit(1.005), 2),
        W.rounded(F.lit(2.5), 0, half_even=True),
        W.truncated(F.lit(-3.7)),
        W.clip(F.lit(9), 1, 5),
        W.clip(F.lit(-2), low=1),
        W.floored_ratio(F.lit(3.0), F.lit(0)),
        W.safe_ratio(F.lit(3), F.lit(0)),
    ).first()
    assert list(row) == ["E0007", "E12345", "loc_Mall", "95.8%", "96k", "1,432,552", 1.01, 2.0, -3, 5, 1, 3.0, None]


def test_staging_leaves_no_shuffle_files(spark):
    def files():
        tops = [str(d) for d in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()]
        return {f for top in tops for f in glob.glob(f"{top}/*/shuffle_*.data")}

    was, before = spark.conf.get(FREE_KEY), files()
    out = stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s")))
    assert not files() - before and spark.conf.get(FREE_KEY) == was
    assert out.agg(F.sum("s"), F.count("*")).first() == (499500, 7)
