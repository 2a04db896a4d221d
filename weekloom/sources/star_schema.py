"""Panels derived from the star-schema tables (lineitem, supplier, events, ...)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from weekloom.roles import Roles

# money with two decimals
ROLES = Roles(scale=2)

START, END = dt.date(1995, 1, 2), dt.date(2001, 11, 4)
CUT = dt.date(2000, 6, 30)
USER_START, USER_END = dt.date(2024, 1, 1), dt.date(2024, 1, 30)
EVENTS = tuple(
    dt.date(year, month, day)
    for year in range(START.year, END.year + 1)
    for month, day in ((3, 25), (8, 15), (10, 12), (11, 1), (12, 25))
)


# declared, so that opening a table starts no inference job
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _in_days(column: str, start: dt.date, end: dt.date):
    """Range test on the raw timestamp column, so it can reach the scan."""
    bound = lambda d: F.lit(dt.datetime.combine(d, dt.time())).cast("timestamp_ntz")
    return (F.col(column) >= bound(start)) & (F.col(column) < bound(end + dt.timedelta(1)))


def supplier_records(
    spark: SparkSession, sf_dir: str, start: dt.date = START, end: dt.date = END
) -> DataFrame:
    """One row per line item: supplier, ship day, price, 1, returned."""
    items = table(spark, sf_dir, "lineitem").where(_in_days("l_shipdate", start, end))
    return items.select(
        F.col("l_suppkey").alias(ROLES.entity),
        F.col("l_shipdate").cast("date").alias(ROLES.day),
        F.col("l_extendedprice").alias(ROLES.value),
        F.lit(1).alias(ROLES.n_ok),
        (F.col("l_returnflag") == "R").cast("int").alias(ROLES.n_failed),
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier with its region as segment."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias(ROLES.entity),
            F.col("r_name").alias(ROLES.segment),
            F.col("s_acctbal").alias("acctbal"),
        )
    )


def user_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: user, day, value, 1, error."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias(ROLES.entity),
        F.col("ts").cast("date").alias(ROLES.day),
        F.col("value").alias(ROLES.value),
        F.lit(1).alias(ROLES.n_ok),
        (F.col("event_type") == "error").cast("int").alias(ROLES.n_failed),
    )
