"""Data-quality and summary figures of a daily table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from weekloom.functions import exact_sum, safe_ratio
from weekloom.operators.labels import exact_threshold
from weekloom.operators.panel import outage_flag
from weekloom.roles import Roles


def data_quality(daily: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """One row: shape, date range, missing cells, duplicate keys, outages, failed rate.

    Grouping goes by key, then by entity, then to one row, each step with partial
    sums. So duplicates and distinct entities are exact without a distinct
    aggregate, and a busy entity is spread over its days.
    """
    gone = {c: F.col(c).isNull() | F.isnan(c) if t in ("float", "double") else F.col(c).isNull() for c, t in daily.dtypes}
    missing = sum((is_gone.cast("int") for is_gone in gone.values()), F.lit(0))
    flags = [c for c in (roles.weekend, roles.payday, roles.event) if c in daily.columns]
    by_key = daily.groupBy(roles.entity, roles.day).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(missing).alias("missing"),
        F.count_if(outage_flag(roles)).alias("outages"),
        F.sum(roles.n_ok).alias("ok"),
        F.sum(roles.n_failed).alias("failed"),
        exact_sum(F.col(roles.value), roles.scale).alias("total"),
        F.max(roles.value).alias("top"),
        F.max(roles.n_ok).alias("top_ok"),
        *[F.sum(c).alias(c) for c in flags],
    )
    sums = ["n", "missing", "outages", "ok", "failed", *flags]
    extra = lambda: [F.sum(c).alias(c) for c in sums] + [
        exact_sum(F.col("total"), roles.scale).alias("total"),
        F.max("top").alias("top"),
        F.max("top_ok").alias("top_ok"),
    ]
    by_entity = by_key.groupBy(roles.entity).agg(
        F.min(roles.day).alias("first_day"),
        F.max(roles.day).alias("last_day"),
        F.sum(F.col("n") - 1).alias("duplicates"),
        *extra(),
    )
    known = F.count(roles.entity)  # NULL is not an entity
    one = by_entity.agg(
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
        F.sum("duplicates").alias("duplicates"),
        known.alias("n_entities"),
        *extra(),
    )
    n = F.col("n")
    return one.select(
        n.alias("n_rows"),
        F.lit(len(daily.columns)).alias("n_columns"),
        "n_entities",
        "first_day",
        "last_day",
        F.col("missing").alias("missing_cells"),
        F.col("duplicates").alias("duplicate_rows"),
        F.col("outages").alias("outage_rows"),
        safe_ratio(F.col("outages"), n).alias("outage_share"),
        safe_ratio(F.col("failed"), F.col("ok")).alias("failed_rate"),
        F.col("total").alias("total_value"),
        safe_ratio(F.col("total"), n).alias("mean_value"),
        F.col("top").alias("max_value"),
        safe_ratio(F.col("ok"), n).alias("mean_count"),
        F.col("top_ok").alias("max_count"),
        *[safe_ratio(F.col(c), n).alias(f"{c}_share") for c in flags],
    )


def day_span(rows: DataFrame, roles: Roles = Roles()) -> tuple:
    """First and last day of a table, from one aggregation; ``(None, None)`` without any."""
    row = rows.agg(F.min(F.col(roles.day).cast("date")).alias("a"), F.max(F.col(roles.day).cast("date")).alias("b")).first()
    return row["a"], row["b"]


def whole_weeks(first, last) -> tuple:
    """The first Monday on or after ``first`` and the last Sunday on or before ``last``; ``(None, None)`` if no whole week lies between."""
    if first is None or last is None:
        return None, None
    start = first + dt.timedelta(-first.weekday() % 7)
    end = last - dt.timedelta((last.weekday() + 1) % 7)
    return (start, end) if start < end else (None, None)


def dropped_rows(rows: DataFrame, start, end, roles: Roles = Roles()) -> DataFrame:
    """One row: how many rows an explicit range of days keeps, and how many lie before it, after it or have no day."""
    day = F.col(roles.day).cast("date")
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(day).alias("first_day"), F.max(day).alias("last_day"),
        F.count_if(day < F.lit(start)).alias("n_before"), F.count_if(day > F.lit(end)).alias("n_after"), F.count_if(day.isNull()).alias("n_undated"),
    )


def ranked(summary: DataFrame, by: str, first: str, name: str = "rank") -> DataFrame:
    """A small summary with its order as a column: largest ``by`` first, ties by ``first``."""
    return summary.withColumn(name, F.row_number().over(Window.orderBy(F.desc(by), first)))


def median_value(daily: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """One row with the exact median of the value column."""
    median = exact_threshold(daily, roles.value)
    return daily.sparkSession.range(1).select(F.lit(median).cast("double").alias("median_value"))


def segment_summary(panel: DataFrame, roles: Roles = Roles(), digits: int = 0) -> DataFrame:
    """Entities, mean value and mean count per segment, highest mean first.

    Entities are counted after a grouping by entity, so no task holds the distinct
    entities of a large segment.
    """
    per_entity = panel.groupBy(roles.entity, roles.segment).agg(
        F.count(F.lit(1)).alias("n"),
        exact_sum(F.col(roles.value), roles.scale).alias("total"),
        F.sum(roles.n_ok).alias("ok"),
    )
    return (
        per_entity.groupBy(roles.segment)
        .agg(
            F.count(roles.entity).alias("n_entities"),
            F.round(safe_ratio(exact_sum(F.col("total"), roles.scale), F.sum("n")), digits).alias("avg_daily_value"),
            F.round(safe_ratio(F.sum("ok"), F.sum("n")), digits).alias("avg_daily_count"),
        )
        .orderBy(F.desc("avg_daily_value"), roles.segment)
    )


def entity_count(panel: DataFrame, roles: Roles = Roles(), error: float | None = None) -> DataFrame:
    """One row with the number of distinct entities; a sketch if an error is allowed."""
    if error is not None:
        return panel.agg(F.approx_count_distinct(roles.entity, error).alias("n_entities"))
    return panel.groupBy(roles.entity).count().agg(F.count(roles.entity).alias("n_entities"))


def preview(df: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows by key."""
    return df.orderBy(*keys).limit(n)
