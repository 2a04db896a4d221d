"""Day and week calendars with weekend, payday and event flags.

A calendar has one row per day (or week) of a fixed date range, so its size is
bounded by that range and does not grow with the data. Joins broadcast it only
while the range is below ``BROADCAST_DAYS``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weekloom import constants as K
from weekloom.functions import is_payday, is_weekend, week_start
from weekloom.roles import Roles

BROADCAST_DAYS = 200_000  # about 550 years of days

Date = dt.date | str


def to_date(day: Date) -> dt.date:
    return dt.date.fromisoformat(day) if isinstance(day, str) else day


def days_between(start: Date, end: Date) -> int:
    """Number of days in the inclusive range."""
    return (to_date(end) - to_date(start)).days + 1


def bounded(calendar: DataFrame, start: Date, end: Date) -> DataFrame:
    """Broadcast a one-row-per-day table if its date range keeps it small."""
    return F.broadcast(calendar) if days_between(start, end) <= BROADCAST_DAYS else calendar


def date_spine(spark: SparkSession, start: Date, end: Date, day: str = "day") -> DataFrame:
    """Every date of the inclusive range."""
    first, last = F.lit(to_date(start)), F.lit(to_date(end))
    return spark.range(0, 1, 1, 1).select(F.explode(F.sequence(first, last)).alias(day))


def event_days(
    spark: SparkSession,
    events: DataFrame | Iterable[Date],
    before: int = K.EVENT_DAYS_BEFORE,
    after: int = K.EVENT_DAYS_AFTER,
    day: str = "day",
) -> DataFrame:
    """Distinct days inside [event - before, event + after].

    Opening the windows into days turns the interval match into an equi join. A list
    is already in the driver's hands, so its days are broadcast; a table is not.
    """
    if isinstance(events, DataFrame):
        event = F.col(events.columns[0]).cast("date")
        window = F.sequence(F.date_sub(event, before), F.date_add(event, after))
        return events.select(F.explode(window).alias(day)).distinct()
    offsets = [dt.timedelta(n) for n in range(-before, after + 1)]
    opened = sorted({to_date(e) + n for e in events for n in offsets})
    listed = F.split(F.lit(",".join(map(str, opened))), ",")
    rows = spark.range(0, 1, 1, 1).select(F.explode(listed).alias(day)).where(F.col(day) != "")
    return F.broadcast(rows.select(F.col(day).cast("date").alias(day)))


def event_flag(df: DataFrame, opened: DataFrame, day: str = "day", flag: str = "is_event") -> DataFrame:
    """Add 1 where ``day`` is one of the opened event days, else 0."""
    marked = opened.withColumnsRenamed({opened.columns[0]: day}).withColumn(flag, F.lit(1))
    return df.join(marked, day, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(0)))


def event_rows(df: DataFrame, opened: DataFrame, day: str = "day") -> DataFrame:
    """Rows of ``df`` whose day falls in an event window (semi join)."""
    return df.join(opened.withColumnsRenamed({opened.columns[0]: day}), day, "left_semi")


def calendar(
    spark: SparkSession,
    start: Date,
    end: Date,
    events: DataFrame | Iterable[Date] = (),
    roles: Roles = Roles(),
    before: int = K.EVENT_DAYS_BEFORE,
    after: int = K.EVENT_DAYS_AFTER,
    payday: tuple[int, int] = (K.PAYDAY_LAST_EARLY_DAY, K.PAYDAY_FIRST_LATE_DAY),
) -> DataFrame:
    """One row per day with the three 0/1 flags."""
    spine = date_spine(spark, start, end, roles.day).select(
        roles.day,
        is_weekend(roles.day).alias(roles.weekend),
        is_payday(roles.day, *payday).alias(roles.payday),
    )
    opened = event_days(spark, events, before, after, roles.day)
    return event_flag(spine, opened, roles.day, roles.event)


def calendar_weeks(days: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Payday and event days and the day count of every calendar week."""
    return days.groupBy(week_start(roles.day).alias(roles.week)).agg(
        F.sum(roles.payday).alias("payday_days"),
        F.sum(roles.event).alias("festival_days"),
        F.count(F.lit(1)).alias("n_days"),
    )


def trend_index(day: Column | str, start: Date, end: Date, growth: float = K.TREND_GROWTH) -> Column:
    """1 + growth * i / n for day i of an n-day range; no ordering pass needed."""
    col = F.col(day) if isinstance(day, str) else day
    position = F.datediff(col.cast("date"), F.lit(to_date(start)))
    return F.lit(1.0) + F.lit(growth) * position / F.lit(days_between(start, end))


def day_counts(
    start: Date,
    end: Date,
    payday: tuple[int, int] = (K.PAYDAY_LAST_EARLY_DAY, K.PAYDAY_FIRST_LATE_DAY),
) -> dict[str, int]:
    """Days, weekend days and paydays of the range, worked out from the range alone."""
    first, n = to_date(start), days_between(start, end)
    days = [first + dt.timedelta(i) for i in range(n)]
    return {
        "days": n,
        "weekend": sum(d.weekday() >= 5 for d in days),
        "payday": sum(d.day <= payday[0] or d.day >= payday[1] for d in days),
    }
