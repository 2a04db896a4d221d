"""Weekly roll-up, from a dense panel or straight from records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from weekloom import constants as K
from weekloom.functions import exact_sum, week_start
from weekloom.functions.numbers import minor_units
from weekloom.operators.calendar import Date, bounded, calendar_weeks, to_date
from weekloom.operators.panel import fill_slots
from weekloom.roles import Roles

WEEKLY = ["wd", "tx", "failed", "payday_days", "festival_days", "wd_weekend", "outage_days", "n_days"]


def with_week(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    return df.withColumn(roles.week, week_start(roles.day))


def _weekend_value(flag: Column, roles: Roles) -> Column:
    return F.when(flag == 1, F.col(roles.value)).otherwise(F.lit(0))


def complete_weeks(weekly: DataFrame, n: int = K.DAYS_PER_WEEK) -> DataFrame:
    """Weeks with exactly ``n`` rows. Counts rows, so duplicate days show up too."""
    return weekly.where(F.col("n_days") == n)


def weekly_rollup(panel: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Sums and counts per entity, segment and week of a daily panel, complete weeks only."""
    weekly = (
        with_week(panel, roles)
        .groupBy(roles.entity, roles.segment, roles.week)
        .agg(
            exact_sum(F.col(roles.value), roles.scale).alias("wd"),
            F.sum(roles.n_ok).alias("tx"),
            F.sum(roles.n_failed).alias("failed"),
            F.sum(roles.payday).alias("payday_days"),
            F.sum(roles.event).alias("festival_days"),
            exact_sum(_weekend_value(F.col(roles.weekend), roles), roles.scale).alias("wd_weekend"),
            F.count_if(F.col(roles.n_ok) == 0).alias("outage_days"),
            F.count(F.lit(1)).alias("n_days"),
        )
    )
    return complete_weeks(weekly)


def whole_weeks(start: Date, end: Date) -> tuple[dt.date, dt.date]:
    """First Monday and last Sunday that bound the complete weeks inside the range."""
    start, end = to_date(start), to_date(end)
    first = start + dt.timedelta(-start.weekday() % 7)
    last = end - dt.timedelta((end.weekday() + 1) % 7)
    return first, last


def weekly_from_records(
    records: DataFrame,
    entities: DataFrame,
    days: DataFrame,
    start: Date,
    end: Date,
    roles: Roles = Roles(),
) -> DataFrame:
    """``weekly_rollup`` of the densified records without building the daily panel.

    Records (any number per entity and day) are summed to weeks in one partial +
    final aggregation. Active days of a week are a 7-bit mask, so counting them
    needs no second grouping by day. Empty weeks are then opened per entity, and the
    calendar counts joined by week. Equal to densify + roll-up, without sending
    days through a shuffle.
    """
    first, last = whole_weeks(start, end)
    day, weekday = F.col(roles.day), F.col("__weekday")
    value = F.col(roles.value) if roles.scale is None else minor_units(F.col(roles.value), roles.scale)
    # named once, so the aggregation below does not work them out per use
    prepared = records.where(day.between(F.lit(first), F.lit(last))).select(
        roles.entity,
        day,
        F.weekday(day).alias("__weekday"),
        value.alias("__value"),
        roles.n_ok,
        roles.n_failed,
    )
    total = lambda v: F.sum(v) if roles.scale is None else F.sum(v) / F.lit(float(10**roles.scale))
    active = F.when(F.col(roles.n_ok) > 0, F.call_function("shiftleft", F.lit(1), weekday)).otherwise(F.lit(0))
    seen = prepared.groupBy(roles.entity, F.date_sub(day, weekday).alias(roles.week)).agg(
        total(F.col("__value")).alias("wd"),
        F.sum(roles.n_ok).alias("tx"),
        F.sum(roles.n_failed).alias("failed"),
        total(F.when(weekday >= 5, F.col("__value")).otherwise(F.lit(0))).alias("wd_weekend"),
        F.bit_count(F.bit_or(active)).cast("bigint").alias("active_days"),
    )
    last_week = last - dt.timedelta(6)
    measures = ["wd", "tx", "failed", "wd_weekend", "active_days"]
    filled = fill_slots(seen, entities, roles.week, first, last_week, 7, measures, roles)
    weeks = complete_weeks(calendar_weeks(days, roles))
    return filled.join(bounded(weeks, start, end), roles.week).select(
        roles.entity,
        roles.segment,
        roles.week,
        "wd",
        "tx",
        "failed",
        "payday_days",
        "festival_days",
        "wd_weekend",
        (F.col("n_days") - F.col("active_days")).alias("outage_days"),
        "n_days",
    )
