"""Past-only weekly features.

All window columns share one partitioning and ordering and are written in one
select, so Spark sorts once. After the roll-up an entity has at most one row per
week of the calendar, which bounds every window group.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from weekloom.functions import floored_ratio, season_cos, season_sin
from weekloom.operators.calendar import Date, to_date
from weekloom.operators.rollup import weekly_from_records
from weekloom.roles import Roles

SPAN = 4  # weeks a feature looks back at most

LAGS = ["lag1_wd", "lag2_wd", "lag1_tx", "lag1_outage_days"]
ROLLING = ["roll4_wd", "roll4_std"]
LAG_RATIOS = ["lag1_avg_amt", "lag1_fail_rate", "lag1_weekend_share"]
SEASON = ["woy_sin", "woy_cos"]

# model inputs, in vector order
NUMERIC = [
    "lag1_wd",
    "lag2_wd",
    "lag1_tx",
    "roll4_wd",
    "roll4_std",
    "lag1_avg_amt",
    "lag1_fail_rate",
    "lag1_weekend_share",
    "lag1_outage_days",
    "payday_days",
    "festival_days",
    "woy_sin",
    "woy_cos",
]


def past(roles: Roles = Roles()):
    """Weeks of one entity in order. The segment is not part of the key."""
    return Window.partitionBy(roles.entity).orderBy(roles.week)


def feature_columns(roles: Roles = Roles(), span: int = SPAN) -> dict[str, Column]:
    """Name -> expression over a weekly roll-up; ``span`` weeks feed the rolling pair."""
    weeks = past(roles)
    trailing = weeks.rowsBetween(-span, -1)
    wd, tx = F.col("wd"), F.col("tx")
    back = lambda expr, n=1: F.lag(expr, n).over(weeks)
    return {
        "lag1_wd": back(wd),
        "lag2_wd": back(wd, 2),
        "lag1_tx": back(tx),
        "roll4_wd": F.avg(wd).over(trailing),
        "roll4_std": F.stddev(wd).over(trailing),
        "lag1_avg_amt": back(floored_ratio(wd, tx)),
        "lag1_fail_rate": back(floored_ratio(F.col("failed"), tx)),
        "lag1_weekend_share": back(floored_ratio(F.col("wd_weekend"), wd)),
        "lag1_outage_days": back(F.col("outage_days")),
        "woy_sin": season_sin(roles.week),
        "woy_cos": season_cos(roles.week),
    }


def add_features(weekly: DataFrame, names: list[str] | None = None, roles: Roles = Roles()) -> DataFrame:
    """The weekly table and the named features (all by default), warm-up rows included."""
    available = feature_columns(roles)
    chosen = available if names is None else {n: available[n] for n in names}
    return weekly.select("*", *[expr.alias(name) for name, expr in chosen.items()])


def drop_warmup(features: DataFrame) -> DataFrame:
    """Rows without any NULL or NaN: from the third complete week of an entity on."""
    return features.dropna()


def weekly_features(weekly: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Complete weekly feature table, warm-up removed."""
    return drop_warmup(add_features(weekly, roles=roles))


def recent_features(
    records: DataFrame,
    entities: DataFrame,
    days: DataFrame,
    since: Date,
    start: Date,
    end: Date,
    roles: Roles = Roles(),
) -> DataFrame:
    """Feature rows of weeks starting at ``since`` or later, reading only the days they need.

    Spark keeps a filter on the week above the window, so it would read all history. Here
    the range itself starts ``SPAN`` weeks earlier, and the day filter reaches the scan.
    """
    since, start = to_date(since), to_date(start)
    monday = since - dt.timedelta(since.weekday())
    first = max(start, monday - dt.timedelta(7 * SPAN))
    weekly = weekly_from_records(records, entities, days, first, end, roles)
    return weekly_features(weekly, roles).where(F.col(roles.week) >= F.lit(since))
