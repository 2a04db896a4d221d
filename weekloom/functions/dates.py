"""Date expressions. All work on dates, so the session time zone plays no part."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from weekloom import constants as K


def as_date(day: Column | str) -> Column:
    col = F.col(day) if isinstance(day, str) else day
    return col.cast("date")


def week_start(day: Column | str) -> Column:
    """Monday of the ISO week, as a date."""
    return F.trunc(as_date(day), "week")


def is_weekend(day: Column | str) -> Column:
    """1 on Saturday and Sunday."""
    return (F.weekday(as_date(day)) >= 5).cast("int")


def is_payday(
    day: Column | str,
    last_early: int = K.PAYDAY_LAST_EARLY_DAY,
    first_late: int = K.PAYDAY_FIRST_LATE_DAY,
) -> Column:
    """1 on the first and last days of a month, by day number."""
    number = F.dayofmonth(as_date(day))
    return ((number <= last_early) | (number >= first_late)).cast("int")


def week_of_year(day: Column | str) -> Column:
    """ISO week number, 1 to 53."""
    return F.weekofyear(as_date(day))


def _season_angle(day: Column | str) -> Column:
    return F.lit(2 * math.pi) * week_of_year(day) / F.lit(K.SEASON_DIVISOR)


def season_sin(day: Column | str) -> Column:
    return F.sin(_season_angle(day))


def season_cos(day: Column | str) -> Column:
    return F.cos(_season_angle(day))
