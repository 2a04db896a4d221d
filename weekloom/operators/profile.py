"""One behavioural profile per entity."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from weekloom.functions import exact_sum, is_payday, is_weekend, safe_ratio
from weekloom.operators.calendar import Date, day_counts, to_date
from weekloom.operators.panel import outage_flag
from weekloom.roles import Roles

PROFILE = [
    "avg_daily_wd",
    "p90_daily_wd",
    "avg_daily_tx",
    "cv_wd",
    "avg_txn_amount",
    "weekend_ratio",
    "payday_uplift",
    "peak_to_mean",
    "fail_rate",
]


def live_days(panel: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Days with at least one successful transaction."""
    return panel.where(~outage_flag(roles))


def _flag_ratio(value: Column, flag: Column) -> Column:
    """Mean on flagged days over mean on the others."""
    return safe_ratio(F.avg(F.when(flag == 1, value)), F.avg(F.when(flag == 0, value)))


def entity_profile(panel: DataFrame, roles: Roles = Roles(), live_only: bool = False) -> DataFrame:
    """Nine measures per entity and segment of a daily panel; one shuffle, partial sums first.

    The 90th percentile is a sketch that is exact below 10,000 days per entity.
    Ratios with a zero denominator are NULL.
    """
    days = live_days(panel, roles) if live_only else panel
    value, n_ok = F.col(roles.value), F.col(roles.n_ok)
    total = exact_sum(value, roles.scale)
    mean = total / F.count(roles.value)
    return days.groupBy(roles.entity, roles.segment).agg(
        mean.alias("avg_daily_wd"),
        F.percentile_approx(value, 0.9).alias("p90_daily_wd"),
        F.avg(n_ok).alias("avg_daily_tx"),
        safe_ratio(F.stddev(value), mean).alias("cv_wd"),
        safe_ratio(total, F.sum(n_ok)).alias("avg_txn_amount"),
        _flag_ratio(value, F.col(roles.weekend)).alias("weekend_ratio"),
        _flag_ratio(value, F.col(roles.payday)).alias("payday_uplift"),
        safe_ratio(F.max(value), mean).alias("peak_to_mean"),
        safe_ratio(F.sum(roles.n_failed), F.sum(n_ok)).alias("fail_rate"),
    )


def profile_from_daily(
    daily: DataFrame, entities: DataFrame, start: Date, end: Date, roles: Roles = Roles()
) -> DataFrame:
    """``entity_profile`` of the densified panel, from the observed days alone.

    ``daily`` has one row per entity and observed day, values >= 0. The missing days are
    zeros whose number follows from the date range, so they are added to the counts
    instead of being built. The percentile is the exact value at its rank. Entities
    without any row in the range keep a row of zeros and NULL ratios.
    """
    size = day_counts(start, end)
    n, n_weekend, n_payday = size["days"], size["weekend"], size["payday"]
    entity, value = roles.entity, F.col(roles.value)
    day = F.col(roles.day)
    inside = daily.where(day.between(F.lit(to_date(start)), F.lit(to_date(end))))

    # zeros rank below every value, so the wanted rank is counted from the top
    from_top = n - max(1, math.ceil(0.9 * n)) + 1
    by_value = Window.partitionBy(entity).orderBy(F.desc(roles.value))
    ranked = inside.withColumn("__rank", F.row_number().over(by_value))
    flagged = lambda flag: exact_sum(F.when(flag == 1, value).otherwise(F.lit(0)), roles.scale)
    seen = ranked.groupBy(entity).agg(
        F.count(F.lit(1)).alias("__k"),
        exact_sum(value, roles.scale).alias("__sum"),
        F.avg(value).alias("__mean"),
        F.var_pop(value).alias("__var"),
        F.max(value).alias("__max"),
        F.max(F.when(F.col("__rank") == from_top, value)).alias("__p90"),
        flagged(is_weekend(day)).alias("__weekend"),
        flagged(is_payday(day)).alias("__payday"),
        F.sum(roles.n_ok).alias("__ok"),
        F.sum(roles.n_failed).alias("__failed"),
    )
    joined = entities.select(entity, roles.segment).join(seen, entity, "left")
    part = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    k, total = part("__k"), part("__sum")
    mean = total / n
    # merge the moments of the k seen days with those of n - k zeros
    squares = part("__var") * k + part("__mean") * part("__mean") * k * (n - k) / n
    spread = F.sqrt(squares / (n - 1)) if n > 1 else F.lit(None).cast("double")

    def uplift(inside_sum: Column, m: int) -> Column:
        if m in (0, n):
            return F.lit(None).cast("double")
        return safe_ratio(inside_sum / m, (total - inside_sum) / (n - m))

    return joined.select(
        entity,
        roles.segment,
        mean.alias("avg_daily_wd"),
        part("__p90").alias("p90_daily_wd"),
        (part("__ok") / n).alias("avg_daily_tx"),
        safe_ratio(spread, mean).alias("cv_wd"),
        safe_ratio(total, part("__ok")).alias("avg_txn_amount"),
        uplift(part("__weekend"), n_weekend).alias("weekend_ratio"),
        uplift(part("__payday"), n_payday).alias("payday_uplift"),
        safe_ratio(part("__max"), mean).alias("peak_to_mean"),
        safe_ratio(part("__failed"), part("__ok")).alias("fail_rate"),
    )
