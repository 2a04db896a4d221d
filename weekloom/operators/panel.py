"""From observed rows to a dense entity x day panel, and derived panel columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from weekloom import constants as K
from weekloom.functions import clip, exact_sum, truncated
from weekloom.functions.numbers import safe_ratio
from weekloom.operators.calendar import Date, bounded, to_date, trend_index
from weekloom.roles import Roles

#: Rows of a dense panel that one task opens, and the fewest tasks.
PANEL_ROWS = 500_000
LEAST_PARTITIONS = 8


def daily_totals(records: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """One row per entity and day. Partial sums run before the shuffle."""
    return records.groupBy(roles.entity, roles.day).agg(
        exact_sum(F.col(roles.value), roles.scale).alias(roles.value),
        F.sum(roles.n_ok).alias(roles.n_ok),
        F.sum(roles.n_failed).alias(roles.n_failed),
    )


def entities_of(records: DataFrame, segment: str = "all", roles: Roles = Roles()) -> DataFrame:
    """Entity table for records that come without one: every entity seen, one common segment."""
    return records.select(roles.entity).distinct().withColumn(roles.segment, F.lit(segment))


def fill_slots(
    seen: DataFrame,
    entities: DataFrame,
    slot: str,
    first: Date,
    last: Date,
    step: int,
    measures: list[str],
    roles: Roles = Roles(),
    carry: tuple[str, ...] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Every entity x every slot (day or week); unseen slots get zero measures.

    ``seen`` has one row per entity and slot, ``entities`` one row per entity with
    its segment. Each entity adds one anchor row just before the first slot; then
    every row opens the gap up to the next seen one. So only seen slots and one row
    per entity are shuffled, never the dense panel, and the result stays partitioned
    by entity for the windows that follow. A group is bounded by the number of slots.
    Rows of entities missing in ``entities`` are dropped. ``carry`` names further
    columns of ``entities`` that every row of the entity gets. The entities are dealt to
    ``partitions`` tasks if given; Spark else goes by the size of the rows before they open.
    """
    first, last = to_date(first), to_date(last)
    entity, segment = roles.entity, roles.segment
    known = [segment, *carry]
    anchors = entities.select(entity, *known, F.date_sub(F.lit(first), step).alias(slot), F.lit(True).alias("__anchor"))
    inside = seen.where(F.col(slot).between(F.lit(first), F.lit(last)))
    rows = inside.select(entity, slot, *measures).unionByName(anchors, allowMissingColumns=True)
    if partitions:
        rows = rows.repartition(partitions, entity)

    in_order = Window.partitionBy(entity).orderBy(slot)
    next_seen = F.coalesce(F.lead(slot).over(in_order), F.date_add(F.lit(last), step))
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    of_entity = lambda c: F.first_value(c).over(so_far)  # the anchor comes first
    linked = rows.select(
        entity,
        slot,
        *measures,
        "__anchor",
        next_seen.alias("__next"),
        of_entity("__anchor").alias("__known"),
        *[of_entity(c).alias(c) for c in known],
    ).where("__known")

    # positions of the slots a row stands for: itself (unless it is an anchor, 0) and the gap after it
    from_pos = F.when(F.col("__anchor"), 1).otherwise(0)
    to_pos = F.expr(f"datediff(__next, `{slot}`) div {step}").cast("int") - 1
    opened = F.when(from_pos <= to_pos, F.sequence(from_pos, to_pos))
    here = F.col("__pos") == 0
    zero = lambda m: F.lit(0).cast(seen.schema[m].dataType)
    return linked.select(
        entity, *known, F.col(slot).alias("__from"), *measures, F.explode(opened).alias("__pos")
    ).select(
        entity,
        *known,
        F.date_add("__from", F.col("__pos") * step).alias(slot),
        *[F.when(here, F.col(m)).otherwise(zero(m)).alias(m) for m in measures],
    )


def panel_partitions(n_entities: int, start: Date, end: Date) -> int:
    """Tasks of a dense panel of so many entities, of about ``PANEL_ROWS`` rows each."""
    n_days = (to_date(end) - to_date(start)).days + 1
    return max(LEAST_PARTITIONS, -(-n_entities * n_days // PANEL_ROWS))


def densify(
    daily: DataFrame,
    entities: DataFrame,
    days: DataFrame,
    start: Date,
    end: Date,
    roles: Roles = Roles(),
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Entity x day panel with the calendar flags; missing days carry zeros.

    The entities are counted first and dealt so that a task opens about ``PANEL_ROWS`` rows,
    whatever the size: groupings of the panel by entity and day or week stay in these tasks.
    """
    measures = [roles.value, roles.n_ok, roles.n_failed]
    parts = panel_partitions(entities.count(), start, end)
    dense = fill_slots(daily, entities, roles.day, start, end, 1, measures, roles, carry, parts)
    return dense.join(bounded(days, start, end), roles.day).select(
        roles.entity,
        roles.segment,
        roles.day,
        *measures,
        roles.weekend,
        roles.payday,
        roles.event,
        *carry,
    )


def union_panels(panels: list[DataFrame]) -> DataFrame:
    """Stack panels by column name; columns a panel lacks become NULL."""
    out = panels[0]
    for other in panels[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def outage_flag(roles: Roles = Roles()) -> Column:
    """True on days without a single successful transaction."""
    return F.col(roles.n_ok) == 0


def mask_measures(df: DataFrame, mask: Column, columns: list[str]) -> DataFrame:
    """Zero the columns on masked rows."""
    return df.withColumns(
        {c: F.when(mask, F.lit(0).cast(df.schema[c].dataType)).otherwise(F.col(c)) for c in columns}
    )


def expected_level(
    panel: DataFrame,
    segment_levels: DataFrame,
    start: Date,
    end: Date,
    entity_scale: str | None = None,
    event_factor: float = K.EVENT_FACTOR,
    growth: float = K.TREND_GROWTH,
    roles: Roles = Roles(),
    name: str = "expected",
) -> DataFrame:
    """Base level x entity scale x weekend x payday x event x trend.

    ``segment_levels`` holds segment, base, weekend_factor, payday_factor. Its join
    is left to Spark: a small table is broadcast by its measured size.
    """
    s, base, weekend_f, payday_f = segment_levels.columns
    on_flag = lambda flag, factor: F.when(F.col(flag) == 1, factor).otherwise(F.lit(1.0))
    joined = panel.join(segment_levels.withColumnRenamed(s, roles.segment), roles.segment)
    scale = F.col(entity_scale) if entity_scale else F.lit(1.0)
    level = (
        F.col(base)
        * scale
        * on_flag(roles.weekend, F.col(weekend_f))
        * on_flag(roles.payday, F.col(payday_f))
        * on_flag(roles.event, F.lit(event_factor))
        * trend_index(roles.day, start, end, growth)
    )
    return joined.withColumn(name, level).drop(base, weekend_f, payday_f)


def learned_levels(
    daily: DataFrame, entities: DataFrame, days: DataFrame, roles: Roles = Roles()
) -> DataFrame:
    """Per segment: mean value of an entity's plain day, what flagged days are to it, and the ticket.

    ``daily`` holds observed days only (``daily_totals``); days of ``days`` without a row count as
    zero, by the number of entities and days, so no dense panel is built. A plain day has none of
    the three flags; each factor is the mean over days of its flag divided by the plain mean.
    Zero denominators give NULL; a segment without any row has a mean of zero.
    """
    flags = [roles.weekend, roles.payday, roles.event]
    kinds = {"base": F.greatest(*flags) == 0} | {f: F.col(f) == 1 for f in flags}
    n_days = days.agg(*[F.count_if(on).alias(k) for k, on in kinds.items()]).first()
    seen = daily.select(roles.entity, roles.day, roles.value, roles.n_ok).join(
        days.select(roles.day, *flags), roles.day)
    # one row an entity before the segments meet, so that a large segment is no hot spot
    per = seen.groupBy(roles.entity).agg(
        *[F.coalesce(exact_sum(F.when(on, F.col(roles.value)), roles.scale), F.lit(0)).alias(f"s_{k}") for k, on in kinds.items()],
        exact_sum(F.col(roles.value), roles.scale).alias("s_all"), F.sum(roles.n_ok).alias("s_ok"))
    sums = entities.select(roles.entity, roles.segment).join(per, roles.entity, "left").groupBy(roles.segment).agg(
        F.count(F.lit(1)).alias("entities"),
        *[F.coalesce(exact_sum(F.col(c), roles.scale if c != "s_ok" else None), F.lit(0)).alias(c)
          for c in (*[f"s_{k}" for k in kinds], "s_all", "s_ok")])
    mean = {k: safe_ratio(F.col(f"s_{k}"), F.col("entities") * F.lit(n_days[k])) for k in kinds}
    return sums.select(
        roles.segment, "entities", mean["base"].alias("base"),
        *[safe_ratio(mean[f], mean["base"]).alias(f"{f}_factor") for f in flags],
        safe_ratio(F.col("s_all"), F.col("s_ok")).alias("ticket"),
    )


def derived_count(
    value: Column,
    ticket: Column,
    segment: Column,
    dearer: Mapping[str, float] = {"Transit_Hub": 1.25},
) -> Column:
    """Whole number of transactions behind a value, at least 1.

    ``dearer`` raises the ticket of single segments (default +25 % for one).
    """
    factor = F.lit(1.0)
    for name, times in dearer.items():
        factor = F.when(segment == name, F.lit(times)).otherwise(factor)
    return clip(truncated(value / (ticket * factor)), low=1)
