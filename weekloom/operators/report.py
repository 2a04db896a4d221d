"""Report tables: tier summary, segment mix, lifts and lookups."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weekloom import constants as K
from weekloom.functions import safe_ratio
from weekloom.operators.profile import PROFILE
from weekloom.roles import Roles


def tier_summary(
    tiered: DataFrame, columns: list[str] = PROFILE, digits: int = 2, entities: str = "n_entities"
) -> DataFrame:
    """Entities and rounded means per tier, lowest tier first."""
    means = [F.round(F.avg(c), digits).alias(c) for c in columns]
    return (
        tiered.groupBy("tier_rank", "demand_tier")
        .agg(F.count(F.lit(1)).alias(entities), *means)
        .orderBy("tier_rank")
        .drop("tier_rank")
    )


def tier_mix(tiered: DataFrame, names: Iterable[str] = K.TIERS, roles: Roles = Roles()) -> DataFrame:
    """Entities per segment and tier; the tiers are columns in business order."""
    return (
        tiered.groupBy(roles.segment)
        .agg(*[F.count_if(F.col("demand_tier") == t).alias(t) for t in names])
        .orderBy(roles.segment)
    )


def tier_ratio(summary: DataFrame, top: str = "High", base: str = "Low", metric: str = "avg_daily_wd") -> DataFrame:
    """Mean of the top tier over the mean of the base tier."""
    of = lambda t: F.max(F.when(F.col("demand_tier") == t, F.col(metric)))
    return summary.agg(safe_ratio(of(top), of(base)).alias("tier_ratio"))


def usual_tier(tiered: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Most frequent tier of every segment; the lower tier wins a tie.

    Entities are counted per segment and tier first, so a group holds one row per tier.
    """
    counts = tiered.groupBy(roles.segment, "tier_rank", "demand_tier").agg(F.count(F.lit(1)).alias("n"))
    best = F.max(F.struct("n", (-F.col("tier_rank")).alias("r"), "demand_tier"))
    return counts.groupBy(roles.segment).agg(best.alias("b"), F.sum("n").alias("n_entities")).select(
        roles.segment,
        F.col("b.demand_tier").alias("usual_tier"),
        safe_ratio(F.col("b.n"), F.col("n_entities")).alias("tier_share"),
    )


def policy_table(spark: SparkSession, policy: Iterable[tuple[str, str]] = K.TIER_POLICY) -> DataFrame:
    """tier -> policy, one row per tier."""
    pairs = [F.struct(F.lit(t).alias("demand_tier"), F.lit(p).alias("policy")) for t, p in policy]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*pairs)))


def with_policy(tiered: DataFrame, policy: DataFrame) -> DataFrame:
    """Attach the policy of each tier (one row per tier, broadcast)."""
    return tiered.join(F.broadcast(policy), "demand_tier", "left")


def append_baseline(metrics: DataFrame, baseline: DataFrame) -> DataFrame:
    """Model rows and the baseline row; measures the baseline lacks are NULL."""
    return metrics.unionByName(baseline, allowMissingColumns=True)


def lift_over_baseline(metrics: DataFrame, baseline: DataFrame) -> DataFrame:
    """Accuracy and F1 gained over the one-row baseline, in percentage points."""
    base = baseline.limit(1).first()
    return metrics.select(
        "model",
        ((F.col("accuracy") - F.lit(base["accuracy"])) * 100).alias("accuracy_lift"),
        ((F.col("f1") - F.lit(base["f1"])) * 100).alias("f1_lift"),
    )
