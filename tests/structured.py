"""A daily table with structure to learn from: expected levels x seeded noise, with outages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weekloom import Roles
from weekloom import constants as K
from weekloom.operators import calendar as C, panel as P

START, END, CUT = "2024-01-01", "2025-02-28", "2024-11-01"


def daily_table(spark: SparkSession, entities: int = 70, roles: Roles = Roles()) -> DataFrame:
    levels = spark.createDataFrame([list(r) for r in K.DEFAULT_SEGMENT_LEVELS], "s string, b double, w double, p double")
    names = F.lit([r[0] for r in K.DEFAULT_SEGMENT_LEVELS])
    people = spark.range(1, entities + 1).select(
        F.format_string("E%04d", "id").alias(roles.entity),
        F.element_at(names, (F.col("id") % 7 + 1).cast("int")).alias(roles.segment),
        F.exp(0.35 * F.sin(F.col("id") * 12.9898) * 1.4).alias("scale"),
    )
    cal = C.calendar(spark, START, END, K.DEFAULT_EVENTS, roles)
    none = spark.createDataFrame([], f"{roles.entity} string, {roles.day} date, {roles.value} double, {roles.n_ok} int, {roles.n_failed} int")
    panel = P.densify(none, people, cal, START, END, roles, carry=("scale",))
    noisy = P.expected_level(panel, levels, START, END, "scale", roles=roles)
    seed = F.xxhash64(roles.entity, roles.day)
    uniform = lambda salt: (F.pmod(F.xxhash64(seed, F.lit(salt)), F.lit(1_000_003)) + 1) / 1_000_004.0
    normal = F.sqrt(-2 * F.log(uniform(1))) * F.cos(6.283185307 * uniform(2))
    value = F.bround(F.col("expected") * F.exp(0.18 * normal))
    out = noisy.withColumn(roles.value, value)
    out = out.withColumn(roles.n_ok, P.derived_count(F.col(roles.value), F.lit(3200.0), F.col(roles.segment)).cast("int"))
    out = out.withColumn(roles.n_failed, (F.col(roles.n_ok) * 0.025 + uniform(3)).cast("int"))
    out = P.mask_measures(out, uniform(4) < 0.012, [roles.value, roles.n_ok, roles.n_failed])
    return out.select(*[f.name for f in roles.schema().fields])
