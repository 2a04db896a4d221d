"""Column roles of an entity x day panel and the explicit schemas of its files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Roles:
    """Which column of a panel plays which part.

    ``scale`` is the number of decimals ``value`` carries. Sums are then taken on
    whole minor units, so they do not depend on the order in which Spark adds the
    rows. ``None`` (the default) sums the column as it is.
    """

    entity: str = "entity_id"
    segment: str = "segment"
    day: str = "day"
    value: str = "value"
    n_ok: str = "n_ok"
    n_failed: str = "n_failed"
    weekend: str = "is_weekend"
    payday: str = "is_payday"
    event: str = "is_event"
    week: str = "week_start"
    scale: int | None = None

    def schema(self, entity_type: T.DataType | None = None) -> T.StructType:
        """Schema of a daily file, in file order."""
        return T.StructType(
            [
                T.StructField(self.entity, entity_type or T.StringType()),
                T.StructField(self.day, T.DateType()),
                T.StructField(self.segment, T.StringType()),
                T.StructField(self.value, T.DoubleType()),
                T.StructField(self.n_ok, T.IntegerType()),
                T.StructField(self.n_failed, T.IntegerType()),
                T.StructField(self.weekend, T.IntegerType()),
                T.StructField(self.payday, T.IntegerType()),
                T.StructField(self.event, T.IntegerType()),
            ]
        )


CONFUSION = T.StructType([T.StructField(c, T.LongType()) for c in ("TN", "FP", "FN", "TP")])

MODEL_METRICS = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("precision", T.DoubleType()),
        T.StructField("recall", T.DoubleType()),
        T.StructField("f1", T.DoubleType()),
        T.StructField("auc", T.DoubleType()),
        T.StructField("confusion", CONFUSION),
    ]
)
