"""Interval join: rows that lie in any window of a large table, by cells of the axis."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def islands(windows: DataFrame, start: str, end: str, width: int, keys: list[str]) -> DataFrame:
    """(keys, cell, lo, hi): the windows cut at cell borders and merged inside each cell, without overlaps.

    ``start`` and ``end`` are whole numbers, both inside the window; a window that ends before it
    starts, or lacks an end, covers nothing. Windows that share a start in a cell are one before
    any are ordered, so what a task orders is one cell's different starts.
    """
    lo, hi = F.col(start).cast("long"), F.col(end).cast("long")
    cell = lambda x: F.floor(x / F.lit(width)).cast("long")
    kept = windows.select(*keys, lo.alias("__s"), hi.alias("__e")).where("__e >= __s")
    cut = kept.select(*keys, "__s", "__e", F.explode(F.sequence(cell(F.col("__s")), cell(F.col("__e")))).alias("cell"))
    low = F.greatest(F.col("__s"), F.col("cell") * width)
    high = F.least(F.col("__e"), F.col("cell") * width + (width - 1))
    pieces = cut.select(*keys, "cell", low.alias("lo"), high.alias("hi")).groupBy(*keys, "cell", "lo").agg(F.max("hi").alias("hi"))
    order = Window.partitionBy(*keys, "cell").orderBy("lo")
    before = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("lo") > before + 1).cast("int"), F.lit(1))
    placed = pieces.select(*keys, "cell", "lo", "hi", opens.alias("__new"))
    placed = placed.withColumn("__island", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return placed.groupBy(*keys, "cell", "__island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("__island")


def covered(rows: DataFrame, windows: DataFrame, at: str, start: str, end: str, width: int, keys: list[str] = ()) -> DataFrame:
    """The rows whose ``at`` lies in any window of the same keys, each once, all their columns kept.

    An equi join on keys and cell of ``width``; as merged windows do not overlap, a row meets at most one
    of them, however many windows hold it. Neither side is broadcast by this function nor opened on the
    driver. Choose ``width`` near the usual length of a window: a longer window has a piece in each of
    its cells. Rows with a null ``at`` or key match nothing.
    """
    keys = list(keys)
    parts = islands(windows, start, end, width, keys).withColumnsRenamed({k: f"__{k}" for k in keys} | {"cell": "__cell", "lo": "__lo", "hi": "__hi"})
    place = F.col(at).cast("long")
    match = F.floor(place / F.lit(width)).cast("long") == F.col("__cell")
    for k in keys:
        match = match & (F.col(k) == F.col(f"__{k}"))
    return rows.join(parts, match & place.between(F.col("__lo"), F.col("__hi")), "left_semi")
