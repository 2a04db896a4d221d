"""Connected components by alternating stars: a distributed union-find without a driver side."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.staging import stage


#: Parts of a key that name leaders of their own, and how many times more lead each round.
SALTS = 16
EDGES_PER_FILE = 200_000


def _state(edges: DataFrame) -> tuple[int, bool]:
    """How many edges there are, and whether each node hangs on one that hangs on none."""
    ends = F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up")), F.struct(F.col("v").alias("x"), F.lit(0).alias("up")))
    per = edges.select(F.inline(ends)).groupBy("x").agg(F.sum("up").alias("ups"), F.count(F.lit(1)).alias("n"))
    row = per.agg(F.sum("ups"), F.expr("count_if(ups > 0 and n > 1)")).first()
    return row[0] or 0, row[1] == 0


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node of an edge table; ``root`` is the smallest node reachable.

    Edges with a null end or equal ends are ignored, repeated edges count once; a table without
    edges gives no rows. Every pass hangs each node's neighbours onto its smallest neighbour,
    first the larger ones, then the smaller, and is written to shared storage. Minima are taken
    with partial sums, so that a node with very many neighbours is no hot spot.
    """
    e = stage(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
              .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    n, settled = _state(e)
    while not settled:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        far = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        far = far.where("u != v")
        low = far.groupBy("u").agg(F.min("v").alias("m"))
        near = far.join(low, "u")
        near = near.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                             F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        # few edges stay in few files
        files = 1 + n // EDGES_PER_FILE
        e = stage(near.select("x.u", "x.v").where("u != v").distinct().coalesce(files), "edges")
        n, settled = _state(e)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def with_lead(members: DataFrame) -> DataFrame:
    """Rows ``(key, rep)`` with the smallest ``rep`` of their key, found by partial minima, as ``lead``."""
    members = stage(members.select("key", "rep"), "keyed")
    return members.join(members.groupBy("key").agg(F.min("rep").alias("lead")), "key")


def _unsettled(members: DataFrame) -> DataFrame:
    """``members`` of the keys that hold several components; extremes by partial sums, so that a large key is no hot spot."""
    keys = members.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 != r1").select("key")
    return members.join(keys, "key", "left_semi")


def link_by_keys(
    members: DataFrame, verify: Callable[[DataFrame], DataFrame], ties: DataFrame, traits: DataFrame, may_link: str
) -> DataFrame:
    """``(node, root)`` of everything linked among rows ``(key, rep, lead)`` that share a key.

    Each key's smallest member, ``lead``, is paired with its others and ``verify`` keeps the pairs
    ``(a, b)`` that hold, with their other columns. A member that has led is done. Where a key
    then still has members of several components, further members lead, until each pair is
    verified or in one component: as ``verify`` would link all pairs, without listing them.
    These members carry their ``traits`` (a table with a column ``rep``), and a pair is made only
    if ``may_link`` holds, a condition on traits with ``_a`` and ``_b`` after their names that no
    pair that ``verify`` keeps fails. Later leaders are the first of each of ``SALTS`` parts of a key, then
    ``SALTS`` times as many a round. A pair carries the roots of its ends, so later rounds join
    components and do not go back to the links. ``ties`` are links known before.
    """
    held = [c for c in traits.columns if c != "rep"]
    led = stage(members.where("lead < rep").select("key", "rep", "lead"), "members")
    pairs = led.select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct()
    pairs = pairs.select("a", "b", F.col("a").alias("root_a"), F.col("b").alias("root_b"))
    found = verify(pairs).select("root_a", "root_b")
    maps = [components(found.unionByName(ties.select(F.col("a").alias("root_a"), F.col("b").alias("root_b"))), "root_a", "root_b")]

    left = led.select("key", "rep", F.col("rep").alias("root"))
    left = stage(_unsettled(_renamed(left, maps[-1])), "rest")
    part = Window.partitionBy("key", F.pmod(F.xxhash64("rep"), F.lit(SALTS))).orderBy("rep")
    left = stage(left.withColumn("place", F.row_number().over(part)).join(traits, "rep"), "rest")
    last = 1
    while not left.isEmpty():
        lead = left.where(F.col("place") <= last).select(
            "key", F.col("rep").alias("a"), F.col("root").alias("root_a"),
            *[F.col(c).alias(f"{c}_a") for c in held])
        others = left.select("key", F.col("rep").alias("b"), "place", F.col("root").alias("root_b"),
                             *[F.col(c).alias(f"{c}_b") for c in held])
        # of two leaders one leads the other
        pairs = lead.join(others, "key").where(f"root_a != root_b and (place > {last} or a < b) and ({may_link})")
        found = verify(pairs.select("a", "b", "root_a", "root_b").distinct()).select("root_a", "root_b")
        maps.append(components(found, "root_a", "root_b"))
        left = stage(_unsettled(_renamed(left.where(F.col("place") > last), maps[-1])), "rest")
        last *= SALTS
    if len(maps) == 1:
        return maps[0]
    return components(reduce(DataFrame.unionByName, maps), "node", "root")


def _renamed(members: DataFrame, now: DataFrame) -> DataFrame:
    """``members`` with the roots of their roots."""
    now = now.select("node", F.col("root").alias("now"))
    return members.join(now, F.col("root") == F.col("node"), "left").withColumn("root", F.coalesce("now", "root")).drop("now", "node")
