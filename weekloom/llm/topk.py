"""Exact top-k search by distributed histogram selection.

Vectors become integers, scores are integer inner products. Every pass scores the whole table
against a block of queries and counts each query's scores in the bins of an interval; the bin of
the k-th score is the next interval, until an interval is a single score. A last pass returns all
higher scores and, of equal ones, the smallest ids. A task keeps per query only its highest bins
up to k scores, and only its k smallest ids of the last score, which cannot lose a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.staging import stage

BINS = 1024
QUERY_BLOCK = 2048
ROW_BLOCK = 1024
EXACT = 1 << 53


def integers(vectors: list, scale: int = 1024) -> np.ndarray:
    return np.floor(np.asarray(vectors, np.float64) * scale)


def scores(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Integer inner products, rows x queries: by floats while these are exact, else by integers.

    Beyond 64 bits a score stays at the end of the range.
    """
    if not rows.size or not queries.size:
        return np.zeros((len(rows), len(queries)), np.int64)
    bound = np.abs(rows).max() * np.abs(queries).max() * rows.shape[1]
    if bound < EXACT:
        return (rows @ queries.T).astype(np.int64)
    if bound < 2**62:
        return rows.astype(np.int64) @ queries.T.astype(np.int64)
    whole = [[sum(int(a) * int(b) for a, b in zip(r, q, strict=True)) for q in queries] for r in rows]
    return np.array([[min(max(x, -(2**63)), 2**63 - 1) for x in r] for r in whole], np.int64)


def valid(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows ``(id, v)`` that take part: an id, and a vector without null or non-finite components."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull()).where(~bad)


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, ROW_BLOCK):
            part = batch.slice(i, ROW_BLOCK)
            flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
            yield part.column(0).to_numpy(zero_copy_only=False), integers(flat.reshape(part.num_rows, width))


def _histogram(held, width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q, low, step = held.value
        n = len(ids)
        counts = np.zeros((n, BINS + 1), np.int64)
        for row_ids, rows in _blocks(batches, width):
            s = scores(rows, q)
            # bins of the interval, the last one for all above it
            b = np.minimum((s - low) // step, BINS)
            use = (s >= low) & (row_ids[:, None] != ids)
            counts += np.bincount((b + np.arange(n) * (BINS + 1))[use], minlength=n * (BINS + 1)).reshape(n, -1)
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        # what lies above is kept whole: it is one number a query
        keep = (counts > 0) & ((above < k) | (np.arange(BINS + 1) == BINS))
        at, bin_ = np.nonzero(keep)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int64)), pa.array(bin_.astype(np.int64)), pa.array(counts[at, bin_])], ["q", "bin", "n"])

    return run


def _best(held, width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q, last = held.value
        ties: list[np.ndarray] = [np.zeros(0, np.int64)] * len(ids)
        for row_ids, rows in _blocks(batches, width):
            s = scores(rows, q)
            r, c = np.nonzero((s > last) & (row_ids[:, None] != ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[c]), pa.array(row_ids[r].astype(np.int64)), pa.array(s[r, c])], ["query_id", "vec_id", "score"])
            r, c = np.nonzero((s == last) & (row_ids[:, None] != ids))
            for i in np.unique(c):
                ties[i] = np.sort(np.append(ties[i], row_ids[r[c == i]]))[:k]
        size = [len(t) for t in ties]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(ids, size)), pa.array(np.concatenate(ties).astype(np.int64)), pa.array(np.repeat(last, size))],
            ["query_id", "vec_id", "score"])

    return run


def _search(rows: DataFrame, width: int, ids: np.ndarray, q: np.ndarray, peak: float, k: int) -> DataFrame:
    """The best ``k`` of one block of queries over all rows of this width."""
    sc = rows.sparkSession.sparkContext
    reach = np.minimum(np.abs(q).sum(axis=1) * peak, 2.0**62)
    low = -np.ceil(reach).astype(np.int64)
    step = np.maximum((-2 * low) // BINS + 1, 1)
    done = np.zeros(len(ids), bool)
    while not done.all():
        held = sc.broadcast((ids, q, low, step))
        counts = rows.mapInArrow(_histogram(held, width, k), "q long, bin long, n long")
        counts = counts.groupBy("q", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("q").orderBy(F.desc("bin"))
        reached = counts.withColumn("upto", F.sum("n").over(down)).where(f"upto >= {k}")
        found = {r["q"]: r["bin"] for r in reached.groupBy("q").agg(F.max("bin").alias("bin")).collect()}
        held.unpersist()
        for i in np.flatnonzero(~done):
            if i not in found:  # fewer than k scores: all of them count
                done[i], low[i], step[i] = True, low[i] - 1, 1
            elif step[i] == 1:
                done[i], low[i] = True, low[i] + found[i]
            else:
                low[i] += found[i] * step[i]
                step[i] = -(-step[i] // BINS)
    held = sc.broadcast((ids, q, low))
    return rows.mapInArrow(_best(held, width, k), "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, every: int = 100, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query the ``k`` highest scores, ties to the smaller id.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but the query's
    own id. Vectors that are null or hold nulls or non-finite numbers, and rows without an id,
    take no part. Vectors of different lengths meet only their own length. Rows that repeat an id
    are candidates each; a repeated query id is answered for its smallest vector. Queries pass the
    driver in blocks of ``QUERY_BLOCK``; rows are scored where they are read.
    """
    spark = vectors.sparkSession
    rows = valid(vectors, id_col, vec_col)
    queries = stage(rows.where(F.pmod("id", F.lit(every)) == 0).groupBy("id").agg(F.min("v").alias("v")).withColumn(
        "width", F.size("v")), "queries")
    found = spark.createDataFrame([], "query_id long, vec_id long, score long")
    for width in [r["width"] for r in queries.select("width").distinct().orderBy("width").collect()]:
        same = rows.where(F.size("v") == width)
        peak = same.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(F.floor(x * 1024.0)).cast("double"))))).first()[0]
        mine, start = queries.where(F.col("width") == width), None
        while True:
            rest = mine if start is None else mine.where(F.col("id") > start)
            block = rest.orderBy("id").limit(QUERY_BLOCK).collect()
            if not block:
                break
            ids = np.array([r["id"] for r in block], np.int64)
            q = integers([r["v"] for r in block]).reshape(len(block), width)
            found = found.unionByName(stage(_search(same, width, ids, q, float(peak or 0), k), "best"))
            start = int(ids[-1])
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
