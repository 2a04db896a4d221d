"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks of bytes that cover all of it. Learned filters run over
each chunk, every filter keeps its maximum, a small layer combines them to chunk features, and
the maximum and mean of these over the chunks give one probability. The network is fitted on a
bounded sample of labelled rows; scoring is one pass over the Arrow buffers, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom.llm import scan

CHUNK, HOP = 256, 192
WIDTH, STRIDE = 10, 2
BATCH_CHUNKS = 64
SPOTS = (CHUNK - WIDTH) // STRIDE + 1


@dataclass
class Net:
    embed: np.ndarray  # 256 x e
    filters: np.ndarray  # width * e x filters
    bias: np.ndarray
    hidden: np.ndarray  # filters x features
    hidden_bias: np.ndarray
    out: np.ndarray  # 2 * features
    out_bias: np.ndarray

    @classmethod
    def new(cls, seed: int, e: int = 4, filters: int = 32, features: int = 16) -> Net:
        r = np.random.default_rng(seed)
        f32 = lambda *shape, by: (r.standard_normal(shape) * by).astype(np.float32)
        return cls(f32(256, e, by=0.5), f32(WIDTH * e, filters, by=0.25), np.zeros(filters, np.float32),
                   f32(filters, features, by=0.2), np.zeros(features, np.float32),
                   f32(2 * features, by=0.3), np.zeros(1, np.float32))

    def parts(self) -> list[np.ndarray]:
        return list(self.__dict__.values())


def chunks(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every chunk, and its row; an empty row has one empty chunk."""
    size = np.diff(at)
    count = 1 + np.maximum(0, -(-(size - CHUNK) // HOP))
    row = np.repeat(np.arange(len(size)), count)
    number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = at[:-1][row] + number * HOP
    return start, np.minimum(start + CHUNK, at[1:][row]), row


def gather(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Chunk bytes, zero beyond the end of the row."""
    where = start[:, None] + np.arange(CHUNK)
    inside = where < end[:, None]
    if not len(data):
        return np.zeros(where.shape, np.uint8)
    return np.where(inside, data[np.minimum(where, len(data) - 1)], 0).astype(np.uint8)


def windows(net: Net, block: np.ndarray) -> np.ndarray:
    """Embedded windows: chunks x places x (width * e)."""
    e = net.embed.shape[1]
    x = net.embed[block].reshape(len(block), CHUNK * e)
    s0, s1 = x.strides
    view = np.lib.stride_tricks.as_strided(x, (len(block), SPOTS, WIDTH * e), (s0, STRIDE * e * s1, s1))
    return np.ascontiguousarray(view)


def chunk_features(net: Net, block: np.ndarray) -> np.ndarray:
    x = windows(net, block)
    peak = (x.reshape(-1, x.shape[2]) @ net.filters).reshape(len(block), SPOTS, -1).max(axis=1)
    return np.maximum(np.maximum(peak + net.bias, 0) @ net.hidden + net.hidden_bias, 0)


def probability(net: Net, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One probability for each row."""
    if len(at) < 2:
        return np.zeros(0)
    start, end, row = chunks(data, at)
    h = np.concatenate([chunk_features(net, gather(data, start[i : i + BATCH_CHUNKS], end[i : i + BATCH_CHUNKS]))
                        for i in range(0, len(start), BATCH_CHUNKS)])
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    count = np.diff(np.append(first, len(row)))[:, None]
    pooled = np.hstack([np.maximum.reduceat(h, first), np.add.reduceat(h, first) / count])
    z = pooled.astype(np.float64) @ net.out.astype(np.float64) + float(net.out_bias[0])
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _step(net: Net, data: np.ndarray, at: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean log loss over a few rows."""
    start, end, row = chunks(data, at)
    block = gather(data, start, end)
    x = windows(net, block)
    a = (x.reshape(-1, x.shape[2]) @ net.filters).reshape(len(block), SPOTS, -1)
    place = a.argmax(axis=1)
    peak = np.take_along_axis(a, place[:, None, :], 1)[:, 0] + net.bias
    m = np.maximum(peak, 0)
    pre = m @ net.hidden + net.hidden_bias
    h = np.maximum(pre, 0)
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    count = np.diff(np.append(first, len(row)))
    top = np.maximum.reduceat(h, first)
    mean = np.add.reduceat(h, first) / count[:, None]
    pooled = np.hstack([top, mean])
    p = 1 / (1 + np.exp(-np.clip(pooled @ net.out + net.out_bias[0], -30, 30)))
    dz = ((p - y) / len(y)).astype(np.float32)
    k = h.shape[1]
    dpool = dz[:, None] * net.out[None, :]
    ties = (h == top[row]).astype(np.float32)
    ties /= np.add.reduceat(ties, first)[row]
    dh = ties * dpool[row, :k] + dpool[row, k:] / count[row][:, None]
    dpre = (dh * (pre > 0)).astype(np.float32)
    dm = (dpre @ net.hidden.T) * (peak > 0)
    near = np.take_along_axis(x, place[:, :, None], 1)  # chunks x filters x (width * e)
    dfilters = np.einsum("cfw,cf->wf", near, dm, optimize=True)
    e = net.embed.shape[1]
    spread = (dm[:, :, None] * net.filters.T[None]).reshape(len(block), -1, WIDTH, e)
    byte = np.take_along_axis(block[:, None, :], place[:, :, None] * STRIDE + np.arange(WIDTH), 2)
    dembed = np.stack([np.bincount(byte.ravel(), spread[..., i].ravel(), 256) for i in range(e)], 1)
    return [dembed, dfilters, dm.sum(0), m.T @ dpre, dpre.sum(0), pooled.T @ dz, np.array([dz.sum()])]


def fit(texts: list[bytes], y: np.ndarray, seed: int = 7, epochs: int = 14, rows: int = 48, rate: float = 0.004, steps: int = 600) -> Net:
    """Adam over small batches of rows, ``epochs`` times or for ``steps`` batches, whichever is more.

    The order depends on the seed alone.
    """
    epochs = max(epochs, -(-steps * rows // max(len(texts), 1)))
    net, r = Net.new(seed), np.random.default_rng(seed + 1)
    m1 = [np.zeros_like(w) for w in net.parts()]
    m2 = [np.zeros_like(w) for w in net.parts()]
    t = 0
    for epoch in range(epochs):
        order = r.permutation(len(texts))
        step = rate * (1 - epoch / epochs) + rate / 20
        for i in range(0, len(order), rows):
            some = order[i : i + rows]
            data = np.frombuffer(b"".join(texts[j] for j in some), np.uint8)
            at = np.append(0, np.cumsum([len(texts[j]) for j in some])).astype(np.int64)
            t += 1
            for w, g, a, b in zip(net.parts(), _step(net, data, at, y[some]), m1, m2, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= (step * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-7)).astype(np.float32)
    return net


def sample(docs: DataFrame, labels: DataFrame, each: int, most_bytes: int, doc_filter=None) -> list:
    """Up to ``each`` labelled texts of either class, those with the smallest id hashes.

    Only texts of at most ``most_bytes`` bytes are sampled. Labels other than 0 and 1, and rows
    without an id, are left out; an id labelled both ways is too.
    """
    marks = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(
        F.min("quality").alias("y"), F.max("quality").alias("y1")).where("y = y1").select("doc_id", "y")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.where(F.octet_length("text") <= most_bytes)
    if doc_filter is not None:
        rows = rows.where(doc_filter)
    # the ids first: only the few texts that are chosen travel
    ids = rows.select("doc_id").join(marks, "doc_id").distinct().select("doc_id", "y", F.xxhash64("doc_id").alias("h"))
    chosen = None
    for y in (0, 1):
        part = ids.where(F.col("y") == y).orderBy("h", "doc_id").limit(each)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = rows.join(F.broadcast(chosen), "doc_id")  # at most 2 * each ids
    return texts.groupBy("doc_id", "y", "h").agg(F.min("text").alias("text")).orderBy("h", "doc_id").collect()


def train(docs: DataFrame, labels: DataFrame, each: int = 1500, most_bytes: int = 8000, doc_filter=None, seed: int = 7) -> Net | None:
    """A network fitted to ``labels.quality``; None if the sample lacks one of the classes."""
    rows = sample(docs, labels, each, most_bytes, doc_filter)
    y = np.array([r.y for r in rows], np.float32)
    if not len(y) or y.min() == y.max():
        return None
    return fit([r.text.encode() for r in rows], y, seed)


def with_score(docs: DataFrame, net: Net | None, name: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns and the probability that a text is good.

    Without a network every row scores 1.0, so nothing is rejected for lack of labels. Null and
    empty texts score like any other, through their one empty chunk. ``name`` must be new.
    """
    if name in docs.columns:
        raise ValueError(f"a column named {name} is there already")
    at_text = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = scan.buffers(batch.column(at_text))
            parts = [np.ones(j - i) if net is None else probability(net, data, at[i : j + 1])
                     for i, j in scan.slices(at)]
            score = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Labels are learned only from rows that are not held out. A row without an id is not held
    out and has no label. Rows that repeat an id are scored one by one. Other columns of
    ``docs`` are never read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    net = train(docs, labels, doc_filter=~held_out())
    scored = with_score(rows, net)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
