"""N-gram Jaccard join by parity sketches.

A document's set of shingles is hashed to positions 0..2^32-1; its sketch is the parity of each
position. Two sketches differ in at most as many bits as the sets differ in elements, and sets
with Jaccard similarity ``t`` or more, sizes a and b, differ in at most
``(a + b) * (1 - t) / (1 + t)`` elements. So per size band the sketch is cut into T segments, of
which similar documents disagree in at most d < T: they share at least T - d segments, hence
(order the segments of each document by one common order) one of its first d + 1. Those d + 1
segments, the ones with most elements first, are the join keys. Bands grow by 1/t, so a partner
is in the same band or the next, and a document is keyed for both.

Exact copies of a set share a fingerprint and are one class; a task emits the keys of a class
once. Within a key the smallest id is paired with the others (no pairs among all), a folded
1024-bit sketch bounds the difference from below, and what is left is verified on the sets.
Where a key still holds several components, its members carry size and sketch and further ones
become leaders, round by round, paired only where the bound allows it, until each pair of members
is ruled out, verified or in one component: no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.llm import scan
from weekloom.llm.components import link_by_keys, with_lead
from weekloom.staging import stage

U = np.uint64
FOLD_WORDS = 16


class Bands:
    """Size bands and their segments for a similarity of ``percent`` / 100."""

    def __init__(self, percent: int, most: int = 1 << 40):
        edges, x = [1], 1
        while x < most:
            x = max(x + 1, -(-x * 100 // percent))
            edges.append(x)
        self.edges = np.array(edges, np.int64)
        ratio = Fraction(100 - percent, 100 + percent)
        self.allowed = np.array([int(2 * (hi - 1) * ratio) for hi in edges[1:]], np.int64)
        self.segments = np.maximum(self.allowed + 2, (self.allowed + 1) * 5 // 4)
        # with no difference allowed only equal sets match, and those are one class already
        self.segments[self.allowed == 0] = 0

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, sizes, "right") - 1


def fold(h: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Parity of the positions modulo 1024, as 16 words a row."""
    word = owner * FOLD_WORDS + ((h >> U(6)) & U(FOLD_WORDS - 1)).astype(np.int64)
    bit = U(1) << (h & U(63))
    order = np.argsort(word, kind="stable")
    return scan.sums(bit[order], word[order], n * FOLD_WORDS, np.bitwise_xor).reshape(n, -1)


def segment_keys(
    h: np.ndarray, owner: np.ndarray, size: np.ndarray, band: np.ndarray, bands: Bands, seed: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each row the keys of its first d + 1 segments in ``band``, and their rows."""
    n = len(size)
    t, d = bands.segments[band], bands.allowed[band]
    t = np.where(size > 0, t, 0)
    base = np.cumsum(t) - t
    if seed:
        position = scan.mix(h ^ U(seed)) >> U(32)
        order = np.argsort((owner.astype(U) << U(32)) | position, kind="stable")
        position, owner = position[order], owner[order]
    else:
        position = h >> U(scan.SHINGLE_BITS - 32)
    used = t[owner] > 0
    position, owner, h = position[used], owner[used], h[used]
    segment = ((position * t[owner].astype(U)) >> U(32)).astype(np.int64)
    slot = base[owner] + segment
    total = int(t.sum())
    parity = scan.sums(scan.mix(position), slot, total, np.bitwise_xor)
    count = np.bincount(slot, minlength=total)
    row = np.repeat(np.arange(n), t)
    number = np.arange(total) - base[row]
    key = scan.mix(parity ^ scan.mix(band[row].astype(U) * U(1 << 32) + number.astype(U) + U(seed)))
    # most elements first; equal segments have equal counts, so the order is a common one
    rank = (row.astype(U) << U(48)) | ((U(255) - np.minimum(count, 255).astype(U)) << U(40)) | (key >> U(24))
    order = np.argsort(rank, kind="stable")
    first = number < (d[row] + 1)  # the rows are in order, so this is the place in the sorted row too
    kept = order[first]
    key, row, empty = key[kept], row[kept], count[kept] == 0
    if seed == 0 and empty.any():
        key, row = _finer(h, owner, size, band, bands, key, row, empty)
    return key, row


def _finer(h, owner, size, band, bands, key, row, empty):
    """An empty segment says little: its key is joined with those of a second segmentation.

    Two similar rows that agree in the empty segment agree in a segment of the second one too.
    """
    rows = np.unique(row[empty])
    inside = np.isin(owner, rows)
    again = np.searchsorted(rows, owner[inside])
    k2, r2 = segment_keys(h[inside], again, size[rows], band[rows], bands, 0x5BD1E995)
    counts = np.bincount(r2, minlength=len(rows))
    first = np.cumsum(counts) - counts
    ek, er = key[empty], np.searchsorted(rows, row[empty])
    reps = counts[er]
    at = np.repeat(first[er] - (np.cumsum(reps) - reps), reps) + np.arange(reps.sum())
    key = np.append(key[~empty], scan.mix(np.repeat(ek, reps) ^ scan.mix(k2[at])))
    return key, np.append(row[~empty], np.repeat(rows[er], reps))


def _fingerprints(h, owner, n) -> tuple[np.ndarray, np.ndarray]:
    return (scan.sums(scan.mix(h), owner, n, np.add),
            scan.sums(scan.mix(h ^ U(0xABCDEF123456789)), owner, n, np.add))


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple]:
    ids = batch.column(0)
    data, at = scan.buffers(batch.column(1))
    for i, j in scan.slices(at):
        yield ids.slice(i, j - i), *scan.shingle_sets(data, at[i : j + 1], k)


def _profiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, h, owner, size in _sets(batch, k):
                n = len(ids)
                f1, f2 = _fingerprints(h, owner, n)
                flat = pa.array(scan.signed(fold(h, owner, n)).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * FOLD_WORDS), flat)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(size.astype(np.int64)), pa.array(scan.signed(f1)), pa.array(scan.signed(f2)), lists],
                    ["doc_id", "n", "f1", "f2", "sketch"])

    return run


def _keys(k: int, bands: Bands):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for ids, h, owner, size in _sets(batch, k):
                f1, f2 = _fingerprints(h, owner, len(ids))
                new = np.zeros(len(ids), bool)
                for i, f in enumerate((f1 ^ scan.mix(f2)).tolist()):
                    if f not in seen:
                        seen.add(f)
                        new[i] = True
                mask = new[owner]
                h, owner = h[mask], owner[mask]
                size = np.where(new, size, 0)
                band = bands.of(np.maximum(size, 1))
                number = ids.to_numpy(zero_copy_only=False)
                for b in (band, band + 1):
                    key, row = segment_keys(h, owner, size, b, bands, 0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(scan.signed(key)), pa.array(number[row].astype(np.int64))], ["key", "doc_id"])

    return run


def _tokens(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, h, _, size in _sets(batch, k):
                ends = pa.array(np.append(0, np.cumsum(size)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.ListArray.from_arrays(ends, pa.array(h.astype(np.int64)))], ["doc_id", "tokens"])

    return run


def _side(df: DataFrame, end: str) -> DataFrame:
    return df.select([F.col(c).alias(f"{c}_{end}") for c in df.columns])


def _alike(percent: int) -> str:
    """Sizes and folded sketches ``_a`` and ``_b`` leave room for a similarity of ``percent`` / 100."""
    differ = " + ".join(f"bit_count(sketch_a[{i}] ^ sketch_b[{i}])" for i in range(FOLD_WORDS))
    return (f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"
            f" and ({differ}) * {100 + percent} <= (n_a + n_b) * {100 - percent}")


def _verified(pairs: DataFrame, reps: DataFrame, texts: DataFrame, percent: int, k: int) -> DataFrame:
    """The pairs ``(a, b)`` of class representatives that are similar enough, by their whole sets."""
    bounded = (
        pairs.join(_side(reps, "a"), F.col("a") == F.col("doc_id_a"))
        .join(_side(reps, "b"), F.col("b") == F.col("doc_id_b"))
        .where(_alike(percent))
        .select(*pairs.columns)
    )
    pairs = stage(bounded, "pairs")
    ends = stage(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ends")
    tokens = scan.only_ids(texts, ends, "doc_id").mapInArrow(_tokens(k), "doc_id long, tokens array<long>")
    # rows that share an id may differ; the class of its first fingerprint counts for the id
    tokens = stage(tokens, "tokens")
    both = pairs.join(_side(tokens, "a"), F.col("a") == F.col("doc_id_a")).join(
        _side(tokens, "b"), F.col("b") == F.col("doc_id_b")
    )
    shared = both.select(*pairs.columns, F.size(F.array_intersect("tokens_a", "tokens_b")).cast("long").alias("i"),
                         (F.size("tokens_a") + F.size("tokens_b")).cast("long").alias("s"))
    return shared.where(f"100 * i >= {percent} * (s - i)").select(*pairs.columns)


def link_components(docs: DataFrame, k: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs``.

    Two rows link if the Jaccard similarity of their sets of ``k``-word shingles is at least
    ``percent`` / 100. Words are runs of anything but ASCII white space, A-Z count as a-z. A row
    with fewer words than ``k`` has its whole sequence as its one shingle. A null or empty text
    has the empty set and links with nothing. A row without an id keeps its size, links with
    nothing and has a null component. Rows that repeat an id are one node: links of either
    count. Other columns are ignored, so their names do not matter.
    """
    bands = Bands(percent)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    profile = stage(texts.mapInArrow(_profiles(k), "doc_id long, n long, f1 long, f2 long, sketch array<long>"), "profiles")
    full = profile.where("n > 0 and doc_id is not null")
    # several texts under one id: each of its classes counts, tied together by the id
    classes = full.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep"))
    member = stage(full.select("doc_id", "f1", "f2", "n").distinct().join(classes, ["f1", "f2", "n"])
                   .select("doc_id", "rep", "f1", "f2"), "classes")
    tied = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a != b")
    tied = member.join(tied, "doc_id").select("a", F.col("rep").alias("b")).where("a != b")
    # equal rows of one id have equal fingerprints: one of them stands for all
    first = full.groupBy("doc_id", "f1", "f2").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    reps = stage(first.join(member.where("doc_id = rep"), ["doc_id", "f1", "f2"]).select("doc_id", "n", "sketch"), "reps")
    again = stage(full.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id"), "repeated")
    named = texts.where("doc_id is not null")
    link_texts = scan.only_ids(named, again, "doc_id", "left_anti").unionByName(
        scan.only_ids(named, again, "doc_id").dropDuplicates(["doc_id", "text"]))

    keys = link_texts.mapInArrow(_keys(k, bands), "key long, doc_id long")
    of_key = Window.partitionBy("key")
    multi = stage(
        keys.select("key", "doc_id", F.min("doc_id").over(of_key).alias("low"), F.max("doc_id").over(of_key).alias("high"))
        .where("low != high").select("key", "doc_id"),
        "keys",
    )
    rep_of = member.groupBy("doc_id").agg(F.min("rep").alias("rep"))
    multi = multi.join(rep_of, "doc_id").select("key", "rep").distinct()

    def verify(pairs: DataFrame) -> DataFrame:
        return _verified(pairs, reps, link_texts, percent, k)

    traits = reps.withColumnRenamed("doc_id", "rep")
    joined = link_by_keys(with_lead(multi), verify, tied.select("a", "b"), traits, _alike(percent))
    roots = joined.select(F.col("node").alias("rep"), "root")
    labels = rep_of.join(roots, "rep", "left").select("doc_id", F.coalesce("root", "rep").alias("component"))
    return profile.select("doc_id", F.col("n").alias("n_shingles")).join(labels, "doc_id", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
