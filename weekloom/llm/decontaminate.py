"""Benchmark decontamination: BM25 with block-max WAND over an inverted index of test items.

The items are indexed, not the corpus: every window of every document is a query, its distinct
terms are the query terms. The window is as long as two of the longest item and moves by one, so
that some window holds any item whole. Scores are fractions of the item's score for itself, and
all windows at or above the threshold are retrieved:

* WAND: of an item's terms only the rarest, ``essential`` ones, which hold most of its score,
  open a candidate. A window that lacks them cannot reach the threshold on the others.
* Block-max: posting lists are cut into blocks of items; a (window, block) pair whose sum of
  block maxima, plus all that other terms could give, stays below the threshold is skipped.
* What is left is scored in full, and then verified by five-word shingles: enough of the whole
  item, of its question and of its answer must stand in the window.

The index is handled in shards of bounded size, one broadcast at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm import scan
from weekloom.staging import stage

U = np.uint64
K1, B = 1.2, 0.75
THETA = 0.6
ESSENTIAL = 0.75
BLOCK = 8
SHARD_WORDS = 2_000_000
CONTAINED, PART_CONTAINED = 0.8, 0.5
SHINGLE = 5


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: the answer is the last sentence of at least three words, else the second half."""
    parts = [p for p in re.split(r"(?<=[.?!:])\s+", text.strip()) if p]
    for i in range(len(parts) - 1, 0, -1):
        if len(" ".join(parts[i:]).split()) >= 3:
            return " ".join(parts[:i]), " ".join(parts[i:])
    each = text.split()
    return " ".join(each[: len(each) // 2]), " ".join(each[len(each) // 2 :])


def hashes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return scan.words(raw, np.array([0, len(raw)]), scan.NOT_ALNUM, fold=True)[0]


WEIGHTS = scan.mix(np.arange(SHINGLE, dtype=U) + U(5)) | U(1)


def shingles(h: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Distinct shingles of a word sequence."""
    m = len(h) - size + 1
    if m <= 0:
        return np.zeros(0, U)
    value = np.zeros(m, U)
    for j in range(size):
        value += h[j : j + m] * WEIGHTS[j]
    return np.unique(value)


def contained(part: np.ndarray, window: np.ndarray) -> float:
    """Share of the part's shingles in the window; a part of under five words is one shingle."""
    size = min(SHINGLE, len(part))
    return float(np.isin(shingles(part, size), shingles(window, size)).mean()) if size else 1.0


@dataclass
class Index:
    """One shard: terms sorted by hash; for each term its essential postings, by block and by item."""

    ids: list[int]
    item_terms: list[np.ndarray]
    item_weights: list[np.ndarray]
    slack: np.ndarray  # per item: what terms that are not essential can give
    words: list[np.ndarray]
    question: list[np.ndarray]
    answer: list[np.ndarray]
    terms: np.ndarray
    first: np.ndarray  # per term: where its block postings begin
    block: np.ndarray
    block_max: np.ndarray
    block_slack: np.ndarray
    stride: int


def build(rows: list, df: dict[int, int], n_items: int, mean_words: float) -> Index:
    """``rows``: (item_id, text) of one shard; ``df``: items of all shards that hold a term."""
    ids, terms_of, weights_of, slack, words = [], [], [], [], []
    question, answer, post = [], [], {}
    for item_id, text in sorted(rows):
        h = hashes(text)
        t, tf = np.unique(h, return_counts=True)
        n = np.array([df[x] for x in t.tolist()], float)
        idf = np.log1p((n_items - n + 0.5) / (n + 0.5))
        w = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(h) / mean_words))
        w = w / w.sum()
        order = np.lexsort((t, -w))
        need = int(np.searchsorted(np.cumsum(w[order]), ESSENTIAL - 1e-9)) + 1
        for k in order[:need]:
            post.setdefault(int(t[k]), []).append((len(ids) // BLOCK, w[k]))
        slack.append(w[order[need:]].sum())
        q, a = split_item(text)
        ids.append(item_id)
        terms_of.append(t)
        weights_of.append(w)
        words.append(h)
        question.append(hashes(q))
        answer.append(hashes(a))
    terms = np.array(sorted(post), U)
    first, block, top = [0], [], []
    for t in terms.tolist():
        best: dict[int, float] = {}
        for b, w in post[t]:
            best[b] = max(best.get(b, 0.0), w)
        block += best.keys()
        top += best.values()
        first.append(len(block))
    slack = np.array(slack)
    rest = np.array([slack[i : i + BLOCK].max() for i in range(0, len(ids), BLOCK)])
    return Index(ids, terms_of, weights_of, slack, words, question, answer, terms, np.array(first),
                 np.array(block, np.int64), np.array(top), rest, max(len(h) for h in words))


def search(index: Index, data: np.ndarray, at: np.ndarray) -> list[tuple]:
    """``(row, item number, window, score, whole, question, answer)`` of all verified windows."""
    h, row = scan.words(data, at, scan.NOT_ALNUM, fold=True)
    if not len(h):
        return []
    n = len(at) - 1
    total = np.bincount(row, minlength=n)
    begin = np.cumsum(total) - total
    cells = -(-total // index.stride)  # steps of a row; window i is steps i and i + 1
    cell0 = np.cumsum(cells) - cells
    cell = cell0[row] + (np.arange(len(h)) - begin[row]) // index.stride
    # essential terms only
    term = np.searchsorted(index.terms, h)
    term[term == len(index.terms)] = 0
    hit = np.flatnonzero(index.terms[term] == h)
    pair = np.unique((cell[hit].astype(np.int64) << 32) | term[hit])
    where, term = pair >> 32, pair & 0xFFFFFFFF
    # a step belongs to the window it opens and to the one before
    last = (cell0 + cells - 1)[np.searchsorted(cell0 + cells, where, "right")]
    start = cell0[np.searchsorted(cell0 + cells, where, "right")]
    opens, closes = np.maximum(np.minimum(where, last - 1), start), np.maximum(where - 1, start)
    window = np.concatenate([opens, closes[closes != opens]])
    term = np.concatenate([term, term[closes != opens]])
    pair = np.unique((window << 32) | term)
    window, term = pair >> 32, pair & 0xFFFFFFFF
    count = index.first[term + 1] - index.first[term]
    which = np.repeat(index.first[term] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    blocks = len(index.block_slack)
    key = np.repeat(window, count) * blocks + index.block[which]
    keys, inverse = np.unique(key, return_inverse=True)
    bound = np.bincount(inverse, index.block_max[which], len(keys)) + index.block_slack[keys % blocks]
    found = []
    for k in keys[bound >= THETA - 1e-9].tolist():
        w, b = divmod(k, blocks)
        r = int(np.searchsorted(cell0 + cells, w, "right"))
        i = begin[r] + (w - cell0[r]) * index.stride
        part = h[i : min(i + 2 * index.stride, begin[r] + total[r])]
        seen = np.unique(part)
        for item in range(b * BLOCK, min(b * BLOCK + BLOCK, len(index.ids))):
            terms = index.item_terms[item]
            at_term = np.searchsorted(seen, terms)
            at_term[at_term == len(seen)] = 0
            score = index.item_weights[item][seen[at_term] == terms].sum()
            if score < THETA:
                continue
            whole = contained(index.words[item], part)
            q, a = contained(index.question[item], part), contained(index.answer[item], part)
            if whole >= CONTAINED and q >= PART_CONTAINED and a >= PART_CONTAINED:
                found.append((r, item, w - cell0[r], float(score), whole, q, a))
    return found


SCHEMA = "doc_id long, item_id long, window long, score double, contained double, question double, answer double"


def _run(held, pass_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, at = scan.buffers(batch.column(1))
            out = []
            for i, j in scan.slices(at):
                out += [(ids[i + f[0]], index.ids[f[1]], *f[2:]) for f in search(index, data, at[i : j + 1])]
            if out:
                yield pa.RecordBatch.from_pydict(
                    {n: pa.array(v, t) for n, v, t in zip(
                        ["doc_id", "item_id", "window", "score", "contained", "question", "answer"], zip(*out, strict=True),
                        [pa.int64()] * 3 + [pa.float64()] * 4, strict=True)})

    return run


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = scan.buffers(batch.column(1))
        for i, j in scan.slices(at):
            h, row = scan.words(data, at[i : j + 1], scan.NOT_ALNUM, fold=True)
            owner = batch.column(0).slice(i, j - i).take(pa.array(row))
            yield pa.RecordBatch.from_arrays([owner, pa.array(scan.signed(h))], ["item_id", "term"])


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Verified leaks: one row for each document and test item, its best window and overlaps.

    Words are runs of letters and digits, whatever their case; punctuation does not matter.
    Documents or items with a null or empty text, or of null id, match nothing; a document of
    null id cannot be named. Items that repeat an id are joined by the longer text. Items of
    fewer than five words are too short to verify and are not searched. Rows that repeat a doc_id
    give one row per item. Extra columns are not read.
    """
    spark = docs.sparkSession
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where("item_id is not null and text is not null").groupBy("item_id").agg(
        F.max_by("text", F.struct(F.length("text"), F.col("text"))).alias("text"))
    rows = stage(rows, "items")
    terms = stage(rows.mapInArrow(_terms, "item_id long, term long").groupBy("item_id", "term").agg(
        F.count(F.lit(1)).alias("tf")), "terms")
    sizes = terms.groupBy("item_id").agg(F.sum("tf").alias("words")).where(f"words >= {SHINGLE}")
    sizes = stage(sizes, "sizes")
    total = sizes.agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("w")).first()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.where("doc_id is not null")
    out = spark.createDataFrame([], SCHEMA)
    shards = -(-(total["w"] or 0) // SHARD_WORDS)
    df = terms.join(sizes, "item_id", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    for s in range(shards):
        part = sizes.where(F.pmod(F.xxhash64("item_id"), F.lit(shards)) == s)
        some = rows.join(part, "item_id", "left_semi").collect()  # about SHARD_WORDS words
        if not some:
            continue
        near = terms.join(part, "item_id", "left_semi").select("term").distinct().join(df, "term").collect()
        counts = {r["term"] % (1 << 64): r["df"] for r in near}
        index = build([(r["item_id"], r["text"]) for r in some], counts, total["n"], total["w"] / total["n"])
        held = spark.sparkContext.broadcast(index)
        out = out.unionByName(stage(texts.mapInArrow(_run(held, s), SCHEMA), "leaks"))
    best = F.max_by(F.struct("window", "score", "contained", "question", "answer"),
                    F.struct("contained", "score", -F.col("window"))).alias("best")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")
