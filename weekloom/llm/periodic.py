"""Periodic runs of words by recompression.

The words of a slice of documents become a run-length grammar: blocks of equal symbols, then
pairs of a left and a right symbol, in turn, until little is left. A symbol stands for the same
words wherever it occurs, so two places are compared by climbing while symbols agree and by
descending to the first difference: an extension costs a few steps a level, not a step a word.

A run of period ``q`` and at least ``m`` periods holds ``m`` neighbours of the grid 0, q, 2q, ..;
their words agree. For every ``q`` the chains of equal grid words are candidates (a harmonic sum
over all ``q``), and extensions to both sides give their exact ends. There are no suffix arrays.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm import wordstream
from weekloom.llm.scan import mix

MIN_WORDS, MIN_PERIODS = 24, 3
LEVELS = 400


class Grammar:
    """Levels of a recompressed sequence; level 0 is the sequence between two symbols of its own.

    ``symbols[l]`` are a level's symbols, ``parent[l]`` the node above each, ``first[l]`` the first
    node below each (one entry more than nodes), ``width`` the words of a symbol. ``rules`` has
    for a symbol its pair, or its symbol and count.
    """

    def __init__(self, seq: np.ndarray, enough: int = 2):
        n = int(seq.max()) + 1 if len(seq) else 0
        s = np.concatenate([[n], seq, [n + 1]])
        self.symbols, self.parent, self.first, self.blocks = [s], [], [None], []
        self.rules: list[tuple[int, np.ndarray, np.ndarray]] = []
        widths, made = [np.ones(n + 2, np.int64)], n + 2
        level = 0
        while len(s) > enough and level < LEVELS:
            block = level % 2 == 0
            opens = np.ones(len(s), bool)
            if block:
                opens[1:] = s[1:] != s[:-1]
            else:
                right = (mix(s.astype(np.uint64) + np.uint64(level << 40)) & np.uint64(1)).astype(bool)
                opens[1:] = ~(right[1:] & ~right[:-1])
            first = np.flatnonzero(opens)
            count = np.diff(np.append(first, len(s)))
            above = s[first]
            many = np.flatnonzero(count > 1)
            if len(many):
                other = count[many] if block else s[first[many] + 1]
                stride = int(other.max()) + 1
                rule, name = np.unique(above[many] * stride + other, return_inverse=True)
                left, second = rule // stride, rule % stride
                width = np.concatenate(widths) if len(widths) > 1 else widths[0]
                widths = [width, width[left] * second if block else width[left] + width[second]]
                self.rules.append((made, left, second))
                above[many] = made + name
                made += len(rule)
            self.parent.append(np.cumsum(opens) - 1)
            self.first.append(np.append(first, len(s)))
            self.blocks.append(block)
            self.symbols.append(above)
            s = above
            level += 1
        self.width = np.concatenate(widths)

    def extension(self, a: np.ndarray, b: np.ndarray, to: int) -> np.ndarray:
        """How many words agree from places ``a`` and ``b`` (of the sequence) on; ``to``: 1 right, -1 left."""
        a, b = a + 1, b + 1
        total = np.zeros(len(a), np.int64)
        stopped = np.full(len(a), -1, np.int64)
        top = len(self.symbols) - 1
        live = np.arange(len(a))
        for level in range(top + 1):
            live = self._climb(level, live, a, b, total, stopped, to, level == top)
            if not len(live):
                break
        for level in range(int(stopped.max(initial=0)), 0, -1):
            live = np.flatnonzero(stopped >= level)
            below = self.first[level]
            for x in (a, b):
                x[live] = below[x[live]] if to > 0 else below[x[live] + 1] - 1
            self._agree(level - 1, live, a, b, total, to)
        return total

    def _rest(self, level: int, x: np.ndarray, to: int) -> np.ndarray:
        """Nodes from ``x`` to the end of its block, itself included."""
        up = self.parent[level][x]
        return self.first[level + 1][up + 1] - x if to > 0 else x - self.first[level + 1][up] + 1

    def _step(self, level: int, i: np.ndarray, a, b, total, to: int) -> None:
        x, y = a[i], b[i]
        n = np.ones(len(i), np.int64)
        if level < len(self.blocks) and self.blocks[level]:
            n = np.minimum(self._rest(level, x, to), self._rest(level, y, to))
        total[i] += n * self.width[self.symbols[level][x]]
        a[i] += to * n
        b[i] += to * n

    def _agree(self, level: int, live: np.ndarray, a, b, total, to: int) -> None:
        s = self.symbols[level]
        while len(live):
            live = live[s[a[live]] == s[b[live]]]
            self._step(level, live, a, b, total, to)

    def _climb(self, level: int, live, a, b, total, stopped, to: int, last: bool) -> np.ndarray:
        s, rising = self.symbols[level], []
        while len(live):
            same = s[a[live]] == s[b[live]]
            stopped[live[~same]] = level
            live = live[same]
            if not last:
                up, below = self.parent[level], self.first[level + 1]
                at_edge = np.ones(len(live), bool)
                for x in (a, b):
                    at_edge &= (below[up[x[live]]] if to > 0 else below[up[x[live]] + 1] - 1) == x[live]
                rising.append(live[at_edge])
                live = live[~at_edge]
            self._step(level, live, a, b, total, to)
        rising = np.concatenate(rising) if rising else live
        if len(rising):
            a[rising], b[rising] = self.parent[level][a[rising]], self.parent[level][b[rising]]
        return rising


def _chains(seq: np.ndarray, q: int, need: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last grid place of every stretch of at least ``need`` equal steps of ``q``."""
    grid = seq[::q]
    same = grid[1:] == grid[:-1]
    held = same[need - 1 :].copy()
    for j in range(need - 1):
        held &= same[j : len(same) - need + 1 + j]
    at = np.flatnonzero(held)
    if not len(at):
        return at, at
    new = np.append(True, np.diff(at) > 1)
    ends = np.append(np.flatnonzero(new)[1:], len(at)) - 1
    return at[new] * q, at[ends] * q


def runs(seq: np.ndarray, longest: int, min_words: int = MIN_WORDS, periods: int = MIN_PERIODS, texts: int = 1) -> np.ndarray:
    """``(start, length, period)`` of every run, by start and period.

    ``longest``: words of the longest text in ``seq``; no number stands in two texts, so that no
    run does. ``periods`` is at least 2.
    """
    found = [np.zeros((0, 3), np.int64)]
    if longest < min_words:
        return found[0]
    grammar = Grammar(seq, 2 * texts)
    cover_end, cover_period = np.zeros(len(seq) + 1, np.int64), np.ones(len(seq) + 1, np.int64)
    low = 1
    while low * periods <= longest:
        opens, lasts, qs, needs = [], [], [], []
        for q in range(low, min(2 * low, longest // periods + 1)):
            need = max(periods, min_words // q) - 1
            x, last = _chains(seq, q, need)
            if len(x):
                opens.append(x)
                lasts.append(last)
                qs.append(np.full(len(x), q))
                needs.append(np.full(len(x), need))
        low *= 2
        if not opens:
            continue
        x, last, q, need = (np.concatenate(v) for v in (opens, lasts, qs, needs))
        # within a known run its period's multiples tell nothing new
        fresh = (cover_end[x] <= last + need * q) | (q % cover_period[x] != 0)
        x, last, q = x[fresh], last[fresh], q[fresh]
        while len(x):
            right = grammar.extension(x, x + q, 1)
            left = grammar.extension(x - 1, x + q - 1, -1)
            start, end = x - left, x + q + right
            long = end - start >= np.maximum(min_words, periods * q)
            found.append(np.stack([start, end - start, q], 1)[long])
            for s, e, p in zip(start[long].tolist(), end[long].tolist(), q[long].tolist(), strict=True):
                newer = cover_end[s:e] < e
                cover_end[s:e][newer] = e
                cover_period[s:e][newer] = p
            # the next grid place whose pair lies beyond
            x = x + -(-(end - q + 1 - x) // q) * q
            more = x <= last
            x, last, q = x[more], last[more], q[more]
    every = np.unique(np.concatenate(found), axis=0)  # by start, length, period: the smallest period first
    if len(every):
        every = every[np.append(True, (every[1:, :2] != every[:-1, :2]).any(1))]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def repeat_tail(doc_id: int | None, held: list[bytes]) -> list[bytes]:
    """The contract's planted tail: of ids whose crc32 ends in 0, the words from a place on repeat a period."""
    if doc_id is None or not held:
        return held
    h, n = zlib.crc32(str(doc_id).encode()), len(held)
    if h % 10:
        return held
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = held[a : a + p]
    return held[:a] + (unit * (-(-(n - a) // p)))[: n - a]


def _documents(batches: Iterator[pa.RecordBatch], planted: bool, min_words: int, periods: int):
    """``(doc_id, words, runs)`` of every row of ``(doc_id, text)``."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for at, texts in wordstream.slices(batch.column(1)):
            held = [wordstream.words(t) for t in texts]
            if planted:
                held = [repeat_tail(ids[at + k], w) for k, w in enumerate(held)]
            seq, starts = wordstream.numbered(held)
            every = runs(seq, max(map(len, held)), min_words, periods, len(held))
            bounds = np.searchsorted(every[:, 0], starts)
            for k, w in enumerate(held):
                own = every[bounds[k] : bounds[k + 1]].copy()
                own[:, 0] -= starts[k]
                yield ids[at + k], w, own


def kept(held: list[bytes], own: np.ndarray) -> list[bytes]:
    """The words that no run holds beyond its first period."""
    if not len(own):
        return held
    keep = np.ones(len(held), bool)
    for start, length, period in own.tolist():
        keep[start + period : start + length] = False
    return [held[i] for i in np.flatnonzero(keep).tolist()]


def _best(own: np.ndarray) -> tuple | None:
    rows = own.tolist()
    return min(rows, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if rows else None


RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
DIGESTS = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
           "runs_sha256 string, collapsed_sha256 string")
ROWS = 500


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, periods: int = MIN_PERIODS) -> DataFrame:
    """Every row with its runs and its text without their repetitions.

    A run is a stretch of words of smallest period q, at least ``min_words`` words and
    ``periods`` (2 or more) periods long, that cannot be extended. ``collapsed`` has the words
    that no run holds after its first q words, joined by one blank. A null or empty text has no
    words and no runs, a null doc_id stays null, rows that repeat a doc_id are rows of their own,
    an empty table gives none; extra columns are not read. Nothing is shuffled: a text is
    handled whole in its task, about 200 bytes of memory a word.
    """
    if periods < 2 or min_words < 2:
        raise ValueError("a run has at least two periods and two words")
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(pa.struct(
        [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(({"doc_id": i, "n_words": len(w), "collapsed": b" ".join(kept(w, own)).decode(),
                          "runs": [dict(zip(("start", "length", "period"), r, strict=True)) for r in own.tolist()]}
                         for i, w, own in _documents(batches, False, min_words, periods)), schema)

    return _texts(docs).mapInArrow(find, RUNS)


def run_digests(docs: DataFrame, planted: bool = False) -> DataFrame:
    """Number of runs, the run of most periods, and digests of all runs and of the collapsed text.

    ``planted`` repeats the tail of every tenth id (``repeat_tail``), not of rows without an id.
    Odd rows are as in ``periodic_runs``; without a run the four figures of the run are null.
    """
    schema = pa.schema([(f.split()[0], pa.string() if "string" in f else pa.int64()) for f in DIGESTS.split(", ")])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for i, w, own in _documents(batches, planted, MIN_WORDS, MIN_PERIODS):
                best = _best(own)
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in own.tolist())
                yield {"doc_id": i, "n_runs": len(own),
                       **(dict(zip(("start", "length", "period"), best, strict=True)) if best else {}),
                       "exponent_milli": 1000 * best[1] // best[2] if best else None,
                       "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(),
                       "collapsed_sha256": hashlib.sha256(b" ".join(kept(w, own))).hexdigest()}

        return _batches(rows(), schema)

    return _texts(docs).mapInArrow(digest, DIGESTS)
