"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

A word is the vector of its letter counts, over the whole word and over its first half. An edit
moves either part by at most one letter up and one down: a replaced letter leaves the length, so
its search stays in the tree of that length; an inserted one leads to the tree of the next length
and takes nothing away. A tree's boxes that need more than that are pruned, what is left is
verified letter by letter.

The upper levels of the trees are made of a sample and cut the words into cells of some thousand
words. Every word goes to its own cell, and to each cell that its two searches reach; a task then
builds the lower levels for one cell at a time and streams the searches past it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.staging import stage

MIN_LETTERS, MIN_COUNT, FACTOR = 7, 2, 10
CELL_WORDS, LEAF_WORDS = 4096, 24
#: One word in so many is sampled for the upper levels: 16 a cell.
SAMPLE = CELL_WORDS // 16
HELD_WORDS = 200_000
PAIRS_AT_ONCE = 1 << 20
#: The given words' letters: a to z, then U+00C0 to U+00FF, and one dimension for all others.
LETTERS = 26 + 64 + 1
WHOLE = np.uint64(0xFFFFFFFF)
RUN = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_LETTERS)


def _letters(low: str, doc_id: int | None, planted: bool) -> str:
    if planted and doc_id is not None:
        h = zlib.crc32(f"{doc_id}:{low}".encode())
        if h % 31 == 0:
            i = h % len(low)
            return low[:i] + low[i + 1 :]
    return low


def _count(planted: bool):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return out

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, raw in zip(ids, batch.column(1).cast(pa.large_string()).cast(pa.large_binary()), strict=True):
                if not raw.is_valid:
                    continue
                # bytes.lower changes A-Z alone
                for low, n in Counter(RUN.findall(raw.as_py().lower().decode())).items():
                    total[_letters(low, i, planted)] += n
                if len(total) >= HELD_WORDS:
                    yield rows()
        if total:
            yield rows()

    return count


def count_words(docs: DataFrame, planted: bool = False) -> DataFrame:
    """``(word, n)``: runs of Latin letters, A-Z as a-z, of 7 letters or more and at least two occurrences.

    ``planted`` drops one letter of every 31st pair of document and run, not in rows of null
    doc_id. Null texts hold no words; rows that repeat a doc_id all count; extra columns are
    not read. A task holds 200,000 different words at a time.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(_count(planted), "word string, n long").where(F.length("word") >= MIN_LETTERS)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def code_points(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def vectors(codes: np.ndarray) -> np.ndarray:
    """Letter counts (up to 127) of whole words, then of their first halves."""
    n, length = codes.shape
    at = np.full(codes.shape, LETTERS - 1, np.int64)
    small, wide = (codes >= 97) & (codes <= 122), (codes >= 0xC0) & (codes <= 0xFF)
    at[small] = codes[small] - 97
    at[wide] = codes[wide] - 0xC0 + 26
    out = np.zeros((n, 2 * LETTERS), np.uint8)
    for part, end in ((0, length), (LETTERS, length // 2)):
        place = np.arange(n)[:, None] * (2 * LETTERS) + part + at[:, :end]
        flat = np.bincount(place.ravel(), minlength=out.size) if end else np.zeros(out.size, np.int64)
        out += np.minimum(flat, 127).astype(np.uint8).reshape(out.shape)
    return out


def parities(codes: np.ndarray) -> np.ndarray:
    """Odd or even, for 32 groups of letters over the whole word, then over its first half: an edit flips at most two bits of either."""
    bit = np.uint64(1) << (codes.astype(np.uint64) & np.uint64(31))
    half = np.bitwise_xor.reduce(bit[:, : codes.shape[1] // 2], axis=1)
    return np.bitwise_xor.reduce(bit, axis=1) | (half << np.uint64(32))


class Tree:
    """Splits by one count at a time, each as even as any; a leaf holds ``leaf`` rows, or rows all alike."""

    def __init__(self, rows: np.ndarray, leaf: int):
        self.nodes: list[tuple[int, int, int, int]] = []  # dimension, most on the left, left, right; or -1 and leaf
        self.leaves: list[np.ndarray] = []
        self.root = self._grow(rows, np.arange(len(rows)), leaf)

    def _grow(self, rows: np.ndarray, own: np.ndarray, leaf: int) -> int:
        me = len(self.nodes)
        self.nodes.append((-1, len(self.leaves), 0, 0))
        best = (0, 0, 0)
        if len(own) > leaf:
            part = rows[own]
            for t in range(int(part.max())):
                more = np.count_nonzero(part > t, axis=0)
                even = np.minimum(more, len(own) - more)
                d = int(even.argmax())
                if even[d] > best[0]:
                    best = (int(even[d]), d, t)
                if more.max() <= best[0]:
                    break
        if not best[0]:
            self.leaves.append(own)
            return me
        _, d, t = best
        left = rows[own, d] <= t
        a = self._grow(rows, own[left], leaf)
        b = self._grow(rows, own[~left], leaf)
        self.nodes[me] = (d, t, a, b)
        return me

    def home(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of every row."""
        out = np.zeros(len(rows), np.int64)
        todo = [(self.root, np.arange(len(rows)))]
        while todo:
            node, own = todo.pop()
            d, t, a, b = self.nodes[node]
            if d < 0:
                out[own] = t
            elif len(own):
                left = rows[own, d] <= t
                todo += [(a, own[left]), (b, own[~left])]
        return out

    def reached(self, rows: np.ndarray, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """``(leaf, rows)``: boxes at most one letter up and ``down`` letters down from a row, in its halves one up and one down."""
        zero = np.zeros(len(rows), np.int16)
        limits = np.array([1, down, 1, 1])
        todo = [(self.root, np.arange(len(rows)), np.stack([zero] * 4), {}, {})]
        while todo:
            node, own, need, lo, hi = todo.pop()
            if not len(own):
                continue
            d, t, a, b = self.nodes[node]
            if d < 0:
                yield t, own
                continue
            c = rows[own, d].astype(np.int16)
            part = 0 if d < LETTERS else 2
            for child, which, was, now in ((b, part, lo, t + 1), (a, part + 1, hi, t)):
                sign = 1 if was is lo else -1
                more = np.maximum(sign * (now - c), 0)
                if d in was:
                    more = more - np.maximum(sign * (was[d] - c), 0)
                level = need[which] + more
                go = level <= limits[which]
                held = need[:, go]
                held[which] = level[go]
                todo.append((child, own[go], held, {**lo, d: now} if was is lo else lo, {**hi, d: now} if was is hi else hi))


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of code points ``a`` are one edit from those of ``b``, as long or one longer."""
    n = a.shape[-1]
    if b.shape[-1] == n:
        return np.count_nonzero(a != b, axis=-1) == 1
    front = np.logical_and.accumulate(a == b[..., :n], axis=-1).sum(-1)
    back = np.logical_and.accumulate((a == b[..., 1:])[..., ::-1], axis=-1).sum(-1)
    return front + back >= n


def _pairs(tree: Tree, homes: np.ndarray, asked: np.ndarray, down: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers in ``asked`` and ``homes`` of all pairs one edit apart.

    Within a leaf the L1 distance is bounded by the parities that differ, before letters are compared.
    """
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    odd, asked_odd = parities(homes), parities(asked)
    for leaf, rows in tree.reached(vectors(asked), down):
        held = tree.leaves[leaf]
        step = max(1, PAIRS_AT_ONCE // len(held))
        for i in range(0, len(rows), step):
            some = rows[i : i + step]
            flips = asked_odd[some][:, None] ^ odd[held][None]
            near = (np.bitwise_count(flips & WHOLE) <= 2) & (np.bitwise_count(flips & ~WHOLE) <= 2)
            x, y = np.nonzero(near)
            for j in range(0, len(x), PAIRS_AT_ONCE // homes.shape[1] + 1):
                a, b = some[x[j : j + PAIRS_AT_ONCE // homes.shape[1] + 1]], held[y[j : j + PAIRS_AT_ONCE // homes.shape[1] + 1]]
                yes = one_edit(asked[a], homes[b])
                left.append(a[yes])
                right.append(b[yes])
    return np.concatenate(left), np.concatenate(right)


class Cells:
    """The upper levels: a tree of sampled words for each length; unseen lengths are one cell each."""

    def __init__(self, sample: list[str], cell_words: int):
        by: dict[int, list[str]] = {}
        for w in sorted(sample):
            by.setdefault(len(w), []).append(w)
        leaf = max(1, cell_words // SAMPLE)
        self.trees = {n: Tree(vectors(code_points(w)), leaf) for n, w in by.items()}
        for tree in self.trees.values():
            tree.leaves = []

    def route(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        """``(length of the cell, its leaf, place in words, role)``: 0 home, 1 as long, 2 one longer."""
        lengths = np.array([len(w) for w in words])
        for n in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == n)
            rows = vectors(code_points([words[i] for i in at.tolist()]))
            for role, length in ((0, n), (1, n), (2, n + 1)):
                tree = self.trees.get(length)
                if tree is None:
                    yield np.full(len(at), length), np.zeros(len(at), np.int64), at, role
                elif role == 0:
                    yield np.full(len(at), length), tree.home(rows), at, role
                else:
                    for leaf, own in tree.reached(rows, 2 - role):
                        yield np.full(len(own), length), np.full(len(own), leaf), at[own], role


def _route(cells: Cells):
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0)
            for length, leaf, at, role in cells.route(words.to_pylist()):
                for i in range(0, len(at), 10_000):
                    some = pa.array(at[i : i + 10_000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(length[i : i + 10_000].astype(np.int32)), pa.array(leaf[i : i + 10_000].astype(np.int32)),
                         pa.array(np.full(len(some), role, np.int32)), words.take(some), batch.column(1).take(some)],
                        ["length", "leaf", "role", "word", "n"])

    return route


NEAR = "word string, n_near long, near string, near_n long"


class _Side:
    """Words of one length, the preferred ones first: larger n, then smaller in code-point order."""

    def __init__(self, words: list[str], counts: list[int]):
        order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
        self.words, self.counts = [words[i] for i in order], [counts[i] for i in order]
        self.codes = code_points(self.words)


def _best(of: _Side, mine: np.ndarray, among: _Side, theirs: np.ndarray) -> pa.RecordBatch:
    """One row for each word of ``of`` with partners: how many, and the preferred one."""
    order = np.lexsort((theirs, mine))
    mine, theirs = mine[order], theirs[order]
    first = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
    count = np.diff(np.append(first, len(mine)))
    return pa.RecordBatch.from_arrays(
        [pa.array([of.words[i] for i in mine[first].tolist()], pa.string()), pa.array(count, pa.int64()),
         pa.array([among.words[i] for i in theirs[first].tolist()], pa.string()),
         pa.array([among.counts[i] for i in theirs[first].tolist()], pa.int64())], ["word", "n_near", "near", "near_n"])


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell and role: the cell's words first, then the searches that reach it."""
    cell, words, counts, home, tree = None, [], [], None, None
    for batch in batches:
        key = np.stack([batch.column(k).to_numpy() for k in range(3)], 1)
        first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(1))) if len(key) else []
        for i, j in zip(first, [*first[1:], len(key)], strict=True):
            length, leaf, role = key[i].tolist()
            some, n = batch.column(3)[i:j].to_pylist(), batch.column(4)[i:j].to_pylist()
            if (length, leaf) != cell:
                cell, words, counts, home = (length, leaf), [], [], None
            if role == 0:
                words += some
                counts += n
                continue
            if not words:
                continue
            if home is None:
                home = _Side(words, counts)
                tree = Tree(vectors(home.codes), LEAF_WORDS)
            asked = _Side(some, n)
            left, right = _pairs(tree, home.codes, asked.codes, 2 - role)
            if len(left):
                yield _best(asked, left, home, right)
                if role == 2:
                    yield _best(home, right, asked, left)


def near_words(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """``(word, n_near, near, near_n)`` for words that have any: how many are one edit away, and the preferred one."""
    row = words.agg(F.count(F.lit(1)).alias("n")).first()
    rate = SAMPLE if row["n"] > cell_words else 1
    sample = [r["word"] for r in words.where(F.pmod(F.xxhash64("word"), F.lit(rate)) == 0).select("word").collect()] if rate > 1 else []
    routed = words.mapInArrow(_route(Cells(sample, cell_words)), "length int, leaf int, role int, word string, n long")
    cells = routed.repartition("length", "leaf").sortWithinPartitions("length", "leaf", "role")
    best = F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), F.col("near"))).alias("best")
    return cells.mapInArrow(_match, NEAR).groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", "best.*")


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for ``(word, form)``: the end of every chain, which no cycle can be as counts grow."""
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = stage(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        if now.where("next is not null").limit(1).count() == 0:
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_groups(words: DataFrame, factor: int = FACTOR, cell_words: int = CELL_WORDS) -> DataFrame:
    """Every word of ``(word, n)`` with its near words' number, its form and its root.

    Near words differ by one inserted, deleted or replaced code point. The form is the near word
    of largest n (ties: smallest in code-point order) if that is at least ``factor`` (over 1)
    times the word's own n. ``root`` follows forms to the last; a word without a form is its own.
    Null and empty words and null counts take no part; of rows that repeat a word the counts are
    added. An empty table gives no rows; extra columns are not read. The driver sees one word in
    256, for the upper levels of the trees; words alike in both vectors share a leaf and are
    compared in full.
    """
    if factor <= 1:
        raise ValueError("a form must be more frequent than its variants")
    words = words.select(F.col("word").cast("string").alias("word"), F.col("n").cast("long").alias("n"))
    words = stage(words.where("word != '' and n is not null").groupBy("word").agg(F.sum("n").alias("n")), "words")
    near = words.join(near_words(words, cell_words), "word", "left")
    has = F.col("near_n") >= factor * F.col("n")
    formed = stage(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("near")).alias("form"),
                               F.when(has, F.col("near_n")).alias("form_n")), "forms")
    roots = _roots(formed.where("form is not null").select("word", "form"))
    return formed.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
