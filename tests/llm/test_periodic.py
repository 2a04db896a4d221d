"""Runs of words: against a scan of every period, and the query's digests against the same."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from weekloom.llm import periodic, wordstream

DOCS = "doc_id long, text string, start int, length string"


def brute_runs(w, min_words=24, periods=3):
    """Every stretch whose words agree at distance q, for all q, with its smallest q."""
    found = {}
    for q in range(1, len(w) // periods + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > s and i + q - s >= max(min_words, periods * q):
                found.setdefault((s, i + q), q)
            i += 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def some_text(r, size, letters):
    w = []
    while len(w) < size:
        unit = [r.randrange(letters) for _ in range(r.randrange(1, 12))]
        w += unit * r.choice([1, 1, 2, 3, 5, 9]) + unit[: r.randrange(len(unit) + 1)]
    return [b"%d" % x for x in w]


@pytest.mark.parametrize("min_words,periods", [(24, 3), (6, 3), (4, 2), (10, 4)])
def test_runs_equal_a_scan_of_all_periods(min_words, periods):
    r = random.Random(min_words)
    for _ in range(60):
        texts = [some_text(r, r.choice([0, 10, 60, 250]), r.choice([1, 2, 3, 20])) for _ in range(r.randrange(1, 5))]
        seq, starts = wordstream.numbered(texts)
        got = periodic.runs(seq, max(map(len, texts)), min_words, periods, len(texts)).tolist()
        want = [[s + starts[k], n, q] for k, w in enumerate(texts) for s, n, q in brute_runs(w, min_words, periods)]
        assert got == sorted(want, key=lambda x: (x[0], x[2]))


def test_grammar_rules_spell_the_sequence_and_extensions_are_exact():
    r = random.Random(2)
    seq = np.array([int(x) for x in some_text(r, 700, 3)])
    g = periodic.Grammar(seq)
    below = {int(made) + k: (int(x), int(y)) for made, left, second in g.rules for k, (x, y) in enumerate(zip(left, second, strict=True))}
    blocks = set()
    for level, block in enumerate(g.blocks):
        if block:
            blocks |= set(g.symbols[level + 1].tolist()) - set(g.symbols[level].tolist())

    def spell(s):
        if s not in below:
            return [s]
        x, y = below[s]
        return spell(x) * y if s in blocks else spell(x) + spell(y)

    n = int(seq.max()) + 1
    assert len(g.symbols[-1]) <= 2
    for level in (3, 8, len(g.symbols) - 1):
        assert [x for s in g.symbols[level].tolist() for x in spell(s)] == [n, *seq.tolist(), n + 1]
        assert all(g.width[s] == len(spell(s)) for s in set(g.symbols[level].tolist()))
    a, b = np.array([r.randrange(len(seq)) for _ in range(400)]), np.array([r.randrange(len(seq)) for _ in range(400)])
    a, b = a[a != b], b[a != b]
    for to in (1, -1):
        for x, y, got in zip(a, b, g.extension(a.copy(), b.copy(), to), strict=True):
            k = 0
            while 0 <= x + to * k < len(seq) and 0 <= y + to * k < len(seq) and seq[x + to * k] == seq[y + to * k]:
                k += 1
            assert got == k


def test_digests_of_odd_rows(spark):
    r = random.Random(9)
    rows = [(i, b" ".join(some_text(r, r.choice([5, 40, 300]), r.choice([2, 30]))).decode()) for i in range(60)]
    rows += [(60, None), (61, ""), (62, " \t\n"), (None, "a b " * 30), (5, rows[5][1]), (63, "x y\tz " * 3000), (64, " ".join(map(str, range(30000)))),
             (65, "only " * 24), (66, "only " * 23)]
    df = spark.createDataFrame([(*x, 1, "y") for x in rows], DOCS)
    got = periodic.run_digests(df, planted=True).collect()
    want = []
    for i, t in rows:
        w = (t or "").encode().split()
        h, n = zlib.crc32(str(i).encode()), len(w)
        if i is not None and h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        own = brute_runs(w) if n < 20000 else ([] if i == 64 else None)
        gone = {k for s, m, q in own for k in range(s + q, s + m)}
        best = min(own, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if own else (None,) * 3
        want.append((i, len(own), *best, 1000 * best[1] // best[2] if own else None,
                     hashlib.sha256("".join("%d,%d,%d\n" % x for x in own).encode()).hexdigest(),
                     hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(x[1] > 0 for x in want) > 10
    assert periodic.run_digests(df.where("false")).count() == 0


def test_collapsed_text(spark):
    df = spark.createDataFrame([(1, "go " + "one two three " * 9 + "end", 0, ""), (2, "x " * 30, 0, ""), (3, None, 0, "")], DOCS)
    got = {x.doc_id: x for x in periodic.periodic_runs(df).collect()}
    assert got[1].collapsed == "go one two three end" and got[2].collapsed == "x" and got[3].collapsed == ""
    assert [tuple(x) for x in got[1].runs] == [(1, 27, 3)] and got[2].n_words == 30
