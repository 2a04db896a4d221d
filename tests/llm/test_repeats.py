"""Repeated passages against a count of all windows; the FM-index against plain search."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from weekloom.llm import fmindex, repeats, wordstream

DOCS = "doc_id long, text string, key string, first int, u int"


def brute_cover(rows, window):
    """For each row which of its words a window covers that stands at two places or more."""
    words = [(t or "").encode().split() for _, t in rows]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((w, gone))
    return out


def brute_digests(rows, window):
    return sorted(((i, len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest())
                   for (i, _), (w, gone) in zip(rows, brute_cover(rows, window), strict=True)), key=str)


def corpus(seed, window):
    r = random.Random(seed)

    def prose(n):
        return [r.choice("abcdefghijklmnop") + str(r.randrange(40)) for _ in range(n)]

    shared = [prose(window + k) for k in (-1, 0, 1, 30)]
    phrase = prose(window // 2)  # common, but no window is
    rows = []
    for i in range(90):
        w = prose(r.randrange(2 * window))
        for part in r.choices([*shared, phrase, phrase, []], k=3):
            at = r.randrange(len(w) + 1)
            w[at:at] = part
        rows.append((i, " ".join(w)))
    twice = prose(window + 5)
    return rows + [
        (90, rows[3][1]), (91, rows[3][1] + " x"), (4, rows[4][1]), (92, None), (93, ""), (94, " \t\n"), (None, " ".join(shared[3])), (None, None),
        (95, " ".join(twice + ["between"] + twice)), (96, "same " * (window + 1)), (97, "other " * window), (98, " ".join(prose(20000))),
        (99, "Case\x0bA\x0cb\rc d\xa0e " * 9), (100, "\x85 ".join(shared[2])), (101, "\n".join(shared[2]))]


@pytest.mark.parametrize("window,gram,hot", [(35, 12, 4096), (35, 12, 2), (8, 3, 5), (5, 5, 4096), (6, 1, 3)])
def test_digests_equal_a_count_of_all_windows(spark, window, gram, hot):
    rows = corpus(window + gram, window)
    df = spark.createDataFrame([(*x, "clash", 1, 2) for x in rows], DOCS)
    got = repeats.kept_digests(df, window, gram=gram, hot=hot, shard_words=3000).collect()
    assert sorted(map(tuple, got), key=str) == brute_digests(rows, window)
    assert sum(x.n_removed for x in got) > 0


def test_passages_and_no_rows(spark):
    rows = corpus(1, 35)
    df = spark.createDataFrame([(*x, "clash", 1, 2) for x in rows], DOCS)
    got = sorted(((x.doc_id, x.first, x.words, x.passage) for x in repeats.repeated_passages(df).collect()), key=str)
    want = []
    for (i, _), (w, gone) in zip(rows, brute_cover(rows, 35), strict=True):
        for lo in sorted(k for k in gone if k - 1 not in gone):
            hi = lo
            while hi in gone:
                hi += 1
            want.append((i, lo, hi - lo, b" ".join(w[lo:hi]).decode()))
    assert got == sorted(want, key=str)
    assert repeats.kept_digests(df.where("false")).count() == 0
    assert repeats.kept_digests(df.where("doc_id = 92")).collect()[0][:3] == (92, 0, 0)


def test_matching_statistics_equal_plain_search():
    r = random.Random(1)
    for _ in range(60):
        k = r.choice([2, 3, 10])
        texts = [[r.randrange(k) * 7 for _ in range(r.randrange(1, 20))] for _ in range(r.randrange(1, 12))]
        copies = [r.choice([1, 2]) for _ in texts]
        index = fmindex.Index(np.array(sum(texts, []), np.uint64), np.array([len(x) for x in texts]), np.array(copies))
        asked = [[r.randrange(k + 1) * 7 for _ in range(r.randrange(20))] for _ in range(5)] + texts
        least = r.choice([1, 2, 3])

        def places(part, texts=texts, copies=copies):
            return sum(c * sum(x[i : i + len(part)] == part for i in range(len(x) - len(part) + 1)) for x, c in zip(texts, copies, strict=True))

        want = []
        for x in asked:
            for i in range(len(x)):
                m = 0
                while i + m < len(x) and places(x[i : i + m + 1]) >= least:
                    m += 1
                want.append(m)
        assert index.matching(np.array(sum(asked, []), np.uint64), np.array([len(x) for x in asked]), least).tolist() == want


def test_wavelet_ranks():
    seq = np.random.default_rng(1).integers(0, 21, 500)
    w = fmindex.Wavelet(seq, 5)
    base = w.follow(np.arange(21), np.zeros(21, np.int64))
    for s in range(21):
        i = np.arange(501)
        assert (w.follow(np.full(501, s), i) - base[s]).tolist() == [0, *np.cumsum(seq == s).tolist()]


def test_equal_windows_have_equal_anchors():
    r = random.Random(2)
    part = [r.randrange(9) for _ in range(60)]
    texts = [[r.randrange(1000) for _ in range(r.randrange(50))] + part + [r.randrange(1000)] for _ in range(20)]
    h, starts = wordstream.hashed([[b"%d" % x for x in t] for t in texts])
    key, seg, first, size = repeats.stretches(h, starts[1:], 20, 6)
    anchor = {}
    for k, a, n in zip(key.tolist(), first.tolist(), size.tolist(), strict=True):
        for i in range(a, a + n - 19):
            assert anchor.setdefault(tuple(h[i : i + 20].tolist()), k) == k
    assert sum(size - 19) == sum(len(t) - 19 for t in texts)
    assert len(set(zip(key.tolist(), seg.tolist(), strict=True))) < len(key)
