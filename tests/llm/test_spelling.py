"""Spelling groups against all pairs: near words, forms and roots, odd rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from weekloom.llm import spelling

DOCS = "doc_id long, text string, word string, n int"


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(n, factor=10):
    partners = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, found in partners.items():
        if found:
            v = min(found, key=lambda v: (-n[v], v))
            if n[v] >= factor * n[w]:
                form[w] = v
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, n[w], len(partners[w]), form.get(w), n[form[w]] if w in form else None, root))
    return sorted(out)


def groups(words, **more):
    rows = spelling.spelling_groups(words, **more).collect()
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in rows)


@pytest.mark.parametrize("letters", ["ab", "abc", "abcdeéß漢"])
def test_groups_equal_all_pairs(spark, letters):
    r = random.Random(len(letters))
    words = {"".join(r.choice(letters) for _ in range(r.randrange(1, 10))) for _ in range(700)}
    n = {w: int(10 ** r.uniform(0, 4)) for w in words}
    df = spark.createDataFrame([(w, k, "x") for w, k in n.items()], "word string, n long, near string")
    # many small cells: the sampled upper levels take part
    assert groups(df, cell_words=32) == groups(df) == brute_groups(n)
    assert groups(df, factor=3) == brute_groups(n, 3)


def test_long_chains_of_forms(spark):
    n = {"a" * k: 10**k for k in range(1, 9)}
    got = groups(spark.createDataFrame(list(n.items()), "word string, n long"))
    assert {r[5] for r in got} == {"a" * 8} and got == brute_groups(n)


def test_boxes_bound_edits():
    r = random.Random(7)
    words = sorted({"".join(r.choice("abcd") for _ in range(9)) for _ in range(600)})
    codes = spelling.code_points(words)
    rows = spelling.vectors(codes)
    assert rows[:, : spelling.LETTERS].sum(1).tolist() == [9] * len(words)
    tree = spelling.Tree(rows, 8)
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(len(words)))
    assert all(len(x) <= 8 or (rows[x] == rows[x[0]]).all() for x in tree.leaves)
    home = tree.home(rows)
    assert all(home[i] == k for k, x in enumerate(tree.leaves) for i in x)
    seen = [set() for _ in words]
    for leaf, own in tree.reached(rows, 1):
        for i in own.tolist():
            seen[i] |= set(tree.leaves[leaf].tolist())
    assert all(j in seen[i] for i, a in enumerate(words) for j, b in enumerate(words) if near(a, b))
    assert sum(map(len, seen)) < 0.5 * len(words) ** 2  # and most are pruned


def test_words_of_documents(spark):
    r = random.Random(3)
    vocabulary = ["wanderer", "Wanderer", "wanderers", "wandérer", "ÀLPHABET", "àlphabet", "shorter", "maßstäbe", "a×bcdefg", "tiny", "漢字漢字漢字漢字"]
    rows = [(i, " ".join(r.choices(vocabulary, k=60)) + "!") for i in range(120)]
    rows += [(120, None), (121, ""), (None, "wanderer wanderes-wanderes"), (5, rows[5][1]), (122, "q" * 30000 + " " + "q" * 30000), (123, "ſhorterſ onceonly")]
    want = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{low}".encode())
            if i is not None and h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            want[low] += 1
    want = {w: k for w, k in want.items() if len(w) >= 7 and k >= 2}
    df = spark.createDataFrame([(*x, "clash", 1) for x in rows], DOCS)
    counted = spelling.count_words(df, planted=True)
    assert {x.word: x.n for x in counted.collect()} == want and "q" * 30000 in want
    assert groups(counted) == brute_groups(want)
    assert spelling.spelling_groups(spelling.count_words(df.where("false"))).count() == 0


def test_odd_rows_of_words(spark):
    rows = [("river", 3), ("river", 4), ("rivers", 100), (None, 5), ("", 7), ("lone", None), ("x", 1), ("y", 1)]
    assert groups(spark.createDataFrame(rows, "word string, n long")) == brute_groups({"river": 7, "rivers": 100, "x": 1, "y": 1})
    with pytest.raises(ValueError):
        spelling.spelling_groups(spark.createDataFrame(rows, "word string, n long"), factor=1)
