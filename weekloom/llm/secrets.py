"""Secret scans: fixed patterns, and passwords found by what they would cost to guess.

The value behind a credential word is cut into words, dates, repeats, keyboard walks and
brute-force spans so that the product of their guesses is smallest (dynamic programming over the
ends of the spans). A value that is expensive even then is a secret. Words are ranked by how
often all documents hold them.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.staging import stage


# Fixed patterns and kinds, in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_VALUE = 12
CONTEXT = re.compile(
    r"""(?:password|passwd|passphrase|passcode|pwd|secret|token|credential|api_?key|access_?key|private_?key)"""
    r"""["']?[\x20\t]*(?::=|=>|[:=]|\bis\b)[\x20\t]*["'`]?([^\s"'`<>]{6,})""", re.ASCII | re.IGNORECASE)
CONTEXT_WORDS = ("pass", "pwd", "secret", "token", "credential", "api", "access", "private")
# Rows of a common keyboard, and the alphabet and digits as rows of their own.
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz", "0123456789")

DICTIONARY_WORDS = 20_000
LONGEST_WORD = 32
COSTLY = 10.0
SPAN_COST = math.log10(2)
#: Repeats are of units of up to so many characters.
REPEAT_UNIT = 8
BRUTE = {"digit": 1.0, "letter": math.log10(26), "other": math.log10(33), "wide": 4.0}
PLACE = {c: [(r, row.index(c)) for r, row in enumerate(ROWS) if c in row] for c in set("".join(ROWS))}
PLAIN = str.maketrans("@4301!5$7", "aaeoiisst")


def _brute(c: str) -> float:
    if c.isdigit():
        return BRUTE["digit"]
    if c.isascii():
        return BRUTE["letter"] if c.isalpha() else BRUTE["other"]
    return BRUTE["wide"]


def _case_cost(s: str) -> float:
    """Extra guesses for capitals: none, the first, all, or any others."""
    big = sum(c.isupper() for c in s)
    if not big:
        return 0.0
    if s[0].isupper() and big == 1 or big == len(s):
        return math.log10(2)
    return math.log10(math.comb(len(s), min(big, len(s) - big)) + 1)


def _date(s: str) -> bool:
    """Day, month and year in digits, with or without separators."""
    m = re.fullmatch(r"(\d{1,4})([-/._]?)(\d{1,2})\2(\d{1,4})", s)
    if not m:
        return bool(re.fullmatch(r"(19|20)\d\d", s))
    for y, mo, d in ((m[1], m[3], m[4]), (m[4], m[3], m[1]), (m[4], m[1], m[3])):
        if len(y) in (2, 4) and 1 <= int(mo) <= 12 and 1 <= int(d) <= 31 and (len(y) == 2 or 1900 <= int(y) <= 2099):
            return True
    return False


def guess_cost(value: str, ranks: dict[str, int]) -> float:
    """log10 of the guesses for the cheapest way to cut ``value`` into spans; 0 for an empty one."""
    n = len(value)
    low = value.lower() if len(value.lower()) == n else value
    plain = low.translate(PLAIN)
    best = [0.0] + [math.inf] * n

    def offer(i: int, j: int, cost: float) -> None:
        best[j] = min(best[j], best[i] + cost + SPAN_COST)

    # by unit length and place in the unit: the starts within the run of equal units that ends here
    starts: list[list[list[int]]] = [[[] for _ in range(unit)] for unit in range(REPEAT_UNIT + 1)]
    def offer_repeats(unit: int, j: int) -> None:
        """Two and more equal units that end at ``j``; starts that can win no more are not kept."""
        first, place = j - unit, starts[unit][j % unit]
        if first < unit or value[first - unit : first] != value[first:j]:
            place[:] = [first]
            return
        piece = value[first:j]
        cost = sum(map(_brute, piece))
        if rank := ranks.get(low[first:j]):
            cost = min(cost, math.log10(rank + 1))
        for i in place:
            offer(i, j, cost + math.log10((j - i) // unit))
        # twice or more from ``first`` never beats the longer run from ``i``, now or later
        if all(best[first] < best[i] + math.log10(((first - i) // unit + 2) / 2) for i in place):
            place.append(first)

    for i in range(n):
        for unit in range(1, min(REPEAT_UNIT, i) + 1):
            offer_repeats(unit, i)
        run = 0.0
        for j in range(i + 1, min(n, i + LONGEST_WORD) + 1):  # a longer brute-force span is several
            run += _brute(value[j - 1])
            offer(i, j, run)
            rank = ranks.get(low[i:j])
            if rank:
                offer(i, j, math.log10(rank + 1) + _case_cost(value[i:j]))
            elif plain[i:j] != low[i:j] and (rank := ranks.get(plain[i:j])):
                swaps = sum(a != b for a, b in zip(plain[i:j], low[i:j], strict=True))
                offer(i, j, math.log10(rank + 1) + _case_cost(value[i:j]) + swaps * math.log10(2))
        for j in range(i + 4, min(n, i + 10) + 1):
            if value[i].isdigit() and _date(value[i:j]):
                offer(i, j, math.log10(365 * 120) + (math.log10(4) if j - i > 8 else 0))
        # keyboard walks: neighbours in a row, one direction
        for r, p in PLACE.get(low[i], ()):
            for step in (1, -1):
                j, q = i + 1, p
                while j < n and 0 <= q + step < len(ROWS[r]) and ROWS[r][q + step] == low[j]:
                    j, q = j + 1, q + step
                    if j - i >= 3:
                        offer(i, j, math.log10(94 * 2 * (j - i)) + _case_cost(value[i:j]))
    for unit in range(1, min(REPEAT_UNIT, n) + 1):
        offer_repeats(unit, n)
    return best[n]


def spans(text: str, ranks: dict[str, int]) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of all spans, sorted; offsets are code points."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_VALUE]
    covered = list(found)
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if any(w in low for w in CONTEXT_WORDS):
        for m in CONTEXT.finditer(text):
            value = m[1].rstrip(".,;:!?)]}")
            start, end = m.start(1), m.start(1) + len(value)
            inside = any(s <= start and end <= e for s, _, e in covered)
            if not inside and len(value) >= 6 and guess_cost(value, ranks) >= COSTLY:
                found.append((start, 3, end))
    return sorted(found)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    word = re.compile(r"[a-z]{3,%d}" % LONGEST_WORD)
    counts: Counter[str] = Counter()

    def rows() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
        counts.clear()
        return out

    for batch in batches:
        for text in batch.column(0):
            counts.update(word.findall((text.as_py() or "").lower()))
            if len(counts) > 200_000:
                yield rows()
    yield rows()


def word_ranks(docs: DataFrame, most: int = DICTIONARY_WORDS) -> dict[str, int]:
    """The ``most`` frequent words over all documents with their ranks, ties by the word.

    Words are runs of small ASCII letters, at least three; capitals count as small.
    """
    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_count, "word string, n long")
    counts = stage(counts.groupBy("word").agg(F.sum("n").alias("n")), "words")
    # sixteen bins to a doubling of the count: at most a thousand rows, at every size
    level = F.floor(F.log2("n") * 16).cast("int")
    left, lowest = most, 0
    for row in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("level")).collect():
        lowest, left = row["level"], left - row["words"]
        if left <= 0:
            break
    # eight parts, so that the driver gets at most eight times the words it keeps
    top = counts.where(level >= lowest).repartition(8, "word").orderBy(F.desc("n"), "word").limit(most)
    return {r["word"]: i + 1 for i, r in enumerate(top.collect())}  # of fixed size


NAMES = ["doc_id", "n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans"]


def secrets(docs: DataFrame) -> DataFrame:
    """Spans of secrets in every row of ``docs``: counts by kind, a digest of the fixed kinds, all spans.

    A null text is empty and has no spans; a null id stays null; repeated rows are scanned one by
    one; texts are scanned whole. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(word_ranks(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in NAMES[1:]]
            for text in batch.column(1):
                found = spans(text.as_py() or "", held.value)
                for k in range(4):
                    out[k].append(sum(f[1] == k for f in found))
                names = [(f"{KINDS[k]}:{s}:{e}", k) for s, k, e in found]
                base = ",".join(x for x, k in names if k < 3)
                out[4].append(hashlib.sha256(base.encode()).hexdigest())
                out[5].append(",".join(x for x, _ in names))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, t) for v, t in zip(out, kinds, strict=True))], NAMES)

    return rows.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string")
