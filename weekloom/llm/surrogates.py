"""Surrogates for personal data: keyed, consistent by type, distinct, the same in all documents.

Numbers and letters are replaced by a keyed permutation of all strings of the same pattern (a
Feistel network with cycle walking), so two values never share a surrogate and a format stays
what it was, card check digit included; where a pattern has too few strings a later attempt is longer. Names get made-up names of the same gender and script.
All values of the corpus are then checked together: a surrogate that equals its value, a value
that occurs, or another surrogate is drawn again. Only those exceptions are joined with the texts.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import cache
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.llm import scan
from weekloom.staging import stage

# Fixed forms of address that announce a name, by gender.
TITLES = {"m": ("Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "Don", "Sir", "Lord", "господин", "г-н"),
          "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "Dra", "Dame", "Lady", "госпожа", "г-жа"),
          "n": ("Dr", "Doctor", "Doktor", "Docteur", "Prof", "Professor", "Professeur", "Mx", "Rev", "Reverend", "доктор", "профессор")}
TITLE_GENDER = {t: g for g, ts in TITLES.items() for t in ts}
# Syllables of made-up names and their endings, by script and gender.
SYLLABLES = {
    "latin": ("ba be bi bo da de di do fa fe fi ga ge go ka ke ko la le li lo ma me mi mo na ne ni no"
              " pa pe ra re ri ro sa se si so ta te ti to va ve vi vo").split(),
    "cyrillic": ("ба бе би бо да де ди до га го ка ко ла ле ли ло ма ме ми мо на не ни но"
                 " па ра ре ри ро са се си та те ти то ва ве ви во").split(),
}
ENDINGS = {("latin", "m"): ("n", "rd", "s", "ck"), ("latin", "f"): ("a", "ia", "elle", "ina"),
           ("latin", "n"): ("en", "or", "is", "el"), ("cyrillic", "n"): ("ко", "их", "ен", "ук"),
           ("cyrillic", "m"): ("н", "р", "с", "слав"), ("cyrillic", "f"): ("на", "ия", "ина", "лия")}

EMAIL = r"(?<![\w.+%-])[\w+%-]+(?:\.[\w+%-]+)*@[\w-]+(?:\.[\w-]+)+"
IP = r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)"
IBAN = r"(?<!\w)[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
CARD = r"(?<![\w.-])\d(?:[\x20-]?\d){12,18}(?![\w-]|\.\d)"
PHONE = (r"(?<![\w.+(-])(?:\+\d{1,3}[\x20.-]?)?\(\d{2,4}\)[\x20.-]?\d{3,4}[\x20.-]?\d{3,4}(?![\w-]|\.\d)"
         r"|(?<![\w.+(-])\+\d{1,3}(?:[\x20.-]?\d{2,4}){2,5}(?![\w-]|\.\d)"
         r"|(?<![\w.+(-])(?:1[\x20.-])?\d{3}[\x20.-]\d{3}[\x20.-]\d{4}(?![\w-]|\.\d|\x20\d{4})"
         r"|(?<![\w.+(-])0\d{1,4}[\x20./-]\d{3,4}[\x20.-]?\d{3,4}(?![\w-]|\.\d|\x20\d{4})"
         r"|(?<![\w.+(-])0\d(?:[\x20.-]\d{2}){4}(?![\w-]|\.\d)")
UPPER, LOWER = "A-ZÀ-ÖØ-ÞА-ЯЁ", "a-zß-öø-ÿа-яё"
WORD = rf"[{UPPER}][{LOWER}]+"
NAME = r"(?<!\w)((?:(?:" + "|".join(TITLE_GENDER) + rf")\.?\x20)+)({WORD}(?:[\x20-]{WORD}){{0,2}})"
KINDS = ("email", "ip", "iban", "ssn", "phone", "card")
NUMBERS = re.compile("|".join(f"(?P<{k}>{p})" for k, p in zip(KINDS, (EMAIL, IP, IBAN, SSN, PHONE, CARD), strict=True)))
NAMES = re.compile(NAME)
#: A word that may be a name said again, alone.
AGAIN = re.compile(rf"(?<![\w-]){WORD}(?!\w|-\w)")


def find(text: str, numbers: bool = True) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of all entities, in order and apart."""
    found = [(m.start(), m.end(), m.lastgroup) for m in NUMBERS.finditer(text)] if numbers else []
    if any(t in text for t in TITLE_GENDER):
        for m in NAMES.finditer(text):
            start = m.start(2)
            if not any(s < m.end() and start < e for s, e, _ in found):
                genders = [TITLE_GENDER[t.rstrip(".")] for t in m[1].split()]
                found.append((start, m.end(), "name:" + next((g for g in genders if g != "n"), "n")))
    return sorted(found)


def mentions(text: str, numbers: bool = True) -> list[tuple[int, int, str, str, tuple[int, int] | None]]:
    """``(start, end, kind, canon, words)`` of all entities, in order and apart.

    A name that stands after a title is also found where it, or words of it, stand alone elsewhere
    in the text; ``words`` then is the range of its words, ``canon`` the name as announced. A word
    of several names means the one announced last before it, or the first one.
    """
    first = find(text, numbers)
    out = [(s, e, k, canonical(k, text[s:e]), None) for s, e, k in first]
    named: dict[str, list[tuple[int, str, str, int]]] = {}
    for s, _, k, canon, _ in out:
        if k.startswith("name:"):
            for i, word in enumerate(re.split(r"[\x20-]", canon)):
                named.setdefault(word, []).append((s, k, canon, i))
    if not named:
        return out
    more: list[tuple] = []
    at = 0
    for m in AGAIN.finditer(text):
        if m.group() not in named:
            continue
        while at < len(first) and first[at][1] <= m.start():
            at += 1
        if at < len(first) and first[at][0] < m.end():
            continue
        known = named[m.group()]
        _, k, canon, i = next((x for x in reversed(known) if x[0] < m.start()), known[0])
        if more and more[-1][2:4] == (k, canon) and more[-1][4][1] == i and text[more[-1][1] : m.start()] == " ":
            more[-1] = (more[-1][0], m.end(), k, canon, (more[-1][4][0], i + 1))
        else:
            more.append((m.start(), m.end(), k, canon, (i, i + 1)))
    return sorted([*out, *more], key=lambda x: x[0])


def canonical(kind: str, value: str) -> str:
    """What mentions of one entity share: case of an address, signs of a number do not matter."""
    if kind == "email":
        return value.lower()
    if kind in ("ssn", "card", "phone"):
        return ("+" if value.startswith("+") else "") + re.sub(r"\D", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    return value


def _random(key: bytes, tweak: str, data: int, bits: int) -> int:
    raw = hashlib.blake2b(f"{tweak}|{data}".encode(), key=key, digest_size=16).digest()
    return int.from_bytes(raw, "big") & ((1 << bits) - 1)


def permute(x: int, n: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of 0..n-1."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        a, b = x >> half, x & mask
        for r in range(8):
            a, b = b, a ^ _random(key, f"{tweak}|{r}", b, half)
        x = a << half | b
        if x < n:
            return x


ALPHABETS = tuple("".join(map(chr, range(ord(a), ord(b) + 1))) for a, b in ("09", "az", "AZ", "ая", "АЯ", "αω", "ΑΩ", "ßÿ"))
OF = {c: a for a in ALPHABETS for c in a}
#: A pattern of fewer strings is left for a longer surrogate at the second attempt, any at ``LATE``.
SMALL, LATE = 1_000_000, 16


@cache
def _alphabet(c: str) -> str:
    """What may stand for a letter or digit: its alphabet, or its kind within the 128 characters around it."""
    if c in OF or not c.isalnum():
        return OF.get(c, "")
    first = ord(c) & ~127
    return "".join(x for x in map(chr, range(first, first + 128)) if x.isalnum() and x not in OF and category(x) == category(c))


def _space(value: str) -> int:
    return math.prod(len(_alphabet(c)) or 1 for c in value)


def _more(canon: str, key: bytes, tweak: str, letters: str, n: int) -> str:
    """``n`` characters drawn for a value."""
    seed, out = _random(key, f"more|{tweak}", int.from_bytes(canon.encode(), "big"), 128), ""
    for i in range(n):
        out += letters[_random(key, f"more|{tweak}|{i}", seed, 32) % len(letters)]
    return out


def reshape(value: str, key: bytes, tweak: str) -> str:
    """Another string of the same pattern: digits for digits, letters for letters of their script."""
    total, size = 0, 1
    for c in value:
        if a := _alphabet(c):
            total = total * len(a) + a.index(c)
            size *= len(a)
    pattern = "".join((str(ALPHABETS.index(a)) if a in ALPHABETS else f"({a[0]})") if (a := _alphabet(c)) else c for c in value)
    total = permute(total, size, key, f"{tweak}|{pattern}")
    out = []
    for c in reversed(value):
        if a := _alphabet(c):
            total, digit = divmod(total, len(a))
            c = a[digit]
        out.append(c)
    return "".join(reversed(out))


def _luhn(digits: str) -> int:
    """Sum modulo 10 of the digits doubled in turn, the last one not."""
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10


def _name(value: str, gender: str, key: bytes, attempt: int) -> str:
    script = "cyrillic" if re.search("[А-яЁё]", value) else "latin"
    out = []
    for i, word in enumerate(re.split(r"([\x20-])", value)):
        if i % 2:
            out.append(word)
            continue
        seed = _random(key, f"name|{gender}|{attempt if ' ' not in value or i else 0}|{i}", int.from_bytes(word.encode(), "big"), 100)
        made = ""
        for _ in range(2 + attempt // 4 + (i > 0)):
            seed, k = divmod(seed, len(SYLLABLES[script]))
            made += SYLLABLES[script][k]
        ends = ENDINGS[script, gender]
        out.append((made + ends[seed % len(ends)]).capitalize())
    return "".join(out)


def surrogate(kind: str, canon: str, key: bytes, attempt: int = 0) -> str:
    """The canonical surrogate of a canonical value."""
    tweak = f"{kind}|{attempt}"
    if kind.startswith("name:"):
        return _name(canon, kind[-1], key, attempt)
    if kind == "email":
        local, _, domain = canon.partition("@")
        first, dot, rest = domain.partition(".")
        # what lies left of the last labels is one pattern, so that the address as a whole stays distinct
        if attempt and (attempt >= LATE or _space(local + first) < SMALL):
            return f"{_more(canon, key, tweak, ALPHABETS[1], 8 + attempt)}@{reshape(first, key, f'{tweak}|{rest}')}{dot}{rest}"
        made = reshape(f"{local}@{first}", key, f"{tweak}|{rest}")
        return made + dot + rest
    if kind == "ip":
        x = permute(int.from_bytes(bytes(map(int, canon.split("."))), "big"), 1 << 32, key, tweak)
        return ".".join(map(str, x.to_bytes(4, "big")))
    if kind == "card":
        made = reshape(canon[:-1], key, tweak)
        # the last digit keeps what the check digit says, right or wrong
        off = _luhn(canon)
        return made + next(str(d) for d in range(10) if _luhn(made + str(d)) == off)
    if kind == "iban":
        return canon[:2] + reshape(canon[2:], key, tweak)
    if kind in ("ssn", "phone") and attempt >= LATE:
        # a short number of which all others occur gets more digits
        sign = "+" if canon.startswith("+") else ""
        return sign + reshape(canon[len(sign) :], key, tweak) + _more(canon, key, tweak, ALPHABETS[0], attempt // LATE)
    if kind == "phone" and canon.startswith("+"):
        keep = max(2, len(canon) - 10)
        return canon[:keep] + reshape(canon[keep:], key, f"{tweak}|{canon[:keep]}")
    return reshape(canon, key, tweak)


def render(kind: str, value: str, made: str) -> str:
    """The surrogate with the signs, spaces and case of the mention."""
    if kind == "email":
        return "".join(b.upper() if a.isupper() and len(b.upper()) == 1 else b for a, b in zip(value, made, strict=True)) if len(value) == len(made) else made
    if kind in ("ssn", "card", "phone", "iban"):
        left = iter(made.lstrip("+"))
        return "".join([next(left) if c.isalnum() else c for c in value]) + "".join(left)
    return made


# -- Spark ----------------------------------------------------------------------------------


def _candidates(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows that hold a digit or an at sign."""
    lo, hi = int(at[0]), int(at[-1])
    b = data[lo:hi]
    count = np.append(0, np.cumsum((b >= 0x30) & (b <= 0x39) | (b == 0x40)))
    return count[at[1:] - lo] > count[at[:-1] - lo]


def _entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        numbers = _candidates(*scan.buffers(batch.column(1)))
        for key, text, has in zip(batch.column(0).to_pylist(), batch.column(1), numbers, strict=True):
            text = text.as_py() or ""
            out += {(key, k, canonical(k, text[s:e])) for s, e, k in find(text, has)}  # names said again add none
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.string(), pa.string()), strict=True)],
                                             ["key", "kind", "canon"])


def _draw(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, canons, tries = (batch.column(i).to_pylist() for i in range(3))
            made = [surrogate(k, c, key, t) for k, c, t in zip(kinds, canons, tries, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], ["kind", "canon", "attempt", "made"])

    return run


def attempts(values: DataFrame, key: bytes) -> DataFrame:
    """``(kind, canon, attempt)`` of the values whose first surrogate will not do.

    ``values``: stored distinct ``(kind, canon)``. Of equal surrogates the value that comes first
    keeps its own; a drawn one must differ from all values and all surrogates so far.
    """
    schema = "kind string, canon string, attempt int, made string"
    now = values.withColumn("attempt", F.lit(0))
    settled = None
    while True:
        drawn = stage(now.select("kind", "canon", "attempt").mapInArrow(_draw(key), schema), "drawn")
        own = F.split(F.col("kind"), ":")[0]
        taken = values.select(own.alias("type"), F.col("canon").alias("made"))
        if settled is not None:
            taken = taken.unionByName(settled.select(own.alias("type"), "made"))
        first = F.row_number().over(Window.partitionBy("type", "made").orderBy("kind", "canon"))
        typed = drawn.withColumn("type", own)
        # of equal surrogates few can be equal: they are draws from a large set
        marked = typed.withColumn("first", first).join(taken.distinct().withColumn("taken", F.lit(True)), ["type", "made"], "left")
        marked = stage(marked.withColumn("good", F.col("taken").isNull() & (F.col("first") == 1)), "marked")
        good = marked.where("good").select(*drawn.columns)
        settled = good if settled is None else settled.unionByName(good)
        now = marked.where("not good").withColumn("attempt", F.col("attempt") + 1)
        if now.isEmpty():
            return settled.where("attempt > 0").select("kind", "canon", "attempt")


def pseudonymise(docs: DataFrame, key: str = "replace this key") -> DataFrame:
    """``(doc_id, text, n_entities)``: every row with its entities replaced.

    Found are e-mail addresses, IPv4 addresses, IBANs, numbers like 123-45-6789, cards, phone
    numbers that start with + or have separators in common places, and names of up to three
    capitalised words after a title of ``TITLES``; such a name, and each word of it, is replaced
    in the whole text, whatever else the word may mean. Not found: names that never follow such a
    title in their text, names in other scripts than Latin and Cyrillic, names in capitals,
    IPv6, phone numbers of plain digits or other separators, numbers in rows without an ASCII digit or at sign,
    postal addresses, dates of birth, numbers of passports and the like.

    The same value gets the same surrogate in all rows, another value another one; who holds the
    key can repeat the run. A null text stays null with no entities, texts without entities stay
    as they are, null and repeated ids do not matter. Other columns are not read.
    """
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), F.col("text").cast("string").alias("text"))
    held = rows.select("key", "text").mapInArrow(_entities, "key long, kind string, canon string")
    held = stage(held.distinct(), "entities")
    again = attempts(stage(held.select("kind", "canon").distinct(), "values"), secret)
    odd = held.join(again, ["kind", "canon"]).groupBy("key").agg(F.collect_list(F.struct("kind", "canon", "attempt")).alias("odd"))
    both = rows.join(stage(odd, "exceptions"), "key", "left").select("doc_id", "text", "odd")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            numbers = _candidates(*scan.buffers(batch.column(1)))
            for text, odd_ones, has in zip(batch.column(1), batch.column(2), numbers, strict=True):
                text = text.as_py()
                found = mentions(text, has) if text else []
                if found:
                    tries = {(x["kind"], x["canon"]): x["attempt"] for x in odd_ones.as_py() or ()}
                    parts, at = [], 0
                    for s, e, k, canon, words in found:
                        made = surrogate(k, canon, secret, tries.get((k, canon), 0))
                        if words:
                            made = " ".join(re.split(r"[\x20-]", made)[slice(*words)])
                        parts += [text[at:s], render(k, text[s:e], made)]
                        at = e
                    text = "".join([*parts, text[at:]])
                texts.append(text)
                counts.append(len(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
                                             ["doc_id", "text", "n_entities"])

    return both.mapInArrow(run, "doc_id long, text string, n_entities long")
