"""Words, shingles and set sketches straight from the UTF-8 buffers of Arrow columns.

Everything here is vectorised over a slice of rows, so no Python object is made per word.
Hashes are 64-bit; a document's shingle set keeps 48 bits of each, sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 16
SHINGLE_BITS = 48
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scramble."""
    x = x + U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_VALUES = mix(np.arange(256, dtype=U) + U(1000))
STEP = U(0xD6E8FEB86659FD93)

#: Space and the five ASCII controls from tab to carriage return.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
#: Everything but ASCII letters, digits and the bytes of other characters.
NOT_ALNUM = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row starts; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), at


def slices(at: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one longer row."""
    i, n = 0, len(at) - 1
    while i < n:
        j = min(max(int(np.searchsorted(at, at[i] + limit, "right")) - 1, i + 1), i + 60000)
        yield i, min(j, n)
        i = min(j, n)


def words(
    data: np.ndarray, at: np.ndarray, blanks: np.ndarray = BLANKS, fold: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word and the row it stands in, in order.

    ASCII capitals count as small letters, with ``fold`` those of Latin-1 too.
    """
    lo, hi = int(at[0]), int(at[-1])
    b = LOWER[data[lo:hi]]
    if fold and len(b) > 1:
        big = (b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E) & (b[1:] != 0x97)
        b[1:][big] += 0x20
    blank = blanks[b]
    first = ~blank
    first[1:] &= blank[:-1]
    rows = (at - lo).astype(np.int64)
    inner = rows[:-1][(rows[:-1] < len(b)) & (rows[1:] > rows[:-1])]
    first[inner] |= ~blank[inner]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, U), np.zeros(0, np.int64)
    values = BYTE_VALUES[b]
    values[blank] = 0
    gaps = np.diff(np.append(starts, len(b)))
    values = values[starts[0] :]
    where = np.arange(len(values)) - np.repeat(starts - starts[0], gaps)
    # blanks may run on for long after a word; their value is 0 whatever the power
    longest = min(int(gaps.max()), len(b))
    power = np.full(longest, STEP, U)
    power[0] = 1
    values *= np.multiply.accumulate(power)[where]
    hashes = mix(np.add.reduceat(values, starts - starts[0]))
    return hashes, np.searchsorted(rows, starts, "right") - 1


def shingle_sets(
    data: np.ndarray, at: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``k``-word shingles of each row: sorted 48-bit hashes, their rows, row sizes.

    A row of fewer words has its whole sequence as one shingle, a row without words none.
    """
    n = len(at) - 1
    h, row = words(data, at)
    total = np.bincount(row, minlength=n)
    weight = mix(np.arange(k, dtype=U) + U(77)) | U(1)
    begin = np.cumsum(total) - total
    m = max(len(h) - k + 1, 0)
    value = np.zeros(m, U)
    for j in range(k):
        value += h[j : j + m] * weight[j]
    whole = row[:m] == row[k - 1 : k - 1 + m]
    value, owner = value[whole], row[:m][whole]
    short = np.flatnonzero((total > 0) & (total < k))
    if len(short):
        extra = np.zeros(len(short), U)
        for j in range(k - 1):
            has = total[short] > j
            extra[has] += h[begin[short[has]] + j] * weight[j]
        value = np.append(value, extra + total[short].astype(U))
        owner = np.append(owner, short)
    packed = (owner.astype(U) << U(SHINGLE_BITS)) | (mix(value) >> U(64 - SHINGLE_BITS))
    packed.sort()
    if len(packed):
        packed = packed[np.append(True, packed[1:] != packed[:-1])]
    owner = (packed >> U(SHINGLE_BITS)).astype(np.int64)
    size = np.bincount(owner, minlength=n)
    return packed & U((1 << SHINGLE_BITS) - 1), owner, size


def sums(values: np.ndarray, owner: np.ndarray, n: int, how: np.ufunc) -> np.ndarray:
    """``how`` over the values of each row, 0 for a row without any; owner ascending."""
    out = np.zeros(n, values.dtype)
    if len(values):
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        out[owner[first]] = how.reduceat(values, first)
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(U).view(np.int64)


def only_ids(df: DataFrame, ids: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """``df`` with (or by ``left_anti`` without) the keys in ``ids``.

    ``ids`` is a stored table of distinct keys. It is counted first: up to ``ID_LIMIT`` keys
    (a few dozen MB) go to every executor, more than that meet by a shuffle.
    """
    row: Row = ids.agg(F.count(F.lit(1)).alias("n")).first()
    side = F.broadcast(ids) if row["n"] <= ID_LIMIT else ids
    return df.join(side, key, how)


ID_LIMIT = 500_000
