"""Words of whole documents, slice by slice, for operators that number or hash them in numpy."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 1 << 20


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """``(first row, UTF-8 texts)`` of at most ``limit`` bytes together, or of one longer text; null is empty."""
    texts = column.cast(pa.large_string()).cast(pa.large_binary())
    first, held, size = 0, [], 0
    for i in range(len(texts)):
        raw = texts[i].as_py() or b""
        if held and size + len(raw) > limit:
            yield first, held
            first, held, size = i, [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield first, held


def words(raw: bytes) -> list[bytes]:
    """Runs of bytes other than the blank and the five ASCII controls from tab to carriage return."""
    return raw.split()


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number for every word, no number in two texts, and where each text begins and the last ends."""
    parts, base = [], 0
    for held in texts:
        seen: defaultdict[bytes, int] = defaultdict(count().__next__)
        parts.append(np.fromiter(map(seen.__getitem__, held), np.int64, len(held)) + base)
        base += len(seen)
    starts = np.cumsum([0, *map(len, texts)])
    return np.concatenate(parts) if parts else np.zeros(0, np.int64), starts


class Hashes(dict):
    """64-bit hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def hashed(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of every word, and where each text begins and the last ends."""
    known = Hashes()
    parts = [np.fromiter(map(known.__getitem__, held), np.uint64, len(held)) for held in texts]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.cumsum([0, *map(len, texts)])
