"""An FM-index over many short texts, and matching statistics of texts against it, in numpy.

The Burrows-Wheeler transform of all texts (each closed by a separator of its own) is held as a
wavelet matrix: one bit a word and level, with counts every 64 bits. Backward search extends a
match to the left by two ranks; where too few occurrences are left, the match is cut on the right
to its parent interval by the array of common prefix lengths. All texts search in step.
"""

from __future__ import annotations

import numpy as np

ONE, SIXTY_THREE = np.uint64(1), np.uint64(63)


class Bits:
    """A bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]])
        self.zeros = len(bits) - int(np.count_nonzero(bits))

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Set bits before place ``i``."""
        at = i >> 6
        mask = (ONE << (i.astype(np.uint64) & SIXTY_THREE)) - ONE
        return self.before[at] + np.bitwise_count(self.words[at] & mask)


class Wavelet:
    """A sequence of numbers below ``2 ** levels`` as bits by level."""

    def __init__(self, seq: np.ndarray, levels: int):
        self.levels: list[Bits] = []
        for k in range(levels - 1, -1, -1):
            bit = (seq >> k) & 1
            self.levels.append(Bits(bit.astype(np.uint8)))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def follow(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where the first ``i`` places of each symbol end at the bottom."""
        top = len(self.levels) - 1
        for k, bits in enumerate(self.levels):
            ones = bits.ones(i)
            i = np.where((symbol >> (top - k)) & 1, ones + bits.zeros, i - ones)
        return i


class Index:
    """``words``: the texts' words one after the other, ``sizes``: words of each, ``copies``: how often each counts."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray, copies: np.ndarray):
        names, ids = np.unique(words, return_inverse=True)
        self.names = names
        starts = np.cumsum(sizes) - sizes
        which = np.repeat(np.arange(len(sizes)), copies)
        sizes, starts = sizes[which], starts[which]
        n = int(sizes.sum()) + len(sizes)
        ends = np.cumsum(sizes + 1) - 1
        text = np.zeros(n, np.int64)  # 0 separates
        inner = np.ones(n, bool)
        inner[ends] = False
        text[inner] = ids[np.arange(n - len(sizes)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)] + 1
        order, levels = self._sorted(text, ends, int(sizes.max(initial=0)) + 1)
        self.common = self._common(order, levels, n)
        bwt = text[order - 1]
        self.n = n
        self.wavelet = Wavelet(bwt, max(1, int(len(names)).bit_length()))
        symbols = np.arange(len(names) + 1)
        count = np.bincount(bwt, minlength=len(names) + 1)
        self.shift = np.cumsum(count) - count - self.wavelet.follow(symbols, np.zeros(len(symbols), np.int64))
        # minima over stretches of 1, 2, 4, .. of the common prefix lengths, to find parents
        self.least = [self.common]
        while 2 << (len(self.least) - 1) <= n:
            last, step = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(last[:-step], last[step:]))

    @staticmethod
    def _sorted(text: np.ndarray, ends: np.ndarray, longest: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """All suffixes in order by doubling, and the ranks by their first 1, 2, 4, .. symbols."""
        n = len(text)
        rank = text + len(ends)
        rank[ends] = np.arange(len(ends))
        levels, h = [], 1
        order = np.argsort(rank, kind="stable")
        while True:
            levels.append(np.append(rank, np.full(1, -1)).astype(np.int32))
            if h >= longest:
                return order, levels
            key = rank * (n + len(ends) + 2)
            key[: n - h] += rank[h:] + 1
            order = np.argsort(key)
            key = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.append(0, key[1:] != key[:-1]))
            h *= 2

    @staticmethod
    def _common(order: np.ndarray, levels: list[np.ndarray], n: int) -> np.ndarray:
        """Symbols that each suffix shares with the one before it in order; 0 at both ends."""
        a, b = order[:-1].copy(), order[1:].copy()
        length = np.zeros(n - 1, np.int64)
        for k in range(len(levels) - 1, -1, -1):
            same = levels[k][np.minimum(a, n)] == levels[k][np.minimum(b, n)]
            length += same << k
            a += same << k
            b += same << k
        return np.concatenate([[0], length, [0]]).astype(np.int32)

    def back(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search."""
        both = self.wavelet.follow(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        shift = self.shift[symbol]
        return shift + both[: len(lo)], shift + both[len(lo) :]

    def parent(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The smallest larger interval of each, and the length of the prefix it stands for."""
        length = np.maximum(self.common[lo], self.common[hi])
        lo, hi = lo.copy(), hi.copy()
        for k in range(len(self.least) - 1, -1, -1):
            least, step = self.least[k], 1 << k
            go = (lo >= step) & (length > 0)
            go[go] = least[lo[go] - step + 1] >= length[go]
            lo[go] -= step
            go = (hi + step <= len(self.common)) & (length > 0)
            go[go] = least[hi[go]] >= length[go]
            hi[go] += step
        lo[length == 0], hi[length == 0] = 0, self.n
        return lo, hi, length

    def matching(self, words: np.ndarray, sizes: np.ndarray, least: int) -> np.ndarray:
        """For each word of the texts how many words from there on stand at ``least`` times in the index."""
        at = np.searchsorted(self.names, words)
        at[at == len(self.names)] = 0
        symbols = np.where(self.names[at] == words, at + 1, -1) if len(self.names) else np.full(len(words), -1)
        out = np.zeros(len(words), np.int64)
        first = np.cumsum(sizes) - sizes
        place, live = first + sizes - 1, np.flatnonzero(sizes > 0)
        lo, hi, length = np.zeros(len(sizes), np.int64), np.full(len(sizes), self.n), np.zeros(len(sizes), np.int64)
        while len(live):
            symbol = symbols[place[live]]
            a, b = self.back(np.maximum(symbol, 0), lo[live], hi[live])
            more = (symbol > 0) & (b - a >= least)
            on = live[more]
            lo[on], hi[on] = a[more], b[more]
            length[on] += 1
            # no shorter match to try: the word itself is too rare
            rare = live[~more & (length[live] == 0)]
            cut = live[~more & (length[live] > 0)]
            if len(cut):
                lo[cut], hi[cut], length[cut] = self.parent(lo[cut], hi[cut])
            for done in (on, rare):
                out[place[done]] = length[done]
                place[done] -= 1
            live = live[place[live] >= first[live]]
        return out
