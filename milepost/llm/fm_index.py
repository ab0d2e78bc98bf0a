"""A compressed full-text index of a shard: wavelet matrix over the transform of
an integer text, searched backwards for many patterns at a time."""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` symbols at least."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order, k = np.argsort(rank, kind="stable"), 1
    while k < depth:
        follow = np.zeros(len(text), np.int64)
        follow[:-k] = rank[k:] + 1
        key = rank * (len(text) + 1) + follow
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.r_[0, key[order][1:] != key[order][:-1]])
        rank[order] = new
        if new[-1] == len(text) - 1:
            break
        k *= 2
    return order


class Bits:
    """A packed bit vector with a count of ones for every 64 bits."""

    def __init__(self, bits: np.ndarray):
        self.word = np.packbits(np.r_[bits, np.zeros(64 - len(bits) % 64, bool)], bitorder="little").view("<u8")
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.word))].astype(np.int32)
        self.zeros = int(len(bits) - bits.sum())

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        w = i >> 6
        part = self.word[w] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[w] + np.bitwise_count(part)


class FmIndex:
    """Texts of one shard, each with a weight; a search asks whether a pattern
    occurs in a text of smaller weight than a bound."""

    def __init__(self, flat: np.ndarray, size: np.ndarray, weight: np.ndarray, depth: int):
        self.symbols, code = np.unique(flat, return_inverse=True)
        self.code = code + 1  # 0 ends each text
        self.at = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(size)), size)
        text = np.zeros(len(flat) + len(size), np.int64)
        text[np.arange(len(flat)) + owner] = self.code
        order = suffix_order(text, depth)
        last = text[order - 1]
        self.first = np.r_[0, np.cumsum(np.bincount(text, minlength=len(self.symbols) + 1))]
        self.levels = []
        for shift in range(int(len(self.symbols)).bit_length() - 1, -1, -1):
            bit = (last >> shift & 1).astype(bool)
            self.levels.append((shift, Bits(bit)))
            last = np.r_[last[~bit], last[bit]]
        self.n = len(text)
        every = np.arange(len(self.symbols) + 1)
        self.base = self._place(every, np.zeros(len(every), np.int64))
        # smallest weight in any range of suffixes: minima over powers of two
        self.weights = np.unique(weight)
        own = np.full(self.n, len(self.weights), np.int32)
        own[np.arange(len(flat)) + owner] = np.searchsorted(self.weights, weight)[owner]
        self.least = [own[order]]
        while 2 ** len(self.least) <= self.n:
            low, half = self.least[-1], 2 ** (len(self.least) - 1)
            self.least.append(np.minimum(low[:-half], low[half:]))

    def _place(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where the first i places lead when followed down the bits of c."""
        for shift, bits in self.levels:
            ones = bits.ones(i)
            i = np.where(c >> shift & 1, bits.zeros + ones, i - ones)
        return i

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges after putting symbol c in front."""
        both = self._place(np.r_[c, c], np.r_[lo, hi]) + np.tile(self.first[c] - self.base[c], 2)
        return both[:len(c)], both[len(c):]

    def smallest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Smallest weight's number in non-empty ranges."""
        level = np.log2(hi - lo).astype(np.int64)
        out = np.full(len(lo), len(self.weights), np.int32)
        for k in np.unique(level).tolist():
            own = level == k
            row = self.least[k]
            out[own] = np.minimum(row[lo[own]], row[hi[own] - 2 ** k])
        return out

    def reach(self, text: np.ndarray, end: np.ndarray, left: np.ndarray, below: np.ndarray) -> np.ndarray:
        """How far (down to ``left``) the pattern that ends before ``end`` in its text
        extends backwards with an occurrence in a text of weight number < below."""
        j = end.copy()
        lo, hi = np.zeros(len(text), np.int64), np.full(len(text), self.n)
        live = np.flatnonzero(j > left)
        while len(live):
            c = self.code[self.at[text[live]] + j[live] - 1]
            lo2, hi2 = self.extend(c, lo[live], hi[live])
            some = hi2 > lo2
            live, lo2, hi2 = live[some], lo2[some], hi2[some]
            fine = self.smallest(lo2, hi2) < below[live]
            live = live[fine]
            lo[live], hi[live] = lo2[fine], hi2[fine]
            j[live] -= 1
            live = live[j[live] > left[live]]
        return j
