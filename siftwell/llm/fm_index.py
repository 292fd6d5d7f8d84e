"""An FM-index in numpy: suffix order, wavelet matrix over the transform, backward search and sampled locating.

The text is a sequence of segments over the symbols 1 to sigma, each ended by a terminator (symbol 0). Terminators are distinct and
sort by position, so that suffixes are totally ordered within their segment, and the last-to-first mapping is exact.
"""

from __future__ import annotations

import numpy as np

SAMPLE_EVERY = 8


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix tripling and then doubling; only groups that still tie are sorted again."""
    n = len(text)
    ends = text == 0
    n_ends = int(ends.sum())
    rank = text.astype(np.int64) + (n_ends - 1)
    rank[ends] = np.arange(n_ends)
    width = int(rank.max()) + 2 if n else 1
    padded = np.concatenate((rank + 1, np.zeros(2, np.int64)))
    packs = 3 if width**3 < 1 << 62 else 2
    key = padded[:n] * width + padded[1 : n + 1]
    if packs == 3:
        key = key * width + padded[2 : n + 2]
    order = np.argsort(key, kind="stable")
    key = key[order]
    fresh = np.r_[True, key[1:] != key[:-1]] if n else np.zeros(0, bool)
    # The rank of a suffix is the place of its group's first member.
    place = np.flatnonzero(fresh)[np.cumsum(fresh) - 1] if n else np.zeros(0, np.int64)
    rank = np.empty(n, np.int64)
    rank[order] = place
    depth = packs
    while True:
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            return order
        members = order[slots]
        follow = members + depth
        second = np.where(follow < n, rank[np.minimum(follow, n - 1)] + 1, 0)
        group = rank[members]
        sub = np.lexsort((second, group))
        members, group, second = members[sub], group[sub], second[sub]
        order[slots] = members
        new = np.r_[True, (group[1:] != group[:-1]) | (second[1:] != second[:-1])]
        fresh[slots] = new
        place = slots[np.flatnonzero(new)[np.cumsum(new) - 1]]
        rank[members] = place
        depth *= 2


class BitRank:
    """Bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:], dtype=np.int64)

    def __call__(self, i: np.ndarray) -> np.ndarray:
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels: list[tuple[int, BitRank, int]] = []
        self.n = len(symbols)
        s = symbols
        for bit in range(max(1, sigma.bit_length()) - 1, -1, -1):
            on = (s >> bit) & 1
            rank = BitRank(on.astype(np.uint8))
            self.levels.append((bit, rank, int(len(s) - on.sum())))
            on = on.astype(bool)
            s = np.concatenate((s[~on], s[on]))
        # Where each symbol's run begins on the last level.
        self.first = self._down(np.arange(sigma + 1), np.zeros(sigma + 1, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for bit, rank, zeros in self.levels:
            ones = rank(i)
            i = np.where((symbol >> bit) & 1 == 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before place i."""
        return self._down(symbol, i) - self.first[symbol]


class FMIndex:
    def __init__(self, text: np.ndarray, sigma: int):
        """text: symbols 0 (terminator) to sigma, the last a terminator."""
        self.n = len(text)
        order = suffix_order(text)
        before = order - 1  # of place 0: the last terminator
        self.transform = text[before]
        self.wavelet = WaveletMatrix(self.transform, sigma)
        self.less = np.zeros(sigma + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=sigma + 1), out=self.less[1:])
        # Sampled: every SAMPLE_EVERYth position, and each segment's first, so that no walk passes a terminator.
        sampled = (order % SAMPLE_EVERY == 0) | (self.transform == 0)
        self.sampled, self.samples = BitRank(sampled.astype(np.uint8)), order[sampled].astype(np.int32 if self.n < 1 << 31 else np.int64)
        self.is_sampled = sampled

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of the phrases, given right-aligned in a matrix (0 to the left)."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for k in range(1, phrases.shape[1] + 1):
            live = np.flatnonzero((lengths >= k) & (lo < hi))
            if not len(live):
                break
            c = phrases[live, -k]
            ends = self.wavelet.rank(np.concatenate((c, c)), np.concatenate((lo[live], hi[live])))
            lo[live] = self.less[c] + ends[: len(live)]
            hi[live] = self.less[c] + ends[len(live) :]
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back until a sampled one."""
        at, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        live = np.arange(len(rows))
        while len(live):
            here = at[live]
            stop = self.is_sampled[here]
            done = live[stop]
            out[done] = self.samples[self.sampled(here[stop])] + steps[done]
            live, here = live[~stop], here[~stop]
            c = self.transform[here]
            at[live] = self.less[c] + self.wavelet.rank(c, here)
            steps[live] += 1
        return out
