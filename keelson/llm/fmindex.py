"""An FM-index over a sequence of small integers, in numpy.

Suffixes are sorted by prefix doubling; the Burrows-Wheeler transform is held
in a wavelet matrix (one ranked bit vector for each bit of a symbol), and the
positions of every ``SAMPLE``-th text place are kept. Patterns are searched
backward many at a time: each step is two rank queries for all patterns.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_order(seq: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of ``seq`` in sorted order (a shorter one first)."""
    n = len(seq)
    rank = np.unique(seq, return_inverse=True)[1].astype(np.int64) + 1
    step = 1
    while True:
        later = np.zeros(n, np.int64)
        later[: max(n - step, 0)] = rank[step:]
        key = rank * np.int64(n + 2) + later
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = 1 + np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        if n == 0 or rank[order[-1]] == n:
            return order
        step *= 2


class WaveletMatrix:
    """Rank and access over a sequence of integers below ``2 ** levels``."""

    def __init__(self, seq: np.ndarray, largest: int):
        self.levels = max(1, int(largest).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        current = seq
        for level in reversed(range(self.levels)):
            bit = (current >> level) & 1
            ones = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(seq) - int(ones[-1]))
            current = np.concatenate((current[bit == 0], current[bit == 1]))

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        lo, hi = np.zeros_like(places), places
        for level, ones, zeros in zip(reversed(range(self.levels)), self.ones, self.zeros, strict=True):
            one = ((symbols >> level) & 1).astype(bool)
            below, upto = ones[lo], ones[hi]
            lo = np.where(one, zeros + below, lo - below)
            hi = np.where(one, zeros + upto, hi - upto)
        return hi - lo

    def access_rank(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and how often it occurs before it."""
        symbol = np.zeros(len(places), np.int64)
        lo, at = np.zeros_like(places), places
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            below, upto = ones[lo], ones[at]
            one = ones[at + 1] > upto
            symbol = symbol * 2 + one
            lo = np.where(one, zeros + below, lo - below)
            at = np.where(one, zeros + upto, at - upto)
        return symbol, at - lo


class FMIndex:
    """``seq`` holds symbols of 1 or more, and 0 where no pattern may match."""

    def __init__(self, seq: np.ndarray):
        text = np.concatenate((np.asarray(seq, np.int64) + 1, [0]))  # the last symbol is the end mark
        order = suffix_order(text)
        bwt = text[order - 1]
        largest = int(text.max())
        self.wavelet = WaveletMatrix(bwt, largest)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=largest + 1))))
        sampled = (order % SAMPLE) == 0
        self.sampled = np.concatenate(([0], np.cumsum(sampled)))
        self.places = order[sampled]
        self.size, self.largest = len(text), largest

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of ``patterns`` the range of suffixes that begin with it."""
        lo = np.zeros(len(patterns), np.int64)
        hi = np.full(len(patterns), self.size, np.int64)
        for symbol in (patterns.T + 1)[::-1]:
            alive = (hi > lo) & (symbol <= self.largest)
            hi = np.where(alive, hi, lo)
            live = np.flatnonzero(alive)
            s = symbol[live]
            first = self.before[s]
            lo[live], hi[live] = first + self.wavelet.rank(s, lo[live]), first + self.wavelet.rank(s, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step backward to the next sampled one."""
        found = np.zeros(len(rows), np.int64)
        at, todo, steps = rows.copy(), np.arange(len(rows)), 0
        while len(todo):
            hit = self.sampled[at + 1] > self.sampled[at]
            found[todo[hit]] = self.places[self.sampled[at[hit]]] + steps
            todo, at = todo[~hit], at[~hit]
            if len(todo):
                symbol, rank = self.wavelet.access_rank(at)
                at = self.before[symbol] + rank
            steps += 1
        return found
