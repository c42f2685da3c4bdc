"""A compressed-suffix index over one shard of word symbols: suffix order, wavelet ranks, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_order(s: np.ndarray) -> np.ndarray:
    """Suffix positions in order. Ranks are refined by doubling; only suffixes that still tie are looked at again.

    ``s`` must end in a symbol that occurs once and is the smallest.
    """
    n = len(s)
    order = np.argsort(s, kind="stable")
    place = np.arange(n)
    first = np.r_[True, s[order][1:] != s[order][:-1]]
    start = np.maximum.accumulate(np.where(first, place, 0))
    rank = np.empty(n, np.int64)
    rank[order] = start
    open_ = order[~(first & np.r_[first[1:], True])]
    step = 1
    while open_.size:
        second = rank[open_ + step]
        by = np.lexsort((second, rank[open_]))
        open_, second = open_[by], second[by]
        group = rank[open_]
        place = np.arange(open_.size)
        new_group = np.r_[True, group[1:] != group[:-1]]
        new_rank = new_group | np.r_[True, second[1:] != second[:-1]]
        at_group = np.maximum.accumulate(np.where(new_group, place, 0))
        at_rank = np.maximum.accumulate(np.where(new_rank, place, 0))
        rank[open_] = group + at_rank - at_group
        open_ = open_[~(new_rank & np.r_[new_rank[1:], True])]
        step *= 2
    order[rank] = np.arange(n)
    return order


class FMIndex:
    """Counts and locates phrases in a sequence of symbols >= 1; symbol 0 is the end mark."""

    def __init__(self, symbols: np.ndarray, sample: int = 16):
        s = np.r_[symbols.astype(np.int64), 0]
        sa = suffix_order(s)
        bwt = s[sa - 1]
        self.n = len(s)
        self.below = np.r_[0, np.cumsum(np.bincount(s))]
        # Wavelet levels from the top bit: zeros before each place, and where the ones begin on the next level.
        self.levels: list[tuple[int, np.ndarray, int]] = []
        seq = bwt
        for bit in range(max(1, int(s.max()).bit_length()) - 1, -1, -1):
            one = (seq >> bit) & 1 == 1
            zeros = np.r_[0, np.cumsum(~one)].astype(np.int32)
            self.levels.append((bit, zeros, int(zeros[-1])))
            seq = np.r_[seq[~one], seq[one]]
        marked = sa % sample == 0
        self.marks = np.r_[0, np.cumsum(marked)].astype(np.int32)
        self.sampled = sa[marked]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place of the transform."""
        lo, hi = np.zeros_like(at), at
        for bit, zeros, ones_at in self.levels:
            one = (symbol >> bit) & 1 == 1
            zl, zh = zeros[lo], zeros[hi]
            lo, hi = np.where(one, ones_at + lo - zl, zl), np.where(one, ones_at + hi - zh, zh)
        return hi - lo

    def before(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that starts one symbol earlier."""
        symbol, lo, hi = np.zeros_like(row), np.zeros_like(row), row
        for _, zeros, ones_at in self.levels:
            one = zeros[hi + 1] == zeros[hi]
            zl, zh = zeros[lo], zeros[hi]
            lo, hi = np.where(one, ones_at + lo - zl, zl), np.where(one, ones_at + hi - zh, zh)
            symbol = symbol * 2 + one
        return self.below[symbol] + hi - lo

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of phrases, given as rows of ``phrases`` written backwards; empty ranges have equal ends."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), self.n, np.int64)
        for k in range(phrases.shape[1]):
            live = np.flatnonzero((lengths > k) & (lo < hi))
            if not live.size:
                break
            symbol = phrases[live, k]
            known = symbol < len(self.below) - 1
            lo[live[~known]] = hi[live[~known]] = 0
            live, symbol = live[known], symbol[known]
            base = self.below[symbol]
            lo[live], hi[live] = base + self.rank(symbol, lo[live]), base + self.rank(symbol, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: walk back to the nearest sampled suffix."""
        out = np.empty(len(rows), np.int64)
        left, row, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while left.size:
            hit = self.marks[row + 1] > self.marks[row]
            out[left[hit]] = self.sampled[self.marks[row[hit]]] + steps
            left, row = left[~hit], row[~hit]
            if left.size:
                row = self.before(row)
            steps += 1
        return out
