"""Run-length grammar of a sequence by recompression, and longest common extensions on it, many at a time."""

from __future__ import annotations

import numpy as np

from skygrid.llm.set_join import mixed


class Grammar:
    """Levels of a sequence: runs of one symbol become one symbol, then pairs of two kinds of symbols, in turn.

    Equal stretches get equal symbols but at their ends, whatever surrounds them, so two stretches are compared symbol by symbol
    on the highest level on which both start, in a number of steps that grows with the logarithm of their length.

    ``symbols`` are whole numbers below 2**31. Those from ``fence`` on are fences: they must occur once each and are never
    merged; the first and the last symbol are fences. Levels are added until each stretch between fences is one symbol.
    """

    def __init__(self, symbols: np.ndarray, fence: int):
        self.symbols = [np.asarray(symbols, np.int64)]  # of each level
        self.first: list[np.ndarray] = []  # of each level above the lowest: where its symbols begin on the level below, and its end
        self.up: list[np.ndarray] = []  # of each level below the highest: the symbol above
        self.runs: list[bool] = []  # of each level above the lowest: whether it was made of runs
        n_fences = int((self.symbols[0] >= fence).sum())
        self._fences, self._next = (fence, fence + n_fences), fence + n_fences
        turn = 0
        while self._open():
            self._merge_runs()
            self._merge_pairs(turn)
            turn += 1

    def _is_fence(self, s: np.ndarray) -> np.ndarray:
        return (s >= self._fences[0]) & (s < self._fences[1])

    def _open(self) -> bool:
        """Whether two neighbours could still be merged."""
        s = self._is_fence(self.symbols[-1])
        return bool((~s[1:] & ~s[:-1]).any())

    def _add(self, starts: np.ndarray, merged: np.ndarray, codes: np.ndarray, runs: bool) -> None:
        """A level of symbols that begin at ``starts``; those marked in ``merged`` are named by their codes."""
        s = self.symbols[-1]
        above = s[starts]
        names, which = np.unique(codes, return_inverse=True)
        above[merged] = self._next + which
        self._next += len(names)
        begins = np.zeros(len(s), np.int64)
        begins[starts] = 1
        self.up.append(np.cumsum(begins) - 1)
        self.first.append(np.append(starts, len(s)))
        self.symbols.append(above)
        self.runs.append(runs)

    def _merge_runs(self) -> None:
        s = self.symbols[-1]
        starts = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        if len(starts) == len(s):
            return
        length = np.diff(starts, append=len(s))
        merged = length > 1
        self._add(starts, merged, s[starts[merged]] << 32 | length[merged], True)

    def _merge_pairs(self, turn: int) -> None:
        """Symbols are dealt into two kinds; each left one before a right one is merged with it, so pairs never overlap."""
        s = self.symbols[-1]
        salt = np.uint64(0x9E3779B97F4A7C15 * (turn + 1) % 2**64)
        kind = mixed(s.astype(np.uint64) + salt) >> np.uint64(63) == 1
        free = ~self._is_fence(s)
        left, right = kind & free, ~kind & free
        pair = left[:-1] & right[1:]
        other = right[:-1] & left[1:]
        if other.sum() > pair.sum():
            pair = other
        if not pair.any():
            return
        starts = np.flatnonzero(~np.append(False, pair))
        merged = np.append(pair, False)[starts]
        at = starts[merged]
        self._add(starts, merged, s[at] << 32 | s[at + 1], False)

    def _step(self, level: int, x: np.ndarray, y: np.ndarray, back: bool) -> np.ndarray:
        """How far equal symbols reach for certain: one of a pair, or the shorter rest of two runs."""
        if not self.runs[level]:
            return np.ones(len(x), np.int64)
        first, up = self.first[level], self.up[level]
        if back:
            return np.minimum(x - first[up[x]], y - first[up[y]]) + 1
        return np.minimum(first[up[x] + 1] - x, first[up[y] + 1] - y)

    def _at_edge(self, level: int, x: np.ndarray, y: np.ndarray, back: bool) -> np.ndarray:
        first, up = self.first[level], self.up[level]
        if back:
            return (first[up[x] + 1] - 1 == x) & (first[up[y] + 1] - 1 == y)
        return (first[up[x]] == x) & (first[up[y]] == y)

    def extension(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """Symbols that agree from positions ``i`` and ``j`` on (i differs from j), forwards, or backwards; both count.

        Up: on each level two places advance over at most one merged symbol to where both begin one of the level above.
        Down: from the first differing symbols, over what their parts have in common, to the first differing positions.
        """
        sign = -1 if back else 1
        x, y, who = np.array(i, np.int64), np.array(j, np.int64), np.arange(len(i))
        stuck: list[list[tuple]] = [[] for _ in self.symbols]
        for level in range(len(self.up)):
            s = self.symbols[level]
            ready = self._at_edge(level, x, y, back)
            same = ~ready & (s[x] == s[y])
            if same.any():
                by = sign * self._step(level, x[same], y[same], back)
                x[same] += by
                y[same] += by
                ready[same] = self._at_edge(level, x[same], y[same], back)
            stuck[level].append((x[~ready], y[~ready], who[~ready]))
            x, y, who = self.up[level][x[ready]], self.up[level][y[ready]], who[ready]
            if not len(x):
                break
        else:
            s = self.symbols[-1]
            while (same := s[x] == s[y]).any():
                x, y = x + sign * same, y + sign * same
            stuck[-1].append((x, y, who))
        x, y, who = (np.zeros(0, np.int64),) * 3
        for level in range(len(self.up), -1, -1):
            if len(x):
                first = self.first[level]
                x, y = (first[x + 1] - 1, first[y + 1] - 1) if back else (first[x], first[y])
                same = self.symbols[level][x] == self.symbols[level][y]
                if same.any():
                    by = sign * self._step(level, x[same], y[same], back)
                    x[same] += by
                    y[same] += by
            for more in stuck[level]:
                x, y, who = np.append(x, more[0]), np.append(y, more[1]), np.append(who, more[2])
        out = np.empty(len(i), np.int64)
        out[who] = sign * (x - np.asarray(i)[who])
        return out
