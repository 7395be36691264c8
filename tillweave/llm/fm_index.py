"""FM-index over a sequence of small numbers: suffix order, wavelet-tree ranks, sampled places."""

from __future__ import annotations

import numpy as np


class WaveletTree:
    """Ranks and access over an integer sequence, one bit vector with running counts per bit.

    The levels are stored one below the other, zeros before ones at each level,
    so a symbol's occurrences before a place are found by following the place
    down the levels.  All methods take arrays of queries.
    """

    def __init__(self, sequence: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for bit in range(self.levels - 1, -1, -1):
            up = (sequence >> bit) & 1
            self.ones.append(np.append(0, np.cumsum(up, dtype=np.int32)))
            self.zeros.append(int(len(up) - up.sum()))
            sequence = np.concatenate([sequence[up == 0], sequence[up == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before ``place``."""
        begin = np.zeros_like(place)
        for level, ones in enumerate(self.ones):
            up = (symbol >> (self.levels - 1 - level)) & 1 == 1
            b, p = ones[begin], ones[place]
            begin = np.where(up, self.zeros[level] + b, begin - b)
            place = np.where(up, self.zeros[level] + p, place - p)
        return place - begin

    def access(self, place: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(place)
        for level, ones in enumerate(self.ones):
            before = ones[place]
            up = ones[place + 1] - before
            symbol = symbol * 2 + up
            place = np.where(up == 1, self.zeros[level] + before, place - before)
        return symbol


def suffix_order(sequence: np.ndarray) -> np.ndarray:
    """Places of all suffixes in order, by doubling; every 0 is an end of its own.

    Zeros compare by place, so no comparison goes beyond the run it began in.
    """
    n = len(sequence)
    ends = np.flatnonzero(sequence == 0)
    rank = sequence.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    order = np.argsort(rank, kind="stable")
    step = 1
    while True:
        # Ranks again, as small numbers, equal for what is still equal.
        sorted_rank = rank[order]
        fresh = np.append(0, np.cumsum(sorted_rank[1:] != sorted_rank[:-1]))
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if not n or fresh[-1] == n - 1:
            return order
        # Only suffixes that share their rank with another are still open.
        twin = np.append(fresh[1:] == fresh[:-1], False)
        twin[1:] |= twin[:-1].copy()
        open_at = np.flatnonzero(twin)
        open_order = order[open_at]
        behind = rank[np.minimum(open_order + step, n - 1)] + 1
        behind[open_order + step >= n] = 0
        key = rank[open_order] * np.int64(n + 2) + behind
        by = np.argsort(key, kind="stable")
        order[open_at] = open_order[by]
        wide = rank * np.int64(n + 2)
        wide[open_order] = key
        rank = wide
        step *= 2


class FMIndex:
    """Backward search and location of number sequences in ``sequence``, whose zeros part runs."""

    def __init__(self, sequence: np.ndarray, sigma: int, sample: int = 8):
        self.n = len(sequence)
        order = suffix_order(sequence)
        previous = sequence[order - 1]
        self.tree = WaveletTree(previous, sigma)
        counts = np.bincount(sequence, minlength=sigma)
        self.before = np.append(0, np.cumsum(counts))
        # Sampled: every ``sample``-th place, and the first of a run, whose symbol
        # before is an end, so that no walk has to pass an end.
        kept = (order % sample == 0) | (previous == 0)
        self.marked = kept
        self.mark_rank = np.append(0, np.cumsum(kept))
        self.samples = order[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For phrases of one length, a row each: the range of suffixes that begin with each."""
        count, size = phrases.shape
        low = np.zeros(count, np.int64)
        high = np.full(count, self.n, np.int64)
        live = np.arange(count)
        for column in range(size - 1, -1, -1):
            symbol = phrases[live, column]
            base = self.before[symbol]
            both = self.tree.rank(
                np.concatenate([symbol, symbol]), np.concatenate([low[live], high[live]])
            )
            low[live], high[live] = base + both[: len(live)], base + both[len(live) :]
            live = live[low[live] < high[live]]
            if not len(live):
                break
        dead = low >= high
        low[dead] = high[dead] = 0
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the sequence of the suffixes at ``rows`` of the order."""
        place = np.zeros(len(rows), np.int64)
        walking = np.arange(len(rows))
        at = rows.copy()
        steps = 0
        while len(walking):
            here = self.marked[at]
            done = walking[here]
            place[done] = self.samples[self.mark_rank[at[here]]] + steps
            walking, at = walking[~here], at[~here]
            if len(walking):
                symbol = self.tree.access(at)
                at = self.before[symbol] + self.tree.rank(symbol, at)
            steps += 1
        return place
