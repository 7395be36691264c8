"""Links that connect all that is close, without listing all that is close."""

from __future__ import annotations

import numpy as np


class DisjointSets:
    """Disjoint sets over the places 0 to count - 1."""

    def __init__(self, count: int):
        self.parent = list(range(count))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y

    def roots(self) -> np.ndarray:
        return np.fromiter((self.find(i) for i in range(len(self.parent))), np.int64)


def spanning_links(near: np.ndarray, sets: DisjointSets) -> list[tuple[int, int]]:
    """Pairs (row, column) of ``near`` that connect each row and the columns near it.

    ``sets`` holds what earlier calls have connected of the columns and is
    brought up to date.  A row gives one pair, and another only where it joins
    two sets, so there are fewer pairs than rows and columns together.
    """
    rows = np.flatnonzero(near.any(axis=1))
    if not len(rows):
        return []
    first = near.argmax(axis=1)
    out = [(int(r), int(first[r])) for r in rows]
    while True:
        roots = sets.roots()
        # Columns near a row but not yet in the set of the first one near it.
        other = near[rows] & (roots[None, :] != roots[first[rows]][:, None])
        open_rows = other.any(axis=1)
        if not open_rows.any():
            return out
        rows, other = rows[open_rows], other[open_rows]
        for row, column in zip(rows.tolist(), other.argmax(axis=1).tolist()):
            if sets.join(int(first[row]), column):
                out.append((row, column))
