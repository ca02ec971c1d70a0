"""An R-tree over group-count points, searched by an upper bound of the overlap.

A point holds, for one set, the number of its tokens in each group. Two sets share at most the sum
of the coordinate minima of their points. A node keeps the coordinate maxima and the least size of
what lies below it, so the same sum against a node bounds every point below.
"""

from __future__ import annotations

import numpy as np

FANOUT = 16


class CountTree:
    """Points packed in the order of their sizes and counts, then in nodes of ``FANOUT``."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((*points.T[:3], sizes))
        self.levels = [(points[self.order], sizes[self.order], sizes[self.order])]
        while len(self.levels[-1][1]) > 1:
            top, least, most = self.levels[-1]
            cuts = np.arange(0, len(least), FANOUT)
            self.levels.append(
                (np.maximum.reduceat(top, cuts), np.minimum.reduceat(least, cuts), np.maximum.reduceat(most, cuts))
            )

    def search(self, point: np.ndarray, size: int, numerator: int, denominator: int) -> np.ndarray:
        """Positions of all points whose Jaccard similarity with this one can reach the threshold.

        With overlap o and sizes a and b, o / (a + b - o) >= t means o >= t / (1 + t) * (a + b).
        """
        nodes = np.zeros(min(1, len(self.order)), dtype=np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            top, least, most = self.levels[depth]
            bound = np.minimum(top[nodes], point).sum(axis=1, dtype=np.int64)
            keep = bound * (numerator + denominator) >= numerator * (size + least[nodes])
            keep &= (denominator * size >= numerator * least[nodes]) & (denominator * most[nodes] >= numerator * size)
            nodes = nodes[keep]
            if depth:
                below = len(self.levels[depth - 1][1])
                nodes = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                nodes = nodes[nodes < below]
        return self.order[nodes]
