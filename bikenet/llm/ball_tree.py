"""Exact largest inner products over sparse integer vectors by a ball tree.

A node has the centroid of its vectors, the radius around it and the largest value in each coordinate. For
weights ``q`` no vector of the node scores more than ``q . centroid + |q| * radius`` and none more than
``q . largest``; the less of both, rounded up past any error of the doubles, bounds the node. Nodes are
opened by falling bound until none can reach the weakest result kept. Leaves are scored in 64-bit integers.
"""

from __future__ import annotations

import heapq

import numpy as np

LEAF_ROWS = 32
#: Queries whose bounds are worked out at once.
QUERY_BLOCK = 128
#: Relative and absolute room for errors of doubles: far above what sums of some thousand terms can be off.
SLACK = 1e-9


class BallTree:
    """Vectors as rows of ``(indptr, cols, values)``, each with an entry at least; values are positive integers."""

    def __init__(self, ids: np.ndarray, indptr: np.ndarray, cols: np.ndarray, values: np.ndarray):
        self.terms, local = np.unique(cols, return_inverse=True)
        self._indptr, self._cols, self._values = indptr, local, values
        self._norms = np.add.reduceat((values.astype(np.float64) ** 2), indptr[:-1])
        centroids, largest, self.radius, self.children, order = [], [], [], [], []
        self._build(np.arange(len(ids)), centroids, largest, order)
        self.centroids, self.largest = np.stack(centroids), np.stack(largest)
        self.radius = np.array(self.radius)
        order = np.concatenate(order)
        place, self.row_start = self._entries(order)
        self.ids, self.cols, self.values = ids[order], local[place], values[place]
        del self._indptr, self._cols, self._values, self._norms

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the rows' entries, one row after the other, and where each row starts (and the end)."""
        length = np.diff(self._indptr)[rows]
        start = np.concatenate([[0], np.cumsum(length)])
        return np.repeat(self._indptr[rows] - start[:-1], length) + np.arange(start[-1]), start

    def _build(self, rows: np.ndarray, centroids: list, largest: list, order: list) -> int:
        node = len(centroids)
        place, start = self._entries(rows)
        cols, values = self._cols[place], self._values[place].astype(np.float64)
        centre = np.bincount(cols, weights=values, minlength=len(self.terms)) / len(rows)
        most = np.zeros(len(self.terms))
        np.maximum.at(most, cols, values)
        norm = centre @ centre

        def dots(vector: np.ndarray) -> np.ndarray:
            return np.add.reduceat(values * vector[cols], start[:-1])

        away = self._norms[rows] - 2 * dots(centre) + norm
        room = SLACK * (self._norms[rows].max() + norm)
        centroids.append(centre)
        largest.append(most)
        self.radius.append(float(np.sqrt(max(away.max(), 0) + room)))
        self.children.append(None)
        if len(rows) <= LEAF_ROWS:
            low = sum(map(len, order))
            order.append(rows)
            self.children[node] = (low, low + len(rows))
            return node

        def dense(k: int) -> np.ndarray:
            vector = np.zeros(len(self.terms))
            vector[cols[start[k] : start[k + 1]]] = values[start[k] : start[k + 1]]
            return vector

        one = dense(int(away.argmax()))
        from_one = self._norms[rows] - 2 * dots(one)
        side = dots(one - dense(int(from_one.argmax())))
        halves = np.argsort(side, kind="stable")
        cut = len(rows) // 2
        left = self._build(rows[halves[:cut]], centroids, largest, order)
        right = self._build(rows[halves[cut:]], centroids, largest, order)
        self.children[node] = (-left, -right)  # negative: nodes, not places
        return node

    def bounds(self, weights: np.ndarray) -> np.ndarray:
        """For each node (row) and each column of ``weights`` a number that no score of the node exceeds."""
        ball = self.centroids @ weights + self.radius[:, None] * np.sqrt((weights ** 2).sum(axis=0))
        return np.minimum(ball, self.largest @ weights) * (1 + SLACK) + 1

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], best: list[Best]) -> int:
        """Add the vectors that score best for each query of ``(terms, weights)``; returns the leaves scored."""
        opened = 0
        for first in range(0, len(queries), QUERY_BLOCK):
            block = range(first, min(first + QUERY_BLOCK, len(queries)))
            weights = np.zeros((len(self.terms), len(block)), dtype=np.int64)
            for k, query in enumerate(block):
                terms, own = queries[query]
                at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
                here = self.terms[at] == terms
                weights[at[here], k] = own[here]
            bounds = self.bounds(weights.astype(np.float64))
            weights = np.ascontiguousarray(weights.T)
            for k, query in enumerate(block):
                if weights[k].any():
                    opened += self._best_first(weights[k], bounds[:, k], best[query])
        return opened

    def _best_first(self, weights: np.ndarray, bounds: np.ndarray, best: Best) -> int:
        opened, waiting = 0, [(-bounds[0], 0)]
        while waiting:
            bound, node = heapq.heappop(waiting)
            if -bound < best.least:
                break
            low, high = self.children[node]
            if high < 0:
                heapq.heappush(waiting, (-bounds[-low], -low))
                heapq.heappush(waiting, (-bounds[-high], -high))
                continue
            opened += 1
            a, b = self.row_start[low], self.row_start[high]
            best.add(self.ids[low:high], np.add.reduceat(
                weights[self.cols[a:b]] * self.values[a:b], self.row_start[low:high] - a))
        return opened


class Best:
    """The ``size`` greatest positive scores so far; of equal ones those of smaller ids."""

    def __init__(self, size: int):
        self.size, self.least = size, 1
        self.ids = np.zeros(0, dtype=np.int64)
        self.scores = np.zeros(0, dtype=np.int64)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        kept = scores >= self.least
        if not kept.any():
            return
        ids, scores = np.concatenate([self.ids, ids[kept]]), np.concatenate([self.scores, scores[kept]])
        first = np.lexsort((ids, -scores))[: self.size]
        self.ids, self.scores = ids[first], scores[first]
        if len(first) == self.size:
            self.least = int(self.scores[-1])
