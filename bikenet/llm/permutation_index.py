"""Approximate nearest neighbours by a permutation index.

Pivots are a small sample of the vectors. Every vector is represented by its ``LISTED`` nearest pivots
in their order, and posted under each of them, with its place in that order, in the pivots' inverted
files. A query reads only the files of its own ``VISITED`` nearest pivots and ranks what it finds by the
footrule: the sum over the pivots of the distance between the two places, where a pivot that is not listed
counts as if it came right behind the list. The first ``SHARE`` of the rows, at least ``LEAST_CANDIDATES``,
are reranked by the exact inner product. A crowd of near copies would take all these places, so rows
are taken on until those taken have half as many different sets of three nearest pivots.

Vectors are not normalised for the result; for the order of pivots one more coordinate makes all of
them as long as the longest, after which the nearest by distance is the largest by inner product.

Rows and queries are dealt to blocks of bounded size and each block of rows meets each block of
queries once, in a task of its own; a task keeps the best of its block for each query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bikenet.llm.store import written

#: The more pivots, the shorter their files: a row is in ``LISTED`` of them, a query reads ``VISITED``.
PIVOTS = 1024
LISTED = 96
VISITED = 64
#: Rows among which the pivots are chosen: those with the least hash of their id.
PIVOT_SAMPLE = 4096
SHARE = 0.04
LEAST_CANDIDATES = 1000
NEAREST = 20
#: Rows of the index that one task searches, and queries that it answers.
BLOCK_ROWS = 32_768
BLOCK_QUERIES = 2048


def usable(vector: Column) -> Column:
    """Neither null nor zero nor holding null or non-finite components."""
    def sound(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    return F.coalesce(F.forall(vector, sound) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def spread_pivots(sample: np.ndarray) -> np.ndarray:
    """Up to ``PIVOTS`` of the sampled vectors, in their order, none close to an earlier one.

    Close is half the median distance to the first; pivots side by side would count one place twice.
    """
    close = np.median(np.linalg.norm(sample - sample[0], axis=1)) / 2
    chosen, count = np.zeros((min(PIVOTS, len(sample)), sample.shape[1])), 0
    for vector in sample:
        if not count or np.linalg.norm(chosen[:count] - vector, axis=1).min() > close:
            chosen[count] = vector
            count += 1
        if count == len(chosen):
            break
    return chosen[:count]


class PivotOrder:
    """Orders of the pivots as seen from vectors. ``longest`` is the greatest norm of all vectors."""

    def __init__(self, pivots: np.ndarray, longest: float):
        self.longest = longest
        self.pivots = self._even(pivots)

    def _even(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.longest**2 - (vectors**2).sum(axis=1), 0)
        return np.concatenate((vectors, np.sqrt(rest)[:, None]), axis=1)

    def nearest(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """The nearest pivots of each vector, nearest first, ties to the earlier pivot."""
        own = np.concatenate((vectors, np.zeros((len(vectors), 1))), axis=1) if query else self._even(vectors)
        away = -own @ self.pivots.T if query else (self.pivots**2).sum(axis=1) - 2 * own @ self.pivots.T
        listed = min(VISITED if query else LISTED, away.shape[1])
        first = np.sort(np.argpartition(away, listed - 1, axis=1)[:, :listed], axis=1)
        order = np.argsort(np.take_along_axis(away, first, axis=1), axis=1, kind="stable")
        return np.take_along_axis(first, order, axis=1)

    def all_nearest(self, vectors: np.ndarray, step: int = 4096) -> np.ndarray:
        """As :func:`nearest`, some thousand vectors at a time."""
        return np.concatenate([self.nearest(vectors[a : a + step]) for a in range(0, len(vectors), step)])


class InvertedFiles:
    """For each pivot the rows that list it, and the place where they do."""

    def __init__(self, orders: np.ndarray, pivots: int):
        rows, listed = orders.shape
        pivot = orders.ravel()
        order = np.argsort(pivot, kind="stable")
        self.rows = (order // max(listed, 1)).astype(np.int32)
        self.places = (order % max(listed, 1)).astype(np.int32)
        self.cuts = np.searchsorted(pivot[order], np.arange(pivots + 1))
        self.size, self.listed = rows, listed

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """The footrule between an order and that of every row."""
        apart = self.listed * (self.listed + 1) // 2 + (self.listed - np.arange(len(order))).sum()  # nothing in common
        total = np.full(self.size, apart, dtype=np.int32)
        for place, pivot in enumerate(order):
            low, high = self.cuts[pivot], self.cuts[pivot + 1]
            there = self.places[low:high]
            total[self.rows[low:high]] += np.abs(there - place) - (self.listed - there) - (self.listed - place)
        return total


def scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed from the first component to the last."""
    total = np.zeros(len(vectors))
    for d in range(vectors.shape[1]):
        total += vectors[:, d] * query[d]
    return total


def search_block(
    order: PivotOrder, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the queries their best rows of one block: query ids, row ids and scores."""
    by_id = np.argsort(ids, kind="stable")
    ids, vectors = ids[by_id], np.ascontiguousarray(vectors[by_id])
    # Equal vectors are one point of the index, so that many of them don't take all the candidates.
    # They tie, so of each point only the least ids can be among the nearest.
    _, first, point = np.unique(
        vectors.view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel(),
        return_index=True, return_inverse=True)
    members = np.argsort(point, kind="stable")
    begins = np.searchsorted(point[members], np.arange(len(first) + 1))
    orders = order.all_nearest(vectors[first])
    files = InvertedFiles(orders, len(order.pivots))
    corner = np.sort(orders[:, :3], axis=1) @ len(order.pivots) ** np.arange(min(3, orders.shape[1]))
    wanted = max(LEAST_CANDIDATES, int(np.ceil(SHARE * len(first)))) + 1  # and the query itself
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for query_id, query, own in zip(query_ids, queries, order.nearest(queries, query=True)):
        points = np.arange(len(first))
        if wanted < len(first):
            # of equal footrules the smaller id
            ranked = files.footrule(own).astype(np.int64) * len(ids) + first
            taken = wanted
            while True:
                points = np.argpartition(ranked, taken - 1)[:taken]
                if taken == len(first) or 2 * len(np.unique(corner[points])) >= wanted:
                    break
                taken = min(2 * taken, len(first))
        length = np.minimum(begins[points + 1] - begins[points], k + 1)
        place = np.repeat(begins[points] - np.cumsum(length) + length, length) + np.arange(length.sum())
        rows = np.sort(members[place])
        rows = rows[ids[rows] != query_id]
        found = scores(vectors[rows], query)
        best = np.argsort(-found, kind="stable")[:k]
        out.append((np.full(len(best), query_id), ids[rows[best]], found[best]))
    return tuple(np.concatenate(part) for part in zip(*out)) if out else (ids[:0], ids[:0], np.zeros(0))


def nearest_neighbours(
    rows: DataFrame, is_query: Column, id_column: str = "vec_id", vector: str = "embedding", k: int = NEAREST
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query row its ``k`` nearest found rows but itself.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows
    without an id or of another dimension than the most frequent (of equally frequent ones the least).
    Of rows that repeat an id the one with the greatest vector is taken. Equal scores go to the
    smaller id. An empty table gives an empty result, and fewer rows than ``k`` give all of them.
    """
    spark = rows.sparkSession
    schema = "query_id bigint, vec_id bigint, score double"
    sound = written(
        rows.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector).alias("v"), is_query.alias("asks"))
        .filter(F.col("id").isNotNull() & usable(F.col("v")))
        .groupBy("id").agg(F.max("v").alias("v"), F.max("asks").alias("asks")),
        "vectors",
    ).withColumn("v", F.col("v").cast("array<double>"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    shapes = (
        sound.groupBy(F.size("v").alias("width"))
        .agg(F.count("*").alias("rows"), F.max(norm).alias("longest"), F.count_if("asks").alias("queries"))
        .orderBy(F.desc("rows"), "width").limit(1).collect()
    )
    empty = spark.createDataFrame([], schema)
    if not shapes:
        return _ranked(empty, k)
    width, count, longest, asked = shapes[0]
    sound = sound.filter(F.size("v") == width)
    sample = sound.orderBy(F.xxhash64("id"), "id").limit(PIVOT_SAMPLE).select("v").toArrow()
    order = PivotOrder(spread_pivots(_matrix(sample.column(0), width)), float(longest))

    row_blocks, query_blocks = -(-count // BLOCK_ROWS), max(1, -(-asked // BLOCK_QUERIES))
    def blocked(frame: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        return (
            frame.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias(own))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
        )

    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        found = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
        if candidates.num_rows and queries.num_rows:
            found = search_block(
                order, candidates.column("id").to_numpy(), _matrix(candidates.column("v"), width),
                queries.column("id").to_numpy(), _matrix(queries.column("v"), width), k)
        return pa.table({
            "query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()),
            "score": pa.array(found[2], pa.float64())})

    found = (
        blocked(sound, "row_block", row_blocks, "query_block", query_blocks).groupBy("row_block", "query_block")
        .cogroup(blocked(sound.filter("asks"), "query_block", query_blocks, "row_block", row_blocks)
                 .groupBy("row_block", "query_block"))
        .applyInArrow(search, schema)
    )
    return _ranked(found, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
