"""Nearest neighbours by the permutation index."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from bikenet.llm import permutation_index as index

SCHEMA = "vec_id bigint, embedding array<float>, v int, id int"


def _found(frame, divisor, k=20):
    rows = index.nearest_neighbours(frame, F.col("vec_id") % divisor == 0, k=k).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def _exact(ids, vectors, query, k=20):
    scores = index.scores(vectors, vectors[np.flatnonzero(ids == query)[0]])
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != query][:k]
    return [(int(ids[i]), float(scores[i])) for i in order]


def test_recall_where_candidates_are_few(spark, monkeypatch):
    draw = np.random.default_rng(2)
    middles = draw.normal(size=(10, 32))
    vectors = (middles[draw.integers(0, 10, 6000)] * 0.6 + draw.normal(size=(6000, 32))).astype(np.float32)
    vectors[:1500] = vectors[0] + draw.normal(size=(1500, 32)).astype(np.float32) * 0.01  # a crowd
    monkeypatch.setattr(index, "LEAST_CANDIDATES", 600)
    monkeypatch.setattr(index, "BLOCK_ROWS", 4096)
    monkeypatch.setattr(index, "BLOCK_QUERIES", 40)
    frame = spark.createDataFrame([(i, v.tolist(), 0, 0) for i, v in enumerate(vectors)], SCHEMA)
    found = _found(frame, 60)
    assert len(found) == 100
    ids = np.arange(6000)
    hits = [len(dict(found[q]).keys() & dict(_exact(ids, vectors.astype(float), q)).keys()) / 20 for q in found]
    assert np.mean(hits) >= 0.9


def test_small_table_is_exact_with_ties_to_the_smaller_id(spark, small):
    rows = small("embeddings").collect()
    ids = np.array([r["vec_id"] for r in rows])
    vectors = np.array([r["embedding"] for r in rows], dtype=np.float64)
    found = _found(small("embeddings"), 20)
    assert found == {int(q): _exact(ids, vectors, q) for q in ids if q % 20 == 0}
    same = spark.createDataFrame([(i, [1.0, 2.0], 0, 0) for i in range(50)], SCHEMA)
    assert [i for i, _ in _found(same, 40)[40]] == list(range(20))
    assert [i for i, _ in _found(same, 40)[0]] == list(range(1, 21))


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    frame = spark.createDataFrame(
        [(0, [1.0, 0.0], 0, 0), (1, [0.5, 0.5], 0, 0), (1, [0.5, 0.5], 0, 0), (2, None, 0, 0), (3, [0.0, 0.0], 0, 0),
         (4, [1.0, None], 0, 0), (5, [nan, 1.0], 0, 0), (6, [inf, 1.0], 0, 0), (None, [1.0, 1.0], 0, 0),
         (7, [], 0, 0), (8, [1.0, 2.0, 3.0], 0, 0), (20, [-3.0, 1.0], 0, 0)], SCHEMA)
    assert _found(frame, 20) == {0: [(1, 0.5), (20, -3.0)], 20: [(1, -1.0), (0, -3.0)]}
    assert _found(frame.limit(0), 20) == _found(frame.filter("vec_id = 2"), 1) == {}
