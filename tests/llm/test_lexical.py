"""Ball trees and ranked search against plain scoring of every document."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bikenet.llm import lexical_search
from bikenet.llm.ball_tree import BallTree, Best
from bikenet.llm.lexical_search import search, trees

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _plain(docs, items, top=50):
    held = [(i, Counter(_terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    texts, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, counts in held:
            n = sum(counts.values())
            m = 100 - 50 + ((50 * n * texts) // total)
            score = sum(math.floor(1000 * math.log((2 * texts + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * counts[t]) // (1000 * counts[t] + 20 * m)) for t in set(_terms(text)) if counts[t])
            if score > 0 and i is not None:
                scored.append((-score, i))
        out += [(item, rank, i, -score) for rank, (score, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def _items(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1.0) for i, t in rows], "item_id bigint, text string, doc_id string, score double")


def _vectors(rng, rows, terms, most):
    lengths = rng.integers(1, most, rows)
    cols = np.concatenate([np.sort(rng.choice(terms, n, replace=False)) for n in lengths])
    return np.concatenate([[0], np.cumsum(lengths)]), cols, rng.integers(1, 900_000, len(cols))


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 400), st.integers(1, 30))
def test_tree_equals_all_scores(seed, rows, top):
    rng = np.random.default_rng(seed)
    indptr, cols, values = _vectors(rng, rows, 60, 12)
    values = values // 10_000 * 10_000  # ties
    ids = rng.permutation(rows)
    queries = [(np.sort(rng.choice(80, 7, replace=False)), rng.integers(0, 9, 7)) for _ in range(9)]
    best = [Best(top) for _ in queries]
    BallTree(ids, indptr, cols, values).search(queries, best)
    for (terms, weights), got in zip(queries, best):
        dense = np.zeros(80, dtype=np.int64)
        dense[terms] = weights
        scores = np.add.reduceat(dense[cols] * values, indptr[:-1])
        want = [(-s, i) for s, i in sorted(zip(-scores, ids)) if s < 0][:top]
        assert list(zip(got.scores, got.ids)) == want


def test_no_bound_is_too_small():
    rng = np.random.default_rng(5)
    indptr, cols, values = _vectors(rng, 700, 90, 20)
    tree = BallTree(np.arange(700), indptr, cols, values)
    weights = rng.integers(0, 30_000, (len(tree.terms), 20))
    bounds = tree.bounds(weights.astype(float))
    scores = np.stack([np.add.reduceat(weights[tree.cols, k] * tree.values, tree.row_start[:-1]) for k in range(20)], axis=1)

    def rows(node):
        low, high = tree.children[node]
        return list(range(low, high)) if high > 0 else rows(-low) + rows(-high)

    for node in range(len(tree.children)):
        assert (bounds[node] >= scores[rows(node)].max(axis=0)).all()


def test_far_subtrees_are_not_opened():
    rng = np.random.default_rng(6)
    parts = [_vectors(rng, 640, 40, 12) for _ in range(4)]  # four vocabularies
    cols = np.concatenate([c + 100 * k for k, (_, c, _) in enumerate(parts)])
    values = np.concatenate([v for *_, v in parts])
    indptr = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p) for p, *_ in parts]))])
    tree = BallTree(np.arange(2560), indptr, cols, values)
    best = [Best(10)]
    opened = tree.search([(np.arange(200, 206), np.arange(1, 7))], best)
    assert len(best[0].ids) == 10 and (best[0].ids // 640 == 2).all()
    assert opened <= 0.4 * sum(high > 0 for _, high in tree.children)


def test_trees_take_every_row_once(monkeypatch):
    monkeypatch.setattr(lexical_search, "TREE_ROWS", 7)
    monkeypatch.setattr(lexical_search, "TREE_ENTRIES", 20)
    rng = np.random.default_rng(7)
    batches, lengths = [], []
    for size in (1, 5, 30, 2):
        n = rng.integers(1, 9, size)
        n[0] = 45  # alone over the limit
        lengths += n.tolist()
        offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
        ones = pa.ListArray.from_arrays(offsets, pa.array(np.arange(n.sum()) % 50, pa.int32()))
        ids = np.arange(len(lengths) - size, len(lengths))
        batches.append(pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n.astype(np.int64)), ones, ones], ["id", "n", "terms", "counts"]))
    made = list(trees(iter(batches), 10, 100))
    assert sorted(i for tree in made for i in tree.ids) == list(range(38))
    assert all(len(tree.ids) <= 7 and (len(tree.ids) == 1 or len(tree.cols) <= 20) for tree in made)
    assert sorted(n for tree in made for n in np.diff(tree.row_start)) == sorted(lengths)


def test_equals_plain_scores(spark, docs, small):
    rows = [(r.doc_id, r.text) for r in small("documents").select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in small("benchmark").collect()]
    frame = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id bigint, text string, item_id string").repartition(5)
    got = sorted((tuple(r) for r in search(frame, _items(spark, items), top=9).collect()), key=str)
    assert got == _plain(rows, items, 9)


def test_edges(spark, docs, edge_rows):
    rows = edge_rows + [(10 + i, "tie tie row") for i in range(5)]
    items = [(1, "tie ROW, tie; unknown"), (2, None), (3, ""), (4, "É ünï WORD7 x"), (4, "a text"), (None, "row"), (6, "the same row")]
    for top in (3, 50):
        got = sorted((tuple(r) for r in search(docs(*rows), _items(spark, items), top=top).collect()), key=str)
        assert got == _plain(rows, items, top)
    assert search(docs(), _items(spark, items)).count() == 0
    assert search(docs(*rows), _items(spark, [])).columns == ["item_id", "rank", "doc_id", "score"]
    assert search(docs((1, None)), _items(spark, items)).count() == 0


def test_blocks_of_items(spark, docs, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 2)
    rows = [(i, f"w{i % 3} w{i % 5} w{i % 7} common") for i in range(40)]
    items = [(i, f"w{i} common") for i in range(5)]
    got = sorted((tuple(r) for r in search(docs(*rows), _items(spark, items), top=6).collect()), key=str)
    assert got == _plain(rows, items, 6)


@pytest.mark.parametrize("text", ["A_b-C9ü", "  ", "\x7f\x00", "ＡＢＣ x", "é́ ẞ"])
def test_terms(text):
    n, offsets, terms, counts = lexical_search.count_terms(pa.array([text]), lexical_search.item_terms([text])[0])
    assert n[0] == len(_terms(text)) and sorted(counts) == sorted(Counter(_terms(text)).values())
