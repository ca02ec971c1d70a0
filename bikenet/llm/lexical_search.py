"""Ranked lexical search: integer term weights, searched exactly by sparse ball trees.

A text's terms are its runs of ASCII letters, digits and bytes from 128 on, with A-Z lowered. Two passes:

1. The texts are read once. Each becomes its number of terms and the counts of those terms that some item
   asks for; this thin table is written. Numbers of texts and terms and the document frequencies come from it.
2. The written vectors are gathered into ball trees of some thousand rows in each task. Each item keeps its
   best documents over all trees of the task, so that later trees are pruned by what earlier ones gave, and
   the tasks' lists are merged, first in shares and then by item.

Items are a stated query set: they go to the tasks in blocks of at most ``BLOCK_BYTES`` of text and
``BLOCK_ITEMS`` rows, and each block is a search of its own. Terms are told apart by 64-bit hashes.

Defined cases: a null or empty text has no term, counts nowhere and is found by nothing. A document without
an id counts in the statistics but is not ranked. Repeated rows are documents of their own, repeated items
are answered each. An item without terms has no rows. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bikenet.llm.ball_tree import BallTree, Best
from bikenet.llm.store import written
from bikenet.llm.text_arrays import PUNCTUATION, column_words

BLOCK_BYTES = 8 << 20
BLOCK_ITEMS = 1 << 15
#: Rows and entries of a tree, at most (a row with more entries makes a tree of its own).
TREE_ROWS = 4096
TREE_ENTRIES = 1 << 20
#: Shares in which the lists of an item are merged first.
SHARES = 64

_VECTOR = "id bigint, n bigint, terms array<int>, counts array<int>"


def item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[object, str]]]:
    """Items one after the other, gathered into bounded blocks."""
    block, held = [], 0
    for row in items.select(F.col(item_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).toLocalIterator():
        size = len(row.text.encode())
        if block and (held + size > BLOCK_BYTES or len(block) >= BLOCK_ITEMS):
            yield block
            block, held = [], 0
        block.append((row.id, row.text))
        held += size
    if block:
        yield block


def item_terms(texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The block's terms as sorted hashes, and for each item the places of its own terms, once each."""
    own: list[np.ndarray] = []
    for _, _, words in column_words(pa.array(texts, pa.string()), PUNCTUATION):
        hashes = words.hashes()
        own += [np.unique(hashes[a:b]) for a, b in zip(words.first[:-1], words.first[1:])]
    known = np.unique(np.concatenate(own))
    return known, [np.searchsorted(known, terms) for terms in own]


def count_terms(column: pa.Array, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text, and for all (text, known term) met: offsets by text, places in ``known`` and counts."""
    n = np.zeros(len(column), dtype=np.int64)
    held = np.zeros(len(column), dtype=np.int64)
    terms, counts = [], []
    for low, high, words in column_words(column, PUNCTUATION):
        n[low:high] = np.diff(words.first)
        hashes = words.hashes()
        at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
        met = known[at] == hashes if len(known) else np.zeros(len(hashes), dtype=bool)
        row = np.repeat(np.arange(high - low), n[low:high])[met]
        pairs, count = np.unique(row * max(len(known), 1) + at[met], return_counts=True)
        row, term = np.divmod(pairs, max(len(known), 1))
        held[low:high] = np.bincount(row, minlength=high - low)
        terms.append(term)
        counts.append(count)
    empty = np.zeros(0, dtype=np.int64)
    return n, np.concatenate([[0], np.cumsum(held)]), np.concatenate([empty, *terms]), np.concatenate([empty, *counts])


def term_vectors(docs: DataFrame, known: np.ndarray, id_column: str, text: str) -> DataFrame:
    """``(id, n, terms, counts)`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, offsets, terms, counts = count_terms(batch.column(1), shared.value)
            offsets = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32()))], ["id", "n", "terms", "counts"])

    return docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text")).mapInArrow(run, _VECTOR)


def term_weight(texts: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * texts + 2) / (2 * holding + 1)))


def impacts(counts: np.ndarray, n: np.ndarray, texts: int, total: int) -> np.ndarray:
    """What each entry adds for each unit of weight; ``n`` are the terms of the entry's text."""
    length = 50 + (50 * n * texts) // total
    return (1_000_000_000 * counts) // (1000 * counts + 20 * length)


def trees(batches: Iterator[pa.RecordBatch], texts: int, total: int) -> Iterator[BallTree]:
    """Ball trees over a task's vectors, some thousand at a time."""
    parts: list[tuple[np.ndarray, ...]] = []
    rows = entries = 0

    def build() -> BallTree:
        ids, lengths, terms, values = (np.concatenate(x) for x in zip(*parts))
        return BallTree(ids, np.concatenate([[0], np.cumsum(lengths)]), terms, values)

    for batch in batches:
        ids, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        offsets = batch.column(2).offsets.to_numpy()
        lengths = np.diff(offsets)
        terms = batch.column(2).values.to_numpy().astype(np.int64)[offsets[0] : offsets[-1]]
        at = batch.column(3).offsets.to_numpy()
        counts = batch.column(3).values.to_numpy().astype(np.int64)[at[0] : at[-1]]
        values = impacts(counts, np.repeat(n, lengths), texts, total)
        offsets = offsets - offsets[0]
        low = 0
        while low < len(ids):
            high = int(np.searchsorted(offsets, offsets[low] + TREE_ENTRIES - entries, side="right")) - 1
            high = min(max(high, low), low + TREE_ROWS - rows, len(ids))
            if high == low and not parts:
                high = low + 1
            if high > low:
                a, b = offsets[low], offsets[high]
                parts.append((ids[low:high], lengths[low:high], terms[a:b], values[a:b]))
                rows, entries, low = rows + high - low, entries + int(b - a), high
            if low < len(ids) or rows >= TREE_ROWS:
                yield build()
                parts, rows, entries = [], 0, 0
    if parts:
        yield build()


def _search_block(docs: DataFrame, block: list[tuple[object, str]], first: int, top: int, names: tuple[str, ...]) -> DataFrame:
    known, places = item_terms([text for _, text in block])
    vectors = written(term_vectors(docs, known, *names), "lexical-vectors")
    texts, total = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    weights = np.full(len(known), term_weight(texts, 0), dtype=np.int64)
    for term, holding in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        weights[term] = term_weight(texts, holding)
    shared = docs.sparkSession.sparkContext.broadcast([(own, weights[own]) for own in places])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        best = [Best(top) for _ in queries]
        for tree in trees(batches, texts, total):
            tree.search(queries, best)
        item = np.repeat(np.arange(len(best)) + first, [len(b.ids) for b in best])
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(np.concatenate([b.ids for b in best])),
             pa.array(np.concatenate([b.scores for b in best]))], ["item", "id", "score"])

    return vectors.filter("id IS NOT NULL AND size(terms) > 0").mapInArrow(run, "item bigint, id bigint, score bigint")


def search(
    docs: DataFrame, items: DataFrame, top: int = 50, id_column: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``(item_id, rank, id, score)``: the ``top`` documents of each item by score, equal ones by id."""
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType.simpleString()
    found = None
    first = 0
    for block in item_blocks(items, item_id, item_text):
        part = _search_block(docs, block, first, top, (id_column, text))
        ids = spark.createDataFrame([(first + k, name) for k, (name, _) in enumerate(block)], f"item bigint, item_id {kind}")
        part = _merge(part.withColumn("share", F.spark_partition_id() % SHARES), top).join(ids, "item")
        found = part if found is None else found.unionByName(part)
        first += len(block)
    if found is None:
        return spark.createDataFrame([], f"{item_id} {kind}, rank int, {id_column} bigint, score bigint")
    return found.select(F.col("item_id").alias(item_id), "rank", F.col("id").alias(id_column), "score")


def _merge(lists: DataFrame, top: int) -> DataFrame:
    for keys in (["item", "share"], ["item"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
        lists = lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return lists


SEARCH_SQL = r"""
WITH words AS (
  SELECT d, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS d, doc_id, text FROM documents)),
counts AS (SELECT d, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT d, sum(tf)::BIGINT AS n FROM counts GROUP BY d),
whole AS (SELECT count(*) AS texts, sum(n)::BIGINT AS total FROM lengths),
asked AS (
  SELECT DISTINCT i, item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(texts) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, whole GROUP BY term),
scored AS (
  SELECT i, item_id, d, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * texts) // total))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (d), whole
  WHERE doc_id IS NOT NULL GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM scored WHERE score > 0)
WHERE rank <= 50"""
