"""Toxicity scores: subword embeddings averaged into a linear softmax.

A word is the mean of the embeddings of its character n-grams (and of the whole word) in a hashed
table, a text the mean of its words, and a softmax layer over that mean gives two classes. Table and
layer are trained jointly. An unseen misspelling shares most of its n-grams with the word it comes
from, and so its vector.

For scoring, the layer is multiplied into the table: the score of a text is linear in its n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bikenet.llm.labelled import held_out, labelled_sample
from bikenet.llm.text_arrays import PUNCTUATION, Words, column_words, prefix_hash, span_hashes
from bikenet.llm.worker_memory import frugal

#: Rows of the embedding table.
BUCKETS = 1 << 19
DIMENSIONS = 8
#: Lengths of n-grams, in bytes of the word between its two marks.
GRAMS = (3, 4, 5)
#: Labelled rows that teach, at most, of each class.
PER_CLASS = 3000
EPOCHS = 200
RATE = 0.05
#: Pull of all entries towards 0.
DECAY = 1e-4
#: Averages are small shares; they are taught in hundredths.
SCALE = 100.0
#: N-grams are taught if at least so many texts of the sample hold them,
LEAST_TEXTS = 5
#: if the classes' shares of such texts are so many standard errors apart,
LEAST_EVIDENCE = 3.0
#: and if they are among so many of the farthest apart: a bound on the features, which all texts' labels in the
#: sample decide. Others say nothing: with few labelled texts a table of all n-grams learns the texts by heart.
TAUGHT = 4096
#: Texts whose averages are laid out as a matrix at once.
ROWS_AT_ONCE = 512

_OPEN, _CLOSE = 60, 62  # marks that no word holds


class Model(NamedTuple):
    """The weight of each bucket in the difference of the two logits, and the constant."""

    weights: np.ndarray
    bias: float


def subwords(words: Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the chosen words' n-grams, with the position in ``chosen`` of each one's word."""
    start, end = words.start[chosen], words.end[chosen]
    length = end - start
    begin = np.cumsum(length + 2) - length - 2
    total = int((length + 2).sum())
    owner = np.repeat(np.arange(len(chosen)), length + 2)
    inside = np.arange(total) - begin[owner]
    marked = words.bytes[np.clip(start[owner] + inside - 1, 0, max(len(words.bytes) - 1, 0))]
    marked[begin] = _OPEN
    marked[begin + length + 1] = _CLOSE
    prefix = prefix_hash(marked)
    room = length[owner] + 2 - inside
    buckets = [span_hashes(prefix, begin, begin + length + 2)]
    owners = [np.arange(len(chosen))]
    for n in GRAMS:
        at = np.flatnonzero(room >= n)
        at = at[length[owner[at]] + 2 > n]  # the whole word is there already
        buckets.append(span_hashes(prefix, at, at + n))
        owners.append(owner[at])
    return (np.concatenate(buckets) & np.uint64(BUCKETS - 1)).astype(np.int64), np.concatenate(owners)


def _evidence(texts: list[str | None], labels: np.ndarray) -> np.ndarray:
    """The buckets whose share of texts differs most between the classes, in standard errors."""
    holds = np.zeros((2, BUCKETS))
    for low, _, words in column_words(pa.array(texts, pa.string()), PUNCTUATION):
        row = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
        _, first, at = np.unique(words.hashes(), return_index=True, return_inverse=True)
        row, word = np.unique(np.stack([row, at]), axis=1)
        buckets, owner = subwords(words, first)
        order = np.argsort(owner, kind="stable")
        size = np.bincount(owner, minlength=len(first))
        begin = np.cumsum(size) - size
        place = np.repeat(begin[word] - np.cumsum(size[word]) + size[word], size[word]) + np.arange(size[word].sum())
        pairs = np.unique(np.repeat(row, size[word]) * BUCKETS + buckets[order][place])
        for value in (0, 1):
            holds[value] += np.bincount(pairs[labels[low + pairs // BUCKETS] == value] % BUCKETS, minlength=BUCKETS)
    rows = np.bincount(labels, minlength=2)[:, None]
    share = (holds + 0.5) / (rows + 1)
    spread = np.sqrt((share * (1 - share) / rows).sum(axis=0))
    distance = np.abs(share[1] - share[0]) / spread
    distance[holds.sum(axis=0) < LEAST_TEXTS] = 0
    best = np.argsort(-distance, kind="stable")[:TAUGHT]
    return np.sort(best[distance[best] >= LEAST_EVIDENCE])


class Averages(NamedTuple):
    """The shares of taught buckets in the averages over each text's words, row after row: few of all are not 0."""

    first: np.ndarray
    bucket: np.ndarray
    share: np.ndarray

    def blocks(self, columns: int) -> Iterator[tuple[slice, np.ndarray]]:
        """The same as matrices of ``ROWS_AT_ONCE`` rows."""
        for low in range(0, len(self.first) - 1, ROWS_AT_ONCE):
            high = min(low + ROWS_AT_ONCE, len(self.first) - 1)
            a, b = self.first[low], self.first[high]
            block = np.zeros((high - low, columns), dtype=np.float32)
            row = np.repeat(np.arange(high - low), np.diff(self.first[low : high + 1]))
            block[row, self.bucket[a:b]] = self.share[a:b]
            yield slice(low, high), block


def _averages(texts: list[str | None], taught: np.ndarray) -> Averages:
    column = np.full(BUCKETS, -1)
    column[taught] = np.arange(len(taught))
    rows, buckets_met, shares = [], [], []
    for low, _, words in column_words(pa.array(texts, pa.string()), PUNCTUATION):
        count = np.diff(words.first)
        row = np.repeat(np.arange(len(count)), count)
        buckets, owner = subwords(words, np.arange(len(words.start)))
        size = np.bincount(owner, minlength=len(words.start))
        kept = column[buckets] >= 0
        owner, place = owner[kept], column[buckets[kept]]
        cells, at = np.unique(row[owner] * len(taught) + place, return_inverse=True)
        share = np.bincount(at, weights=SCALE / size[owner] / count[row[owner]], minlength=len(cells))
        rows.append((low + cells // max(len(taught), 1)).astype(np.int32))
        buckets_met.append((cells % max(len(taught), 1)).astype(np.int32))
        shares.append(share.astype(np.float32))
    row = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int32)
    return Averages(np.searchsorted(row, np.arange(len(texts) + 1)),
                    np.concatenate(buckets_met) if rows else row, np.concatenate(shares) if rows else row)


def train(texts: list[str | None], labels: np.ndarray, share: float) -> Model:
    """Fit on lowered texts. ``share`` is the share of label 1 among all rows, whatever the sample's.

    Rows of one class only, or none, teach nothing: every text gets the score 1/3, and none is rejected.
    """
    n, ones = len(texts), int(labels.sum())
    if not 0 < ones < n:
        return Model(np.zeros(BUCKETS, dtype=np.float32), float(np.log(0.5)))
    taught = _evidence(texts, labels)
    averages = _averages(texts, taught)
    table = np.zeros((len(taught), DIMENSIONS), dtype=np.float32)
    layer = np.random.default_rng(7).normal(0, 1, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, dtype=np.float32)
    weight = np.where(labels == 1, share / ones, (1 - share) / (n - ones)).astype(np.float32)[:, None]
    target = np.eye(2, dtype=np.float32)[labels]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (table, layer, bias)]
    for epoch in range(1, EPOCHS + 1):
        gradients = [DECAY * table, DECAY * layer, np.zeros_like(bias)]
        for rows, block in averages.blocks(len(taught)):
            hidden = block @ table
            logits = hidden @ layer + bias
            chance = np.exp(logits - logits.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            error = (chance - target[rows]) * weight[rows]
            gradients[0] += block.T @ (error @ layer.T)
            gradients[1] += hidden.T @ error
            gradients[2] += error.sum(axis=0)
        for parameter, gradient, (mean, square) in zip((table, layer, bias), gradients, moments):  # Adam
            mean += 0.1 * (gradient - mean)
            square += 0.001 * (gradient**2 - square)
            parameter -= RATE * (mean / (1 - 0.9**epoch)) / (np.sqrt(square / (1 - 0.999**epoch)) + 1e-8)
    weights = np.zeros(BUCKETS, dtype=np.float32)  # an n-gram that was not taught says nothing
    weights[taught] = SCALE * (table @ (layer[:, 1] - layer[:, 0]))
    return Model(weights, float(bias[1] - bias[0]))


def score_column(column: pa.Array, model: Model) -> np.ndarray:
    """The probability of label 1 for each lowered text; one without words has the constant's."""
    out = []
    for _, _, words in column_words(column, PUNCTUATION):
        unique, first, at = np.unique(words.hashes(), return_index=True, return_inverse=True)
        buckets, owner = subwords(words, first)
        of_word = np.bincount(owner, weights=model.weights[buckets], minlength=len(unique)) / np.maximum(
            np.bincount(owner, minlength=len(unique)), 1)
        sums = np.concatenate(([0.0], np.cumsum(of_word[at])))
        count = np.diff(words.first)
        out.append((sums[words.first[1:]] - sums[words.first[:-1]]) / np.maximum(count, 1))
    logits = np.concatenate(out) if out else np.zeros(0)
    return 1 / (1 + np.exp(-np.clip(logits + model.bias, -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> Model:
    """Train on a sample of at most ``per_class`` labelled rows of each class."""
    lowered = docs.select("doc_id", F.lower("text").alias("text"))
    return train(*labelled_sample(lowered, labels, label, per_class))


def with_score(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text (null counts as empty) as a last column.

    A column of that name is replaced.
    """
    docs = docs.drop(score)
    schema = docs.select("*", F.lit(0.0).alias(score)).schema
    lowered = docs.select("*", F.lower(F.col(text)).alias("lowered text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(score_column(batch.column(batch.num_columns - 1), model))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], scores], names=schema.names)

    return lowered.mapInArrow(frugal(run), schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``docs``; ties and repeats score alike."""
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that score below 0.5, with their columns."""
    scored = with_score(docs, model, score="toxicity score")
    return scored.filter(F.col("toxicity score") < 0.5).select(*docs.columns)
