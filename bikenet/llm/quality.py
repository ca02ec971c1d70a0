"""Quality scores learnt from preference pairs (Bradley-Terry).

Of a pair of texts, one labelled good and one not, the good one is preferred with the probability
``sigmoid(s(good) - s(bad))``. A text's score s is linear in its features, so the logistic loss is
on feature differences. The share of bad labels gives the quantile of scores at which texts are
told apart; it is taken over the scores of all rows, a sample only teaches the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bikenet.llm.labelled import held_out, labelled_sample
from bikenet.llm.store import written
from bikenet.llm.text_arrays import WHITE, row_runs, texts_of, words_of

#: Labelled rows that teach, at most, of each class.
PER_CLASS = 3000
#: Preference pairs drawn from them.
PAIRS = 40_000
EPOCHS = 300
RATE = 0.05
DECAY = 1e-3
#: Scores from here on are predicted as label 1.
CUT = 0.3
#: Words of a passage, the unit of the features that look for the worst part of a text.
PASSAGE = 40
#: Bins of a histogram of scores.
BINS = 4096

_LINES = np.zeros(256, dtype=bool)
_LINES[10] = True
_KINDS = np.zeros((6, 256), dtype=np.int32)
_KINDS[0, 97:123] = 1  # small letters
_KINDS[1, 65:91] = 1  # capitals
_KINDS[2, 48:58] = 1  # digits
_KINDS[3, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 1  # signs
_KINDS[4, [ord(c) for c in ".,;:!?'\"-"]] = 1  # signs of prose
_KINDS[5, 192:] = 1  # first bytes of other characters


class Model(NamedTuple):
    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float
    #: share of label 1 among all that may teach
    share: float = 0.5


def _distinct(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many different values each run holds."""
    row = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
    order = np.lexsort((hashes, row))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (hashes[order[1:]] != hashes[order[:-1]]) | (row[order[1:]] != row[order[:-1]])
    return np.bincount(row[order[fresh]].astype(np.int64), minlength=len(first) - 1)


def _ranges(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(values)))
    return (sums[first[1:]] - sums[first[:-1]]).astype(np.float64)


def _worst(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The largest sum over ``PASSAGE`` words of a text, as a share of them."""
    sums = np.concatenate(([0], np.cumsum(values)))
    out = np.zeros(len(first) - 1)
    if len(values):
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        start = np.arange(len(values))
        end = np.minimum(start + PASSAGE, first[row + 1])
        start = np.maximum(first[row], end - PASSAGE)
        np.maximum.at(out, row, (sums[end] - sums[start]) / np.maximum(end - start, 1))
    return out


def features(column: pa.Array) -> np.ndarray:
    """A row of features for each text; texts without words get zeros."""
    data, offsets = texts_of(column)
    parts = []
    for low, high in row_runs(offsets):
        edges = offsets[low : high + 1] - offsets[low]
        raw = data[offsets[low] : offsets[high]]
        kinds = [_ranges(kind[raw], edges) for kind in _KINDS]
        words = words_of(data, offsets, low, high, WHITE)
        lines = words_of(data, offsets, low, high, _LINES)
        own, first = words.hashes(), words.first
        count, n_lines = np.diff(first), np.diff(lines.first)
        n, size = np.maximum(count, 1), np.maximum(np.diff(edges), 1)
        letters = np.maximum(kinds[0] + kinds[1], 1)
        same = np.zeros(len(own), dtype=np.int64)
        same[1:] = own[1:] == own[:-1]
        inner = first[:-1][first[:-1] < len(own)]
        same[inner] = 0
        sign_sums = np.concatenate(([0], np.cumsum(_KINDS[3][raw] - _KINDS[4][raw])))
        case_sums = np.concatenate(([0], np.cumsum(_KINDS[1][raw])))
        odd = sign_sums[words.end] > sign_sums[words.start]
        loud = case_sums[words.end] - case_sums[words.start] > 1
        stop = np.isin(raw[np.maximum(words.end - 1, 0)], [46, 33, 63]) if len(own) else odd
        parts.append(np.stack([
            kinds[1] / letters, kinds[2] / size, (kinds[3] - kinds[4]) / size, kinds[4] / size, kinds[5] / size,
            _ranges(words.end - words.start, first) / n / 10, np.log1p(count) / 5,
            _distinct(own, first) / n, np.sqrt(_distinct(own, first) / n), _ranges(same, first) / n,
            1 - _distinct(lines.hashes(), lines.first) / np.maximum(n_lines, 1),
            _ranges(odd, first) / n, np.sqrt(_ranges(odd, first) / n), _ranges(loud, first) / n,
            np.sqrt(_ranges(loud, first) / n), _ranges(stop, first) / n,
            _worst(same, first), _worst(odd, first), _worst(loud, first), _worst(stop, first),
        ], axis=1))
    return np.concatenate(parts) if parts else np.zeros((0, 20))


def train(texts: list[str | None], labels: np.ndarray, share: float) -> Model:
    """Learn from texts with labels; ``share`` is the share of label 1 among all that may teach.

    Without both classes there are no pairs: all scores are alike and lie at the cut.
    """
    x = features(pa.array(texts, pa.string()))
    if not 0 < labels.sum() < len(labels):
        width = x.shape[1]
        return Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0, share)
    middle, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    x = np.clip((x - middle) / spread, -8, 8)
    draw = np.random.default_rng(11)
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    gap = x[draw.choice(good, PAIRS)] - x[draw.choice(bad, PAIRS)]
    weights = np.zeros(x.shape[1])
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for epoch in range(1, EPOCHS + 1):
        doubt = 1 / (1 + np.exp(np.clip(gap @ weights, -60, 60)))
        gradient = -(gap.T @ doubt) / PAIRS + DECAY * weights
        mean += 0.1 * (gradient - mean)
        square += 0.001 * (gradient**2 - square)
        weights -= RATE * (mean / (1 - 0.9**epoch)) / (np.sqrt(square / (1 - 0.999**epoch)) + 1e-8)
    scores = x @ weights
    # the quantile of scores at the share of bad texts, each class weighted by its share of all rows
    weight = np.where(labels == 1, share / len(good), (1 - share) / len(bad))
    order = np.argsort(scores, kind="stable")
    below = int(np.searchsorted(np.cumsum(weight[order]), 1 - share + 1e-9, side="right"))
    around = scores[order][max(below - 1, 0) : below + 1]  # the rows on both sides of the quantile
    return Model(middle, spread, weights, float(around.mean()), share)


def raw_scores(column: pa.Array, model: Model) -> np.ndarray:
    return np.clip((features(column) - model.middle) / model.spread, -8, 8) @ model.weights


def score_column(column: pa.Array, model: Model) -> np.ndarray:
    """Scores from 0 to 1; the threshold quantile comes out as ``CUT``."""
    logits = raw_scores(column, model) - model.threshold + np.log(CUT / (1 - CUT))
    return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Model:
    """Train on a sample of at most ``per_class`` labelled rows of each class."""
    return train(*labelled_sample(docs, labels, label, per_class))


def _ranked(scores: DataFrame, rank: int) -> float:
    """The score with ``rank`` smaller ones or equals before it; exact, by histograms of ever smaller ranges."""
    low, high = scores.agg(F.min("raw"), F.max("raw")).first()
    while low < high:
        step = F.floor((F.col("raw") - low) / (high - low) * BINS)
        bins = (
            scores.filter(F.col("raw").between(low, high)).groupBy(step.alias("bin"))
            .agg(F.count("*").alias("rows"), F.min("raw").alias("low"), F.max("raw").alias("high"))
            .orderBy("bin").collect()
        )
        for one in bins:
            if rank < one["rows"]:
                low, high = one["low"], one["high"]
                break
            rank -= one["rows"]
    return low


def threshold(scores: DataFrame, share: float) -> float:
    """Between the rows around the quantile of all ``raw`` scores at the share of bad texts; 0 without rows."""
    rows = scores.count()
    if not rows:
        return 0.0
    below = int((1 - share) * rows + 1e-6)
    return (_ranked(scores, max(below - 1, 0)) + _ranked(scores, min(below, rows - 1))) / 2


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row; null texts score as empty ones.

    All rows are scored once and their scores written, since the threshold is a quantile of them.
    """
    model = fit(docs, labels)
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(raw_scores(batch.column(1), model))
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], ["doc_id", "raw"])

    scores = written(rows.mapInArrow(run, f"doc_id {kind}, raw double"), "quality-scores")
    cut = threshold(scores, model.share)
    logit = F.col("raw") - F.lit(cut) + F.lit(float(np.log(CUT / (1 - CUT))))
    score = 1 / (1 + F.exp(-F.greatest(F.least(logit, F.lit(500.0)), F.lit(-500.0))))
    return scores.select("doc_id", held_out("doc_id").alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= CUT).cast("int"))
