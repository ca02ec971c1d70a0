"""Held-out rows and bounded samples of labelled texts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(id_column: str) -> Column:
    """Whether crc32 of the id as text is divisible by ``FOLDS``; such rows never teach. No id: false."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string")), F.lit(FOLDS)) == 0, F.lit(False))


def teaching_labels(labels: DataFrame, label: str, id_column: str = "doc_id") -> DataFrame:
    """``(id, label)`` of rows that may teach; of an id with several labels, the greater."""
    return (
        labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("id"))
        .groupBy("id").agg(F.max("label").alias("label"))
    )


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, id_column: str = "doc_id", text: str = "text"
) -> tuple[list[str], np.ndarray, float]:
    """Texts and labels of up to ``per_class`` rows of each class, and the share of label 1.

    The rows with the least hash of their id are taken, so the sample is the same on every run; only
    they are brought together, after a join with their few ids. The share counts all rows that may
    teach (0.5 if there are none).
    """
    teaching = teaching_labels(labels, label, id_column)
    share = teaching.agg(F.avg("label")).first()[0]
    chosen = None
    for value in (0, 1):
        part = teaching.filter(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    rows = (
        docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
        .join(F.broadcast(chosen), "id")
        .groupBy("id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id").toArrow()
    )
    return rows.column("text").to_pylist(), rows.column("label").to_numpy(), 0.5 if share is None else float(share)
