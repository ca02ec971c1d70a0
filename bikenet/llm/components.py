"""Connected components of a table of links."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bikenet.llm.store import Tables


def components(links: DataFrame, tables: Tables | None = None) -> DataFrame:
    """``(node, label)`` for the nodes of ``links (a, b)``; label is the smallest node reachable.

    Each round takes the least label among a node and its neighbours, then that label's own label,
    so the rounds grow with the logarithm of the longest path. Minima are combined before each
    shuffle, and each round ends in a written table. Without links the result is empty.
    """
    tables = tables or Tables(links.sparkSession, "components")
    both = tables.write(
        "both", links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .filter("a <> b").distinct())
    labels = tables.write(
        "round-0", both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
        .select("node", F.least("node", "label").alias("label")))
    for step in count(1):
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        )
        lowered = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        onward = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        stepped = tables.write(
            f"round-{step}", lowered.join(onward, "label").select("node", "old", F.least("label", "next").alias("label")))
        tables.drop(f"round-{step - 1}")
        labels = stepped.select("node", "label")
        if stepped.filter("label <> old").isEmpty():
            tables.drop("both")
            return labels
