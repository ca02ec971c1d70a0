"""From raw documents to token ids: five stages over the table ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; :func:`run` writes each result as
Parquet below ``spark.checkpoint.dir`` and reads it again for the next stage, so a lost executor costs
at most a part of one stage. All but the last return the columns of ``documents``.

Rows without an id are kept wherever the stage's decision does not need one. A null text is an empty
document: it scores as an empty text, is near no other, holds no leak and no secret, and has no tokens.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikenet.llm import bpe, decontamination, jaccard_join, secrets, toxicity
from bikenet.llm.store import written
from bikenet.session import ship_package

TOKENIZER = "byte_bpe_50k.json"


#: Rows and bytes that Spark hands to a Python worker at once. Its defaults of 10 000 and 64 MB make batches of tens of
#: megabytes of texts and as many again of what is worked out from them; a session that sets its own numbers keeps them.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20
_BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", BATCH_ROWS),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", BATCH_BYTES),
}


def _ready(spark: SparkSession) -> None:
    """The package on the executors, and batches that suit whole texts."""
    ship_package(spark)
    for key, (default, own) in _BATCH.items():
        if spark.conf.get(key) == default:
            spark.conf.set(key, own)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that score 0.5 or more; the model learns from the labelled ones among ``docs``."""
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each group of similar documents the one with the smallest id.

    Rows without an id are kept: nothing says which of their group they would stand for. Rows that
    repeat an id are kept or dropped together.
    """
    _ready(spark)
    groups = jaccard_join.similar_texts(docs)
    dropped = groups.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontamination.without_leaks(docs, _table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; ``n_chars`` follows."""
    _ready(spark)
    clean = secrets.without_secrets(docs)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, tokens)`` of every document."""
    _ready(spark)
    tokens = bpe.encode(docs.select("doc_id", "text"), public_tokenizers.path(TOKENIZER))
    return tokens.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), "tokens")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_leaked),
    ("secret_scans", mask_secrets),
    ("bpe_encoding", encode),
]

#: SQL can state neither a trained model nor the merges; ``tests/llm`` holds the rows of :func:`run`
#: against a brute-force version of each stage.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
