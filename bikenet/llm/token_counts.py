"""Token counts behind a cache of content digests.

A text is known by the digest of its normalised content together with that of the tokenizer file.
The model's own normalisation is the identity, so equal counts are certain for equal UTF-8 text only:
the normalised content is the text itself, with null as the empty text. Another model or a changed
file has another digest and never meets these counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LIMIT = 4096
#: Characters that are encoded by one call of the library.
CHUNK = 1 << 18

CACHE_SCHEMA = "digest binary, n_tokens bigint"


@lru_cache(maxsize=2)
def _model(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def tokenizer_version(path: str) -> str:
    """The digest of the tokenizer file."""
    with open(path, "rb") as file:
        return sha256(file.read()).hexdigest()


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts; an empty table where nothing was stored yet."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    exists = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    return spark.read.schema(CACHE_SCHEMA).parquet(path) if exists else spark.createDataFrame([], CACHE_SCHEMA)


def count_texts(texts: DataFrame, model: str) -> DataFrame:
    """``(digest, n_tokens)`` of rows ``(digest, text)``, encoded whole by the library."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _model(model)
        for batch in batches:
            counts: list[int] = []
            waiting: list[str] = []
            size = 0
            for value in batch.column(1):
                waiting.append(value.as_py())
                size += len(waiting[-1])
                if size >= CHUNK:
                    counts += map(len, own.encode(waiting, num_threads=1))
                    waiting, size = [], 0
            if waiting:
                counts += map(len, own.encode(waiting, num_threads=1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return texts.mapInArrow(run, CACHE_SCHEMA)


def token_counts(
    docs: DataFrame, cache: str, model: str, limit: int = LIMIT, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of every row; misses are appended to the table ``cache``.

    Texts of one digest, a third of all rows say, are brought down to one in each task before they
    are shuffled, and only digests that the cache lacks are encoded. Rows of equal text get equal
    counts; a null text counts as empty; ids are only carried along. An empty table adds nothing.
    """
    spark = docs.sparkSession
    version = tokenizer_version(model)
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("id"), content.alias("text"),
        F.unhex(F.sha2(F.concat(F.lit(f"{version}:").cast("binary"), content.cast("binary")), 256)).alias("digest"),
    )
    stored = read_cache(spark, cache)
    single = rows.select("digest", "text").dropDuplicates(["digest"])
    misses = single.join(stored.select("digest"), "digest", "left_anti")
    count_texts(misses, model).write.mode("append").parquet(cache)
    # two jobs that met the same miss at once may both have stored it
    known = read_cache(spark, cache).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    return (
        rows.select("id", F.octet_length("text").cast("bigint").alias("n_bytes"), "digest").join(known, "digest")
        .select(F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
