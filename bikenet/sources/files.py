"""File listings, and opening a single file inside a task.

Listings never read contents. The few readers that look into a file directly (the first line of a
CSV file, the members of a zip archive) run inside tasks, one file each, through Arrow's file
systems; these take object-store credentials from the executor's environment.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_COLUMN = "source_file"
_ARROW_SCHEMES = ("file", "s3", "s3a", "s3n", "gs", "gcs", "hdfs", "abfs", "abfss")
_SCHEMES = {"s3a": "s3", "s3n": "s3"}  # Hadoop's names of a scheme, and Arrow's


def plain_path() -> Column:
    """The file path in the form the readers accept back: percent escapes and ``file:`` undone."""
    uri = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return F.regexp_replace(F.url_decode(uri), "^file:/+", "/")


def file_uri() -> Column:
    """The file as Spark names it, cheap enough for every row."""
    return F.col("_metadata.file_path")


def empty_files(spark: SparkSession, path: str) -> DataFrame:
    """``source_file, file_uri`` of files of zero bytes below ``path``, which Spark's readers leave out.

    The store is listed through Hadoop, whatever store it is; only such files are kept. Names that begin
    with a dot or an underscore are hidden, as for Spark.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = []
    if "*" not in path and store.exists(root):
        files = store.listFiles(root, True)
        above = len(store.makeQualified(root).toString())
        while files.hasNext():
            status = files.next()
            if status.getLen() == 0:
                uri = status.getPath().toUri().toString()
                inner = status.getPath().toString()[above:]
                if not re.search(r"/[._]", inner):
                    found.append((re.sub("^file:/+", "/", status.getPath().toString()), uri))
    return spark.createDataFrame(found, f"{FILE_COLUMN} string, file_uri string")


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``source_file``, ``file_uri`` and ``modified`` of every file of some length below ``path``."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True).load(path)
    )
    return files.select(
        plain_path().alias(FILE_COLUMN), file_uri().alias("file_uri"), F.col("modificationTime").alias("modified"))


def spread(rows: DataFrame) -> DataFrame:
    """Deal out rows that each stand for much work evenly over the shuffle partitions.

    The rows are tiny, so without a fixed number adaptive execution would gather them in one task.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(partitions)


def arrow_knows(path: str) -> bool:
    """Whether tasks can open files of that store themselves."""
    scheme, colon, _ = path.partition(":")
    return not colon or "/" in scheme or scheme in _ARROW_SCHEMES


def locate(path: str):
    """Arrow's file system for ``path``, and the path within it."""
    from pyarrow import fs

    if path.startswith(("/", "file:")):
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    scheme, _, rest = path.partition("://")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{quote(rest)}")


def open_file(path: str, stream: bool = False):
    """A local or object-store file, seekable unless ``stream``, which undoes gzip and the like."""
    system, inner = locate(path)
    return system.open_input_stream(inner) if stream else system.open_input_file(inner)


def first_lines(files: DataFrame) -> DataFrame:
    """``source_file, file_uri`` and the first line as ``header``; only the head of each file is read."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(header=[_first_line(path) for path in batch[FILE_COLUMN]])

    return files.select(FILE_COLUMN, "file_uri").mapInPandas(read, f"{FILE_COLUMN} string, file_uri string, header string")


def first_lines_below(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`first_lines` for a folder in a store that only Spark reads, by one scan of its lines."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).where("_metadata.file_block_start = 0").select(
        plain_path().alias(FILE_COLUMN), file_uri().alias("file_uri"), "value", F.monotonically_increasing_id().alias("at"))
    first = F.min_by("value", "at").alias("header")
    return lines.groupBy(FILE_COLUMN, "file_uri").agg(first)


def _first_line(path: str, step: int = 4096) -> str:
    head = b""
    with open_file(path, stream=True) as stream:
        while b"\n" not in head:
            block = stream.read(step)
            if not block:
                break
            head += block
    return head.split(b"\n", 1)[0].rstrip(b"\r").decode("utf-8-sig", errors="replace")
