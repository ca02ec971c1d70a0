"""Raw trip CSV files in either published format.

A catalogue has a row for each file: its header's columns and where each known column stands. It is joined to
the rows by the file that they come from, so files with any mixture of headers are read in one scan, and
neither names of files nor headers come to the driver.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bikenet import schema as S
from bikenet.operators.cleaning import canonical_trips, conform, normalise
from bikenet.session import shared_folder
from bikenet.sources.files import (
    FILE_COLUMN, arrow_knows, empty_files, file_uri, first_lines, first_lines_below, list_files, plain_path, spread,
)

#: Columns that the catalogue places, of both formats.
PLACED = tuple(dict.fromkeys((*S.CURRENT_COLUMNS, *S.LEGACY_COLUMNS)))
#: Bytes of the catalogue up to which it is sent to all tasks; beyond, rows and catalogue are shuffled.
BROADCAST_BYTES = 64 << 20

_CATALOGUE = (
    f"{FILE_COLUMN} string, file_uri string, header array<string>, columns array<string>, schema_version string,"
    " positions array<int>"
)


def version_of(columns: Column) -> Column:
    """``current``, ``legacy`` or ``unknown``, by an array of column names in lower case."""
    return (
        F.when(F.array_contains(columns, "ride_id"), "current")
        .when(F.array_contains(columns, "tripduration"), "legacy").otherwise("unknown")
    )


def header_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """A row for each file below ``path``, written once: names as they stand and in lower case, version, positions.

    Tasks read the head of each file (in a store that only Spark reads, Spark reads its lines). A file of zero bytes has no columns. ``positions`` are those of
    :data:`PLACED`, from 0, NULL for columns that the file lacks.
    """
    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[[FILE_COLUMN, "file_uri"]].assign(
                header=[next(csv.reader([h.removeprefix("\ufeff").rstrip("\r")]), []) for h in batch["header"]])

    heads = first_lines(spread(list_files(spark, path))) if arrow_knows(path) else first_lines_below(spark, path)
    heads = heads.mapInPandas(
        split, f"{FILE_COLUMN} string, file_uri string, header array<string>")
    nothing = empty_files(spark, path).withColumn("header", F.array().cast("array<string>"))
    lower = F.transform("header", lambda name: F.lower(name))
    place = F.transform(F.array(*map(F.lit, PLACED)), lambda name: (F.nullif(F.array_position("columns", name), F.lit(0)) - 1).cast("int"))
    target = shared_folder(spark, "headers")
    (
        heads.unionByName(nothing).withColumn("columns", lower)
        .select(FILE_COLUMN, "file_uri", "header", "columns", version_of(F.col("columns")).alias("schema_version"), place.alias("positions"))
        .write.parquet(target)
    )
    return spark.read.schema(_CATALOGUE).parquet(target)


def placed_rows(spark: SparkSession, path: str, catalogue: DataFrame) -> DataFrame:
    """The rows of all files with every column of :data:`PLACED` as text, absent ones NULL; ``source_file`` and version.

    One scan, whatever the headers are. Where all files have the same header there is nothing to join.
    """
    width, size = catalogue.agg(F.max(F.size("header")), F.sum(F.octet_length("file_uri") + 8 * len(PLACED))).first()
    if not width:
        raise ValueError(f"no files with contents below {path}")
    names = [f"cell {k}" for k in range(width)]
    raw = (
        spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
        .option("header", True).option("recursiveFileLookup", True).csv(path)
    )
    cells = F.array(*(F.col(f"`{n}`") for n in names))
    kinds = catalogue.where(F.size("header") > 0).select("schema_version", "positions").distinct().limit(2).collect()
    if len(kinds) == 1:
        positions = [F.lit(p) for p in kinds[0]["positions"]]
        joined = raw.select(plain_path().alias(FILE_COLUMN), cells.alias("cells"), F.lit(kinds[0]["schema_version"]).alias("schema_version"))
    else:
        positions = [F.col("positions")[k] for k in range(len(PLACED))]
        known = catalogue.select("file_uri", FILE_COLUMN, "schema_version", "positions")
        known = F.broadcast(known) if size <= BROADCAST_BYTES else known
        joined = raw.select(file_uri().alias("file_uri"), cells.alias("cells")).join(known, "file_uri")
    values = [F.when(p.isNotNull(), F.get("cells", p)).alias(n) for n, p in zip(PLACED, positions, strict=True)]
    return joined.select(FILE_COLUMN, "schema_version", *values)


def read_raw_trips(spark: SparkSession, path: str, legacy_key: str = "ride") -> DataFrame:
    """All trip CSV files below ``path`` as canonical trips, whatever header each file has.

    A plain multi-file read would take the columns of a file with another header order by position, silently.
    Files of zero bytes have no trips; columns of no known format are an error.
    """
    catalogue = header_catalogue(spark, path)
    odd = catalogue.where("schema_version = 'unknown' AND size(header) > 0").limit(3).collect()
    if odd:
        raise ValueError(f"unrecognised trip columns {odd[0]['header']} in {[r[FILE_COLUMN] for r in odd]}")
    return canonical_trips(placed_rows(spark, path, catalogue), legacy_key)


def read_uniform_trips(spark: SparkSession, path: str, legacy_key: str = "ride") -> DataFrame:
    """As :func:`read_raw_trips` for files known to share one header, without a catalogue.

    Spark checks every file's header against the first and stops at a difference.
    """
    raw = (
        spark.read.option("header", True).option("enforceSchema", False)
        .option("recursiveFileLookup", True).csv(path)
    )
    return conform(normalise(raw, legacy_key))
