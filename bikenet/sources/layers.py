"""Parquet layers and result files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from bikenet import schema as S
from bikenet.functions.wkb import decoded


def read_layer(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table; ``key=value`` directories become columns.

    Passing the schema keeps ``year_month`` a string, which type inference would turn into a
    number, and saves the footer reads of schema discovery.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return read_layer(spark, path, S.BRONZE_SCHEMA)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return read_layer(spark, path, S.SILVER_SCHEMA)


def read_hive_glob(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Directories below ``root`` that match ``pattern``, with their partition columns."""
    return spark.read.option("basePath", root).parquet(f"{root.rstrip('/')}/{pattern}")


def read_plain_glob(spark: SparkSession, root: str) -> DataFrame:
    """Every Parquet file below ``root`` without partition columns.

    Of the output of a streaming query Spark reads committed files only, here as well.
    """
    return spark.read.option("recursiveFileLookup", True).parquet(root)


def read_status_layer(spark: SparkSession, path: str) -> DataFrame:
    """The streaming layer; the sink's log restricts the scan to committed files."""
    return read_layer(spark, path, S.STATUS_LAYER_SCHEMA)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """The attribute columns of the neighbourhood score table, geometry not read."""
    return spark.read.parquet(path).select(
        "neighborhood_id", "neighborhood_name", "borough", "accessibility_score",
    )


def read_geo_scores(spark: SparkSession, path: str) -> DataFrame:
    """The score table with its polygons as nested arrays. For other columns alone there is :func:`read_scores`."""
    table = spark.read.parquet(path)
    place = table.columns.index("geometry")
    schema = T.StructType([T.StructField(f.name, S.GEOMETRY) if f.name == "geometry" else f for f in table.schema])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [decoded(c) if i == place else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return table.mapInArrow(decode, schema)


def read_result_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
