"""Station feeds: nested JSON documents, station CSV and the Kafka topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bikenet import schema as S


def read_station_info(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per station of the station-information documents at ``path``.

    A file holds one document; with ``multi_line=False`` one document per line.
    """
    docs = spark.read.schema(S.FEED_INFORMATION_SCHEMA).option("multiLine", multi_line).json(path)
    return docs.select(F.explode("data.stations").alias("s")).select("s.*")


def read_station_info_csv(
    spark: SparkSession, path: str, schema: T.StructType = S.STATION_SCHEMA,
) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def explode_snapshots(documents: DataFrame) -> DataFrame:
    """One row per station of each status document, with the feed's ``last_updated``."""
    return documents.select(
        "last_updated", F.explode("data.stations").alias("s"),
    ).select("s.*", "last_updated")


def read_status_snapshots(
    spark: SparkSession, path: str, streaming: bool = False, files_per_trigger: int | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Status documents landed at ``path``, as a batch or as a stream of arriving files.

    A file holds one document; with ``multi_line=False`` one document per line.
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.schema(S.FEED_STATUS_SCHEMA).option("multiLine", multi_line)
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return explode_snapshots(reader.json(path))


def kafka_source_options(
    servers: str, topic: str, starting_offsets: str = "latest",
    max_offsets: int = S.MAX_OFFSETS_PER_TRIGGER,
) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "maxOffsetsPerTrigger": str(max_offsets),
    }


def read_status_stream_kafka(
    spark: SparkSession, servers: str, topic: str, **limits,
) -> DataFrame:
    """Kafka records of the status topic; needs the Kafka connector on the class path."""
    options = kafka_source_options(servers, topic, **limits)
    return spark.readStream.format("kafka").options(**options).load()
