"""Health of the streaming layer."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bikenet import schema as S
from bikenet.functions.temporal import minutes_between
from bikenet.operators.status import empty_stations
from bikenet.sources.files import list_files


class StaleStream(RuntimeError):
    """Raised when the layer is empty or too old."""


def freshness_minutes(
    status: DataFrame, as_of: Column | dt.datetime | None = None,
    threshold: int = S.STALENESS_MINUTES, time_column: str = "processed_at",
) -> DataFrame:
    """One row: newest reading, its age in minutes, the limit and whether it is exceeded.

    ``stale`` is true for a layer without readings.
    """
    if as_of is None:
        as_of = F.current_timestamp()
    elif isinstance(as_of, dt.datetime):
        as_of = F.lit(as_of)
    age = minutes_between(F.col("latest"), as_of)
    return (
        status.agg(F.max(time_column).alias("latest"))
        .select(
            "latest",
            age.alias("age_minutes"),
            F.lit(threshold).alias("threshold_minutes"),
            F.coalesce(age > threshold, F.lit(True)).alias("stale"),
        )
    )


def file_freshness(
    spark: SparkSession, path: str, threshold: int = S.STALENESS_MINUTES,
    as_of: Column | dt.datetime | None = None,
) -> DataFrame:
    """As :func:`freshness_minutes`, from the modification times of the data files at ``path``.

    Of a layer that a stream writes the sink's log tells them, and only files that it has committed count. The newest
    batch of the log is read, however many files there are; earlier ones (back to the last compacted one, which has
    all) only if it added none. Other folders are listed.
    """
    batches = _sink_batches(spark, path)
    if not batches:
        return freshness_minutes(list_files(spark, path, "*.parquet"), as_of, threshold, "modified")
    added = committed_files(spark, batches[:1])
    if len(batches) > 1 and added.isEmpty():
        added = committed_files(spark, batches)
    return freshness_minutes(added, as_of, threshold, "modified")


def committed_files(spark: SparkSession, batches: list[str]) -> DataFrame:
    """``path, modified`` of the files that these batches of a sink's log have added."""
    # Spark's file sources leave the log's folder out, as they do all hidden ones
    lines = spark.sparkContext.textFile(",".join(batches)).filter(lambda line: line.startswith("{"))
    entries = spark.read.schema("path string, modificationTime bigint, action string").json(lines)
    return entries.where("action = 'add'").select("path", F.timestamp_millis("modificationTime").alias("modified"))


def _sink_batches(spark: SparkSession, path: str) -> list[str]:
    """The files of the sink's log from the newest back to the last compacted one; Spark keeps few of them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_spark_metadata")
    store = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not store.exists(folder):
        return []
    names = [status.getPath().getName() for status in store.listStatus(folder)]
    numbered = sorted(((int(n.split(".")[0]), n) for n in names if n.split(".")[0].isdigit()), reverse=True)
    kept = []
    for _, name in numbered:
        kept.append(f"{path.rstrip('/')}/_spark_metadata/{name}")
        if name.endswith(".compact"):
            break
    return kept


def require_fresh(freshness: DataFrame) -> DataFrame:
    """Pass the freshness row through, or raise when the layer is empty or too old."""
    row = freshness.first()
    if row["latest"] is None:
        raise StaleStream("the streaming layer holds no data")
    if row["stale"]:
        raise StaleStream(
            f"newest data is {row['age_minutes']:.1f} minutes old, "
            f"limit {row['threshold_minutes']} minutes"
        )
    return freshness


def empty_station_metrics(availability: DataFrame) -> DataFrame:
    """One row: empty stations and all stations."""
    return availability.agg(
        F.count_if(F.col("num_bikes_available") == 0).alias("empty_station_count"),
        F.count("*").alias("total_station_count"),
    )


def empty_station_sample(availability: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` empty stations by id, for a log message."""
    return empty_stations(availability).orderBy("station_id").limit(n)


def health_report(
    freshness: DataFrame, availability: DataFrame, lag: DataFrame | None = None,
) -> DataFrame:
    """Independent checks as rows. Empty stations are reported and never fail the check."""
    parts = [
        freshness.select(
            F.lit("freshness").alias("check"),
            F.col("age_minutes").alias("value"),
            F.col("threshold_minutes").cast("double").alias("threshold"),
            (~F.col("stale")).alias("ok"),
        ),
        empty_station_metrics(availability).select(
            F.lit("empty_stations").alias("check"),
            F.col("empty_station_count").cast("double").alias("value"),
            F.lit(None).cast("double").alias("threshold"),
            F.lit(True).alias("ok"),
        ),
    ]
    if lag is not None:
        parts.append(lag.select(
            F.lit("stream_lag").alias("check"),
            F.col("total_lag").cast("double").alias("value"),
            F.col("threshold").cast("double").alias("threshold"),
            "ok",
        ))
    return reduce(DataFrame.unionByName, parts)
