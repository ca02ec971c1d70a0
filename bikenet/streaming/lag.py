"""Lag of a streaming query, from its own progress reports.

The job that runs a query writes its reports into a log, a table by date beside the checkpoint
(:func:`follow`), so that another process can tell the lag without the query (:func:`stored_lag`).
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bikenet.schema import LAG_LIMIT

_OFFSETS = "source string, topic string, partition string, end_offset long, latest_offset long"


def offset_rows(progress: Iterable[dict[str, Any]]) -> list[tuple]:
    """End and latest offset per topic partition, of the newest report that has each of them.

    A topic's partitions are few, so these are driver-side rows. A partition that is not yet
    processed counts from 0.
    """
    newest: dict[tuple[str, str, str], tuple] = {}
    for report in progress:
        for source in report.get("sources", []):
            name = source.get("description", "")
            end, latest = (_as_dict(source.get(k)) for k in ("endOffset", "latestOffset"))
            for topic, partitions in latest.items():
                if not isinstance(partitions, dict):
                    continue
                done = end.get(topic) or {}
                for partition, offset in partitions.items():
                    key = (name, topic, partition)
                    newest[key] = (*key, int(done.get(partition, 0)), int(offset))
    return list(newest.values())


def partition_lag(spark: SparkSession, progress: Iterable[dict[str, Any]]) -> DataFrame:
    """One row per topic partition with ``lag`` = latest minus processed offset."""
    rows = spark.createDataFrame(offset_rows(progress), _OFFSETS)
    return rows.withColumn("lag", F.col("latest_offset") - F.col("end_offset"))


def stream_lag(
    spark: SparkSession, progress: Iterable[dict[str, Any]], topic: str | None = None,
    threshold: int = LAG_LIMIT,
) -> DataFrame:
    """One row: total lag, the limit and whether it is kept."""
    lag = partition_lag(spark, progress)
    if topic:
        lag = lag.where(F.col("topic") == topic)
    total = F.coalesce(F.sum("lag"), F.lit(0))
    return lag.agg(total.alias("total_lag")).select(
        "total_lag", F.lit(threshold).alias("threshold"),
        (F.col("total_lag") <= threshold).alias("ok"),
    )


def query_progress(query) -> list[dict[str, Any]]:
    """Progress reports of a running query as plain dictionaries."""
    return [json.loads(p.json) if hasattr(p, "json") else dict(p) for p in query.recentProgress]


#: A report as the log keeps it, and the date that it is filed under.
REPORTS = "query string, run string, batch bigint, reported_at timestamp, report string, report_date date"

_SOURCES = "sources array<struct<description: string, endOffset: string, latestOffset: string>>"
_TOPICS = "map<string, map<string, bigint>>"


def append_reports(spark: SparkSession, reports: list[dict[str, Any]], log: str) -> None:
    """Add reports to the log; those of one call make one file a date."""
    rows = [(r.get("id"), r.get("runId"), r.get("batchId"), r["timestamp"], json.dumps(r)) for r in reports]
    if not rows:
        return
    frame = spark.createDataFrame(rows, "query string, run string, batch bigint, at string, report string")
    at = F.to_timestamp("at")
    frame = frame.select("query", "run", "batch", at.alias("reported_at"), "report", F.to_date(at).alias("report_date"))
    frame.coalesce(1).write.mode("append").partitionBy("report_date").parquet(log)


def follow(query: StreamingQuery, log: str, seconds: int = 60) -> None:
    """Wait for a query to end, and write its reports into the log as they come, the last ones also when it fails.

    The reports are asked for, so no port is opened for a listener to be called back on.
    """
    seen: set[tuple] = set()

    def file_new() -> None:
        new = [r for r in query_progress(query) if (r["runId"], r["batchId"], r["timestamp"]) not in seen]
        seen.update((r["runId"], r["batchId"], r["timestamp"]) for r in new)
        append_reports(SparkSession.active(), new, log)

    try:
        while not query.awaitTermination(seconds):
            file_new()
    finally:
        file_new()


def read_reports(spark: SparkSession, log: str, days: int = 2, as_of: Column | None = None) -> DataFrame:
    """Reports of the last ``days`` dates; directories of older ones are not read."""
    until = F.current_date() if as_of is None else F.to_date(as_of)
    reports = spark.read.schema(REPORTS).parquet(log)
    return reports.where((F.col("report_date") > F.date_sub(until, days)) & (F.col("report_date") <= until))


def reported_offsets(reports: DataFrame) -> DataFrame:
    """``query, source, topic, partition, end_offset, latest_offset, lag`` from the newest report of each.

    A partition that no report has as processed counts from 0. Sources without topics have no rows.
    """
    sources = reports.select("query", "reported_at", "batch", F.explode(F.from_json("report", _SOURCES)["sources"]).alias("s"))
    topics = sources.select(
        "query", "reported_at", "batch", F.col("s.description").alias("source"),
        F.from_json("s.endOffset", _TOPICS).alias("ends"), F.explode(F.from_json("s.latestOffset", _TOPICS)).alias("topic", "latest"))
    each = topics.select("query", "reported_at", "batch", "source", "topic", "ends", F.explode("latest").alias("partition", "latest_offset"))
    end = F.coalesce(F.try_element_at(F.try_element_at("ends", F.col("topic")), F.col("partition")), F.lit(0))
    newest = F.max_by(F.struct(end.alias("end_offset"), "latest_offset"), F.struct("reported_at", "batch"))
    return (
        each.groupBy("query", "source", "topic", "partition").agg(newest.alias("n"))
        .select("query", "source", "topic", "partition", "n.*")
        .withColumn("lag", F.col("latest_offset") - F.col("end_offset"))
    )


def stored_lag(reports: DataFrame, topic: str | None = None, threshold: int = LAG_LIMIT) -> DataFrame:
    """As :func:`stream_lag`, from stored reports. Without any the total is NULL, which is no failure."""
    lag = reported_offsets(reports)
    lag = lag if topic is None else lag.where(F.col("topic") == topic)
    return lag.agg(F.sum("lag").alias("total_lag")).select(
        "total_lag", F.lit(threshold).alias("threshold"),
        F.coalesce(F.col("total_lag") <= threshold, F.lit(True)).alias("ok"),
    )


def _as_dict(offset: Any) -> dict[str, Any]:
    if isinstance(offset, str):
        try:
            offset = json.loads(offset)
        except ValueError:
            return {}
    return offset if isinstance(offset, dict) else {}
