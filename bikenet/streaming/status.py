"""Station status: snapshot documents to messages, messages to the partitioned layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bikenet import schema as S
from bikenet.sinks import message_values


def build_messages(
    snapshots: DataFrame, ingested_at: str = "last_updated", missing_id: str = "error",
) -> DataFrame:
    """The eight published fields of each station; absent numbers are 0, an absent id an error.

    With ``missing_id="drop"`` rows without an id are left out instead. A stream needs that, as it
    would meet the same row again after each restart; the observation ``status_messages`` in its
    progress counts them as ``without_station``. ``ingested_at`` is the time of the feed document.
    """
    if missing_id not in ("error", "drop"):
        raise ValueError(f"missing_id must be 'error' or 'drop', not {missing_id!r}")
    present = set(snapshots.columns)

    def number(name: str, dtype) -> Column:
        column = F.col(name) if name in present else F.lit(None)
        return F.coalesce(column, F.lit(0)).cast(dtype).alias(name)

    if "station_id" not in present:
        raise ValueError("status rows need a station_id")
    station = F.col("station_id").cast("string")
    if missing_id == "drop":
        snapshots = snapshots.observe(
            "status_messages", F.count_if(station.isNull()).alias("without_station"),
        ).where(station.isNotNull())
    checked = F.when(station.isNull(), F.raise_error("status row without station_id").cast("string"))
    numbers = [
        number(f.name, f.dataType)
        for f in S.STATUS_SCHEMA if f.name not in ("station_id", "ingested_at")
    ]
    return snapshots.select(
        checked.otherwise(station).alias("station_id"), *numbers,
        F.col(ingested_at).cast("long").alias("ingested_at"),
    )


def explode_payload(records: DataFrame, drop_malformed: bool = False) -> DataFrame:
    """Message fields and the record time. An unreadable payload gives a row of NULLs."""
    payload = F.from_json(F.col("value").cast("string"), S.STATUS_SCHEMA)
    parsed = records.select(payload.alias("data"), F.col("timestamp").alias("kafka_timestamp"))
    parsed = parsed.select("data.*", "kafka_timestamp")
    return parsed.where(F.col("station_id").isNotNull()) if drop_malformed else parsed


def stamp_processing(df: DataFrame) -> DataFrame:
    """Add the processing time, one value per micro-batch, and its date."""
    now = F.current_timestamp()
    return df.withColumns({"processed_at": now, "processing_date": F.to_date(now)})


def build_status_stream(records: DataFrame, drop_malformed: bool = False) -> DataFrame:
    """Records with ``value`` and ``timestamp`` as rows of the status layer."""
    return stamp_processing(explode_payload(records, drop_malformed))


def start_status_sink(
    stream: DataFrame, path: str, checkpoint: str, interval: str = S.MICRO_BATCH_INTERVAL,
    once: bool = False,
) -> StreamingQuery:
    """Append the stream to Parquet by processing date.

    The checkpoint and the sink's log make a restart continue without loss or repetition; both
    folders must be shared storage. ``once`` works off what is there and stops.
    """
    writer = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .partitionBy("processing_date")
    )
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def start_message_job(
    snapshots: DataFrame, checkpoint: str, path: str | None = None, servers: str | None = None,
    topic: str | None = None, once: bool = False, interval: str = "30 seconds",
) -> StreamingQuery:
    """Publish a stream of snapshot rows as messages to a Kafka topic or to text files.

    Rows without a station id are left out and counted, see :func:`build_messages`.
    """
    messages = build_messages(snapshots, missing_id="drop")
    writer = message_values(messages).writeStream.option("checkpointLocation", checkpoint)
    if topic:
        writer = (
            writer.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("kafka.acks", "all").option("topic", topic)
        )
    else:
        writer = writer.format("text").option("path", path)
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()
