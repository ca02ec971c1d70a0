"""Questions answered from the station-status layer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bikenet.functions.temporal import minutes_before

# newest first; readings of one micro-batch share processed_at, so later keys break the tie
NEWEST_FIRST = ("processed_at", "kafka_timestamp", "ingested_at", "last_reported")


def recent_window(
    status: DataFrame, minutes: int, as_of: Column | dt.datetime | None = None,
    time_column: str = "processed_at", date_column: str = "processing_date",
) -> DataFrame:
    """Readings processed at most ``minutes`` before ``as_of`` (default now).

    Where the layer has a date partition, a bound on it keeps older directories unread.
    """
    if as_of is None:
        as_of = F.current_timestamp()
    elif isinstance(as_of, dt.datetime):
        as_of = F.lit(as_of)
    earliest = minutes_before(as_of, minutes)
    if date_column in status.columns:
        status = status.where(F.col(date_column) >= F.to_date(earliest))
    return status.where(F.col(time_column) >= earliest)


def latest_per_station(
    status: DataFrame, key: str = "station_id", order_by: tuple[str, ...] = NEWEST_FIRST,
    drop_malformed: bool = False,
) -> DataFrame:
    """The newest reading of each station; rows are cut per map task before the shuffle."""
    if drop_malformed:
        status = status.where(F.col(key).isNotNull())
    keys = [F.desc_nulls_last(c) for c in order_by if c in status.columns]
    window = Window.partitionBy(key).orderBy(*keys)
    return (
        status.withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def current_station_availability(
    status: DataFrame, lookback_minutes: int = 5, as_of: Column | dt.datetime | None = None,
    drop_malformed: bool = False,
) -> DataFrame:
    """The newest reading per station within the look-back, emptiest stations first.

    The station id as last sort key lets the sort split the many stations of one level.
    """
    recent = recent_window(status, lookback_minutes, as_of)
    return latest_per_station(recent, drop_malformed=drop_malformed).select(
        "station_id", "num_bikes_available", "num_docks_available", "is_renting",
        F.col("processed_at").alias("last_seen"),
    ).orderBy(F.asc_nulls_last("num_bikes_available"), "station_id")


def empty_stations(availability: DataFrame) -> DataFrame:
    return availability.where(F.col("num_bikes_available") == 0)
