"""Questions answered from the aggregate tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bikenet.functions.ratios import percent, ratio


def top_k(df: DataFrame, n: int, by: str, *ties: str) -> DataFrame:
    """The ``n`` rows with the largest ``by``; ties in ascending order of the columns given."""
    return df.orderBy(F.desc_nulls_last(by), *(F.asc_nulls_last(t) for t in ties)).limit(n)


def station_totals(trips_per_station: DataFrame) -> DataFrame:
    """Totals over all days per station and name.

    ``avg_duration_seconds`` is the mean of the daily means; ``weighted_avg_duration_seconds``
    weighs each day by its trips.
    """
    seconds = F.col("avg_duration_seconds") * F.col("trips_started")
    return trips_per_station.groupBy("start_station_id", "start_station_name").agg(
        F.sum("trips_started").alias("total_trips"),
        F.avg("avg_duration_seconds").alias("avg_duration_seconds"),
        ratio(F.sum(seconds), F.sum("trips_started")).alias("weighted_avg_duration_seconds"),
        F.sum("ebike_trips").alias("total_ebike_trips"),
        F.sum("member_trips").alias("total_member_trips"),
    )


def top_stations_by_trips(
    trips_per_station: DataFrame, n: int = 20, rideable_type: str | None = None,
) -> DataFrame:
    """The busiest stations. ``rideable_type`` is accepted and has no effect: the table does not
    hold the vehicle type; filter the rideable split instead."""
    del rideable_type
    return top_k(
        station_totals(trips_per_station), n, "total_trips",
        "start_station_id", "start_station_name",
    )


def top_stations(trips_per_station: DataFrame, n: int = 20) -> DataFrame:
    """The busiest stations with durations in minutes."""
    return top_stations_by_trips(trips_per_station, n).select(
        "start_station_name",
        "start_station_id",
        "total_trips",
        F.round(F.col("avg_duration_seconds") / 60, 1).alias("avg_duration_min"),
        F.col("total_ebike_trips").alias("ebike_trips"),
        F.col("total_member_trips").alias("member_trips"),
    )


def gold_smoke(trips_per_station: DataFrame, n: int = 5) -> DataFrame:
    """The top stations, or an error when there are none."""
    top = top_stations_by_trips(trips_per_station, n)
    if top.isEmpty():
        raise RuntimeError("no stations in the aggregate table")
    return top


def hourly_usage_pattern(pattern: DataFrame) -> DataFrame:
    """Trips per hour, day, vehicle and rider type, in day and hour order."""
    keys = ("day_of_week", "hour_of_day", "rideable_type", "member_casual")
    return pattern.groupBy(*keys).agg(F.sum("trip_count").alias("total_trips")).orderBy(*keys)


def hourly_pattern(pattern: DataFrame) -> DataFrame:
    """Trips per hour and day, in day and hour order."""
    return (
        pattern.groupBy("hour_of_day", "day_of_week")
        .agg(F.sum("trip_count").alias("total_trips"))
        .orderBy("day_of_week", "hour_of_day")
    )


def rideable_split(split: DataFrame, rideable_type: str | None = None) -> DataFrame:
    """Trips per vehicle type with their share of all trips.

    The window without partitions runs on one row per vehicle type.
    """
    totals = split.groupBy("rideable_type").agg(F.sum("trip_count").alias("total_trips"))
    everything = F.sum("total_trips").over(Window.partitionBy())
    shares = totals.withColumn("pct", percent(F.col("total_trips"), everything, 2))
    if rideable_type:
        shares = shares.where(F.col("rideable_type") == rideable_type)
    return shares.orderBy(F.desc("total_trips"), "rideable_type")


def neighborhood_trip_summary(
    trips_per_station: DataFrame, scores: DataFrame,
    station_to_neighborhood: DataFrame | None = None,
) -> DataFrame:
    """Trips, e-bike trips and e-bike share per neighbourhood, best served first.

    ``station_to_neighborhood`` (``station_id``, ``neighborhood_id``) assigns stations to areas;
    without it station ids are compared with neighbourhood ids directly.
    """
    totals = trips_per_station.groupBy("start_station_id").agg(
        F.sum("trips_started").alias("total_trips"),
        F.sum("ebike_trips").alias("ebike_trips"),
    )
    if station_to_neighborhood is None:
        placed = totals.withColumnRenamed("start_station_id", "neighborhood_id")
    else:
        placed = totals.withColumnRenamed("start_station_id", "station_id").join(
            station_to_neighborhood.select("station_id", "neighborhood_id"), "station_id",
        )
    # one row per area before the join, so that a crowded area does not make a crowded join key
    per_area = placed.groupBy("neighborhood_id").agg(
        F.sum("total_trips").alias("total_trips"), F.sum("ebike_trips").alias("ebike_trips"),
    )
    return (
        scores.join(per_area, "neighborhood_id", "left")
        .groupBy("neighborhood_name", "borough", "accessibility_score")
        .agg(
            F.sum("total_trips").alias("total_trips"),
            F.sum("ebike_trips").alias("total_ebike_trips"),
            percent(F.sum("ebike_trips"), F.sum("total_trips"), 2).alias("ebike_pct"),
        )
        .orderBy(F.desc_nulls_last("accessibility_score"), "neighborhood_name", "borough")
    )


def with_crosswalk(
    df: DataFrame, crosswalk: DataFrame | None, key: str, mapped: str = "mapped_id",
) -> DataFrame:
    """Translate station ids through ``crosswalk`` (``key``, ``mapped``) where one is given.

    Trip files and live feeds number stations differently; ids without a mapping are kept.
    """
    if crosswalk is None:
        return df
    pairs = crosswalk.select(F.col(key), F.col(mapped).alias("_mapped"))
    return (
        df.join(pairs, key, "left")
        .withColumn(key, F.coalesce("_mapped", key))
        .drop("_mapped")
    )


def busiest_stations(trips_per_station: DataFrame, limit: int = 200) -> DataFrame:
    totals = trips_per_station.groupBy(F.col("start_station_id").alias("station_id")).agg(
        F.sum("trips_started").alias("historical_trips"),
    )
    return top_k(totals, limit, "historical_trips", "station_id")


def status_summary(status: DataFrame, drop_malformed: bool = False) -> DataFrame:
    """Mean bikes, empty readings and all readings per station."""
    if drop_malformed:
        status = status.where(F.col("station_id").isNotNull())
    return status.groupBy("station_id").agg(
        F.avg("num_bikes_available").alias("avg_bikes_available"),
        F.count_if(F.col("num_bikes_available") == 0).alias("empty_readings"),
        F.count("*").alias("total_readings"),
    )


def equity_gap_stations(
    trips_per_station: DataFrame, status: DataFrame, top_n: int = 10, batch_limit: int = 200,
    crosswalk: DataFrame | None = None,
) -> DataFrame:
    """Stations busy in the trip history and often empty in the status stream.

    The history side has at most ``batch_limit`` rows, so Spark broadcasts it into the join.
    Fewer than ``top_n`` rows come back when busy stations are missing from the stream.
    """
    history = busiest_stations(
        with_crosswalk(trips_per_station, crosswalk, "start_station_id"), batch_limit,
    )
    pct: Column = percent(F.col("empty_readings"), F.col("total_readings"), 2)
    joined = history.join(status_summary(status), "station_id").select(
        "station_id", "historical_trips", "avg_bikes_available",
        "empty_readings", "total_readings", pct.alias("pct_time_empty"),
    )
    return joined.orderBy(
        F.desc("historical_trips"), F.desc_nulls_last("pct_time_empty"), "station_id",
    ).limit(top_n)
