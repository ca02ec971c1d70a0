"""The three aggregate tables built from clean trips.

Each reads only the columns it needs and combines on the map side; three narrow columnar scans
cost less than caching the wide trip table once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bikenet.functions.ratios import flag_sum


def trips_per_station(
    silver: DataFrame, station_id: str = "start_station_id",
    station_name: str = "start_station_name", day: str = "trip_date",
) -> DataFrame:
    """Trips, mean duration, e-bike and member trips per station, station name and day."""
    return silver.groupBy(station_id, station_name, day).agg(
        F.count("*").alias("trips_started"),
        F.avg("trip_duration_seconds").alias("avg_duration_seconds"),
        flag_sum(F.col("rideable_type") == "electric_bike").alias("ebike_trips"),
        flag_sum(F.col("member_casual") == "member").alias("member_trips"),
    )


def hourly_pattern(silver: DataFrame) -> DataFrame:
    """Trips per hour, day of week, vehicle type and rider type."""
    return silver.groupBy("hour_of_day", "day_of_week", "rideable_type", "member_casual").agg(
        F.count("*").alias("trip_count"),
    )


def rideable_split(silver: DataFrame, station_id: str = "start_station_id") -> DataFrame:
    """Trips per station and vehicle type."""
    return silver.groupBy(station_id, "rideable_type").agg(F.count("*").alias("trip_count"))


def gold_tables(silver: DataFrame) -> dict[str, DataFrame]:
    return {
        "trips_per_station": trips_per_station(silver),
        "hourly_pattern": hourly_pattern(silver),
        "rideable_split": rideable_split(silver),
    }


#: Columns of the monthly parts, with the month that each row is of.
GOLD_KEYS = {
    "trips_per_station": "start_station_id string, start_station_name string, trip_date date, trips_started bigint,"
                         " total_duration_seconds bigint, ebike_trips bigint, member_trips bigint, year_month string",
    "hourly_pattern": "hour_of_day int, day_of_week int, rideable_type string, member_casual string,"
                      " trip_count bigint, year_month string",
    "rideable_split": "start_station_id string, rideable_type string, trip_count bigint, year_month string",
}


def partial_tables(silver: DataFrame) -> dict[str, DataFrame]:
    """Counts and sums by the keys of the gold tables; those of several months add up to the whole."""
    tables = gold_tables(silver)
    sums = silver.groupBy("start_station_id", "start_station_name", "trip_date").agg(
        F.count("*").alias("trips_started"),
        F.sum("trip_duration_seconds").alias("total_duration_seconds"),
        flag_sum(F.col("rideable_type") == "electric_bike").alias("ebike_trips"),
        flag_sum(F.col("member_casual") == "member").alias("member_trips"),
    )
    return {**tables, "trips_per_station": sums}


def assemble(name: str, parts: DataFrame) -> DataFrame:
    """A gold table from the parts of all its months."""
    if name != "trips_per_station":
        keys = [c for c in parts.columns if c not in ("trip_count", "year_month")]
        return parts.groupBy(*keys).agg(F.sum("trip_count").alias("trip_count"))
    trips = F.sum("trips_started")
    return parts.groupBy("start_station_id", "start_station_name", "trip_date").agg(
        trips.alias("trips_started"), (F.sum("total_duration_seconds") / trips).alias("avg_duration_seconds"),
        F.sum("ebike_trips").alias("ebike_trips"), F.sum("member_trips").alias("member_trips"),
    )
