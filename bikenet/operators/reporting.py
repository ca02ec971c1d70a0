"""Data preparation of the charts and the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bikenet.functions.labels import short_station_name, vehicle_label
from bikenet.functions.ratios import dominance, percent, percent_even, ratio
from bikenet.functions.temporal import day_name, day_type, monday_first
from bikenet.operators.serving import top_k
from bikenet.schema import DAY_NAMES

_STATION = ("start_station_id", "start_station_name")


def with_station_shares(top: DataFrame) -> DataFrame:
    """Dashboard columns of the station list: e-bike and member share in percent."""
    return top.withColumns({
        "ebike_share_pct": percent_even(F.col("ebike_trips"), F.col("total_trips"), 1),
        "member_pct": percent_even(F.col("member_trips"), F.col("total_trips"), 1),
    })


def with_day_names(hourly: DataFrame) -> DataFrame:
    return hourly.withColumn("day_name", day_name(F.col("day_of_week")))


def station_dominance(top: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` stations with their e-bike share and dominant vehicle type."""
    share = ratio(F.col("ebike_trips"), F.col("total_trips"))
    return top_k(top, n, "total_trips", *_STATION).withColumns({
        "ebike_share": share, "dominant": dominance(share),
    })


def casual_trips(df: DataFrame) -> DataFrame:
    return df.withColumn("casual_trips", F.col("total_trips") - F.col("member_trips"))


def classic_trips(df: DataFrame) -> DataFrame:
    return df.withColumn("classic_trips", F.col("total_trips") - F.col("ebike_trips"))


def drop_null_share(df: DataFrame, share: str = "ebike_share") -> DataFrame:
    """Leave out stations whose share is unknown for want of trips."""
    return df.where(F.col(share).isNotNull())


def positive_capacity(scores: DataFrame) -> DataFrame:
    return scores.where(F.col("total_capacity") > 0)


def area_round(scores: DataFrame) -> DataFrame:
    """The five display columns, area rounded to two digits."""
    return scores.select(
        "neighborhood_name", "borough", "station_count", "total_capacity",
        F.bround("area_km2", 2).alias("area_km2"),
    )


def vehicle_shares(rideable: DataFrame) -> DataFrame:
    """Vehicle types with display label and share, for a ring chart."""
    return rideable.withColumn("label", vehicle_label(F.col("rideable_type")))


def member_casual_split(top: DataFrame, n: int = 15) -> DataFrame:
    """Member and casual trips of the first ``n`` stations."""
    pct = percent(F.col("member_trips"), F.col("total_trips"))
    return casual_trips(top_k(top, n, "total_trips", *_STATION)).withColumn("member_pct", pct)


def vehicle_split(top: DataFrame, n: int = 10) -> DataFrame:
    """E-bike and classic trips of the first ``n`` stations, fewest trips first."""
    first = top_k(top, n, "total_trips", *_STATION)
    return classic_trips(first).orderBy("total_trips", *_STATION)


def ebike_share_points(stations: DataFrame, labelled: int = 5, threshold: float = 50) -> DataFrame:
    """Trips against e-bike share per station; only the busiest carry a short label.

    The labelled rows come from a top-k of fixed size and are joined back, so the station table
    is never ordered in one task.
    """
    share = percent(F.col("ebike_trips"), F.col("total_trips"))
    points = drop_null_share(stations.withColumn("ebike_share", share))
    busiest = top_k(points, labelled, "total_trips", *_STATION).select(
        *(F.col(c).alias(f"_{c}") for c in _STATION),
        short_station_name(F.col("start_station_name")).alias("label"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _STATION]
    return points.join(busiest, same, "left").select(
        *_STATION, "total_trips", "ebike_share", "label",
        (F.col("ebike_share") >= threshold).alias("above_threshold"),
    )


def neighborhood_capacity_top(scores: DataFrame, n: int = 20) -> DataFrame:
    """Neighbourhoods with the most docks."""
    return neighborhood_table(
        top_k(positive_capacity(scores), n, "total_capacity", "neighborhood_id"),
    )


def neighborhood_table(scores: DataFrame) -> DataFrame:
    """All neighbourhoods for display, largest capacity first."""
    return area_round(scores.orderBy(F.desc_nulls_last("total_capacity"), "neighborhood_id"))


def hour_day_pivot(hourly: DataFrame) -> DataFrame:
    """Trips with days as rows from Monday and hours ``h00``..``h23`` as columns."""
    hours = list(range(24))
    table = hourly.groupBy("day_of_week").pivot("hour_of_day", hours).agg(F.sum("total_trips"))
    named = [F.col(f"`{h}`").alias(f"h{h:02d}") for h in hours]
    return table.orderBy(monday_first(F.col("day_of_week"))).select(
        day_name(F.col("day_of_week")).alias("day_name"), *named,
    )


def day_profile(hourly: DataFrame) -> DataFrame:
    """Mean trips per hour over weekdays and over weekend days."""
    return hourly.groupBy(day_type(F.col("day_of_week")).alias("day_type"), "hour_of_day").agg(
        F.avg("total_trips").alias("total_trips"),
    ).orderBy("day_type", "hour_of_day")


def daily_totals(hourly: DataFrame) -> DataFrame:
    """Trips per day name from Monday to Sunday; a day without data shows NULL."""
    week = hourly.sparkSession.createDataFrame(
        list(DAY_NAMES.items()), "day_of_week int, day_name string",
    )
    sums = hourly.groupBy("day_of_week").agg(F.sum("total_trips").alias("total_trips"))
    return (
        week.join(sums, "day_of_week", "left")
        .orderBy(monday_first(F.col("day_of_week")))
        .select("day_name", "total_trips")
    )


def peak_hours(hourly: DataFrame) -> DataFrame:
    """One row: busiest and quietest hour, earliest on a tie, and the ratio of their trips."""
    per_hour = hourly.groupBy("hour_of_day").agg(F.sum("total_trips").alias("trips"))
    hour, trips = F.col("hour_of_day"), F.col("trips")
    return per_hour.agg(
        F.max_by(hour, F.struct(trips, -hour)).alias("peak_hour"),
        F.max(trips).alias("peak_trips"),
        F.min_by(hour, F.struct(trips, hour)).alias("off_hour"),
        F.min(trips).alias("off_trips"),
    ).withColumn("peak_ratio", ratio(F.col("peak_trips"), F.col("off_trips")))


def borough_summary(scores: DataFrame) -> DataFrame:
    """Neighbourhoods, stations, docks and density per borough.

    ``stations_per_km2`` divides by the mean area of a neighbourhood, ``stations_per_total_km2``
    by the area of all of them.
    """
    stations, mean_area = F.col("total_stations"), F.col("avg_area_km2")
    return scores.where(F.col("borough").isNotNull()).groupBy("borough").agg(
        F.count("neighborhood_name").alias("neighborhoods"),
        F.sum("station_count").alias("total_stations"),
        F.sum("total_capacity").alias("total_capacity"),
        F.avg("area_km2").alias("avg_area_km2"),
        F.sum("area_km2").alias("_area"),
    ).select(
        "borough", "neighborhoods", "total_stations", "total_capacity", "avg_area_km2",
        F.bround(ratio(stations, mean_area), 2).alias("stations_per_km2"),
        F.bround(ratio(stations, F.col("_area")), 2).alias("stations_per_total_km2"),
    ).orderBy(F.desc_nulls_last("total_capacity"), "borough")


def kpis(top: DataFrame, rideable: DataFrame, scores: DataFrame) -> DataFrame:
    """One row with the headline figures; each part is a one-row aggregate."""
    electric = F.max(F.when(F.col("rideable_type") == "electric_bike", F.col("pct")))
    counted = scores.agg(F.struct(
        F.count_distinct("borough").alias("boroughs"), F.count("*").alias("rows"),
    ).alias("counted")).scalar()
    return top.agg(
        F.sum("total_trips").alias("total_trips"), F.count("*").alias("stations_tracked"),
    ).withColumns({
        "ebike_share_pct": F.coalesce(
            rideable.agg(electric.alias("pct")).scalar(), F.lit(0.0),
        ),
        "boroughs": counted["boroughs"],
        "neighborhoods_covered": counted["rows"],
    })
