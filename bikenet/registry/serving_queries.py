"""Queries of the serving, status, reporting and monitoring operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bikenet.operators import gold, monitoring, reporting, serving, spatial, status
from bikenet.registry.cleaning_queries import text_times
from bikenet.registry.core import query
from bikenet.registry.sql import stamp, using
from bikenet.registry.tables import DriverTables
from bikenet.session import shared_folder
from bikenet.streaming import lag

LOOKBACK = 2880  # minutes


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    """Counts that may be NULL as double, the type in which every client shows NULLs alike."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


_STATION_TOTALS = """
SELECT start_station_id, start_station_name,
  CAST(sum(trips_started) AS BIGINT) AS total_trips,
  round(avg(avg_duration_seconds), 6) AS avg_duration_seconds,
  round(sum(avg_duration_seconds * trips_started) / sum(trips_started), 6)
    AS weighted_avg_duration_seconds,
  CAST(sum(ebike_trips) AS BIGINT) AS total_ebike_trips,
  CAST(sum(member_trips) AS BIGINT) AS total_member_trips
FROM daily GROUP BY ALL
"""


@query(using(_STATION_TOTALS + "ORDER BY total_trips DESC, 1, 2 LIMIT 20"))
def top_stations_by_trips(t: DriverTables) -> DataFrame:
    top = serving.top_stations_by_trips(t.daily(), 20, rideable_type="electric_bike")
    return rounded(top, 6, "avg_duration_seconds", "weighted_avg_duration_seconds")


@query(using("SELECT * FROM top"))
def top_stations(t: DriverTables) -> DataFrame:
    return t.top()


@query(using(_STATION_TOTALS))
def station_totals(t: DriverTables) -> DataFrame:
    totals = serving.station_totals(t.daily())
    return rounded(totals, 6, "avg_duration_seconds", "weighted_avg_duration_seconds")


@query(using(_STATION_TOTALS + "ORDER BY total_trips DESC, 1, 2 LIMIT 5"))
def gold_smoke(t: DriverTables) -> DataFrame:
    top = serving.gold_smoke(t.daily())
    return rounded(top, 6, "avg_duration_seconds", "weighted_avg_duration_seconds")


@query(using("""
SELECT hour_of_day, day_of_week, rideable_type, member_casual,
  CAST(sum(trip_count) AS BIGINT) AS total_trips FROM pattern GROUP BY ALL
"""))
def hourly_usage_pattern(t: DriverTables) -> DataFrame:
    return serving.hourly_usage_pattern(gold.hourly_pattern(t.event_silver()))


@query(using("SELECT * FROM hourly"))
def hourly_totals(t: DriverTables) -> DataFrame:
    return t.hourly()


@query(using("SELECT * FROM shares"))
def rideable_shares(t: DriverTables) -> DataFrame:
    return t.shares()


_AREA_TRIPS = """
SELECT n.neighborhood_name, n.borough, n.accessibility_score,
  CAST(sum(d.total_trips) AS DOUBLE) AS total_trips,
  CAST(sum(d.ebike_trips) AS DOUBLE) AS total_ebike_trips,
  round(100.0::DOUBLE * sum(d.ebike_trips) / nullif(sum(d.total_trips), 0), 2) AS ebike_pct
FROM {areas} n LEFT JOIN ({trips}) d ON {match}
GROUP BY ALL
"""
_STATION_SUMS = """SELECT start_station_id, sum(trips_started) AS total_trips,
  sum(ebike_trips) AS ebike_trips FROM daily GROUP BY 1"""
_ALL_SCORES = """(SELECT neighborhood_id, a.neighborhood_name, a.borough, s.accessibility_score
  FROM areas a LEFT JOIN scores s USING (neighborhood_id))"""


def _all_scores(t: DriverTables, stored: bool = False) -> DataFrame:
    """Scores of all areas, those without stations included."""
    return spatial.geo_scores(t.neighborhoods(), t.scores(stored)).select(
        "neighborhood_id", "neighborhood_name", "borough", "accessibility_score",
    )


@query(using(_AREA_TRIPS.format(
    areas=_ALL_SCORES, trips=_STATION_SUMS, match="d.start_station_id = n.neighborhood_id",
)))
def neighborhood_trip_summary_proxy(t: DriverTables) -> DataFrame:
    """Station ids compared with neighbourhood ids, as the reference does."""
    summary = serving.neighborhood_trip_summary(t.daily(), _all_scores(t))
    return as_double(summary, "total_trips", "total_ebike_trips")


@query(using(_AREA_TRIPS.format(
    areas=_ALL_SCORES, trips=f"""SELECT p.neighborhood_id, x.*
      FROM ({_STATION_SUMS}) x JOIN placed p ON x.start_station_id = p.station_id""",
    match="d.neighborhood_id = n.neighborhood_id",
)))
def neighborhood_trip_summary(t: DriverTables) -> DataFrame:
    """Stations assigned to neighbourhoods by their position."""
    summary = serving.neighborhood_trip_summary(
        t.stored_daily(), _all_scores(t, True), t.placed_stations())
    return as_double(summary, "total_trips", "total_ebike_trips")


_SUMMARY = """SELECT station_id, avg(num_bikes_available) AS avg_bikes_available,
  CAST(sum(CASE WHEN num_bikes_available = 0 THEN 1 ELSE 0 END) AS BIGINT) AS empty_readings,
  CAST(count(*) AS BIGINT) AS total_readings FROM status GROUP BY station_id"""
_BUSIEST = """SELECT start_station_id AS station_id,
  CAST(sum(trips_started) AS BIGINT) AS historical_trips
  FROM daily GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 200"""


@query(using(_BUSIEST))
def busiest_stations(t: DriverTables) -> DataFrame:
    return serving.busiest_stations(t.daily())


@query(using(_SUMMARY))
def status_summary(t: DriverTables) -> DataFrame:
    return serving.status_summary(t.status())


@query(using(f"""
SELECT b.station_id, b.historical_trips, s.avg_bikes_available, s.empty_readings,
  s.total_readings,
  round(100.0::DOUBLE * s.empty_readings / nullif(s.total_readings, 0), 2) AS pct_time_empty
FROM ({_BUSIEST}) b JOIN ({_SUMMARY}) s USING (station_id)
ORDER BY b.historical_trips DESC, pct_time_empty DESC, b.station_id LIMIT 10
"""))
def equity_gap_stations(t: DriverTables) -> DataFrame:
    return serving.equity_gap_stations(t.daily(), t.status())


@query(using(f"SELECT * REPLACE ({stamp('last_seen')} AS last_seen) FROM available"))
def current_station_availability(t: DriverTables) -> DataFrame:
    now = status.current_station_availability(t.status(), LOOKBACK, t.status_end())
    return text_times(now, "last_seen")


@query(using("SELECT station_id, num_bikes_available, last_reported FROM recent"))
def recent_readings(t: DriverTables) -> DataFrame:
    return status.recent_window(t.status(), LOOKBACK, t.status_end()).select(
        "station_id", "num_bikes_available", "last_reported",
    )


@query(using("""
SELECT station_id, num_bikes_available, num_docks_available, last_reported FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id
    ORDER BY date_trunc('day', processed_at) DESC, kafka_timestamp DESC) AS rn FROM status)
WHERE rn = 1
"""))
def latest_per_station(t: DriverTables) -> DataFrame:
    """One processing time per day, so that the later keys decide."""
    coarse = t.status().withColumn("processed_at", F.col("processing_date"))
    return status.latest_per_station(coarse).select(
        "station_id", "num_bikes_available", "num_docks_available", "last_reported",
    )


@query(using("SELECT station_id, num_docks_available FROM available WHERE num_bikes_available = 0"))
def empty_stations(t: DriverTables) -> DataFrame:
    now = status.current_station_availability(t.status(), LOOKBACK, t.status_end())
    return status.empty_stations(now).select("station_id", "num_docks_available")


@query(using("""
SELECT CAST(count(*) FILTER (num_bikes_available = 0) AS BIGINT) AS empty_station_count,
  CAST(count(*) AS BIGINT) AS total_station_count FROM available
"""))
def empty_station_metrics(t: DriverTables) -> DataFrame:
    now = status.current_station_availability(t.status(), LOOKBACK, t.status_end())
    return monitoring.empty_station_metrics(now)


@query(using("""
SELECT station_id, num_docks_available FROM available WHERE num_bikes_available = 0
ORDER BY station_id LIMIT 10
"""))
def empty_station_sample(t: DriverTables) -> DataFrame:
    now = status.current_station_availability(t.status(), LOOKBACK, t.status_end())
    return monitoring.empty_station_sample(now).select("station_id", "num_docks_available")


def _freshness(t: DriverTables) -> DataFrame:
    """Age of the newest reading, seen at the end of the hour in which it was taken."""
    end = t.table("events").agg(F.max(F.make_timestamp_ntz(
        F.year("ts"), F.month("ts"), F.day("ts"), F.hour("ts"), F.lit(59), F.lit(59),
    )).alias("end"))
    return monitoring.freshness_minutes(t.status(), end.scalar())


@query(using(f"""
SELECT {stamp('latest')} AS latest, round(age, 6) AS age_minutes,
  10 AS threshold_minutes, age > 10 AS stale
FROM (SELECT max(ts) AS latest, date_diff('microsecond', max(ts),
    date_trunc('hour', max(ts)) + INTERVAL 3599 SECOND) / 60000000.0::DOUBLE AS age FROM events)
"""))
def freshness(t: DriverTables) -> DataFrame:
    return rounded(text_times(_freshness(t), "latest"), 6, "age_minutes")


@query(using("""
SELECT 'freshness' AS "check", round(age, 6) AS value, 10.0::DOUBLE AS threshold,
  NOT age > 10 AS ok
FROM (SELECT date_diff('microsecond', max(ts),
    date_trunc('hour', max(ts)) + INTERVAL 3599 SECOND) / 60000000.0::DOUBLE AS age FROM events)
UNION ALL
SELECT 'empty_stations', CAST(count(*) FILTER (num_bikes_available = 0) AS DOUBLE), NULL, true
FROM available
UNION ALL
SELECT 'stream_lag', CAST(sum(lag) AS DOUBLE), 10000, sum(lag) <= 10000 FROM offsets
"""))
def health_report(t: DriverTables) -> DataFrame:
    """The three checks; the lag is read from stored progress reports."""
    now = status.current_station_availability(t.status(), LOOKBACK, t.status_end())
    return rounded(monitoring.health_report(_freshness(t), now, lag.stored_lag(_reports(t))), 6, "value")


def _reports(t: DriverTables) -> DataFrame:
    """Progress reports of a stream over the events, one a day: what has come and what of it is processed.

    A partition has the events of every eighth user; errors are not processed yet.
    """
    path = shared_folder(t.spark, "reports")
    key = (F.col("user_id") % 8).cast("string")
    daily = t.table("events").groupBy(F.to_date("ts").alias("report_date"), key.alias("p")).agg(
        F.max("event_id").alias("latest"), F.max(F.when(F.col("event_type") != "error", F.col("event_id"))).alias("end"))
    entries = F.collect_list(F.struct("p", "latest")).alias("latest"), F.collect_list(
        F.when(F.col("end").isNotNull(), F.struct("p", "end"))).alias("ends")
    offsets = [F.create_map(F.lit("status"), F.map_from_entries(c)).alias(n) for c, n in (("ends", "endOffset"), ("latest", "latestOffset"))]
    source = F.struct(F.lit("KafkaV2[Subscribe[status]]").alias("description"), *offsets)
    (
        daily.groupBy("report_date").agg(*entries)
        .select(F.lit("q").alias("query"), F.lit("r").alias("run"), F.lit(0).cast("bigint").alias("batch"),
                F.col("report_date").cast("timestamp").alias("reported_at"),
                F.to_json(F.struct(F.array(source).alias("sources"))).alias("report"), "report_date")
        .write.partitionBy("report_date").parquet(path)
    )
    last = t.table("events").agg(F.max("ts")).scalar()
    return lag.read_reports(t.spark, path, days=3, as_of=last)


@query(using("SELECT 'status' AS topic, p AS partition, end_offset, latest_offset, lag FROM offsets"))
def stream_lag(t: DriverTables) -> DataFrame:
    """The lag of every partition by the newest stored report that has it."""
    return lag.reported_offsets(_reports(t)).select("topic", "partition", "end_offset", "latest_offset", "lag")


# --- reporting ----------------------------------------------------------------

@query(using("""
SELECT *, round_even(100.0::DOUBLE * ebike_trips / nullif(total_trips, 0), 1) AS ebike_share_pct,
  round_even(100.0::DOUBLE * member_trips / nullif(total_trips, 0), 1) AS member_pct FROM top
"""))
def station_shares(t: DriverTables) -> DataFrame:
    return reporting.with_station_shares(t.top())


@query(using("""
SELECT *, CASE day_of_week WHEN 1 THEN 'Sun' WHEN 2 THEN 'Mon' WHEN 3 THEN 'Tue'
  WHEN 4 THEN 'Wed' WHEN 5 THEN 'Thu' WHEN 6 THEN 'Fri' WHEN 7 THEN 'Sat' END AS day_name
FROM hourly
"""))
def hourly_with_day_names(t: DriverTables) -> DataFrame:
    return reporting.with_day_names(t.hourly())


@query(using("""
SELECT *, ebike_trips / total_trips::DOUBLE AS ebike_share,
  CASE WHEN ebike_trips / total_trips::DOUBLE >= 0.55 THEN 'electric_bike' ELSE 'classic_bike' END
    AS dominant
FROM top ORDER BY total_trips DESC, start_station_id, start_station_name LIMIT 10
"""))
def station_dominance(t: DriverTables) -> DataFrame:
    return reporting.station_dominance(t.top(), 10)


@query(using("""
SELECT *, CASE rideable_type WHEN 'electric_bike' THEN 'Electric Bike'
  WHEN 'classic_bike' THEN 'Classic Bike' END AS label FROM shares
"""))
def vehicle_shares(t: DriverTables) -> DataFrame:
    return reporting.vehicle_shares(t.shares())


@query(using("""
SELECT *, total_trips - member_trips AS casual_trips,
  100.0::DOUBLE * member_trips / total_trips AS member_pct
FROM top ORDER BY total_trips DESC, start_station_id, start_station_name LIMIT 15
"""))
def member_casual_split(t: DriverTables) -> DataFrame:
    return reporting.member_casual_split(t.top())


@query(using("""
SELECT *, total_trips - ebike_trips AS classic_trips
FROM top ORDER BY total_trips DESC, start_station_id, start_station_name LIMIT 10
"""))
def vehicle_split(t: DriverTables) -> DataFrame:
    return reporting.vehicle_split(t.top())


def _every_station(t: DriverTables) -> DataFrame:
    return serving.station_totals(t.daily()).select(
        "start_station_id", "start_station_name", "total_trips",
        F.col("total_ebike_trips").alias("ebike_trips"),
    )


@query(using("""
SELECT start_station_id, start_station_name, total_trips, ebike_share,
  CASE WHEN rank <= 5 THEN trim(split_part(start_station_name, '&', 1)) END AS label,
  ebike_share >= 50 AS above_threshold
FROM (SELECT *, 100.0::DOUBLE * ebike_trips / total_trips AS ebike_share,
  row_number() OVER (ORDER BY total_trips DESC, start_station_id, start_station_name) AS rank
  FROM top_all)
"""))
def ebike_share_points(t: DriverTables) -> DataFrame:
    return reporting.ebike_share_points(_every_station(t))


_HOURS = ", ".join(
    f"CAST(sum(total_trips) FILTER (hour_of_day = {h}) AS DOUBLE) AS h{h:02d}" for h in range(24)
)
_DAY = """CASE day_of_week WHEN 1 THEN 'Sun' WHEN 2 THEN 'Mon' WHEN 3 THEN 'Tue'
  WHEN 4 THEN 'Wed' WHEN 5 THEN 'Thu' WHEN 6 THEN 'Fri' WHEN 7 THEN 'Sat' END"""


@query(using(f"SELECT {_DAY} AS day_name, {_HOURS} FROM hourly GROUP BY 1"))
def hour_day_pivot(t: DriverTables) -> DataFrame:
    pivot = reporting.hour_day_pivot(t.hourly())
    return as_double(pivot, *(c for c in pivot.columns if c != "day_name"))


@query(using("""
SELECT CASE WHEN day_of_week IN (1, 7) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
  hour_of_day, avg(total_trips) AS total_trips FROM hourly GROUP BY ALL
"""))
def day_profile(t: DriverTables) -> DataFrame:
    return reporting.day_profile(t.hourly())


@query(using(f"""
SELECT {_DAY} AS day_name, CAST(sum(total_trips) AS DOUBLE) AS total_trips FROM hourly GROUP BY 1
"""))
def daily_totals(t: DriverTables) -> DataFrame:
    return as_double(reporting.daily_totals(t.hourly()), "total_trips")


@query(using("""
SELECT first(hour_of_day ORDER BY trips DESC, hour_of_day) AS peak_hour,
  max(trips) AS peak_trips,
  first(hour_of_day ORDER BY trips, hour_of_day) AS off_hour,
  min(trips) AS off_trips,
  max(trips)::DOUBLE / min(trips) AS peak_ratio
FROM (SELECT hour_of_day, CAST(sum(total_trips) AS BIGINT) AS trips FROM hourly GROUP BY 1)
"""))
def peak_hours(t: DriverTables) -> DataFrame:
    return reporting.peak_hours(t.hourly())


@query(using("""
SELECT borough, CAST(count(neighborhood_name) AS BIGINT) AS neighborhoods,
  CAST(sum(station_count) AS BIGINT) AS total_stations,
  CAST(sum(total_capacity) AS BIGINT) AS total_capacity,
  round(avg(area_km2), 6) AS avg_area_km2,
  round_even(sum(station_count) / avg(area_km2), 2) AS stations_per_km2,
  round_even(sum(station_count) / sum(area_km2), 2) AS stations_per_total_km2
FROM scores GROUP BY borough
"""))
def borough_summary(t: DriverTables) -> DataFrame:
    return rounded(reporting.borough_summary(t.scores()), 6, "avg_area_km2")


@query(using("""
SELECT CAST((SELECT sum(total_trips) FROM top) AS BIGINT) AS total_trips,
  CAST((SELECT count(*) FROM top) AS BIGINT) AS stations_tracked,
  coalesce((SELECT pct FROM shares WHERE rideable_type = 'electric_bike'), 0.0::DOUBLE)
    AS ebike_share_pct,
  CAST((SELECT count(DISTINCT borough) FROM scores) AS BIGINT) AS boroughs,
  CAST((SELECT count(*) FROM scores) AS BIGINT) AS neighborhoods_covered
"""))
def kpis(t: DriverTables) -> DataFrame:
    return reporting.kpis(serving.top_stations(t.stored_daily()), t.shares(), t.scores(True))


@query(using("""
SELECT neighborhood_name, borough, station_count, total_capacity,
  round_even(area_km2, 2) AS area_km2
FROM scores WHERE total_capacity > 0 ORDER BY total_capacity DESC, neighborhood_id LIMIT 20
"""))
def neighborhood_capacity_top(t: DriverTables) -> DataFrame:
    return reporting.neighborhood_capacity_top(t.scores())


@query(using("""
SELECT neighborhood_name, borough, station_count, total_capacity,
  round_even(area_km2, 2) AS area_km2 FROM scores
"""))
def neighborhood_table(t: DriverTables) -> DataFrame:
    return reporting.neighborhood_table(t.scores())
