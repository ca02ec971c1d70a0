"""Queries of the cleaning operators and the aggregate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bikenet.functions.temporal import previous_month
from bikenet.operators import cleaning, gold, quality
from bikenet.registry.core import query
from bikenet.registry.sql import stamp, using
from bikenet.registry.tables import DriverTables

_STAMP = "yyyy-MM-dd HH:mm:ss"


def text_times(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, _STAMP) for c in columns})


_ROW = ("ride_id", "rideable_type", "started_at", "ended_at", "start_station_name",
        "start_station_id", "end_station_name", "end_station_id", "start_lat", "start_lng",
        "end_lat", "end_lng", "member_casual")
_ROW_SQL = ", ".join(f"{stamp(c)} AS {c}" if c.endswith("_at") else c for c in _ROW)


@query(using(f"""
SELECT {_ROW_SQL}, trip_duration_seconds, hour_of_day, day_of_week,
  CAST(trip_date AS VARCHAR) AS trip_date FROM silver
"""))
def clean_trips(t: DriverTables) -> DataFrame:
    silver = t.silver().withColumn("trip_date", F.col("trip_date").cast("string"))
    return text_times(silver, "started_at", "ended_at")


@query(using("""
SELECT ride_id, start_station_id, member_casual FROM trips WHERE start_lat IS NOT NULL
"""))
def drop_null_critical(t: DriverTables) -> DataFrame:
    return cleaning.drop_null_critical(t.trips()).select(
        "ride_id", "start_station_id", "member_casual",
    )


@query(using(f"""
SELECT {_ROW_SQL} FROM (
  SELECT *, row_number() OVER (PARTITION BY ride_id ORDER BY started_at, ended_at,
    rideable_type, start_station_name, start_station_id, end_station_name, end_station_id,
    start_lat NULLS LAST, start_lng NULLS LAST, end_lat NULLS LAST, end_lng NULLS LAST,
    member_casual) AS copy FROM trips) WHERE copy = 1
"""))
def dedupe_rides(t: DriverTables) -> DataFrame:
    return text_times(cleaning.dedupe_rides(t.trips()), "started_at", "ended_at")


@query(using("""
SELECT start_station_id, CAST(count(*) AS BIGINT) AS trips, CAST(count(key) AS BIGINT) AS with_id
FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY started_at, ended_at,
    rideable_type, start_station_name, start_station_id, end_station_name, end_station_id,
    start_lat NULLS LAST, start_lng NULLS LAST, end_lat NULLS LAST, end_lng NULLS LAST,
    member_casual) AS copy
  FROM (SELECT *, CASE WHEN rideable_type <> 'electric_bike' THEN ride_id END AS key FROM trips))
WHERE copy = 1 OR key IS NULL GROUP BY start_station_id
"""))
def dedupe_without_ids(t: DriverTables) -> DataFrame:
    """A third of the trips have no id; all of those stay."""
    key = F.when(F.col("rideable_type") != "electric_bike", F.col("ride_id"))
    unique = cleaning.dedupe_rides(t.trips().withColumn("ride_id", key))
    return unique.groupBy("start_station_id").agg(
        F.count("*").alias("trips"), F.count("ride_id").alias("with_id"),
    )


@query(using("""
SELECT CAST(count(*) AS BIGINT) AS rides FROM (
  SELECT DISTINCT CASE WHEN rideable_type <> 'electric_bike' THEN ride_id END FROM trips)
"""))
def dedupe_strict(t: DriverTables) -> DataFrame:
    """Reference behaviour: trips without an id collapse to one."""
    key = F.when(F.col("rideable_type") != "electric_bike", F.col("ride_id"))
    unique = cleaning.dedupe_rides(t.trips().withColumn("ride_id", key), strict_ref=True)
    return unique.agg(F.count("*").alias("rides"))


@query(using("""
SELECT ride_id, hour_of_day, day_of_week, CAST(trip_date AS VARCHAR) AS trip_date,
  trip_duration_seconds FROM event_silver
"""))
def event_trip_features(t: DriverTables) -> DataFrame:
    return t.event_silver().select(
        "ride_id", "hour_of_day", "day_of_week",
        F.col("trip_date").cast("string").alias("trip_date"), "trip_duration_seconds",
    )


@query(using("""
SELECT strftime(started_at, '%Y%m') AS year_month,
  strftime(date_trunc('month', started_at) - INTERVAL 1 MONTH, '%Y%m') AS previous_month,
  CAST(count(*) AS BIGINT) AS trips FROM trips GROUP BY ALL
"""))
def month_tags(t: DriverTables) -> DataFrame:
    tagged = cleaning.tag_month(t.trips())
    previous = previous_month(F.to_date("started_at")).alias("previous_month")
    return tagged.groupBy("year_month", previous).agg(F.count("*").alias("trips"))


_LEGACY_SQL = """
SELECT sha256(concat_ws(chr(31), bike, begun, finished, from_id, to_id)) AS ride_id,
  'classic_bike' AS rideable_type, begun AS started_at, finished AS ended_at,
  'S' || from_id || ' St & ' || (o_custkey % 100 % 7) || ' Ave' AS start_station_name,
  from_id AS start_station_id, to_id AS end_station_id,
  CASE WHEN o_custkey % 41 <> 0 THEN 40.0::DOUBLE + (o_custkey % 100 * 11 % 83) / 64.0::DOUBLE
    END AS start_lat,
  -74.0::DOUBLE + (o_orderkey % 100 * 7 % 83) / 64.0::DOUBLE AS end_lng,
  CASE WHEN o_orderstatus = 'F' THEN 'member' ELSE 'casual' END AS member_casual
FROM (SELECT *, CAST(o_orderkey AS VARCHAR) AS bike,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS begun,
  strftime(o_orderdate + to_seconds(o_orderkey % 90000), '%Y-%m-%d %H:%M:%S') AS finished,
  CAST(o_custkey % 100 AS VARCHAR) AS from_id, CAST(o_orderkey % 100 AS VARCHAR) AS to_id
  FROM orders)
"""


@query(_LEGACY_SQL)
def normalise_legacy(t: DriverTables) -> DataFrame:
    trips = cleaning.conform(cleaning.normalise(t.legacy_trips()))
    return text_times(trips, "started_at", "ended_at").select(
        "ride_id", "rideable_type", "started_at", "ended_at", "start_station_name",
        "start_station_id", "end_station_id", "start_lat", "end_lng", "member_casual",
    )


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS ride_id,
  CASE WHEN o_custkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS started_at,
  CASE WHEN o_custkey % 11 <> 0 THEN o_totalprice END AS start_lat
FROM orders
""")
def cast_malformed(t: DriverTables) -> DataFrame:
    """Text columns with unreadable times and numbers, which become NULL."""
    time = F.when(F.col("o_custkey") % 7 == 0, "soon").otherwise(
        F.date_format("o_orderdate", _STAMP))
    number = F.when(F.col("o_custkey") % 11 == 0, "n/a").otherwise(
        F.col("o_totalprice").cast("string"))
    raw = t.table("orders").select(
        F.col("o_orderkey").cast("string").alias("Ride_ID"),
        time.alias("started_at"), number.alias("start_lat"),
    )
    return text_times(cleaning.normalise(raw), "started_at")


@query(using("""
SELECT start_station_id, start_station_name, CAST(trip_date AS VARCHAR) AS trip_date,
  trips_started, round(avg_duration_seconds, 6) AS avg_duration_seconds, ebike_trips, member_trips
FROM daily
"""))
def trips_per_station(t: DriverTables) -> DataFrame:
    return t.daily().withColumns({
        "trip_date": F.col("trip_date").cast("string"),
        "avg_duration_seconds": F.round("avg_duration_seconds", 6),
    })


@query(using("SELECT * FROM pattern"))
def hourly_pattern(t: DriverTables) -> DataFrame:
    return gold.hourly_pattern(t.event_silver())


@query(using("SELECT * FROM split"))
def rideable_split(t: DriverTables) -> DataFrame:
    return gold.rideable_split(t.silver())


def _report_text(report: DataFrame) -> DataFrame:
    """A report with its lists and map as text."""
    rates = F.transform(
        F.array_sort(F.map_entries("null_rate")),
        lambda e: F.format_string("%s=%.4f", e["key"], e["value"]),
    )
    return report.select(
        "schema_version", "row_count", "duplicate_count",
        F.concat_ws("|", "missing_required_columns").alias("missing_required_columns"),
        F.concat_ws("|", rates).alias("null_rate"),
        F.concat_ws("|", "warnings").alias("warnings"),
        F.concat_ws("|", "errors").alias("errors"),
        "is_valid",
    )


def _rate_sql(expr: str) -> str:
    return f"avg(CASE WHEN {expr} IS NULL THEN 1.0 ELSE 0.0 END)"


def _rates_sql(columns: list[tuple[str, str]]) -> str:
    return " || '|' || ".join(
        f"'{name}=' || printf('%.4f', round_even({_rate_sql(expr)}, 4))"
        for name, expr in sorted(columns)
    )


def _null_warning_sql(column: str) -> str:
    share = f"printf('%.1f', 100 * {_rate_sql(column)})"
    return f"'{column} is missing in ' || {share} || ' % of the rows'"


@query(using(f"""
SELECT 'current' AS schema_version, CAST(count(*) AS BIGINT) AS row_count,
  CAST(count(*) - count(DISTINCT ride_id) AS BIGINT) AS duplicate_count,
  '' AS missing_required_columns,
  {_rates_sql([(c, c) for c in ('start_lat', 'start_lng', 'end_lat', 'end_lng')])} AS null_rate,
  concat_ws('|',
    CASE WHEN count(*) < 1000 THEN 'only ' || count(*) || ' rows' END,
    (count(*) - count(DISTINCT ride_id)) || ' rows repeat a ride_id (duplicates)') AS warnings,
  '' AS errors, true AS is_valid
FROM trips
"""))
def validate_trips(t: DriverTables) -> DataFrame:
    return _report_text(quality.validate_dataframe(t.trips()))


@query(using(f"""
SELECT 'current' AS schema_version, CAST(count(*) AS BIGINT) AS row_count,
  CAST(0 AS BIGINT) AS duplicate_count,
  'end_lat|end_lng|end_station_id|end_station_name' AS missing_required_columns,
  {_rates_sql([(c, c) for c in ('start_lat', 'start_lng')])} AS null_rate,
  concat_ws('|',
    {_null_warning_sql('start_lat')},
    {_null_warning_sql('start_lng')},
    CASE WHEN count(*) < 1000 THEN 'only ' || count(*) || ' rows' END) AS warnings,
  'columns not found: end_lat, end_lng, end_station_id, end_station_name' AS errors,
  false AS is_valid
FROM event_trips
"""))
def validate_incomplete(t: DriverTables) -> DataFrame:
    """Event trips lack the end columns and a fifth of the start coordinates."""
    return _report_text(quality.validate_dataframe(t.event_trips()))


@query(f"""
SELECT 'legacy' AS schema_version, CAST(count(*) AS BIGINT) AS row_count,
  CAST(0 AS BIGINT) AS duplicate_count, '' AS missing_required_columns,
  {_rates_sql([
      ('start station latitude', 'CASE WHEN o_custkey % 41 <> 0 THEN 1 END'),
      ('start station longitude', '1'),
      ('end station latitude', '1'), ('end station longitude', '1'),
  ])} AS null_rate,
  concat_ws('|', CASE WHEN count(*) < 1000 THEN 'only ' || count(*) || ' rows' END)
    AS warnings,
  '' AS errors, true AS is_valid
FROM orders
""")
def validate_legacy(t: DriverTables) -> DataFrame:
    return _report_text(quality.validate_dataframe(t.legacy_trips()))


@query("""
SELECT 'unknown' AS schema_version, CAST(count(*) AS BIGINT) AS row_count,
  CAST(0 AS BIGINT) AS duplicate_count, '' AS missing_required_columns, '' AS null_rate,
  '' AS warnings, 'the columns fit no known trip format' AS errors,
  false AS is_valid
FROM customer
""")
def validate_unknown(t: DriverTables) -> DataFrame:
    return _report_text(quality.validate_dataframe(t.table("customer")))


@query(using("""
SELECT round_even(avg(CASE WHEN start_lat IS NULL THEN 1.0 ELSE 0.0 END), 4) AS start_lat,
  round_even(avg(CASE WHEN start_lng IS NULL THEN 1.0 ELSE 0.0 END), 4) AS start_lng,
  round_even(avg(CASE WHEN end_lat IS NULL THEN 1.0 ELSE 0.0 END), 4) AS end_lat,
  round_even(avg(CASE WHEN end_lng IS NULL THEN 1.0 ELSE 0.0 END), 4) AS end_lng
FROM trips
"""))
def null_rates(t: DriverTables) -> DataFrame:
    return quality.null_rates(t.trips())


@query(using("""
SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT start_lat FROM trips)) AS BIGINT)
  AS duplicate_count FROM trips
"""))
def duplicate_count(t: DriverTables) -> DataFrame:
    """Repeated values of a column with NULLs, which count as one value."""
    return quality.duplicate_count(t.trips(), "start_lat")
