"""Common table expressions of the checking SQL.

They state the adapters of :mod:`bikenet.registry.tables` and the layer definitions a second
time. Areas are described by plain coordinate ranges instead of polygons, so that the inside test
and the area are checked by other means than edges.
"""

from __future__ import annotations

from bikenet.schema import CURRENT_COLUMNS


def lat(key: str) -> str:
    return f"(40.0::DOUBLE + ({key} * 11 % 83) / 64.0::DOUBLE)"


def lng(key: str) -> str:
    return f"(-74.0::DOUBLE + ({key} * 7 % 83) / 64.0::DOUBLE)"


def name(key: str) -> str:
    return f"('S' || ({key}) || ' St & ' || (({key}) % 7) || ' Ave')"


def stamp(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


_START = "(l_shipdate + to_hours(CAST(floor(l_quantity) AS BIGINT) % 24))"
_COPY_ORDER = ", ".join(
    f"{c} ASC NULLS LAST" for c in ("started_at", "ended_at", *(
        c for c in CURRENT_COLUMNS if c not in ("ride_id", "started_at", "ended_at")
    ))
)
SECONDS = "CAST(floor(epoch(ended_at)) - floor(epoch(started_at)) AS BIGINT)"
_FEATURES = f"""
    {SECONDS} AS trip_duration_seconds,
    CAST(hour(started_at) AS INTEGER) AS hour_of_day,
    CAST(dayofweek(started_at) + 1 AS INTEGER) AS day_of_week,
    CAST(started_at AS DATE) AS trip_date"""
COMPLETE = """started_at IS NOT NULL AND ended_at IS NOT NULL AND start_lat IS NOT NULL
    AND start_lng IS NOT NULL AND start_station_id IS NOT NULL"""

SIDE = 0.25
# rectangles (u from, u to, v from, v to, sign) that make up each unit shape
RECTANGLES = {
    0: [(0, 1, 0, 0.5, 1), (0, 0.5, 0.5, 1, 1)],
    1: [(0, 1, 0, 1, 1)],
    2: [(0, 1, 0, 1, 1), (0.25, 0.5, 0.25, 0.5, -1)],
    3: [(0, 0.25, 0, 1, 1), (0.5, 1, 0, 1, 1)],
}


def _vertical(v: float, spherical: bool) -> str:
    angle = f"radians(y0 + {v}::DOUBLE * {SIDE})"
    return f"sin({angle})" if spherical else f"ln(tan(pi() / 4 + {angle} / 2))"


def area(spherical: bool = False) -> str:
    """Area in square kilometres of an area row (columns y0, shape)."""
    cases = []
    for shape, parts in RECTANGLES.items():
        terms = " + ".join(
            f"{sign} * radians({(u1 - u0) * SIDE}::DOUBLE)"
            f" * ({_vertical(v1, spherical)} - {_vertical(v0, spherical)})"
            for u0, u1, v0, v1, sign in parts
        )
        cases.append(f"WHEN {shape} THEN {terms}")
    return f"(6378137.0::DOUBLE * 6378137.0::DOUBLE * (CASE shape {' '.join(cases)} END) / 1e6)"


def inside(px: str, py: str, areas: str = "n") -> str:
    """Strictly inside, by ranges of the position within the unit square."""
    u = f"(({px} - {areas}.x0) / {SIDE})"
    v = f"(({py} - {areas}.y0) / {SIDE})"
    square = f"({u} > 0 AND {u} < 1 AND {v} > 0 AND {v} < 1)"
    return f"""(CASE {areas}.shape
        WHEN 0 THEN ({u} > 0 AND {u} < 1 AND {v} > 0 AND {v} < 0.5)
                 OR ({u} > 0 AND {u} < 0.5 AND {v} > 0 AND {v} < 1)
        WHEN 1 THEN {square}
        WHEN 2 THEN {square} AND NOT ({u} BETWEEN 0.25 AND 0.5 AND {v} BETWEEN 0.25 AND 0.5)
        WHEN 3 THEN {v} > 0 AND {v} < 1 AND (({u} > 0 AND {u} < 0.25) OR ({u} > 0.5 AND {u} < 1))
        END)"""


_CTES = {
    "trips": f"""
  SELECT l_orderkey || '-' || l_linenumber AS ride_id,
    CASE WHEN l_returnflag = 'A' THEN 'electric_bike' ELSE 'classic_bike' END AS rideable_type,
    {_START} AS started_at,
    {_START} + to_seconds(CAST(floor(l_extendedprice) AS BIGINT) % 100000) AS ended_at,
    {name('l_suppkey')} || CASE WHEN l_suppkey % 10 = 0 AND l_linenumber > 5 THEN ' (moved)'
      ELSE '' END AS start_station_name,
    CAST(l_suppkey AS VARCHAR) AS start_station_id,
    {name('l_partkey % 100')} AS end_station_name,
    CAST(l_partkey % 100 AS VARCHAR) AS end_station_id,
    CASE WHEN l_partkey % 97 <> 0 THEN {lat('l_suppkey')} END AS start_lat,
    CASE WHEN l_partkey % 97 <> 0 THEN {lng('l_suppkey')} END AS start_lng,
    CASE WHEN l_partkey % 53 <> 0 THEN {lat('(l_partkey % 100)')} END AS end_lat,
    CASE WHEN l_partkey % 53 <> 0 THEN {lng('(l_partkey % 100)')} END AS end_lng,
    CASE WHEN l_linestatus = 'F' THEN 'member' ELSE 'casual' END AS member_casual
  FROM lineitem""",
    "silver": f"""
  SELECT *, {_FEATURES}
  FROM (SELECT *, row_number() OVER (PARTITION BY ride_id ORDER BY {_COPY_ORDER}) AS copy
        FROM trips WHERE {COMPLETE})
  WHERE copy = 1 AND {SECONDS} BETWEEN 60 AND 86400""",
    "event_trips": f"""
  SELECT CAST(event_id AS VARCHAR) AS ride_id,
    CASE WHEN event_type = 'click' THEN 'electric_bike' ELSE 'classic_bike' END AS rideable_type,
    ts AS started_at, ts + to_seconds(CAST(floor(value * 300) AS BIGINT)) AS ended_at,
    {name('user_id')} AS start_station_name, CAST(user_id AS VARCHAR) AS start_station_id,
    CASE WHEN event_type <> 'error' THEN {lat('user_id')} END AS start_lat,
    CASE WHEN event_type <> 'error' THEN {lng('user_id')} END AS start_lng,
    CASE WHEN event_type = 'purchase' THEN 'casual' ELSE 'member' END AS member_casual
  FROM events""",
    "event_silver": f"""
  SELECT *, {_FEATURES} FROM event_trips
  WHERE {COMPLETE} AND {SECONDS} BETWEEN 60 AND 86400""",
    "daily": """
  SELECT start_station_id, start_station_name, trip_date,
    CAST(count(*) AS BIGINT) AS trips_started,
    avg(trip_duration_seconds) AS avg_duration_seconds,
    CAST(sum(CASE WHEN rideable_type = 'electric_bike' THEN 1 ELSE 0 END) AS BIGINT)
      AS ebike_trips,
    CAST(sum(CASE WHEN member_casual = 'member' THEN 1 ELSE 0 END) AS BIGINT) AS member_trips
  FROM silver GROUP BY ALL""",
    "split": """
  SELECT start_station_id, rideable_type, CAST(count(*) AS BIGINT) AS trip_count
  FROM silver GROUP BY ALL""",
    "pattern": """
  SELECT hour_of_day, day_of_week, rideable_type, member_casual,
    CAST(count(*) AS BIGINT) AS trip_count
  FROM event_silver GROUP BY ALL""",
    "hourly": """
  SELECT hour_of_day, day_of_week, CAST(sum(trip_count) AS BIGINT) AS total_trips
  FROM pattern GROUP BY ALL""",
    "top_all": """
  SELECT start_station_name, start_station_id,
    CAST(sum(trips_started) AS BIGINT) AS total_trips,
    round(avg(avg_duration_seconds) / 60, 1) AS avg_duration_min,
    CAST(sum(ebike_trips) AS BIGINT) AS ebike_trips,
    CAST(sum(member_trips) AS BIGINT) AS member_trips
  FROM daily GROUP BY ALL""",
    "top": """
  SELECT * FROM top_all ORDER BY total_trips DESC, start_station_id, start_station_name
  LIMIT 20""",
    "shares": """
  SELECT rideable_type, CAST(sum(trip_count) AS BIGINT) AS total_trips,
    round(100.0::DOUBLE * sum(trip_count) / sum(sum(trip_count)) OVER (), 2) AS pct
  FROM split GROUP BY rideable_type""",
    "offsets": """
  SELECT p, coalesce(end_offset, 0) AS end_offset, latest_offset, latest_offset - coalesce(end_offset, 0) AS lag
  FROM (SELECT CAST(user_id % 8 AS VARCHAR) AS p, CAST(ts AS DATE) AS day, max(event_id) AS latest_offset,
      max(event_id) FILTER (event_type <> 'error') AS end_offset FROM events
    WHERE CAST(ts AS DATE) > (SELECT CAST(max(ts) AS DATE) - 3 FROM events) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY day DESC) = 1""",
    "status": """
  SELECT CAST(user_id AS VARCHAR) AS station_id,
    CAST(floor(value) AS INTEGER) % 10 AS num_bikes_available,
    CAST(props ->> '$.k' AS INTEGER) AS num_docks_available,
    CAST(event_id % 3 AS INTEGER) AS num_ebikes_available,
    1 AS is_installed,
    CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END AS is_renting,
    CAST(floor(epoch(ts)) AS BIGINT) AS last_reported,
    CAST(floor(epoch(ts)) AS BIGINT) + 5 AS ingested_at,
    ts AS kafka_timestamp, ts AS processed_at
  FROM events""",
    "recent": """
  SELECT * FROM status
  WHERE processed_at >= (SELECT max(ts) FROM events) - INTERVAL 2880 MINUTE""",
    "available": """
  SELECT station_id, num_bikes_available, num_docks_available, is_renting,
    processed_at AS last_seen
  FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY processed_at DESC) AS rn
        FROM recent) WHERE rn = 1""",
    "stations": f"""
  SELECT CAST(s_suppkey AS VARCHAR) AS station_id, s_name AS name, {lat('s_suppkey')} AS lat,
    {lng('s_suppkey')} AS lon, CAST(10 + s_suppkey % 30 AS INTEGER) AS capacity
  FROM supplier""",
    "areas": f"""
  SELECT CAST(n_nationkey AS VARCHAR) AS neighborhood_id, n_name AS neighborhood_name,
    r_name AS borough, -74.0::DOUBLE + (n_nationkey % 5) * {SIDE} AS x0,
    40.0::DOUBLE + (n_nationkey // 5) * {SIDE} AS y0, n_nationkey % 4 AS shape
  FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "catchments": f"""
  SELECT CAST(c_custkey AS VARCHAR) AS neighborhood_id, c_name AS neighborhood_name,
    c_mktsegment AS borough, -74.0::DOUBLE + (c_custkey % 331) / 256.0::DOUBLE AS x0,
    40.0::DOUBLE + (c_custkey // 331) * {SIDE} AS y0, c_custkey % 4 AS shape
  FROM customer""",
    "placed": f"""
  SELECT s.*, n.neighborhood_id, n.neighborhood_name, n.borough
  FROM stations s LEFT JOIN areas n ON {inside('s.lon', 's.lat')}""",
    "usage": """
  SELECT p.*, coalesce(d.avg_daily_trips, 0.0::DOUBLE) AS avg_daily_trips
  FROM placed p LEFT JOIN (
    SELECT start_station_id, avg(trips_started) AS avg_daily_trips FROM daily GROUP BY 1
  ) d ON p.station_id = d.start_station_id""",
    "area_stats": """
  SELECT neighborhood_id, neighborhood_name, borough,
    CAST(count(DISTINCT station_id) AS BIGINT) AS station_count,
    CAST(sum(capacity) AS BIGINT) AS total_capacity, avg(avg_daily_trips) AS avg_daily_trips
  FROM usage WHERE neighborhood_id IS NOT NULL GROUP BY ALL""",
    "scores": f"""
  SELECT s.neighborhood_id, s.neighborhood_name, s.borough, s.station_count,
    s.total_capacity, s.avg_daily_trips, {area()} AS area_km2,
    round_even(s.station_count / {area()} * ln(1 + s.avg_daily_trips), 4) AS accessibility_score
  FROM area_stats s JOIN areas n USING (neighborhood_id)""",
}
PREFIX = "WITH" + ",".join(f"\n{key} AS ({body}\n)" for key, body in _CTES.items()) + "\n"


def using(body: str) -> str:
    """A statement that may use all of the expressions above."""
    return PREFIX + body.strip()
