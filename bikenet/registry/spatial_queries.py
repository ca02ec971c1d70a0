"""Queries of the spatial operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bikenet.functions import geometry as G
from bikenet.functions.conic import CONICS
from bikenet.operators import spatial
from bikenet.registry.core import query
from bikenet.registry.serving_queries import as_double, rounded
from bikenet.registry.sql import area, inside, using
from bikenet.registry.tables import DriverTables
from bikenet.session import shared_folder
from bikenet.sinks import write_geo_scores
from bikenet.sources.layers import read_geo_scores, read_scores


@query(using("SELECT * FROM placed"))
def place_stations(t: DriverTables) -> DataFrame:
    return t.placed_stations()


@query(using("""
SELECT station_id, lon AS lng, lat FROM stations
"""))
def station_points(t: DriverTables) -> DataFrame:
    return spatial.stations_to_points(t.stations()).select("station_id", "point.lng", "point.lat")


@query(using(f"""
SELECT c.station_id, n.neighborhood_id, n.neighborhood_name, n.borough
FROM (SELECT c_custkey AS station_id,
  40.0::DOUBLE + (c_custkey * 29 % 337) / 256.0::DOUBLE AS latitude,
  -74.0::DOUBLE + (c_custkey * 13 % 331) / 256.0::DOUBLE AS longitude FROM customer) c
LEFT JOIN areas n ON {inside('c.longitude', 'c.latitude')}
"""))
def place_customers(t: DriverTables) -> DataFrame:
    return t.placed(t.customer_points()).drop("latitude", "longitude")


@query(using(f"""
SELECT s.station_id, n.neighborhood_id, n.borough
FROM stations s LEFT JOIN (
  SELECT CAST(c_custkey AS VARCHAR) AS neighborhood_id, c_name AS neighborhood_name,
    c_mktsegment AS borough, -74.0::DOUBLE + (c_custkey * 13 % 331) / 256.0::DOUBLE AS x0,
    40.0::DOUBLE + (c_custkey * 29 % 337) / 256.0::DOUBLE AS y0, c_custkey % 4 AS shape
  FROM customer) n ON {inside('s.lon', 's.lat')}
"""))
def place_in_catchments(t: DriverTables) -> DataFrame:
    """Stations in many overlapping polygons, a row for each."""
    stations = t.stations().select("station_id", "lat", "lon")
    placed = spatial.join_stations_to_neighborhoods(stations, t.crowded_catchments())
    return placed.select("station_id", "neighborhood_id", "borough")


@query(using(f"""
SELECT h.station_id, f.neighborhood_id FROM (SELECT c_custkey AS station_id FROM customer) h LEFT JOIN (
  SELECT p.station_id, n.neighborhood_id FROM (
    SELECT c_custkey AS station_id, -74.0::DOUBLE + (c_custkey % 4096) / 1024.0::DOUBLE AS lon,
      40.0::DOUBLE + (c_custkey // 4096) / 1024.0::DOUBLE AS lat FROM customer) p
  JOIN areas n ON {inside('p.lon', 'p.lat')}
  UNION ALL SELECT c_custkey, 'k' || c_custkey FROM customer WHERE c_custkey % 10 = 0) f USING (station_id)
"""))
def place_in_levels(t: DriverTables) -> DataFrame:
    """Points in areas and in kiosks of a thousandth of their size, on a level of cells each."""
    areas = t.neighborhoods().unionByName(t.kiosks())
    return spatial.join_stations_to_neighborhoods(t.homes(), areas).select("station_id", "neighborhood_id")


@query(using(f"""
SELECT n.neighborhood_id, n.borough, CAST(count(*) AS BIGINT) AS trips
FROM trips t LEFT JOIN areas n ON {inside('t.start_lng', 't.start_lat')}
GROUP BY ALL
"""))
def place_trip_starts(t: DriverTables) -> DataFrame:
    """Every trip's start point; trips without coordinates stay unplaced."""
    starts = t.trips().select("start_lat", "start_lng")
    placed = t.placed(starts)
    return placed.groupBy("neighborhood_id", "borough").agg(F.count("*").alias("trips"))


@query(using(f"""
SELECT n.neighborhood_id, n.borough, CAST(count(*) AS BIGINT) AS trips
FROM trips t LEFT JOIN areas n ON {inside('t.start_lng', 't.start_lat')}
GROUP BY ALL
"""))
def place_trip_starts_shuffled(t: DriverTables) -> DataFrame:
    """As above with a cell table taken as too large to broadcast."""
    starts = t.trips().select("start_lat", "start_lng")
    placed = t.placed(starts, broadcast_limit=-1)
    return placed.groupBy("neighborhood_id", "borough").agg(F.count("*").alias("trips"))


@query(using("""
SELECT CAST(count(*) FILTER (neighborhood_id IS NULL) AS BIGINT) AS unmatched,
  CAST(count(*) AS BIGINT) AS total FROM placed
"""))
def unmatched_count(t: DriverTables) -> DataFrame:
    return spatial.unmatched_count(t.placed_stations())


@query(using("""
SELECT start_station_id, avg(trips_started) AS avg_daily_trips FROM daily GROUP BY 1
"""))
def avg_daily_trips(t: DriverTables) -> DataFrame:
    return spatial.avg_daily_trips(t.daily())


@query(using("SELECT * FROM usage"))
def stations_with_trips(t: DriverTables) -> DataFrame:
    return spatial.stations_with_trips(t.placed_stations(), t.daily()).select(
        "station_id", "name", "lat", "lon", "capacity",
        *spatial.AREA_COLUMNS, "avg_daily_trips",
    )


@query(using("SELECT * REPLACE (round(avg_daily_trips, 9) AS avg_daily_trips) FROM area_stats"))
def neighborhood_stats(t: DriverTables) -> DataFrame:
    usage = spatial.stations_with_trips(t.placed_stations(), t.daily())
    return rounded(spatial.neighborhood_stats(usage), 9, "avg_daily_trips")


@query(using(f"""
SELECT neighborhood_id, round({area()}, 6) AS mercator_km2,
  round({area(spherical=True)}, 6) AS spherical_km2 FROM catchments
"""))
def neighborhood_area(t: DriverTables) -> DataFrame:
    return t.catchments().select(
        "neighborhood_id",
        F.round(G.area_km2(F.col("geometry")), 6).alias("mercator_km2"),
        F.round(G.area_km2(F.col("geometry"), "spherical"), 6).alias("spherical_km2"),
    )


@query(using("""
SELECT * REPLACE (round(avg_daily_trips, 9) AS avg_daily_trips, round(area_km2, 6) AS area_km2)
FROM scores
"""))
def accessibility_scores(t: DriverTables) -> DataFrame:
    return rounded(rounded(t.scores(), 9, "avg_daily_trips"), 6, "area_km2")


@query(using("""
SELECT a.neighborhood_id, a.neighborhood_name, a.borough,
  CAST(s.station_count AS DOUBLE) AS station_count, s.accessibility_score,
  a.shape = 3 AS two_parts
FROM areas a LEFT JOIN scores s USING (neighborhood_id)
"""))
def geo_scores(t: DriverTables) -> DataFrame:
    """Every polygon with its scores, with the part count read back from the GeoJSON text."""
    geo = spatial.geo_scores(t.neighborhoods(), t.scores())
    parts = F.size(F.from_json(
        F.get_json_object("geometry_json", "$.coordinates"), "array<array<array<array<double>>>>",
    ))
    return as_double(geo, "station_count").select(
        "neighborhood_id", "neighborhood_name", "borough", "station_count",
        "accessibility_score", (parts == 2).alias("two_parts"),
    )


@query(using(f"""
SELECT a.neighborhood_id, a.neighborhood_name, s.accessibility_score, round({area()}, 6) AS area_km2,
  a.shape = 3 AS two_parts
FROM areas a LEFT JOIN scores s USING (neighborhood_id)
"""))
def stored_scores(t: DriverTables) -> DataFrame:
    """The score table written with binary polygons and read back, attributes and polygons apart."""
    path = f"{shared_folder(t.spark, 'scores')}/table"
    write_geo_scores(spatial.geo_scores(t.neighborhoods(), t.scores()), path)
    shapes = read_geo_scores(t.spark, path).select(
        "neighborhood_id", F.round(G.area_km2(F.col("geometry")), 6).alias("area_km2"),
        (F.size("geometry") == 2).alias("two_parts"))
    attributes = read_scores(t.spark, path).select("neighborhood_id", "neighborhood_name", "accessibility_score")
    return attributes.join(shapes, "neighborhood_id")


@query(using("""
SELECT a.neighborhood_id, a.neighborhood_name, a.borough,
  CAST(s.total_capacity AS DOUBLE) AS total_capacity, s.accessibility_score
FROM areas a LEFT JOIN scores s USING (neighborhood_id, neighborhood_name, borough)
"""))
def map_scores(t: DriverTables) -> DataFrame:
    return as_double(spatial.map_scores(t.neighborhoods(), t.scores()), "total_capacity").select(
        "neighborhood_id", "neighborhood_name", "borough", "total_capacity",
        "accessibility_score",
    )


@query(using(f"""
SELECT neighborhood_id, round({area()}, 5) AS area_km2 FROM catchments
"""))
def reprojected_area(t: DriverTables) -> DataFrame:
    """Polygons taken to Web Mercator and back before their area is measured."""
    projected = G.map_vertices(F.col("geometry"), G.mercator_x, G.mercator_y)
    restored = G.to_wgs84(projected, 3857)
    return t.catchments().select(
        "neighborhood_id", F.round(G.area_km2(restored), 5).alias("area_km2"),
    )


@query(using(f"""
SELECT neighborhood_id, round({area()}, 5) AS area_km2 FROM catchments
"""))
def conic_area(t: DriverTables) -> DataFrame:
    """Polygons taken to New York's state plane in US feet and back before their area is measured."""
    projected = G.map_points(F.col("geometry"), CONICS[2263].forward)
    return t.catchments().select(
        "neighborhood_id", F.round(G.area_km2(G.to_wgs84(projected, 2263)), 5).alias("area_km2"),
    )
