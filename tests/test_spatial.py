from __future__ import annotations

import math
import random
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bikenet import schema as S
from bikenet.functions import geometry as G
from bikenet.functions import wkb
from bikenet.functions.conic import CONICS, US_FOOT, Conic
from bikenet.operators import spatial
from bikenet.sinks import write_geo_scores
from bikenet.sources.layers import read_geo_scores, read_scores
from helpers import plan_of

L_SHAPE = [(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4)]
HOLE = [(0.5, 0.5), (1.5, 0.5), (1.5, 1.5), (0.5, 1.5)]
SQUARE = [(4, 0), (8, 0), (8, 4), (4, 4)]


def polygons(spark, shapes):
    rows = [
        (key, f"name {key}", "borough", [[[list(map(float, p)) for p in ring] for ring in polygon]
                                         for polygon in geometry])
        for key, geometry in shapes.items()
    ]
    return spark.createDataFrame(rows, S.NEIGHBORHOOD_SCHEMA)


def points(spark, coordinates):
    rows = [(str(i), x, y) for i, (x, y) in enumerate(coordinates)]
    return spark.createDataFrame(rows, "station_id string, lon double, lat double")


def placed(stations, areas, **options):
    out = spatial.join_stations_to_neighborhoods(stations, areas, **options)
    return sorted((r["station_id"], r["neighborhood_id"]) for r in out.select(
        "station_id", F.coalesce("neighborhood_id", F.lit("-")).alias("neighborhood_id")).collect())


@pytest.fixture(scope="module")
def fixture_areas(spark):
    return polygons(spark, {"L": [[L_SHAPE, HOLE]], "Q": [[SQUARE]]})


@pytest.mark.parametrize("limit", [spatial.BROADCAST_LIMIT, -1])
def test_strictly_inside(spark, fixture_areas, limit):
    expected = {
        (3, 1): "L", (1, 3): "L", (1, 2): "L", (6, 2): "Q",
        (1, 1): "-", (4, 1): "-", (0, 0): "-", (2, 2): "-", (0.5, 1): "-", (3, 3): "-", (9, 9): "-",
        (-0.5, 2): "-", (8, 4): "-",
    }
    stations = points(spark, [(float(x), float(y)) for x, y in expected])
    got = placed(stations, fixture_areas, broadcast_limit=limit)
    assert [k for _, k in sorted(got, key=lambda r: int(r[0]))] == list(expected.values())


def test_missing_coordinates_duplicates_and_overlaps(spark, fixture_areas):
    overlapping = fixture_areas.unionByName(polygons(spark, {"O": [[[(2, 0), (6, 0), (6, 3), (2, 3)]]]}))
    stations = points(spark, [(3.0, 1.0), (3.0, 1.0), (None, 1.0), (float("nan"), 1.0)])
    assert placed(stations, overlapping) == [
        ("0", "L"), ("0", "O"), ("1", "L"), ("1", "O"), ("2", "-"), ("3", "-")]


def test_closed_rings_and_empty_geometry(spark):
    areas = polygons(spark, {"c": [[[*SQUARE, SQUARE[0]]]], "e": [], "r": [[[]]]})
    assert placed(points(spark, [(6.0, 2.0), (4.0, 2.0)]), areas) == [("0", "c"), ("1", "-")]
    empty = areas.where("neighborhood_id = 'e'")
    assert placed(points(spark, [(6.0, 2.0)]), empty) == [("0", "-")]


def _brute(point, geometry):
    """Even-odd rule in exact arithmetic, boundary outside."""
    from fractions import Fraction
    px, py = map(Fraction, point)
    odd = False
    for polygon in geometry:
        for ring in polygon:
            for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True):
                ax, ay, bx, by = map(Fraction, (ax, ay, bx, by))
                cross = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
                if cross == 0 and min(ax, bx) <= px <= max(ax, bx) and min(ay, by) <= py <= max(ay, by):
                    return False
                if (ay > py) != (by > py) and px < ax + (py - ay) * (bx - ax) / (by - ay):
                    odd = not odd
    return odd


def _star(rng, cx, cy, radius, corners):
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(corners))
    snap = 16
    return [(round((cx + rng.uniform(0.3, 1) * radius * math.cos(a)) * snap) / snap,
             round((cy + rng.uniform(0.3, 1) * radius * math.sin(a)) * snap) / snap) for a in angles]


def test_random_polygons_of_very_different_sizes(spark):
    rng = random.Random(7)
    shapes = {"big": [[_star(rng, 0, 0, 40, 30)]]}
    for i in range(30):
        shapes[f"s{i}"] = [[_star(rng, rng.uniform(-30, 30), rng.uniform(-30, 30),
                                  rng.choice([0.5, 2, 8]), rng.randint(5, 12))]]
    coordinates = [(rng.randint(-640, 640) / 16, rng.randint(-640, 640) / 16) for _ in range(1500)]
    corner = [v for g in shapes.values() for v in g[0][0]]
    coordinates += rng.sample(corner, 40)
    expected = []
    for i, p in enumerate(coordinates):
        hits = [k for k, g in shapes.items() if _brute(p, g)]
        expected += [(str(i), k) for k in hits] or [(str(i), "-")]
    areas, stations = polygons(spark, shapes), points(spark, coordinates)
    assert placed(stations, areas) == sorted(expected)
    assert placed(stations, areas, grid=spatial.Grid(3.7, 1.3, 0.0), broadcast_limit=-1) == sorted(expected)


def test_bound_covers_the_cell_table(spark):
    rng = random.Random(3)
    areas = polygons(spark, {
        str(i): [[_star(rng, i, i, rng.choice([1, 3, 20]), 40)]] for i in range(20)})
    grid = spatial.measure_grid(areas)
    cells, copies = spatial.polygon_cells(areas, grid).agg(
        F.count("*"), F.sum(F.size("_edges"))).first()
    actual = cells * spatial._CELL_BYTES + copies * spatial._EDGE_BYTES
    assert actual <= grid.cell_table_bytes <= 5 * actual


def test_plans(spark, fixture_areas):
    stations = points(spark, [(1.0, 2.0)])
    small = plan_of(spatial.join_stations_to_neighborhoods(stations, fixture_areas), "simple")
    assert "BroadcastHashJoin" in small
    large = plan_of(spatial.join_stations_to_neighborhoods(
        stations, fixture_areas, broadcast_limit=-1), "simple")
    for plan in (small, large):
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_crowded_cell_is_not_lost(spark, fixture_areas):
    """A third of all points in one spot."""
    crowd = spark.range(9000).select(
        F.col("id").cast("string").alias("station_id"),
        F.when(F.col("id") % 3 == 0, 3.0).otherwise(F.col("id") % 10 + 0.25).alias("lon"),
        F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.col("id") % 5 + 0.25).alias("lat"),
    )
    out = spatial.join_stations_to_neighborhoods(crowd, fixture_areas, broadcast_limit=-1)
    assert out.count() == 9000
    assert out.where("neighborhood_id = 'L'").count() >= 3000


def test_areas(spark):
    # one degree square at the equator, and the same with a quarter-degree hole
    outer = [(0, 0), (1, 0), (1, 1), (0, 1)]
    hole = [(0.25, 0.25), (0.5, 0.25), (0.5, 0.5), (0.25, 0.5)]
    df = polygons(spark, {"a": [[outer]], "b": [[outer, hole]], "c": [[outer[::-1]]], "e": []})
    rows = {r[0]: (r[1], r[2]) for r in df.select(
        "neighborhood_id", G.area_km2(F.col("geometry")), G.area_km2(F.col("geometry"), "spherical"),
    ).collect()}
    side = math.radians(1) * 6378.137
    assert rows["a"][1] == pytest.approx(side * math.sin(math.radians(1)) * 6378.137, rel=1e-12)
    assert rows["c"] == pytest.approx(rows["a"])
    assert rows["b"][0] < rows["a"][0] and rows["e"] == (0, 0)
    assert 1 < rows["a"][0] / rows["a"][1] < 1.001


def test_column_names():
    assert spatial.find_lat_lng(["Start_Lat", "START_LNG"]) == ("Start_Lat", "START_LNG")
    assert spatial.find_lat_lng(["latitude", "longitude"]) == ("latitude", "longitude")
    with pytest.raises(ValueError, match="latitude"):
        spatial.find_lat_lng(["lat", "y"])


def test_points(spark):
    point = spatial.stations_to_points(points(spark, [(1.5, 2.5)])).first()["point"]
    assert point.asDict() == {"lng": 1.5, "lat": 2.5}


@pytest.fixture
def network(spark, fixture_areas):
    stations = spark.createDataFrame([
        ("a", 3.0, 1.0, 10), ("a", 3.0, 1.0, 10), ("b", 1.0, 3.0, None), ("q", 6.0, 2.0, 5),
        ("out", 9.0, 9.0, 50),
    ], "station_id string, lon double, lat double, capacity int")
    daily = spark.createDataFrame(
        [("a", 10), ("a", 20), ("q", 7), ("ghost", 99)], "start_station_id string, trips_started long")
    return stations, daily, fixture_areas


def test_scores(spark, network):
    stations, daily, areas = network
    rows = {r["neighborhood_id"]: r for r in
            spatial.compute_accessibility_scores(daily, stations, areas).collect()}
    assert set(rows) == {"L", "Q"}
    left = rows["L"]
    assert (left["station_count"], left["total_capacity"]) == (2, 20)
    assert left["avg_daily_trips"] == pytest.approx((15 + 15 + 0) / 3)
    assert left["accessibility_score"] == round(2 / left["area_km2"] * math.log1p(10), 4)
    assert rows["Q"]["avg_daily_trips"] == 7


def test_crosswalk_between_id_systems(spark, network):
    stations, daily, areas = network
    crosswalk = spark.createDataFrame(
        [("ghost", "b")], "start_station_id string, station_id string")
    placed_rows = spatial.join_stations_to_neighborhoods(stations, areas)
    usage = spatial.stations_with_trips(placed_rows, daily, crosswalk)
    assert {(r["station_id"], r["avg_daily_trips"]) for r in usage.collect()} == {
        ("a", 0.0), ("b", 99.0), ("q", 0.0), ("out", 0.0)}


def test_several_trip_ids_of_one_station(spark, network):
    stations, _, areas = network
    daily = spark.createDataFrame(
        [("x", "2024-01-01", 3), ("y", "2024-01-01", 5), ("y", "2024-01-02", 2)],
        "start_station_id string, trip_date string, trips_started long")
    crosswalk = spark.createDataFrame(
        [("x", "a"), ("y", "a"), ("y", "a")], "start_station_id string, station_id string")
    placed_rows = spatial.join_stations_to_neighborhoods(stations, areas)
    usage = spatial.stations_with_trips(placed_rows, daily, crosswalk)
    assert usage.count() == placed_rows.count()
    assert usage.where("station_id = 'a'").first()["avg_daily_trips"] == 5.0


def test_missing_area_counts_as_one(spark, network):
    stats = spark.createDataFrame([("Z", 4)], "neighborhood_id string, station_count long")
    areas = spatial.neighborhood_area(network[2])
    assert spatial.with_area(stats, areas).first()["area_km2"] == 1.0


def test_score_table_round_trip(spark, network, tmp_path):
    stations, daily, areas = network
    scores = spatial.compute_accessibility_scores(daily, stations, areas.where("neighborhood_id='L'"))
    geo = spatial.geo_scores(areas, scores)
    write_geo_scores(geo, str(tmp_path / "scores"))
    rows = {r["neighborhood_id"]: r for r in read_scores(spark, str(tmp_path / "scores")).collect()}
    assert rows["Q"]["accessibility_score"] is None and rows["Q"]["neighborhood_name"] == "name Q"
    assert rows["L"]["accessibility_score"] is not None
    assert spatial.map_scores(areas, scores).where("station_count is null").count() == 1
    back = read_geo_scores(spark, str(tmp_path / "scores"))
    assert sorted(back.collect()) == sorted(geo.collect())
    stored = spark.read.parquet(str(tmp_path / "scores"))
    assert stored.schema["geometry"].dataType == T.BinaryType()
    assert stored.schema["geometry"].metadata == wkb.COLUMN_METADATA
    assert plan_of(read_scores(spark, str(tmp_path / "scores"))).count("ArrowEvalPython") == 0


def _plain_wkb(polygons, order="<"):
    """The standard's words, one number after the other."""
    flag = bytes([order == "<"])

    def polygon(rings):
        out = flag + struct.pack(order + "II", 3, len(rings))
        for ring in rings:
            out += struct.pack(order + "I", len(ring)) + b"".join(struct.pack(order + "dd", *v[:2]) for v in ring)
        return out

    if len(polygons) == 1:
        return polygon(polygons[0])
    return flag + struct.pack(order + "II", 6, len(polygons)) + b"".join(map(polygon, polygons))


def test_binary_geometry_against_the_standard():
    draw = random.Random(4)
    ring = lambda: [[draw.uniform(-180, 180), draw.uniform(-90, 90)] for _ in range(draw.randrange(6))]
    shapes = [[[ring() for _ in range(draw.randrange(4))] for _ in range(draw.randrange(4))] for _ in range(200)]
    shapes += [[], [[]], [[[]]], [[], []]]
    kind = pa.list_(pa.list_(pa.list_(pa.list_(pa.float64()))))
    column = pa.array([None, *shapes, None], kind)
    assert wkb.encoded(column).to_pylist() == [None, *map(_plain_wkb, shapes), None]
    assert wkb.encoded(column.slice(3, 50)).to_pylist() == list(map(_plain_wkb, shapes[2:52]))
    assert wkb.encoded(column.slice(0, 0)).to_pylist() == [] and wkb.encoded(column.slice(0, 1)).to_pylist() == [None]
    assert wkb.decoded(wkb.encoded(column)).to_pylist() == column.to_pylist()
    big = pa.array([_plain_wkb(s, ">") for s in shapes], pa.binary())
    assert wkb.decoded(big).to_pylist() == shapes
    high = [[[[1.0, 2.0, 9.0]]]]
    assert wkb.decoded(wkb.encoded(pa.array([high], kind))).to_pylist() == [[[[[1.0, 2.0]]]]]
    with pytest.raises(ValueError, match="two ordinates"):
        wkb.encoded(pa.array([[[[[1.0]]]]], kind))


def test_binary_geometry_of_others(spark):
    point = struct.pack("<BIdd", 1, 1, 1.0, 2.0)
    with_height = struct.pack("<BIIIddd", 1, 1003, 1, 1, 1.0, 2.0, 3.0)
    extended = struct.pack("<BIIIIdddd", 1, 3 | 0x80000000 | 0x40000000 | 0x20000000, 4326, 1, 1, 1.0, 2.0, 3.0, 4.0)
    whole = _plain_wkb([[[[1.0, 2.0], [3.0, 4.0]]]])
    rows = [(i, v) for i, v in enumerate([point, with_height, extended, whole, whole[:-1], b"", b"\x01", None])]
    read = spark.createDataFrame(rows, "i int, b binary").select("i", wkb.from_wkb(F.col("b")).alias("g"))
    one = [[[[1.0, 2.0]]]]
    assert [r["g"] for r in sorted(read.collect())] == [
        None, one, one, [[[[1.0, 2.0], [3.0, 4.0]]]], None, None, None, None]


def test_polygons_of_very_unequal_sizes(spark):
    """Sizes of 1 to 10 000 in one place: small polygons don't crowd the cells of a large one."""
    squares = [("large", 0.0, 0.0, 10.0)] + [(f"s{i}", 1 + (i % 30) * 0.002, 1 + (i // 30) * 0.002, 0.001) for i in range(900)]
    rows = [(n, n, "b", [[[[x, y], [x + s, y], [x + s, y + s], [x, y + s], [x, y]]]]) for n, x, y, s in squares]
    areas = spark.createDataFrame(rows, S._struct(
        neighborhood_id=T.StringType(), neighborhood_name=T.StringType(), borough=T.StringType(), geometry=S.GEOMETRY))
    grid = spatial.measure_grid(areas)
    assert len(grid.levels) == 2
    cells = spatial.polygon_cells(areas, grid)
    assert cells.groupBy("cell_level", "cell_x", "cell_y").count().agg(F.max("count")).first()[0] <= 6
    assert cells.count() <= 40 * len(rows)
    points = [(i, 1 + (i % 30) * 0.002 + 0.0005, 1 + (i // 30) * 0.002 + 0.0005) for i in range(900)]
    points += [(1000, 9.5, 9.5), (1001, 11.0, 1.0), (1002, None, 1.0), (1003, 1.0, 1.0)]
    stations = spark.createDataFrame([(str(i), y, x) for i, x, y in points], "station_id string, lat double, lon double")
    want = sorted([(str(i), "large") for i in range(900)] + [(str(i), f"s{i}") for i in range(900)]
                  + [("1000", "large"), ("1001", ""), ("1002", ""), ("1003", "large")])
    for limit in (spatial.BROADCAST_LIMIT, -1):
        placed = spatial.join_stations_to_neighborhoods(stations, areas, broadcast_limit=limit)
        assert sorted((r["station_id"], r["neighborhood_id"] or "") for r in placed.collect()) == want


def test_conic_of_the_published_example(spark):
    """The worked example that the registry of coordinate systems publishes for this projection, and round trips."""
    texas = Conic(6378206.4, 294.978698214, 27 + 50 / 60, -99.0, (28 + 23 / 60, 30 + 17 / 60), 2_000_000.0, 0.0, US_FOOT)
    one = spark.range(1).select(
        texas.inverse(F.array(F.lit(2963503.91), F.lit(254759.80))).alias("back"),
        texas.forward(F.array(F.lit(-96.0), F.lit(28.5))).alias("there")).first()
    assert abs(one["back"][0] + 96) < 1e-7 and abs(one["back"][1] - 28.5) < 1e-7
    assert abs(one["there"][0] - 2963503.91) < 0.006 and abs(one["there"][1] - 254759.80) < 0.006
    south = Conic(6378160.0, 298.25, -37.0, 145.0, (-36.0, -38.0), 2_500_000.0, 4_500_000.0)
    for conic, lng, lat in ((CONICS[2263], -74.0, 40.0), (CONICS[32118], -74.0, 40.0), (south, 144.0, -38.0)):
        points = spark.range(400).select(F.array(lng + F.col("id") % 20 * 0.1, lat + F.floor(F.col("id") / 20) * 0.1).alias("p"))
        off = points.select(F.zip_with("p", conic.inverse(conic.forward(F.col("p"))), lambda a, b: F.abs(a - b)).alias("d"))
        assert off.agg(F.max(F.array_max("d"))).first()[0] < 1e-10
    origin = spark.range(1).select(CONICS[2263].forward(F.array(F.lit(-74.0), F.lit(40 + 10 / 60))).alias("o")).first()["o"]
    assert abs(origin[0] - 984250) < 0.01 and abs(origin[1]) < 1e-6


def test_catchments_of_any_key_lie_where_the_stations_are(spark, tmp_path):
    """The job is no smaller for large keys: areas go on to overlap in the stations' land."""
    import duckdb

    from bikenet.registry import load

    con = duckdb.connect()
    for name, rows in (
        ("customer", "SELECT 500000 + r AS c_custkey, 'c' || r AS c_name, 'b' AS c_mktsegment FROM range(200) x(r)"),
        ("supplier", "SELECT r AS s_suppkey, 's' || r AS s_name FROM range(60) x(r)"),
    ):
        con.execute(f"COPY ({rows}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    for name in ("lineitem", "events", "nation", "region"):  # named by expressions that the statement leaves out
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    want = con.execute(load().ORACLE["place_in_catchments"]).fetchall()
    got = [tuple(r) for r in load().QUERIES["place_in_catchments"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(area is not None for _, area, _ in got) > 100


def test_written_out_inside_test_agrees_with_the_general_one(spark):
    """Corners, edges, holes, slanted and level edges, and points without coordinates."""
    slanted = [(0.1, 0.3), (3.7, 0.9), (2.2, 3.9), (0.4, 2.0)]
    areas = polygons(spark, {"L": [[L_SHAPE]], "slanted": [[slanted]], "holed": [[SQUARE, [(5, 1), (6, 2), (5, 3)]]]})
    random.seed(3)
    spots = [(x / 4, y / 4) for x in range(-2, 34) for y in range(-2, 18)] + [(None, 1.0), (math.nan, 1.0), (1.0, None)]
    spots += slanted + [(random.uniform(0, 4), random.uniform(0, 4)) for _ in range(200)]
    stations = points(spark, spots)
    grid = spatial.measure_grid(areas)
    assert grid.most_edges == 7
    general = spatial.replace(grid, most_edges=None, levels=tuple(spatial.replace(g, most_edges=None) for g in grid.levels))
    for limit in (spatial.BROADCAST_LIMIT, -1):
        assert placed(stations, areas, grid=grid, broadcast_limit=limit) == placed(stations, areas, grid=general)


def test_inside_test_is_compiled_with_the_join(spark):
    """Java compiles no method beyond 8000 bytes, and Spark no plan step with a higher-order function."""
    import re

    areas = polygons(spark, {"L": [[L_SHAPE]], "holed": [[SQUARE, HOLE]]})
    joined = spatial.join_stations_to_neighborhoods(points(spark, [(1.0, 1.0)]), areas, broadcast_limit=-1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(joined, "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(size) for size, body in re.findall(
        r"maxMethodCodeSize:(\d+)[^\n]*==\n((?:(?!Generated code:)[\s\S])*)", plan) if "SortMergeJoin" in body]
    assert sizes and max(sizes) < 8000


def test_polygons_with_missing_ordinates_take_the_general_test(spark):
    broken = polygons(spark, {"L": [[L_SHAPE]]}).union(spark.sql(
        "SELECT 'n', 'n', 'b', array(array(array(array(0D, 0D), array(CAST(NULL AS DOUBLE), 2D), array(2D, 0D))))"))
    assert spatial.measure_grid(broken).most_edges > spatial.FEW_EDGES


def test_many_polygons_are_neither_shuffled_nor_sorted(spark, monkeypatch):
    """Cells beyond the limit, points within: on one level and on several."""
    random.seed(11)
    corners = [(random.randint(0, 60) / 4, random.randint(0, 60) / 4) for _ in range(150)]
    shapes = {f"a{i}": [[[(x + u, y + v) for u, v in (L_SHAPE if i % 2 else [(0, 0), (3, 1), (2, 4)])]]]
              for i, (x, y) in enumerate(corners)}
    spots = [(random.randint(-4, 90) / 4 + 0.125 * (i % 2), random.randint(-4, 90) / 4) for i in range(300)]
    stations = points(spark, [*spots, *spots[:20], (None, 1.0), (math.nan, 1.0), (1.0, None), (90.0, 90.0), (-0.0, 0.0)])
    tiny = {f"t{i}": [[[(x, y), (x + 0.05, y), (x + 0.05, y + 0.05), (x, y + 0.05)]]]
            for i, (x, y) in enumerate((a - 0.025, b - 0.025) for a, b in spots[::3])}
    for areas, part in ((polygons(spark, shapes), 2), (polygons(spark, shapes | tiny), 64)):
        grid = spatial.measure_grid(areas)
        limit = int(grid.cell_table_bytes) - 1
        want = placed(stations, areas, grid=grid, broadcast_limit=limit + 2)
        assert {"-"} < {area for _, area in want}
        monkeypatch.setattr(spatial, "FIRST_PART", part)
        assert placed(stations, areas, grid=grid, broadcast_limit=limit) == want
        joined = spatial.join_stations_to_neighborhoods(stations, areas, grid, broadcast_limit=limit)
        assert joined.schema.names == [*stations.columns, *spatial.AREA_COLUMNS]
        plan = plan_of(joined, "simple")
        assert "SortMergeJoin" not in plan and "NestedLoop" not in plan
        assert not [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and ("cell_" in line or "neighborhood" in line)]


def test_inside_test_is_compiled_with_the_join_in_place(spark):
    import re

    areas = polygons(spark, {str(i): [[L_SHAPE]] if i % 2 else [[SQUARE, HOLE]] for i in range(40)})
    grid = spatial.measure_grid(areas)
    joined = spatial.join_stations_to_neighborhoods(
        points(spark, [(1.0, 1.0)]), areas, grid, broadcast_limit=int(grid.cell_table_bytes) - 1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(joined, "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(size) for size, body in re.findall(
        r"maxMethodCodeSize:(\d+)[^\n]*==\n((?:(?!Generated code:)[\s\S])*)", plan) if "BroadcastHashJoin [cell_x" in body]
    assert sizes and max(sizes) < 8000


def test_points_beyond_the_limit_are_shuffled(spark):
    """Texts of a point count; a table of points too large to send is shuffled as before, and none is lost."""
    areas = polygons(spark, {str(i): [[L_SHAPE]] for i in range(3)})
    grid = spatial.measure_grid(areas)
    stations = points(spark, [(1.0, 1.0), (9.0, 9.0)]).withColumn("note", F.repeat(F.lit("x"), int(grid.cell_table_bytes)))
    limit = int(grid.cell_table_bytes) - 1
    assert "SortMergeJoin" in plan_of(spatial.join_stations_to_neighborhoods(stations, areas, grid, broadcast_limit=limit), "simple")
    assert placed(stations, areas, grid=grid, broadcast_limit=limit) == [("0", "0"), ("0", "1"), ("0", "2"), ("1", "-")]
