"""Points in neighbourhood polygons and the accessibility score."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bikenet.functions import geometry as G
from bikenet.functions.ratios import accessibility
from bikenet.schema import LATITUDE_NAMES, LONGITUDE_NAMES
from bikenet.sources.geo import geometry_json

AREA_COLUMNS = ("neighborhood_id", "neighborhood_name", "borough")
BROADCAST_LIMIT = 64 * 1024 * 1024
ROWS_PER_WIDTH = 8
#: Polygons whose sizes are within this factor share a level of cells.
LEVEL_STEP = 8
_BOX = ("min_x", "max_x", "min_y", "max_y")
_EDGE_BYTES = 80  # seven 8-byte fields, null bits and the array slot
#: Polygons of up to so many edges have them as columns of their cells.
FEW_EDGES = 8
_CELL_BYTES = 160  # cell, box, offsets and alignment; the area's texts come on top
_SPOT_BYTES = 128  # a point's cell as key and as columns, place, null bits and pointers
#: Points may take so many times what cells may before polygons are shuffled instead.
POINTS_LIMIT = 2
#: Of polygons that do not move, one in so many is tried first for points that lie in any at all.
FIRST_PART = 64


def find_lat_lng(columns: Iterable[str]) -> tuple[str, str]:
    """Names of the latitude and longitude columns, matched without regard to case."""
    columns = list(columns)
    lat = next((c for c in columns if c.lower() in LATITUDE_NAMES), None)
    lng = next((c for c in columns if c.lower() in LONGITUDE_NAMES), None)
    if lat is None or lng is None:
        raise ValueError(f"no latitude/longitude columns among {columns}")
    return lat, lng


def stations_to_points(stations: DataFrame) -> DataFrame:
    """Add ``point`` = struct(lng, lat)."""
    lat, lng = find_lat_lng(stations.columns)
    x, y = F.col(lng).cast("double"), F.col(lat).cast("double")
    return stations.withColumn("point", F.struct(x.alias("lng"), y.alias("lat")))


@dataclass(frozen=True)
class Grid:
    """Cell width and height for a polygon table, and a bound on the bytes of its cell table.

    Polygons of very unequal sizes have ``levels``: a grid for each power of :data:`LEVEL_STEP` in which
    the size of some polygons lies. ``level`` tells which polygons a grid is for, all of them if ``None``.
    ``most_edges`` is no less than the edges of any polygon of the table, if known.
    """

    width: float
    height: float
    cell_table_bytes: float
    level: int | None = None
    levels: tuple[Grid, ...] = ()
    most_edges: int | None = None


def _level() -> Column:
    """The power of :data:`LEVEL_STEP` that a polygon's longer extent reaches; none for one without an inside."""
    wide, high = F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y")
    size = F.greatest(wide, high)
    return F.when((wide > 0) & (high > 0), F.ceil(F.log(size) / F.log(F.lit(float(LEVEL_STEP))))).cast("int")


def measure_grid(neighborhoods: DataFrame) -> Grid:
    """Choose the cells by one aggregation over the polygons; a row for each level reaches the driver.

    Small and large polygons have cells of their own size, or the small ones would crowd the cells that suit a large one.
    Within a level the width W is the root mean square extent of the bounding boxes and the height H an eighth
    of it, so that a cell keeps few of its polygon's edges. A polygon of width w and height h lies
    in at most (w/W + 2)(h/H + 2) cells, and an edge that rises by dy is kept in at most dy/H + 2
    rows of at most w/W + 2 columns. Summed up, this bounds the cell table by a multiple of the
    polygon table, however the polygons vary in size.
    """
    boxed = _with_box(_with_edges(neighborhoods))
    measured = boxed.select(
        _level().alias("level"),
        (F.col("max_x") - F.col("min_x")).alias("w"),
        (F.col("max_y") - F.col("min_y")).alias("h"),
        F.aggregate("_edges", F.lit(0.0), lambda acc, e: acc + e["dy"]).alias("rise"),
        F.size("_edges").alias("n"),
        F.when(F.exists("_edges", lambda e: e["dx"].isNull() | e["dy"].isNull()), FEW_EDGES + 1)
        .otherwise(F.size("_edges")).alias("most"),  # vertices with a NULL need the general test
        F.octet_length(F.concat_ws("", *AREA_COLUMNS)).alias("text"),
    ).where("level IS NOT NULL")
    sums = ("w * h", "w", "h", "w * rise", "w * n", "rise", "n")
    rows = measured.groupBy("level").agg(
        F.sqrt(F.avg(F.expr("w * w + h * h"))), F.count("*"), F.max("text"), F.max("most"),
        *(F.sum(F.expr(x)) for x in sums),
    ).orderBy("level").collect()
    grids = tuple(_grid_of(*row) for row in rows)
    if len(grids) < 2:
        return replace(grids[0], level=None) if grids else Grid(1.0, 1.0, 0.0)
    return Grid(grids[-1].width, grids[-1].height, sum(g.cell_table_bytes for g in grids), levels=grids,
                most_edges=max(g.most_edges for g in grids))


def _grid_of(level: int, width: float, polygons: int, text: int, most_edges: int, *totals: float) -> Grid:
    wh, w, h, w_rise, w_n, rise, n = totals
    height = width / ROWS_PER_WIDTH
    cells = wh / (width * height) + 2 * (w / width + h / height) + 4 * polygons
    copies = w_rise / (width * height) + 2 * (w_n / width + rise / height) + 4 * n
    if most_edges <= FEW_EDGES:
        copies = cells * FEW_EDGES
    return Grid(width, height, cells * (_CELL_BYTES + text) + copies * _EDGE_BYTES, level, most_edges=most_edges)


def polygon_cells(neighborhoods: DataFrame, grid: Grid) -> DataFrame:
    """One row per grid cell a polygon may reach, with the edges that matter inside that cell.

    For a point in the cell, a ray to the right meets only edges that reach the cell's row and
    do not end left of its column; all others are left out of the row. No shuffle is involved.
    """
    if grid.levels:
        return reduce(DataFrame.unionByName, (polygon_cells(neighborhoods, level) for level in grid.levels))

    def column_of(x: Column) -> Column:
        return F.floor(x / grid.width).cast("long")

    def row_of(y: Column) -> Column:
        return F.floor(y / grid.height).cast("long")

    def cover(cell: Callable, low: str, high: str) -> Column:
        return F.explode(F.sequence(cell(F.col(low)), cell(F.col(high))))

    boxed = _with_box(_with_edges(neighborhoods))
    if grid.level is not None:
        boxed = boxed.where(_level() == grid.level)
    rows = boxed.withColumn("cell_y", cover(row_of, "min_y", "max_y")).withColumn(
        "_edges", F.filter("_edges", lambda e: F.col("cell_y").between(
            row_of(e["y_lo"]), row_of(e["y_hi"]),
        )),
    )
    cells = rows.withColumn("cell_x", cover(column_of, "min_x", "max_x")).withColumn(
        "_edges", F.filter("_edges", lambda e: column_of(e["x_max"]) >= F.col("cell_x")),
    )
    return cells.where(F.size("_edges") > 0).select(
        *AREA_COLUMNS, F.lit(grid.level or 0).alias("cell_level"), "cell_x", "cell_y", *_BOX, "_edges",
    )


def join_stations_to_neighborhoods(
    stations: DataFrame, neighborhoods: DataFrame, grid: Grid | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Left join of points to the polygons they lie strictly inside of.

    A point on a boundary or outside gets NULLs, a point in several polygons several rows. The
    join is an equi-join on grid cells; the bounding box and then the inside test are extra
    conditions. The cells are broadcast when their measured bound keeps below ``broadcast_limit``
    bytes. Else, where the points' measured bound keeps below :data:`POINTS_LIMIT` times that and no polygon has more than
    :data:`FEW_EDGES` edges, the points are broadcast and the polygons stay where they are (see :func:`_join_in_place`). What is left is
    shuffled by cell, where adaptive execution splits a crowded cell. Where
    polygons are of one level, a point is in exactly one cell and is never copied; else it is looked up once on
    each level, and those found on none follow from anti-joins. Pass a ``grid`` to reuse a measurement.
    """
    lat, lng = find_lat_lng(stations.columns)
    px, py = _number(lng), _number(lat)
    grid = grid or measure_grid(neighborhoods)
    levels = grid.levels or (grid,)
    if (grid.most_edges is not None and grid.most_edges <= FEW_EDGES and 0 <= broadcast_limit < grid.cell_table_bytes
            and _point_table_bytes(stations) * len(levels) <= POINTS_LIMIT * broadcast_limit):
        return _join_in_place(stations, px, py, neighborhoods, grid)
    spots = F.array(*(F.struct(
        F.lit(g.level or 0).alias("level"), F.floor(px / g.width).cast("long").alias("x"),
        F.floor(py / g.height).cast("long").alias("y")) for g in levels))
    nowhere = F.lit(float("nan"))  # right of and above all boxes
    located = stations.withColumns({"_x": F.coalesce(px, nowhere), "_y": F.coalesce(py, nowhere), "_spots": spots})
    few = grid.most_edges is not None and grid.most_edges <= FEW_EDGES
    # the planner's own estimate does not see the edges multiply over the cells, so both sides are told
    small = grid.cell_table_bytes <= broadcast_limit
    columns = [F.col(f"`{c}`") for c in stations.columns]

    def told(cells: DataFrame) -> DataFrame:
        if few:
            flat = (c.alias(name) for name, c in G.flat_edges(F.col("_edges"), FEW_EDGES).items())
            cells = cells.select(*(c for c in cells.columns if c != "_edges"), *flat)
        return F.broadcast(cells) if small else cells.hint("merge")

    inside = (
        (F.col("_spot.level") == F.col("cell_level"))
        & (F.col("_spot.x") == F.col("cell_x"))
        & (F.col("_spot.y") == F.col("cell_y"))
        & (F.col("_x") > F.col("min_x")) & (F.col("_x") < F.col("max_x"))
        & (F.col("_y") > F.col("min_y")) & (F.col("_y") < F.col("max_y"))
        & (G.within_flat("_x", "_y", FEW_EDGES) if few
           else G.within(F.col("_x"), F.col("_y"), F.col("_edges")))
    )
    if len(levels) == 1:
        spotted = located.withColumn("_spot", F.col("_spots")[0])
        return spotted.join(told(polygon_cells(neighborhoods, levels[0])), inside, "left").select(*columns, *AREA_COLUMNS)
    spotted = located.withColumn("_spot", F.explode("_spots"))
    met = spotted.join(told(polygon_cells(neighborhoods, grid)), inside).select(*columns, *AREA_COLUMNS)
    rest = located
    for place, level in enumerate(levels):
        rest = rest.withColumn("_spot", F.col("_spots")[place]).join(
            told(polygon_cells(neighborhoods, level)), inside, "left_anti")
    unplaced = (F.lit(None).cast(met.schema[c].dataType).alias(c) for c in AREA_COLUMNS)
    return met.union(rest.select(*columns, *unplaced))


def _join_in_place(stations: DataFrame, px: Column, py: Column, neighborhoods: DataFrame, grid: Grid) -> DataFrame:
    """The join for few points and many polygons of few edges: points are broadcast, each polygon looks its own up.

    Polygons are neither shuffled nor sorted, so their number takes no disk, and a crowded cell is the work of all tasks
    that hold its polygons. Their cells are never stored and may be small: squares as low as those of ``grid``.

    Whether a point lies in no polygon depends on its place only. One polygon in :data:`FIRST_PART` is tried first, which
    settles nearly all places that many polygons cover; the places left are tried against all polygons.
    """
    levels = grid.levels or (grid,)
    nowhere = F.lit(float("nan"))  # right of and above all boxes
    located = stations.withColumns({"_x": F.coalesce(px, nowhere), "_y": F.coalesce(py, nowhere)})
    spots = F.array(*(F.struct(
        F.lit(g.level or 0).alias("_level"), F.floor(px / g.height).cast("long").alias("_column"),
        F.floor(py / g.height).cast("long").alias("_row")) for g in levels))
    spotted = located.select("*", F.inline(spots))
    inside = (
        (F.col("_level") == F.col("cell_level")) & (F.col("_column") == F.col("cell_x")) & (F.col("_row") == F.col("cell_y"))
        & (F.col("_x") > F.col("min_x")) & (F.col("_x") < F.col("max_x"))
        & (F.col("_y") > F.col("min_y")) & (F.col("_y") < F.col("max_y"))
        & G.within_flat("_x", "_y", FEW_EDGES)
    )

    def met(polygons: DataFrame, points: DataFrame) -> DataFrame:
        return _square_cells(polygons, levels).join(F.broadcast(points), inside)

    columns = [F.col(f"`{c}`") for c in stations.columns]
    placed = met(neighborhoods, spotted).select(*columns, *AREA_COLUMNS)

    place = ["_x", "_y"]
    places = spotted.select(*place, "_level", "_column", "_row").distinct()
    part = neighborhoods.where(F.pmod(F.xxhash64(*AREA_COLUMNS, "geometry"), F.lit(FIRST_PART)) == 0)
    first = met(part, places).select(*place).distinct()
    left = places.join(F.broadcast(first), place, "left_anti")
    found = first.union(met(neighborhoods, left).select(*place).distinct())
    rest = located.join(F.broadcast(found), place, "left_anti")
    unplaced = (F.lit(None).cast(placed.schema[c].dataType).alias(c) for c in AREA_COLUMNS)
    return placed.union(rest.select(*columns, *unplaced))


def _square_cells(neighborhoods: DataFrame, levels: tuple[Grid, ...]) -> DataFrame:
    """One row per square cell that a polygon's box reaches, with all edges as columns, computed once per polygon."""
    boxed = _with_box(_with_edges(neighborhoods))
    if len(levels) == 1:
        leveled = boxed.withColumns({"cell_level": F.lit(levels[0].level or 0), "_side": F.lit(levels[0].height)})
    else:
        sides = (F.when(F.col("cell_level") == g.level, g.height) for g in levels)
        leveled = boxed.withColumn("cell_level", _level()).withColumn("_side", F.coalesce(*sides)).where("_side IS NOT NULL")

    def cover(low: str, high: str) -> Column:
        return F.explode(F.sequence(*(F.floor(F.col(end) / F.col("_side")).cast("long") for end in (low, high))))

    edges = (c.alias(name) for name, c in G.flat_edges(F.col("_edges"), FEW_EDGES).items())
    return leveled.select(*AREA_COLUMNS, "cell_level", "_side", *_BOX, *edges).withColumn(
        "cell_y", cover("min_y", "max_y")).withColumn("cell_x", cover("min_x", "max_x"))


def _point_table_bytes(points: DataFrame) -> float:
    """A bound on the bytes of the points as a hash table with a cell each, by one aggregation."""
    def width(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(value), F.lit(0)) + 15  # a whole number of words, and one for the place
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            return F.coalesce(F.octet_length(value.cast("string")), F.lit(0)) * 8 + 64
        return F.lit(24 if isinstance(field.dataType, (T.DecimalType, T.CalendarIntervalType)) else 8)

    of_row = reduce(lambda a, b: a + b, map(width, points.schema.fields), F.lit(_SPOT_BYTES))
    return float(points.agg(F.sum(of_row.cast("double"))).first()[0] or 0)


def unmatched_count(placed: DataFrame) -> DataFrame:
    """One row: points without a polygon, and all rows."""
    return placed.agg(
        F.count_if(F.col("neighborhood_id").isNull()).alias("unmatched"),
        F.count("*").alias("total"),
    )


def avg_daily_trips(trips_per_station: DataFrame) -> DataFrame:
    """Mean trips per row of the daily table, i.e. over the days with trips."""
    return trips_per_station.groupBy("start_station_id").agg(
        F.avg("trips_started").alias("avg_daily_trips"),
    )


def stations_with_trips(
    placed: DataFrame, trips_per_station: DataFrame, crosswalk: DataFrame | None = None,
) -> DataFrame:
    """Stations with their mean daily trips, 0 where there are none.

    ``crosswalk`` (``station_id``, ``start_station_id``) bridges differing id systems. Of a station
    with several trip ids the trips of a day are added up before the mean over its days.
    """
    if crosswalk is not None:
        pairs = crosswalk.select("start_station_id", "station_id").distinct()
        trips_per_station = trips_per_station.join(pairs, "start_station_id").drop("start_station_id")
        if "trip_date" in trips_per_station.columns:
            trips_per_station = trips_per_station.groupBy("station_id", "trip_date").agg(
                F.sum("trips_started").alias("trips_started"))
        trips_per_station = trips_per_station.withColumnRenamed("station_id", "start_station_id")
    daily = avg_daily_trips(trips_per_station).withColumnRenamed("start_station_id", "station_id")
    return placed.join(daily, "station_id", "left").withColumn(
        "avg_daily_trips", F.coalesce("avg_daily_trips", F.lit(0.0)),
    )


def neighborhood_stats(stations: DataFrame) -> DataFrame:
    """Stations, docks and mean daily trips per neighbourhood; unplaced stations left out."""
    return stations.dropna(subset=list(AREA_COLUMNS)).groupBy(*AREA_COLUMNS).agg(
        F.countDistinct("station_id").alias("station_count"),
        F.coalesce(F.sum("capacity"), F.lit(0)).alias("total_capacity"),
        F.avg("avg_daily_trips").alias("avg_daily_trips"),
    )


def neighborhood_area(neighborhoods: DataFrame, area: str = "mercator") -> DataFrame:
    return neighborhoods.select(
        "neighborhood_id", G.area_km2(F.col("geometry"), area).alias("area_km2"),
    )


def with_area(stats: DataFrame, areas: DataFrame) -> DataFrame:
    """Add ``area_km2``; 1 where a neighbourhood has no polygon."""
    return stats.join(areas, "neighborhood_id", "left").withColumn(
        "area_km2", F.coalesce("area_km2", F.lit(1.0)),
    )


def compute_accessibility_scores(
    trips_per_station: DataFrame, stations: DataFrame, neighborhoods: DataFrame,
    area: str = "mercator", crosswalk: DataFrame | None = None, grid: Grid | None = None,
) -> DataFrame:
    """Score of each neighbourhood with stations, highest first."""
    placed = join_stations_to_neighborhoods(stations, neighborhoods, grid)
    stats = neighborhood_stats(stations_with_trips(placed, trips_per_station, crosswalk))
    scored = with_area(stats, neighborhood_area(neighborhoods, area)).withColumn(
        "accessibility_score",
        accessibility(F.col("station_count"), F.col("area_km2"), F.col("avg_daily_trips")),
    )
    return scored.orderBy(F.desc_nulls_last("accessibility_score"), "neighborhood_id")


def geo_scores(neighborhoods: DataFrame, scores: DataFrame) -> DataFrame:
    """Every polygon with its scores, if any; geometry nested and as GeoJSON text."""
    measures = scores.drop("neighborhood_name", "borough")
    return neighborhoods.join(measures, "neighborhood_id", "left").withColumn(
        "geometry_json", geometry_json(F.col("geometry")),
    )


def map_scores(neighborhoods: DataFrame, scores: DataFrame) -> DataFrame:
    """Every polygon with the scores of the same id, name and borough, for a map."""
    return neighborhoods.join(scores, list(AREA_COLUMNS), "left")


def _number(name: str) -> Column:
    """Column as double, with NaN as NULL: Spark orders NaN above all numbers."""
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


def _with_edges(neighborhoods: DataFrame) -> DataFrame:
    """Polygons with their edges. A generated row, unlike a column, is never computed again by what reads it."""
    edges = neighborhoods.select("*", F.explode(F.array(G.edges(F.col("geometry")))).alias("_edges"))
    return edges.where(F.size("_edges") > 0)


def _with_box(df: DataFrame) -> DataFrame:
    def ends(name: str) -> Column:
        return F.transform("_edges", lambda e: e[name])

    return df.select("*", F.inline(F.array(F.struct(
        F.array_min(ends("x_min")).alias("min_x"), F.array_max(ends("x_max")).alias("max_x"),
        F.array_min(ends("y_lo")).alias("min_y"), F.array_max(ends("y_hi")).alias("max_y"),
    ))))
