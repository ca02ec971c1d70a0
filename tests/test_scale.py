"""Plans must stay free of what does not grow: cross joins, Python rows, single-task steps."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from bikenet import schema as S
from bikenet.operators import cleaning, gold, serving, spatial, status
from bikenet.registry import load
from helpers import plan_of

SF_DIR = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "CollectLimit")


@pytest.mark.parametrize("name", sorted(load().QUERIES))
def test_plan_has_no_unbounded_step(spark, name):
    plan = plan_of(load().QUERIES[name](spark, SF_DIR), "simple")
    found = [node for node in FORBIDDEN if node in plan]
    assert not found, plan


def test_gold_tables_read_only_their_columns(spark, tmp_path):
    spark.createDataFrame([], S.SILVER_SCHEMA).write.partitionBy("year_month").parquet(
        str(tmp_path / "silver"))
    silver = spark.read.schema(S.SILVER_SCHEMA).parquet(str(tmp_path / "silver"))
    expected = {
        "trips_per_station": {"start_station_id", "start_station_name", "trip_date",
                              "trip_duration_seconds", "rideable_type", "member_casual"},
        "hourly_pattern": {"hour_of_day", "day_of_week", "rideable_type", "member_casual"},
        "rideable_split": {"start_station_id", "rideable_type"},
    }
    for name, table in gold.gold_tables(silver).items():
        read = re.search(r"ReadSchema: struct<(.*)>", plan_of(table)).group(1)
        assert {f.split(":")[0] for f in read.split(",")} == expected[name]


def _hot(spark, rows=60_000):
    """Trips of which a third start at one station, share one id, and fall on one day."""
    hot = F.col("id") % 3 == 0
    second = F.when(hot, 0).otherwise(F.col("id") * 1000)
    return spark.range(rows, numPartitions=12).select(
        F.when(hot, "hot").otherwise(F.col("id").cast("string")).alias("ride_id"),
        F.when(F.col("id") % 2 == 0, "electric_bike").otherwise("classic_bike").alias("rideable_type"),
        F.timestamp_seconds(second).alias("started_at"),
        F.timestamp_seconds(second + 600 + F.col("id") % 7).alias("ended_at"),
        F.when(hot, "A").otherwise(F.col("id").cast("string")).alias("start_station_name"),
        F.when(hot, "A").otherwise(F.col("id").cast("string")).alias("start_station_id"),
        F.lit(1.0).alias("start_lat"), F.lit(2.0).alias("start_lng"),
        F.lit("member").alias("member_casual"),
    )


def _shuffled_rows(spark, df):
    """Rows written by the shuffles of a finished query, largest first."""
    df.write.format("noop").mode("overwrite").save()
    query = spark._jsparkSession.sharedState().statusStore().executionsList()
    last = query.apply(query.length() - 1)
    values = spark._jsparkSession.sharedState().statusStore().executionMetrics(last.executionId())
    rows = []
    metrics = last.metrics()
    for i in range(metrics.length()):
        metric = metrics.apply(i)
        if metric.name() == "shuffle records written":
            value = values.get(metric.accumulatorId())
            if value.isDefined():
                rows.append(int(value.get().replace(",", "")))
    return sorted(rows, reverse=True)


def test_hot_keys_are_combined_before_the_shuffle(spark):
    trips = _hot(spark)
    unique = cleaning.dedupe_rides(trips)
    assert unique.count() == 40_001
    # one row per ordinary id, and at most one row of the hot id per map task
    assert 40_001 <= _shuffled_rows(spark, unique)[0] <= 40_000 + 12

    with_days = cleaning.temporal_features(cleaning.trip_duration(trips))
    daily = gold.trips_per_station(with_days)
    assert daily.where("start_station_id = 'A'").first()["trips_started"] == 20_000
    assert 40_001 <= _shuffled_rows(spark, daily)[0] <= 40_000 + 12

    readings = trips.select(
        F.col("start_station_id").alias("station_id"), F.col("ended_at").alias("processed_at"),
        F.lit(0).alias("num_bikes_available"),
    )
    assert status.latest_per_station(readings).count() == 40_001
    for result in (status.latest_per_station(readings), serving.status_summary(readings)):
        assert 40_001 <= _shuffled_rows(spark, result)[0] <= 40_000 + 12


def test_distinct_count_of_a_hot_id(spark):
    from bikenet.operators.quality import validate_dataframe
    row = validate_dataframe(_hot(spark)).first()
    assert row["duplicate_count"] == 19_999


@pytest.fixture
def tight_limits(spark):
    """Limits lowered to the size of the test data, so that adaptive execution has to act."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_crowded_cell_is_split(spark, tight_limits):
    """Most points in one cell of a cell table too large to broadcast."""
    from bikenet.operators.spatial import join_stations_to_neighborhoods
    from bikenet.registry.tables import DriverTables

    areas = DriverTables(spark, SF_DIR).neighborhoods()
    points = spark.range(200_000, numPartitions=16).select(
        F.col("id").cast("string").alias("station_id"),
        F.when(F.col("id") % 3 > 0, -73.99).otherwise(-74 + F.rand(1) * 1.3).alias("lon"),
        F.when(F.col("id") % 3 > 0, 40.01).otherwise(40 + F.rand(2) * 1.3).alias("lat"),
    )
    placed = join_stations_to_neighborhoods(points, areas, broadcast_limit=-1)
    assert placed.count() == 200_000
    placed.write.format("noop").mode("overwrite").save()
    placed.collect()
    assert "skewed" in plan_of(placed, "simple")
    assert placed.where("neighborhood_id = '0'").count() >= 133_333


def test_large_cell_tables_are_shuffled(spark):
    shuffled = plan_of(load().QUERIES["place_trip_starts_shuffled"](spark, SF_DIR), "simple")
    joins = re.findall(r"(\w+Join) \[[^\n]*cell_x", shuffled)
    assert joins and set(joins) == {"SortMergeJoin"}
    # many edges in few polygons: the planner's estimate is small, the measured bound is not
    ring = F.transform(F.sequence(F.lit(0), F.lit(1500)), lambda i: F.array(
        F.col("id") % 20 + F.cos(i * 0.0041888) * 0.4, F.floor(F.col("id") / 20) + F.sin(i * 0.0041888) * 0.4))
    areas = spark.range(300).select(
        F.col("id").cast("string").alias("neighborhood_id"), F.lit("n").alias("neighborhood_name"),
        F.lit("b").alias("borough"), F.array(F.array(ring)).alias("geometry"))
    grid = spatial.measure_grid(areas)
    points = spark.range(1000).select(
        F.col("id").cast("string").alias("station_id"), (F.col("id") % 15).cast("double").alias("lat"),
        (F.col("id") % 20).cast("double").alias("lon"))
    plan = plan_of(spatial.join_stations_to_neighborhoods(
        points, areas, grid, broadcast_limit=grid.cell_table_bytes - 1), "simple")
    assert set(re.findall(r"(\w+Join) \[[^\n]*cell_x", plan)) == {"SortMergeJoin"}
