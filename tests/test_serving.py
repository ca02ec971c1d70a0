from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bikenet import schema as S
from bikenet.operators import monitoring, reporting, serving, status
from helpers import plan_of


@pytest.fixture(scope="module")
def daily(spark):
    day = dt.date(2024, 1, 1)
    rows = [
        ("a", "A St & 1 Ave", 10, 100.0, 6, 1, day),
        ("a", "A St & 1 Ave", 30, 200.0, 30, 2, dt.date(2024, 1, 2)),
        ("a", "A renamed", 5, 60.0, 0, 0, day),
        ("b", "B", 40, 90.0, 22, 40, day),
        ("c", None, 40, 90.0, 21, 40, day),
        ("z", "Z", 0, None, 0, 0, day),
    ]
    return spark.createDataFrame(rows, S.TRIPS_PER_STATION_SCHEMA)


def test_totals_ties_and_renamed_stations(daily):
    rows = serving.top_stations_by_trips(daily).collect()
    assert [(r["start_station_id"], r["total_trips"]) for r in rows] == [
        ("a", 40), ("b", 40), ("c", 40), ("a", 5), ("z", 0)]
    assert rows[0]["avg_duration_seconds"] == 150.0
    assert rows[0]["weighted_avg_duration_seconds"] == 175.0
    assert rows[4]["weighted_avg_duration_seconds"] is None
    same = serving.top_stations_by_trips(daily, 20, "electric_bike").collect()
    assert same == rows


def test_minutes_rounded(daily):
    assert [r["avg_duration_min"] for r in serving.top_stations(daily, 2).collect()] == [2.5, 1.5]


def test_top_k_plan(daily):
    assert "TakeOrderedAndProject" in plan_of(serving.top_stations(daily), "simple")


def test_smoke_fails_without_rows(daily):
    assert serving.gold_smoke(daily).count() == 5
    with pytest.raises(RuntimeError):
        serving.gold_smoke(daily.limit(0))


def test_shares(spark):
    split = spark.createDataFrame(
        [("a", "electric_bike", 1), ("b", "electric_bike", 1), ("a", "classic_bike", 1)],
        S.RIDEABLE_SPLIT_SCHEMA)
    rows = [tuple(r) for r in serving.rideable_split(split).collect()]
    assert rows == [("electric_bike", 2, 66.67), ("classic_bike", 1, 33.33)]
    only = serving.rideable_split(split, "classic_bike").collect()
    assert [r["pct"] for r in only] == [33.33]


def test_area_summary_keeps_areas_without_trips(spark, daily):
    scores = spark.createDataFrame(
        [("a", "Na", "X", 1.0), ("n", "Nn", "X", 2.0), ("z", "Nz", "Y", None)],
        "neighborhood_id string, neighborhood_name string, borough string, accessibility_score double")
    rows = serving.neighborhood_trip_summary(daily, scores).collect()
    assert [r["neighborhood_name"] for r in rows] == ["Nn", "Na", "Nz"]
    assert rows[0]["total_trips"] is None and rows[0]["ebike_pct"] is None
    assert rows[1]["total_trips"] == 45 and rows[1]["ebike_pct"] == 80.0
    assert rows[2]["total_trips"] == 0 and rows[2]["ebike_pct"] is None


def _status(spark, rows):
    base = dt.datetime(2024, 5, 1, 12)
    full = [(s, bikes, 1, 1, 1, 1, 0, i, base, base + dt.timedelta(minutes=m), base.date())
            for i, (s, bikes, m) in enumerate(rows)]
    return spark.createDataFrame(full, S.STATUS_LAYER_SCHEMA)


NOON = dt.datetime(2024, 5, 1, 12)


def test_equity_gap(spark, daily):
    readings = _status(spark, [("a", 0, 0), ("a", 2, 0), ("a", None, 0), ("b", 0, 0), (None, None, 0)])
    rows = serving.equity_gap_stations(daily, readings).collect()
    assert [tuple(r) for r in rows] == [
        ("a", 45, 1.0, 1, 3, 33.33), ("b", 40, 0.0, 1, 1, 100.0)]
    assert serving.equity_gap_stations(daily, readings, batch_limit=1).count() == 1
    crosswalk = spark.createDataFrame([("c", "b")], "start_station_id string, mapped_id string")
    mapped = serving.equity_gap_stations(daily, readings, crosswalk=crosswalk).collect()
    assert [r["historical_trips"] for r in mapped] == [80, 45]
    assert serving.status_summary(readings, drop_malformed=True).count() == 2


def test_availability_order_window_and_ties(spark):
    readings = _status(spark, [
        ("old", 0, -6), ("edge", 9, -5), ("a", 5, -1), ("a", 7, 0), ("a", 8, 0), ("n", None, 0),
        ("e", 0, 0)])
    now = status.current_station_availability(readings, 5, NOON)
    got = [(r["station_id"], r["num_bikes_available"]) for r in now.collect()]
    assert got == [("e", 0), ("a", 8), ("edge", 9), ("n", None)]
    metrics = monitoring.empty_station_metrics(now).first()
    assert tuple(metrics) == (1, 4)
    assert [r["station_id"] for r in monitoring.empty_station_sample(now).collect()] == ["e"]


def test_recent_window_prunes_partitions_and_pushes_the_bound(spark, tmp_path):
    readings = _status(spark, [("a", 1, 0)])
    path = str(tmp_path / "layer")
    readings.write.partitionBy("processing_date").parquet(path)
    layer = spark.read.schema(S.STATUS_LAYER_SCHEMA).parquet(path)
    plan = plan_of(status.current_station_availability(layer, 5, NOON))
    partition = plan[plan.index("PartitionFilters"):].splitlines()[0]
    assert "processing_date" in partition and "2024-05-01" in partition
    assert "GreaterThanOrEqual(processed_at" in plan
    assert "num_ebikes_available" not in plan[plan.index("ReadSchema"):].splitlines()[0]


def test_latest_reading_trims_before_the_shuffle(spark):
    plan = plan_of(status.latest_per_station(_status(spark, [("a", 1, 0)])), "simple")
    assert "WindowGroupLimit" in plan[plan.index("Exchange hashpartitioning(station_id"):]


def _top(spark, rows):
    return spark.createDataFrame(rows, (
        "start_station_id string, start_station_name string, total_trips long, "
        "ebike_trips long, member_trips long"))


def test_station_reports(spark):
    top = _top(spark, [
        ("a", "W 1 St & 2 Ave", 100, 55, 70), ("b", "B", 80, 10, 80), ("c", "C & D & E", 0, 0, 0)])
    shares = {r["start_station_id"]: r for r in reporting.with_station_shares(top).collect()}
    assert shares["a"]["ebike_share_pct"] == 55.0 and shares["c"]["member_pct"] is None
    kinds = [r["dominant"] for r in reporting.station_dominance(top).collect()]
    assert kinds == ["electric_bike", "classic_bike", "classic_bike"]
    points = {r["start_station_id"]: r for r in reporting.ebike_share_points(top, 1).collect()}
    assert set(points) == {"a", "b"}
    assert points["a"]["label"] == "W 1 St" and points["b"]["label"] is None
    assert points["a"]["above_threshold"] is True
    split = reporting.member_casual_split(top, 2).collect()
    assert [(r["casual_trips"], r["member_pct"]) for r in split] == [(30, 70.0), (0, 100.0)]
    assert [r["classic_trips"] for r in reporting.vehicle_split(top, 2).collect()] == [70, 45]


def _hourly(spark, rows):
    return spark.createDataFrame(rows, "hour_of_day int, day_of_week int, total_trips long")


def test_hourly_reports(spark):
    hourly = _hourly(spark, [(8, 2, 10), (9, 2, 10), (8, 1, 4), (9, 7, 4), (3, 7, 2)])
    pivot = reporting.hour_day_pivot(hourly).collect()
    assert [r["day_name"] for r in pivot] == ["Mon", "Sat", "Sun"]
    assert pivot[0]["h08"] == 10 and pivot[0]["h03"] is None and len(pivot[0]) == 25
    profile = {(r["day_type"], r["hour_of_day"]): r["total_trips"]
               for r in reporting.day_profile(hourly).collect()}
    assert profile == {("Weekday", 8): 10, ("Weekday", 9): 10, ("Weekend", 8): 4,
                       ("Weekend", 9): 4, ("Weekend", 3): 2}
    totals = [tuple(r) for r in reporting.daily_totals(hourly).collect()]
    assert totals == [("Mon", 20), ("Tue", None), ("Wed", None), ("Thu", None), ("Fri", None),
                      ("Sat", 6), ("Sun", 4)]
    peak = reporting.peak_hours(hourly).first()
    assert tuple(peak) == (8, 14, 3, 2, 7.0)
    zero = reporting.peak_hours(_hourly(spark, [(1, 1, 0), (2, 1, 0)])).first()
    assert tuple(zero) == (1, 0, 1, 0, None)


def test_borough_and_capacity(spark):
    scores = spark.createDataFrame([
        ("1", "A", "X", 4, 100, 1.0, 2.0, 0.5), ("2", "B", "X", 2, 0, 1.0, 4.0, 0.5),
        ("3", "C", "Y", 1, 100, 1.0, 0.125, 0.5), ("4", "D", None, 1, 300, 1.0, 1.0, 0.5),
    ], S.SCORE_SCHEMA)
    rows = {r["borough"]: r for r in reporting.borough_summary(scores).collect()}
    assert set(rows) == {"X", "Y"}
    assert (rows["X"]["total_stations"], rows["X"]["avg_area_km2"]) == (6, 3.0)
    assert (rows["X"]["stations_per_km2"], rows["X"]["stations_per_total_km2"]) == (2.0, 1.0)
    top = reporting.neighborhood_capacity_top(scores, 2).collect()
    assert [(r["neighborhood_name"], r["area_km2"]) for r in top] == [("D", 1.0), ("A", 2.0)]
    table = reporting.neighborhood_table(scores).collect()
    assert [r["area_km2"] for r in table] == [1.0, 2.0, 0.12, 4.0]  # half to even


def test_kpis_without_ebikes(spark):
    top = _top(spark, [("a", "A", 5, 0, 0), ("b", "B", 6, 0, 0)])
    rideable = spark.createDataFrame(
        [("classic_bike", 11, 100.0)], "rideable_type string, total_trips long, pct double")
    scores = spark.createDataFrame([("1", "A", "X"), ("2", "B", "X"), ("3", "B", None)],
                                   "neighborhood_id string, neighborhood_name string, borough string")
    assert tuple(reporting.kpis(top, rideable, scores).first()) == (11, 2, 0.0, 1, 3)


def test_labels(spark):
    from bikenet.functions.labels import short_station_name, vehicle_label
    from bikenet.functions.temporal import day_name
    row = spark.range(1).select(
        vehicle_label(F.lit("electric_bike")), short_station_name(F.lit(" W 4 St & 7 Ave & x")),
        day_name(F.lit(7)), day_name(F.lit(9)),
    ).first()
    assert tuple(row) == ("Electric Bike", "W 4 St", "Sat", None)
