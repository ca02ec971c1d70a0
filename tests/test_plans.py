from __future__ import annotations

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from bikenet import schema as S
from bikenet.operators.quality import InvalidTripData
from bikenet.sinks import write_silver
from bikenet.plans import analytics, layers
from bikenet.session import shared_folder
from bikenet.sources.layers import read_bronze, read_silver
from helpers import CURRENT_ROW, csv_text, plan_of


def _month(root, yyyymm, n, **changes):
    folder = root / f"yyyymm={yyyymm}"
    folder.mkdir(parents=True, exist_ok=True)
    day = f"{yyyymm[:4]}-{yyyymm[4:]}-10"
    rows = [{**CURRENT_ROW, "ride_id": f"{yyyymm}-{i}", "started_at": f"{day} 08:00:00",
             "ended_at": f"{day} 08:20:00", **changes} for i in range(n)]
    (folder / "trips.csv").write_text(csv_text(rows, S.CURRENT_COLUMNS))
    return str(folder)


def test_one_month_replaces_only_itself(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    jan = _month(tmp_path / "raw", "202301", 5)
    feb = _month(tmp_path / "raw", "202302", 3)
    layers.raw_to_bronze(spark, jan, bronze, "202301")
    layers.raw_to_bronze(spark, feb, bronze, "202302")
    # a stray February start in the January file stays in the January directory
    _month(tmp_path / "raw", "202301", 2, started_at="2023-02-01 00:10:00")
    layers.raw_to_bronze(spark, jan, bronze, "202301")
    counts = {r["year_month"]: r["count"] for r in
              read_bronze(spark, bronze).groupBy("year_month").count().collect()}
    assert counts == {"202301": 2, "202302": 3}


def test_an_empty_month_replaces_its_directory(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    raw = _month(tmp_path / "raw", "202301", 5)
    _month(tmp_path / "raw", "202302", 3)
    layers.raw_to_bronze(spark, raw, bronze, "202301")
    layers.raw_to_bronze(spark, str(tmp_path / "raw" / "yyyymm=202302"), bronze, "202302")
    _month(tmp_path / "raw", "202301", 0)
    assert layers.raw_to_bronze(spark, raw, bronze, "202301").count() == 3


def test_rebuild_derives_months(spark, tmp_path):
    _month(tmp_path / "raw", "202301", 2)
    _month(tmp_path / "raw", "202302", 3)
    bronze = layers.raw_to_bronze(spark, str(tmp_path / "raw"), str(tmp_path / "bronze"))
    assert {r["year_month"] for r in bronze.select("year_month").distinct().collect()} == {
        "202301", "202302"}


def test_silver_of_chosen_months_leaves_the_others(spark, tmp_path):
    paths = layers.LayerPaths.below(str(tmp_path))
    _month(tmp_path / "raw", "202301", 5)
    _month(tmp_path / "raw", "202302", 3)
    layers.run_batch(spark, paths, stages=["bronze", "silver"])
    _month(tmp_path / "raw", "202302", 7)
    layers.raw_to_bronze(spark, paths.raw_files("202302"), paths.bronze, "202302")
    layers.bronze_to_silver(spark, paths.bronze, paths.silver, ["202302"])
    counts = {r["year_month"]: r["count"] for r in
              read_silver(spark, paths.silver).groupBy("year_month").count().collect()}
    assert counts == {"202301": 5, "202302": 7}


def test_all_stages(spark, tmp_path):
    _month(tmp_path / "raw", "202301", 30)
    info = {"data": {"stations": [
        {"station_id": "S001", "name": "A", "lat": 40.7128, "lon": -74.006, "capacity": 20}]}}
    (tmp_path / "info.json").write_text(json.dumps(info))
    box = [[[-75, 40], [-73, 40], [-73, 41], [-75, 41], [-75, 40]]]
    (tmp_path / "n.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"NTACode": "N1", "NTAName": "N", "BoroName": "B"},
         "geometry": {"type": "Polygon", "coordinates": box}}]}))
    paths = layers.LayerPaths.below(
        str(tmp_path), station_info=str(tmp_path / "info.json"),
        neighborhoods=str(tmp_path / "n.geojson"), scores=str(tmp_path / "scores"))
    out = layers.run_batch(spark, paths, stages=layers.STAGES)
    assert out["validate"].first()["is_valid"] and out["bronze"].count() == 30
    top = out["smoke"].first()
    assert (top["start_station_id"], top["total_trips"], top["avg_duration_seconds"]) == (
        "S001", 30, 1200.0)
    score = out["spatial"].first()
    assert score["station_count"] == 1 and score["avg_daily_trips"] == 30.0

    tables = analytics.Tables(**layers.read_gold(spark, paths.gold), scores=out["spatial"])
    assert analytics.run_query("neighborhoods", tables).first()["neighborhood_name"] == "N"
    written = analytics.run_analytics(
        tables, str(tmp_path / "out"),
        ("top_stations", "top_stations_minutes", "hourly", "hourly_totals", "rideable_split", "realtime"))
    assert set(written) == {  # realtime has no input
        "top_stations", "top_stations_minutes", "hourly", "hourly_totals", "rideable_split"}
    line = spark.read.option("header", True).csv(written["top_stations"]).first()
    assert line["total_trips"] == "30" and line["avg_duration_seconds"] == "1200.0"
    line = spark.read.option("header", True).csv(written["top_stations_minutes"]).first()
    assert line["avg_duration_min"] == "20.0"
    placed = spark.createDataFrame(
        [("S001", score["neighborhood_id"])], "station_id string, neighborhood_id string")
    served = analytics.run_query(
        "neighborhoods", analytics.Tables(tables.trips_per_station, scores=tables.scores, stations=placed))
    assert served.first()["total_trips"] == 30
    with pytest.raises(ValueError, match="unknown query"):
        analytics.run_query("nothing", tables)


def test_invalid_file_stops_the_batch(spark, tmp_path):
    _month(tmp_path / "raw", "202301", 0)
    paths = layers.LayerPaths.below(str(tmp_path))
    with pytest.raises(InvalidTripData):
        layers.run_batch(spark, paths, "202301", ["validate", "bronze"])
    assert not (tmp_path / "bronze").exists()
    with pytest.raises(ValueError, match="unknown stages"):
        layers.run_batch(spark, paths, stages=["silver", "platinum"])


def test_shared_folder_is_below_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one.startswith(root) and one != two


def _zip(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name, text)


def test_batch_from_an_archive(spark, tmp_path):
    zips = tmp_path / "zips"
    zips.mkdir()

    def rows(n):
        return csv_text([{**CURRENT_ROW, "ride_id": f"{n}-{i}"} for i in range(n)], S.CURRENT_COLUMNS)

    _zip(zips / "2023-tripdata.zip", {
        "2023/1_January/202301-trips_1.csv": rows(4), "2023/1_January/202301-trips_2.csv": rows(3),
        "2023/2_February/202302-trips.csv": rows(2)})
    paths = layers.LayerPaths.below(str(tmp_path), archives=str(zips))
    out = layers.run_batch(spark, paths, "202301", ["ingest", "validate", "bronze"])
    assert {r["yyyymm"] for r in out["ingest"].collect()} == {"202301", "202302"}
    assert out["validate"].count() == 2
    assert [tuple(r) for r in out["bronze"].groupBy("year_month").count().collect()] == [("202301", 7)]
    with pytest.raises(RuntimeError, match="no archive data"):
        layers.run_batch(spark, paths, "202401", ["ingest"])


def test_partitioned_writes_are_rebalanced(spark):
    from bikenet.sinks import rebalanced
    df = spark.range(10).withColumn("year_month", F.lit("202301"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(rebalanced(df, "year_month"), "simple")


def test_cluster_without_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(ValueError, match="shared"):
        shared_folder(Session(), "x")


def test_emptied_month_is_replaced(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = [("a", "202401"), ("b", "202402"), ("c", "202403")]
    frame = spark.createDataFrame(rows, "ride_id string, year_month string")
    write_silver(frame, path)
    write_silver(frame.where("ride_id = 'b'").withColumn("ride_id", F.lit("new")), path, ["202401", "202402"])
    left = {(r["ride_id"], str(r["year_month"])) for r in spark.read.parquet(path).collect()}
    assert left == {("new", "202402"), ("c", "202403")}
