from __future__ import annotations

import gzip
import json
import zipfile
import zlib
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from bikenet import schema as S
from bikenet.functions import geometry as G
from bikenet.sources import archives, feeds, geo, landing, layers, ranges
from bikenet.sources import files as files_module
from bikenet.sources.trips import header_catalogue, placed_rows, read_raw_trips, read_uniform_trips
from helpers import CURRENT_ROW, LEGACY_ROW, csv_text, plan_of


def test_files_with_different_headers_are_read_by_name(spark, tmp_path):
    row = {**CURRENT_ROW, "ride_id": "a"}
    (tmp_path / "a.csv").write_text(csv_text([row], S.CURRENT_COLUMNS))
    (tmp_path / "b.csv").write_text(
        csv_text([{**row, "ride_id": "b"}], list(reversed(S.CURRENT_COLUMNS))))
    (tmp_path / "c.csv").write_text("﻿" + csv_text([LEGACY_ROW], list(LEGACY_ROW)))
    catalogue = header_catalogue(spark, str(tmp_path))
    assert catalogue.select("positions").distinct().count() == 3
    plan = plan_of(placed_rows(spark, str(tmp_path), catalogue))
    assert plan.count("Scan csv") == 2 and "BroadcastHashJoin" in plan  # one scan, told in the tree and in the details
    rows = {r["start_station_name"] + r["rideable_type"] + str(r["ride_id"])[:1]: r
            for r in read_raw_trips(spark, str(tmp_path)).collect()}
    assert len(rows) == 3
    for r in rows.values():
        assert r["start_station_name"] == "Station A" and r["end_station_name"] == "Station B"
        assert r["started_at"].hour == 8 and r["start_lat"] > 40
        assert r["member_casual"] == "member"


def test_uniform_reader_refuses_other_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text(csv_text([CURRENT_ROW], S.CURRENT_COLUMNS))
    assert read_uniform_trips(spark, str(tmp_path)).count() == 1
    (tmp_path / "b.csv").write_text(csv_text([CURRENT_ROW], list(reversed(S.CURRENT_COLUMNS))))
    with pytest.raises(Exception, match="(?i)header"):
        read_uniform_trips(spark, str(tmp_path)).collect()


def test_unknown_trip_file_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    with pytest.raises(ValueError, match="unrecognised"):
        read_raw_trips(spark, str(tmp_path))


def _zip(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name, text)


def test_zip_members(spark, tmp_path):
    _zip(tmp_path / "2023-tripdata.zip", {
        "__MACOSX/202301.csv": "junk", "readme.txt": "no",
        "2023/202301-trips.CSV": "ride_id,started_at\n1,2023-01-01\n",
        "2023/202302-trips.csv": "ride_id,started_at\r\n2,2023-02-01\r\n3,2023-02-02",
    })
    every = archives.read_zipped_trips(spark, str(tmp_path))
    lines = sorted((r["member"], r["line_no"], r["line"]) for r in every.collect())
    assert lines == [
        ("2023/202301-trips.CSV", 0, "ride_id,started_at"),
        ("2023/202301-trips.CSV", 1, "1,2023-01-01"),
        ("2023/202302-trips.csv", 0, "ride_id,started_at"),
        ("2023/202302-trips.csv", 1, "2,2023-02-01"),
        ("2023/202302-trips.csv", 2, "3,2023-02-02"),
    ]
    first = archives.read_zipped_trips(spark, str(tmp_path), "first")
    assert {r["member"] for r in first.collect()} == {"2023/202301-trips.CSV"}
    with pytest.raises(ValueError, match="mode"):
        archives.read_zipped_trips(spark, str(tmp_path), "some")


def test_members_are_spread_over_tasks(spark, tmp_path):
    """The member list is tiny; adaptive execution must not gather it in one task."""
    _zip(tmp_path / "a.zip", {f"2024{m:02d}.csv": "h\n1\n" for m in range(1, 13)})
    lines = archives.read_zipped_trips(spark, str(tmp_path))
    tasks = lines.select(F.spark_partition_id().alias("task"), "member").distinct()
    per_task = tasks.groupBy("task").count().collect()
    assert len(per_task) >= 6 and max(r["count"] for r in per_task) <= 2


def test_zip_without_csv_is_an_error(spark, tmp_path):
    _zip(tmp_path / "a.zip", {"readme.txt": "no"})
    with pytest.raises(Exception, match="no CSV"):
        archives.read_zipped_trips(spark, str(tmp_path)).collect()


def test_zip_members_longer_than_one_batch(spark, tmp_path, monkeypatch):
    rows = 2 * archives.LINES_PER_BATCH + 7
    _zip(tmp_path / "a.zip", {"202401.csv": "h\n" + "\n".join(str(i) for i in range(rows))})
    got = archives.read_zipped_trips(spark, str(tmp_path))
    assert got.count() == rows + 1
    assert got.where(F.col("line_no") > 0).where("line != cast(line_no - 1 as string)").count() == 0


def test_landing_and_reading_back(spark, tmp_path):
    months = {
        f"2024{m:02d}-trips.csv": csv_text(
            [{**CURRENT_ROW, "ride_id": f"{m}-{i}", "started_at": f"2024-{m:02d}-01 08:00:00"}
             for i in range(50)], S.CURRENT_COLUMNS)
        for m in (1, 2)
    }
    zips = tmp_path / "zips"
    zips.mkdir()
    _zip(zips / "2024-tripdata.zip", months)
    raw = str(tmp_path / "raw")
    landed = archives.land_raw(archives.read_zipped_trips(spark, str(zips)), raw)
    assert sorted(r["yyyymm"] for r in landed.collect()) == ["202401", "202402"]
    trips = read_raw_trips(spark, raw)
    assert trips.count() == 100
    assert trips.groupBy(F.month("started_at")).count().count() == 2
    manifest = archives.month_manifest(spark, 2024, 2024)
    missing = archives.missing_months(manifest, landed)
    assert missing.count() == 10


def test_archives_of_the_same_name_stay_apart(spark, tmp_path):
    for folder, columns in (("x", S.CURRENT_COLUMNS), ("y", list(reversed(S.CURRENT_COLUMNS)))):
        (tmp_path / "zips" / folder).mkdir(parents=True)
        rows = [{**CURRENT_ROW, "ride_id": f"{folder}{i}"} for i in range(20)]
        _zip(tmp_path / "zips" / folder / "202401-tripdata.zip", {"202401.csv": csv_text(rows, columns)})
    raw = str(tmp_path / "raw")
    lines = archives.read_zipped_trips(spark, str(tmp_path / "zips")).coalesce(1)
    assert archives.land_raw(lines, raw).count() == 1
    trips = read_raw_trips(spark, raw)
    assert trips.where("start_station_name = 'Station A' and start_lat > 40").count() == 40


def test_months_and_archives(spark):
    rows = archives.month_manifest(spark, 2022, 2024).collect()
    keys = [r["yyyymm"] for r in rows]
    assert len(keys) == 36 and keys[0] == "202201" and keys[-1] == "202412"
    names = {r["yyyymm"]: r["archive"] for r in rows}
    assert names["202301"] == names["202312"] == "2023-tripdata.zip"
    assert names["202401"] == "202401-tripdata.zip"
    to_fetch = archives.archives_to_fetch(archives.month_manifest(spark, 2022, 2024, "-x.zip"))
    assert to_fetch.count() == 14
    assert archives.month_manifest(spark, 2023, 2023).count() == 12


def test_range_ingest_skips_what_is_absent_or_broken(spark, tmp_path):
    zips = tmp_path / "zips"
    zips.mkdir()
    text = csv_text([CURRENT_ROW], S.CURRENT_COLUMNS)
    _zip(zips / "2023-tripdata.zip", {f"2023{m:02d}.csv": text for m in range(1, 13)})
    _zip(zips / "202401-tripdata.zip", {"202401_1.csv": text, "202401_2.csv": text})
    _zip(zips / "202402-tripdata.zip", {"readme.txt": "no"})
    (zips / "202403-tripdata.zip").write_bytes(b"not a zip")
    _zip(zips / "202404-tripdata.zip", {"202404.csv": text * 50})
    whole = (zips / "202404-tripdata.zip").read_bytes()
    (zips / "202404-tripdata.zip").write_bytes(whole[:60] + b"XXXX" + whole[64:])
    _zip(zips / "unrelated.zip", {"202405.csv": text})
    raw = str(tmp_path / "raw")
    landed = landing.ingest_range(spark, str(zips), raw, 2023, 2024)
    months = sorted(r["yyyymm"] for r in landed.collect())
    assert months == [f"2023{m:02d}" for m in range(1, 13)] + ["202401"]
    assert read_raw_trips(spark, raw).count() == 14
    first = landing.ingest_range(
        spark, str(zips), str(tmp_path / "first"), 2024, 2024, monthly_mode="first")
    assert first.count() == 1 and read_raw_trips(spark, str(tmp_path / "first")).count() == 1
    missing = archives.missing_months(archives.month_manifest(spark, 2023, 2024), landed)
    assert missing.count() == 11


def test_published_names_and_single_months(spark, tmp_path):
    zips = tmp_path / "zips"
    zips.mkdir()
    text = csv_text([CURRENT_ROW], S.CURRENT_COLUMNS)
    _zip(zips / "2023-somebike-tripdata.zip", {f"2023{m:02d}.csv": text for m in range(1, 13)})
    for month in ("202401", "202402"):
        _zip(zips / f"{month}-somebike-tripdata.zip", {f"{month}-part_1.csv": text})
    _zip(zips / "JC-202403-somebike-tripdata.zip", {"202403.csv": text})
    raw = str(tmp_path / "raw")
    landed = landing.ingest_range(spark, str(zips), raw, 2023, 2024)
    months = sorted(r["yyyymm"] for r in landed.collect())
    assert months == [f"2023{m:02d}" for m in range(1, 13)] + ["202401", "202402"]
    own = str(tmp_path / "one")
    one = landing.ingest_range(spark, str(zips), own, 2024, 2024, months=["202402"])
    assert [r["yyyymm"] for r in one.collect()] == ["202402"]
    assert [r["yyyymm"] for r in archives.landed_months(spark, own).collect()] == ["202402"]


def test_states_of_archives_and_members(spark, tmp_path):
    """A broken archive, a nameless member and other bytes than UTF-8: the rest lands, byte for byte."""
    zips, raw = tmp_path / "zips", tmp_path / "raw"
    zips.mkdir()
    text = csv_text([CURRENT_ROW], S.CURRENT_COLUMNS)
    odd = "\ufeffride_id,name\r\n1,Montr\u00e9al".encode("latin-1", errors="replace") + b"\xff\x00 no line end"
    with zipfile.ZipFile(zips / "202401-tripdata.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("202401.csv", odd)
        archive.writestr("deep/202401 [b] 50%.csv", b"")
    (zips / "202402-tripdata.zip").write_bytes(b"not a zip")
    _zip(zips / "2023-tripdata.zip", {"202301.csv": text, "extra.csv": text})
    _zip(zips / "202403-tripdata.zip", {"202403_1.csv": text, "202403_2.csv": text})
    whole = (zips / "202403-tripdata.zip").read_bytes()
    second = whole.index(b"202403_2.csv") + 30
    (zips / "202403-tripdata.zip").write_bytes(whole[:second] + b"XXXX" + whole[second + 4:])
    states = landing.ingest_archives(spark, str(zips), str(raw), 2023, 2024).collect()
    told = {(r["archive"], r["member"]): (r["state"], bool(r["reason"])) for r in states}
    assert told[("202404", None)] == ("absent", False) and sum(s == "absent" for s, _ in told.values()) == 9
    assert told[("2023", "202301.csv")] == ("landed", False) and told[("2023", "extra.csv")] == ("rejected", True)
    assert told[("202402", None)] == ("broken", True)
    assert told[("202403", "202403_1.csv")] == ("withheld", True) and told[("202403", "202403_2.csv")] == ("broken", True)
    assert told[("202401", "deep/202401 [b] 50%.csv")] == ("landed", False)
    for row in states:
        if row["state"] == "landed":
            with zipfile.ZipFile(row["path"]) as archive:
                landed = Path(row["target"].removeprefix("file:")).read_bytes()
                assert landed == archive.read(row["member"]) and row["bytes"] == len(landed)
                assert row["crc32"] == zlib.crc32(landed)
    assert not list(raw.glob("yyyymm=202403/**/part*")) and not list(raw.glob("_landing/*/staged"))
    assert landing.last_states(spark, str(raw)).where("state = 'landed'").count() == 3
    assert sorted(r["yyyymm"] for r in archives.landed_months(spark, str(raw)).collect()) == ["202301", "202401"]


def test_landing_again_replaces(spark, tmp_path):
    zips, raw = tmp_path / "zips", str(tmp_path / "raw")
    zips.mkdir()
    for rides in (3, 2):
        rows = [{**CURRENT_ROW, "ride_id": str(i)} for i in range(rides)]
        _zip(zips / "202401-tripdata.zip", {"202401.csv": csv_text(rows, S.CURRENT_COLUMNS)})
        assert landing.ingest_range(spark, str(zips), raw, 2024, 2024, months=["202401"]).count() == 1
        assert read_raw_trips(spark, raw).count() == rides


def test_a_rename_done_before_counts_as_done(tmp_path):
    staged, target = tmp_path / "s" / "x", tmp_path / "t" / "part-00000.csv"
    staged.parent.mkdir()
    staged.write_bytes(b"abc")
    landing._rename(str(staged), str(target), 3)
    landing._rename(str(staged), str(target), 3)
    assert target.read_bytes() == b"abc"
    with pytest.raises(FileNotFoundError, match="gone"):
        landing._rename(str(staged), str(target), 4)


def test_a_lost_attempt_is_never_published(spark, tmp_path):
    """Staged files that the table of members does not name stay out of the raw area."""
    zips, raw = tmp_path / "zips", str(tmp_path / "raw")
    zips.mkdir()
    _zip(zips / "202401-tripdata.zip", {"202401.csv": "a,b\n1,2\n"})
    wanted = archives.wanted_archives(spark, str(zips), 2024, 2024, months=["202401"])
    staged = landing.stage(landing.list_contents(wanted), raw, "run1")
    copy = Path(raw) / "_landing/run1/staged/stray"
    copy.write_bytes(b"half")
    assert [r["state"] for r in landing.publish(staged, raw, "run1").collect()] == ["landed"]
    assert [p.read_bytes() for p in Path(raw).glob("yyyymm=*/**/part*")] == [b"a,b\n1,2\n"] and not copy.exists()


SNAPSHOT = {
    "last_updated": 1712000000, "ttl": 60,
    "data": {"stations": [
        {"station_id": "A01", "num_bikes_available": 4, "num_docks_available": 8,
         "num_ebikes_available": 1, "is_installed": 1, "is_renting": 1, "last_reported": 1711999990},
        {"station_id": "A02"},
    ]},
}


def test_status_snapshots(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps(SNAPSHOT, indent=2))
    rows = {r["station_id"]: r for r in feeds.read_status_snapshots(spark, str(tmp_path)).collect()}
    assert set(rows) == {"A01", "A02"}
    assert rows["A01"]["num_docks_available"] == 8 and rows["A01"]["last_updated"] == 1712000000
    assert rows["A02"]["num_bikes_available"] is None


def test_station_information(spark, tmp_path):
    doc = {"data": {"stations": [
        {"station_id": "a", "name": "A & B", "lat": 40.5, "lon": -74.0, "capacity": 20}]}}
    (tmp_path / "info.json").write_text(json.dumps(doc, indent=1))
    (tmp_path / "info.csv").write_text("station_id,name,lat,lon,capacity\na,A & B,40.5,-74.0,20\n")
    nested = feeds.read_station_info(spark, str(tmp_path / "info.json")).collect()
    flat = feeds.read_station_info_csv(spark, str(tmp_path / "info.csv")).collect()
    assert nested == flat and nested[0]["capacity"] == 20


def test_kafka_reader_options_and_missing_connector(spark):
    options = feeds.kafka_source_options("h:1", "status")
    assert options["maxOffsetsPerTrigger"] == "50000" and options["startingOffsets"] == "latest"
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        feeds.read_status_stream_kafka(spark, "h:1", "status")


def test_geojson_aliases_types_and_crs(spark, tmp_path):
    square = [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]
    features = [
        {"type": "Feature", "properties": {"NTACode": "A1", "NTAName": "Alpha", "BoroName": "X"},
         "geometry": {"type": "Polygon", "coordinates": square}},
        {"type": "Feature", "properties": {"nta_code": "B1", "nta_name": "Beta", "boro_name": "Y",
                                           "NTAAbbrev": "ignored"},
         "geometry": {"type": "MultiPolygon", "coordinates": [square, square]}},
        {"type": "Feature", "properties": {"NTAAbbrev": "C1"},
         "geometry": {"type": "Point", "coordinates": [0, 0]}},
    ]
    path = tmp_path / "n.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    rows = {r["neighborhood_id"]: r for r in geo.read_neighborhoods(spark, str(path)).collect()}
    assert set(rows) == {"A1", "B1", "C1"}
    assert (rows["A1"]["neighborhood_name"], rows["A1"]["borough"]) == ("Alpha", "X")
    assert len(rows["A1"]["geometry"]) == 1 and len(rows["B1"]["geometry"]) == 2
    assert rows["C1"]["geometry"] is None
    mercator = spark.createDataFrame([([[[[111319.49079327358, 111325.1428663851]]]],)], S._struct(
        geometry=S.GEOMETRY))
    x, y = mercator.select(G.to_wgs84(F.col("geometry"), 3857)).first()[0][0][0][0]
    assert abs(x - 1) < 1e-9 and abs(y - 1) < 1e-9
    with pytest.raises(ValueError, match="coordinate system"):
        geo.read_neighborhoods(spark, str(path), epsg=27700)


def _collection(count: int) -> dict:
    """Features whose texts hold brackets, quotes, backslashes and letters of several bytes."""
    odd = ['plain', '{"', '\\', '\\"}', ']]}', 'é{', 'end \\\\', '"type": "Feature"']
    return {
        "type": "FeatureCollection",
        "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:OGC:1.3:CRS84"}},
        "features": [
            {"type": "Feature", "properties": {"nta_code": str(i), "nta_name": odd[i % len(odd)] * (i % 5), "boro_name": "X"},
             "geometry": {"type": "Polygon", "coordinates": [[[i, 0], [i + 1, 0], [i + 1, 1], [i, 1], [i, 0]]]}}
            for i in range(count)],
        "bbox": [0, 0, 1, 1],
    }


@pytest.mark.parametrize("block", [1, 7, 64, 1000])
def test_ranges_of_any_size_cut_the_same_objects(spark, tmp_path, block):
    wanted = _collection(30 if block > 1 else 3)
    (tmp_path / "n.geojson").write_text(json.dumps(wanted, ensure_ascii=False, indent=1 if block == 64 else None))
    (tmp_path / "none.geojson").write_text("")
    found = ranges.nested_objects(spark, str(tmp_path), 2, block).collect()
    features = [json.loads(r["value"]) for r in found]
    assert features.pop(features.index(wanted["crs"]["properties"])) and len(features) == len(wanted["features"])
    assert sorted(features, key=json.dumps) == sorted(wanted["features"], key=json.dumps)


def test_one_collection_is_read_by_many_tasks(spark, tmp_path):
    wanted = _collection(10_000)
    whole = tmp_path / "n.geojson"
    whole.write_text(json.dumps(wanted))
    (tmp_path / "packed").mkdir()
    (tmp_path / "packed" / "n.geojson.gz").write_bytes(gzip.compress(whole.read_bytes()))
    one = geo._whole_features(spark, str(whole))
    many = geo._split_features(spark, str(whole), 100_000)
    counts = [r["n"] for r in many.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(counts) == 10_000 and len(counts) > 1 and max(counts) < 8000
    areas = geo.read_neighborhoods(spark, str(whole), block_bytes=100_000)
    packed = geo.read_neighborhoods(spark, str(tmp_path / "packed"), block_bytes=100_000)
    named = one.select(F.col("f.properties")["nta_code"].alias("id"), F.col("f.properties")["nta_name"].alias("name"),
                       geo.parse_geometry(F.col("f.geometry")).alias("g"))
    expected = sorted(map(str, named.collect()))
    for found in (areas, packed):
        got = found.select(F.col("neighborhood_id").alias("id"), F.col("neighborhood_name").alias("name"), F.col("geometry").alias("g"))
        assert sorted(map(str, got.collect())) == expected
    with pytest.raises(ValueError, match="one byte"):
        ranges.nested_objects(spark, str(whole), 2, 0)


def test_a_cut_off_document_loses_the_last_object_only(spark, tmp_path):
    text = json.dumps(_collection(3))
    (tmp_path / "n.geojson").write_text(text[: text.index('"nta_code": "2"') + 20])
    assert sorted(r["neighborhood_id"] for r in geo.read_neighborhoods(spark, str(tmp_path), block_bytes=50).collect()) == ["0", "1"]


def test_alias_columns(spark):
    df = spark.createDataFrame([(1, "n", "b", None)], "NTACode int, NTAName string, boroname string, geometry string")
    assert geo.canonical_neighborhoods(df).columns == [
        "neighborhood_id", "neighborhood_name", "borough", "geometry"]
    with pytest.raises(ValueError, match="borough"):
        geo.canonical_neighborhoods(df.drop("boroname"))


def test_partition_month_stays_text(spark, tmp_path):
    df = spark.createDataFrame([("1", "202301")], "ride_id string, year_month string")
    df.write.partitionBy("year_month").parquet(str(tmp_path / "b"))
    assert layers.read_bronze(spark, str(tmp_path / "b")).first()["year_month"] == "202301"


def test_first_lines_read_only_the_head(spark, tmp_path):
    import gzip

    from bikenet.sources import files

    long_header = ",".join(f"column_{i}" for i in range(2000))
    (tmp_path / "a b%20.csv").write_text(long_header + "\r\n1\n")
    (tmp_path / "no newline.csv").write_text("x,y")
    with gzip.open(tmp_path / "z.csv.gz", "wt") as f:
        f.write("ride_id,started_at\n1,2\n")
    got = {r["source_file"].rsplit("/", 1)[1]: r["header"]
           for r in files.first_lines(files.list_files(spark, str(tmp_path))).collect()}
    assert got == {"a b%20.csv": long_header, "no newline.csv": "x,y",
                   "z.csv.gz": "ride_id,started_at"}


def test_headers_of_a_store_that_only_spark_reads(spark, tmp_path):
    """By a scan of the lines: the same heads as by opening each file."""
    (tmp_path / "a.csv").write_text("\ufeffride_id,x\r\n1,2\n")
    (tmp_path / "b c%.csv").write_text("tripduration,\"q,r\"\n" + "5,6\n" * 50)
    opened = files_module.first_lines(files_module.list_files(spark, str(tmp_path)))
    scanned = files_module.first_lines_below(spark, str(tmp_path))
    assert sorted(map(tuple, opened.collect())) == sorted((r[0], r[1], r[2].removeprefix("\ufeff")) for r in scanned.collect())
    assert files_module.arrow_knows("s3a://b/x") and files_module.arrow_knows("/a:b") and not files_module.arrow_knows("viewfs://c/x")


def test_rows_longer_or_shorter_than_their_header(spark, tmp_path):
    head, row = list(S.CURRENT_COLUMNS), [CURRENT_ROW[c] for c in S.CURRENT_COLUMNS]
    (tmp_path / "a.csv").write_text("\n".join([",".join(head), ",".join(row), ",".join([*row, "extra"]), ",".join(row[:5])]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join([",".join(head[:8] + ["note"]), ",".join([*row[:8], "n"])]) + "\n")
    (tmp_path / "empty.csv").write_text("")
    rows = read_raw_trips(spark, str(tmp_path)).collect()
    assert len(rows) == 4 and sum(r["member_casual"] == "member" for r in rows) == 2
    assert sum(r["start_lat"] is None for r in rows) == 2 and all(r["start_station_name"] for r in rows)


def test_directory_pattern(spark, tmp_path):
    df = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, 12)], "v int, day int")
    df.write.partitionBy("day").parquet(str(tmp_path / "t"))
    some = layers.read_hive_glob(spark, str(tmp_path / "t"), "day=1*")
    assert sorted((r["v"], r["day"]) for r in some.collect()) == [(1, 1), (2, 1), (4, 12)]
    plain = layers.read_plain_glob(spark, str(tmp_path / "t"))
    assert plain.columns == ["v"] and plain.count() == 4


def test_paths_of_tasks():
    from pyarrow import fs

    from bikenet.sources.files import locate

    for path in ("/a b/c", "file:/a b/c", "file:///a b/c"):
        system, inner = locate(path)
        assert isinstance(system, fs.LocalFileSystem) and inner == "/a b/c"
