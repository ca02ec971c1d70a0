from __future__ import annotations

import pytest

from bikenet import schema as S
from bikenet.operators import quality
from helpers import CURRENT_ROW, LEGACY_ROW, csv_text, current, legacy, plan_of


def report(df) -> quality.ValidationReport:
    rows = quality.validate_dataframe(df).collect()
    assert len(rows) == 1
    return quality.ValidationReport.from_row(rows[0])


def test_valid_current(spark):
    r = report(current(spark, *({} for _ in range(200))))
    assert r.is_valid and r.schema_version == "current" and r.row_count == 200
    assert r.missing_required_columns == []
    assert r.warnings == ["only 200 rows"]
    assert r.null_rate == {"start_lat": 0, "start_lng": 0, "end_lat": 0, "end_lng": 0}


def test_valid_legacy(spark):
    r = report(legacy(spark, *({} for _ in range(200))))
    assert r.is_valid and r.schema_version == "legacy"
    assert set(r.null_rate) == set(S.COORDINATE_COLUMNS["legacy"])
    assert not any("duplicate" in w for w in r.warnings)


def test_missing_column(spark):
    columns = [c for c in S.CURRENT_COLUMNS if c != "member_casual"]
    r = report(current(spark, *({} for _ in range(100)), columns=columns))
    assert not r.is_valid and r.missing_required_columns == ["member_casual"]
    assert r.errors == ["columns not found: member_casual"]


def test_empty(spark):
    r = report(current(spark))
    assert not r.is_valid and r.errors == ["no rows, the file is empty"]
    assert r.warnings == []
    assert r.row_count == 0


def test_unknown_columns_stop_the_checks(spark):
    r = report(spark.createDataFrame([(1, 3), (2, 4)], "x int, y int"))
    assert r.schema_version == "unknown" and len(r.errors) == 1 and r.warnings == []


def test_null_rate_warning_uses_the_unrounded_rate(spark):
    r = report(current(spark, *({"start_lat": None} for _ in range(100))))
    assert "start_lat is missing in 100.0 % of the rows" in r.warnings
    exactly = report(current(spark, *({"end_lat": None if i < 5 else "1"} for i in range(100))))
    assert exactly.null_rate["end_lat"] == 0.05
    assert not any("end_lat" in w for w in exactly.warnings)


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"), "1"), (1.0, "2")], "start_lat double, ride_id string")
    assert report(df).null_rate == {"start_lat": 0.5}


def test_duplicates(spark):
    r = report(current(spark, *({"ride_id": "DUPE"} for _ in range(100))))
    assert "99 rows repeat a ride_id (duplicates)" in r.warnings and r.is_valid
    with_null = report(current(spark, {"ride_id": None}, {"ride_id": None}, {"ride_id": "a"}))
    assert "1 rows repeat a ride_id (duplicates)" in with_null.warnings


def test_column_names_in_any_case(spark):
    df = current(spark, {}).toDF(*(c.upper() for c in S.CURRENT_COLUMNS))
    assert report(df).is_valid


def test_one_report_per_csv_file(spark, tmp_path):
    rows = [{**CURRENT_ROW, "ride_id": str(i)} for i in range(3)]
    rows[0]["start_lat"], rows[1]["start_lat"] = "NA", "null"
    (tmp_path / "current.csv").write_text(csv_text(rows, S.CURRENT_COLUMNS))
    (tmp_path / "same header +1.csv").write_text(csv_text(rows[2:], S.CURRENT_COLUMNS))
    (tmp_path / "legacy.csv").write_text(csv_text([LEGACY_ROW] * 2, list(LEGACY_ROW)))
    (tmp_path / "only_header.csv").write_text(csv_text([], S.CURRENT_COLUMNS))
    (tmp_path / "other.csv").write_text("x,y\n1,2\n")
    (tmp_path / "nothing.csv").write_text("")
    (tmp_path / "_hidden.csv").write_text("")
    reports = {
        r["source_file"].rsplit("/", 1)[1]: r
        for r in quality.validate_csv(spark, str(tmp_path)).collect()
    }
    assert len(reports) == 6
    assert reports["nothing.csv"]["errors"] == ["the file is empty, not even a header"]
    assert reports["nothing.csv"]["row_count"] == 0 and not reports["nothing.csv"]["is_valid"]
    assert reports["legacy.csv"]["duplicate_count"] == 0 and set(reports["legacy.csv"]["null_rate"]) == set(S.COORDINATE_COLUMNS["legacy"])
    assert reports["current.csv"]["row_count"] == 3
    assert reports["current.csv"]["null_rate"]["start_lat"] == 0.6667
    assert reports["same header +1.csv"]["row_count"] == 1
    assert reports["same header +1.csv"]["null_rate"]["start_lat"] == 0.0
    assert reports["legacy.csv"]["schema_version"] == "legacy"
    assert reports["only_header.csv"]["errors"] == ["no rows, the file is empty"]
    assert reports["other.csv"]["schema_version"] == "unknown"


def test_folder_without_files(spark, tmp_path):
    with pytest.raises(ValueError, match="no files"):
        quality.validate_csv(spark, str(tmp_path))


def test_gate(spark):
    good = quality.validate_dataframe(current(spark, {}))
    assert quality.require_valid(good) is good
    with pytest.raises(quality.InvalidTripData, match="empty"):
        quality.require_valid(quality.validate_dataframe(current(spark)))


def test_duplicates_from_a_sketch(spark):
    df = current(spark, *({"ride_id": str(i % 50)} for i in range(200)))
    row = quality.validate_dataframe(df, rsd=0.02).first()
    assert 140 <= row["duplicate_count"] <= 160


def test_folder_with_one_header_is_read_as_a_whole(spark, tmp_path):
    from bikenet.sources.trips import header_catalogue, placed_rows

    for name, n in (("a.csv", 2), ("b c.csv", 1), ("sub/d.csv", 0)):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(csv_text([CURRENT_ROW] * n, S.CURRENT_COLUMNS))
    plan = plan_of(placed_rows(spark, str(tmp_path), header_catalogue(spark, str(tmp_path))))
    assert "Join" not in plan
    rows = quality.validate_csv(spark, str(tmp_path)).collect()
    counts = {r["source_file"].rsplit("/", 1)[1]: r["row_count"] for r in rows}
    assert counts == {"a.csv": 2, "b c.csv": 1, "d.csv": 0}
