"""Months loaded one at a time against a rebuild of everything."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from bikenet.operators.ride_filter import may_be_in, ride_filter
from bikenet.plans import monthly
from bikenet.plans.layers import LayerPaths, bronze_to_silver, read_gold, run_batch, silver_to_gold
from bikenet.sinks import write_bronze
from bikenet.sources.layers import read_silver
from bikenet.operators.cleaning import cast_current, conform
from helpers import csv_text, current, CURRENT_ROW
from bikenet import schema as S


def _ride(ride_id, start="2024-01-05 08:00:00", end="2024-01-05 08:20:00", **more):
    return {"ride_id": ride_id, "started_at": start, "ended_at": end, **more}


def _bronze(spark, root, month, *rides):
    write_bronze(conform(cast_current(current(spark, *rides))).withColumn("year_month", F.lit(month)), f"{root}/bronze", month)


def _load(spark, root, month):
    return monthly.load_month(spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold", f"{root}/state", month)


def _tables(spark, silver, gold):
    found = {"silver": read_silver(spark, silver), **read_gold(spark, gold)}
    return {name: sorted(str(sorted(r.asDict().items())) for r in df.collect()) for name, df in found.items()}


def _same_as_rebuilt(spark, root):
    bronze_to_silver(spark, f"{root}/bronze", f"{root}/whole")
    silver_to_gold(spark, f"{root}/whole", f"{root}/whole_gold")
    now, whole = _tables(spark, f"{root}/silver", f"{root}/gold"), _tables(spark, f"{root}/whole", f"{root}/whole_gold")
    assert now == whole and now["silver"]
    return now


def _files(root):
    return {str(p): p.stat().st_mtime_ns for p in Path(root).rglob("part-*")}


def test_months_one_after_the_other(spark, tmp_path):
    _bronze(spark, tmp_path, "202401", *[_ride(f"a{i}", rideable_type="electric_bike") for i in range(5)],
            _ride("stray", "2024-02-01 00:10:00", "2024-02-01 00:30:00"), _ride(None), _ride("short", end="2024-01-05 08:00:10"))
    _bronze(spark, tmp_path, "202402", *[_ride(f"b{i}", f"2024-02-0{i + 1} 09:00:00", f"2024-02-0{i + 1} 09:30:00") for i in range(3)])
    assert _load(spark, tmp_path, "202401") == ["202401"]
    before = _files(tmp_path)
    assert _load(spark, tmp_path, "202402") == ["202402"]
    _same_as_rebuilt(spark, tmp_path)
    after = _files(tmp_path)
    kept = [p for p in before if "/silver/year_month=202401" in p or "trip_date=2024-01-05" in p or "/parts/trips_per_station/year_month=202401" in p]
    assert len(kept) >= 3 and all(after[p] == before[p] for p in kept)
    day = read_gold(spark, f"{tmp_path}/gold")["trips_per_station"].where("trip_date = '2024-02-01'").first()
    assert day["trips_started"] == 2  # one of each month


@pytest.mark.parametrize("start, wins", [("2024-01-05 09:00:00", False), ("2024-01-05 07:00:00", True)])
def test_a_copy_in_a_later_month(spark, tmp_path, start, wins):
    _bronze(spark, tmp_path, "202401", *[_ride(f"a{i}") for i in range(4)])
    _bronze(spark, tmp_path, "202402", _ride("a1", start), _ride("b"))
    _load(spark, tmp_path, "202401")
    assert _load(spark, tmp_path, "202402") == (["202402", "202401"] if wins else ["202402"])
    rows = read_silver(spark, f"{tmp_path}/silver").where("ride_id = 'a1'").collect()
    assert [r["year_month"] for r in rows] == ["202402" if wins else "202401"]
    _same_as_rebuilt(spark, tmp_path)
    # the month comes again without the copy: the other month has it back
    _bronze(spark, tmp_path, "202402", _ride("b"))
    _load(spark, tmp_path, "202402")
    rows = read_silver(spark, f"{tmp_path}/silver").where("ride_id = 'a1'").collect()
    assert [r["year_month"] for r in rows] == ["202401"]
    _same_as_rebuilt(spark, tmp_path)


def test_three_months_share_a_ride(spark, tmp_path):
    """In every order of loading, also a winner that is implausibly short and takes its copies along."""
    for k, month in enumerate(("202403", "202401", "202402", "202401")):
        _bronze(spark, tmp_path, month, _ride("x", f"2024-01-05 0{8 - k}:00:00"), _ride("y"), _ride(f"own{k}"),
                _ride("z", "2024-01-05 08:00:00", "2024-01-05 08:00:05" if k == 2 else "2024-01-05 08:20:00"))
        _load(spark, tmp_path, month)
        _same_as_rebuilt(spark, tmp_path)
    months = {r["ride_id"]: r["year_month"] for r in read_silver(spark, f"{tmp_path}/silver").collect()}
    assert months["x"] == "202401" and months["y"] == "202401" and "z" not in months


def test_days_left_without_trips(spark, tmp_path):
    _bronze(spark, tmp_path, "202401", _ride("a"), _ride("b", "2024-01-09 08:00:00", "2024-01-09 08:30:00"))
    _load(spark, tmp_path, "202401")
    _bronze(spark, tmp_path, "202401", _ride("a"))
    _load(spark, tmp_path, "202401")
    _same_as_rebuilt(spark, tmp_path)


def test_filter_misses_none_and_passes_few(spark):
    ids = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("ride_id"))
    filters = ride_filter(ids.where("crc32(ride_id) % 2 = 0")).withColumn("year_month", F.lit("202401")).unionByName(
        ride_filter(spark.createDataFrame([("only",), (None,)], "ride_id string")).withColumn("year_month", F.lit("202402")))
    found = may_be_in(ids, filters).groupBy("year_month").count().collect()
    held = ids.where("crc32(ride_id) % 2 = 0").count()
    assert [(r["year_month"], r["count"]) for r in found] == [("202401", held)]
    assert filters.where("year_month = '202401'").count() <= 2 * held / 8  # blocks of 64 bytes: at most 16 bytes an id
    assert may_be_in(ids, filters.where("false")).count() == 0


def test_batch_of_a_month(spark, tmp_path):
    """The first month builds whole, the next goes alone, a run without a month forgets the state."""
    paths = LayerPaths.below(str(tmp_path))
    for month in ("202401", "202402"):
        folder = tmp_path / "raw" / f"yyyymm={month}"
        folder.mkdir(parents=True)
        rows = [{**CURRENT_ROW, "ride_id": f"{month}-{i}"} for i in range(3)] + [{**CURRENT_ROW, "ride_id": "both"}]
        (folder / "part-0.csv").write_text(csv_text(rows, S.CURRENT_COLUMNS))
    run_batch(spark, paths, "202401")
    before = _files(tmp_path / "silver" / "year_month=202401")
    out = run_batch(spark, paths, "202402")
    assert out["silver"].count() == 7 and _files(tmp_path / "silver" / "year_month=202401") == before
    _same_as_rebuilt(spark, tmp_path)
    run_batch(spark, paths)
    assert not monthly.has_state(spark, paths.state)
