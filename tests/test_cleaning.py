from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bikenet import schema as S
from bikenet.operators import cleaning
from helpers import current, legacy, plan_of


def test_detect_schema():
    assert cleaning.detect_schema(["RIDE_ID", "x"]) == "current"
    assert cleaning.detect_schema(["TripDuration", "bikeid"]) == "legacy"
    assert cleaning.detect_schema(["foo", "bar"]) == "unknown"
    assert cleaning.detect_schema(["tripduration", "ride_id"]) == "current"


def test_required_columns():
    assert len(cleaning.required_columns("current")) == 13
    assert len(cleaning.required_columns("legacy")) == 13
    assert cleaning.required_columns("unknown") == set()
    columns = [c.upper() for c in S.CURRENT_COLUMNS if c not in ("member_casual", "end_lat")]
    assert cleaning.missing_columns(columns, "current") == ["end_lat", "member_casual"]


def test_cast_current_turns_unreadable_values_into_null(spark):
    df = current(spark, {}, {"started_at": "yesterday", "start_lat": "north"})
    good, bad = cleaning.conform(cleaning.normalise(df)).orderBy("ride_id").collect()
    assert good["started_at"] == dt.datetime(2023, 1, 1, 8) and good["start_lat"] == 40.7128
    assert bad["started_at"] is None and bad["start_lat"] is None
    assert bad["end_lat"] == 40.7589


def test_legacy_columns_and_rider_type(spark):
    df = legacy(spark, {}, {"usertype": "CUSTOMER"}, {"usertype": None}, {"usertype": "subscriber"})
    out = cleaning.normalise_legacy(df)
    assert tuple(out.columns) == S.CURRENT_COLUMNS
    rows = out.collect()
    assert [r["member_casual"] for r in rows] == ["member", "casual", "casual", "member"]
    assert {r["rideable_type"] for r in rows} == {"classic_bike"}
    assert rows[0]["start_station_id"] == "72" and rows[0]["start_lat"] == 40.7696
    assert rows[0]["started_at"] == dt.datetime(2019, 1, 1, 8)


def test_legacy_key_separates_trips_of_one_bike(spark):
    df = legacy(spark, {}, {"starttime": "2019-01-01 09:00:00"})
    by_ride = cleaning.dedupe_rides(cleaning.normalise_legacy(df))
    by_bike = cleaning.dedupe_rides(cleaning.normalise_legacy(df, "bike"))
    assert by_ride.count() == 2
    assert [r["ride_id"] for r in by_bike.collect()] == ["14969"]


def test_unknown_columns_are_an_error(spark):
    with pytest.raises(ValueError, match="unrecognised"):
        cleaning.normalise(spark.range(1))


def test_conform_fills_and_drops_columns(spark):
    out = cleaning.conform(spark.createDataFrame([("1", 5)], "ride_id string, extra int"))
    assert [f.name for f in out.schema] == list(S.CURRENT_COLUMNS)
    assert [f.dataType for f in out.schema] == [f.dataType for f in S.TRIP_SCHEMA]


@pytest.mark.parametrize("column", S.CRITICAL_COLUMNS)
def test_rows_without_a_critical_value_are_dropped(spark, column):
    df = cleaning.normalise(current(spark, {}, {column: None}))
    assert [r["ride_id"] for r in cleaning.drop_null_critical(df).collect()] == ["0"]


def test_other_values_may_be_missing(spark):
    df = cleaning.normalise(current(spark, {"end_lat": None, "end_lng": None, "member_casual": None}))
    assert cleaning.drop_null_critical(df).count() == 1


@pytest.mark.parametrize(("end", "kept"), [
    ("2023-01-01 08:00:59", False),
    ("2023-01-01 08:01:00", True),
    ("2023-01-01 08:00:59.999", False),
    ("2023-01-02 08:00:00", True),
    ("2023-01-02 08:00:00.900", True),
    ("2023-01-02 08:00:01", False),
    ("2023-01-01 07:59:59", False),
])
def test_duration_bounds(spark, end, kept):
    df = cleaning.normalise(current(spark, {"ended_at": end}))
    assert (cleaning.to_silver(df).count() == 1) is kept


def test_fractional_seconds_are_cut_on_both_sides(spark):
    df = current(spark, {"started_at": "2023-01-01 08:00:00.900", "ended_at": "2023-01-01 08:01:00.100"})
    row = cleaning.trip_duration(cleaning.normalise(df)).first()
    assert row["trip_duration_seconds"] == 60


def test_temporal_features(spark):
    row = cleaning.to_silver(cleaning.normalise(current(spark, {}))).first()
    assert (row["hour_of_day"], row["day_of_week"]) == (8, 1)  # a Sunday
    assert row["trip_date"] == dt.date(2023, 1, 1)


def test_dedupe_keeps_the_earliest_copy_whatever_the_input_order(spark):
    early = {"ride_id": "A"}
    late = {"ride_id": "A", "started_at": "2023-01-01 08:05:00"}
    for changes in ((early, late), (late, early)):
        rows = cleaning.dedupe_rides(cleaning.normalise(current(spark, *changes))).collect()
        assert [r["started_at"].minute for r in rows] == [0]


def test_survivor_is_chosen_before_the_duration_filter(spark):
    short = {"ride_id": "A", "ended_at": "2023-01-01 08:00:10"}
    df = cleaning.normalise(current(spark, short, {"ride_id": "A"}))
    assert cleaning.to_silver(df).count() == 0


def test_trips_without_id(spark):
    df = cleaning.normalise(current(spark, {"ride_id": None}, {"ride_id": None}, {}))
    assert cleaning.dedupe_rides(df).count() == 3
    assert cleaning.dedupe_rides(df, strict_ref=True).count() == 2


def test_dedupe_trims_copies_before_the_shuffle(spark):
    """A third of all rows share one id; at most one row per map task may be shuffled for it."""
    base = spark.range(0, 30_000, numPartitions=6)
    rides = base.select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("ride_id"),
        F.timestamp_seconds("id").alias("started_at"),
        F.timestamp_seconds("id").alias("ended_at"),
    )
    unique = cleaning.dedupe_rides(rides)
    plan = plan_of(unique, "simple")
    exchange = plan.index("Exchange hashpartitioning(ride_id")
    assert "WindowGroupLimit" in plan[exchange:], plan
    assert unique.count() == 20_001
    assert unique.where("ride_id = 'hot'").first()["started_at"].second == 0


def test_tag_month(spark):
    df = cleaning.normalise(current(spark, {"started_at": "2022-12-31 23:59:00"}))
    assert cleaning.tag_month(df).first()["year_month"] == "202212"
    assert cleaning.tag_month(df, "202301").first()["year_month"] == "202301"
