"""From raw text columns to clean, deduplicated trips with time features."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bikenet import schema as S
from bikenet.functions.temporal import whole_seconds, year_month

_LEGACY_NAMES = {
    "started_at": "starttime",
    "ended_at": "stoptime",
    "start_station_name": "start station name",
    "start_station_id": "start station id",
    "end_station_name": "end station name",
    "end_station_id": "end station id",
    "start_lat": "start station latitude",
    "start_lng": "start station longitude",
    "end_lat": "end station latitude",
    "end_lng": "end station longitude",
}
_KEY_SEPARATOR = "\x1f"


def detect_schema(columns: Iterable[str]) -> str:
    """``current``, ``legacy`` or ``unknown``, judged by column names in any case."""
    names = {c.lower() for c in columns}
    for version, marker in (("current", "ride_id"), ("legacy", "tripduration")):
        if marker in names:
            return version
    return "unknown"


def required_columns(version: str) -> set[str]:
    return set(S.REQUIRED_COLUMNS[version])


def missing_columns(columns: Iterable[str], version: str) -> list[str]:
    return sorted(required_columns(version) - {c.lower() for c in columns})


def cast_current(df: DataFrame) -> DataFrame:
    """Type the two times and four coordinates; unreadable values become NULL.

    Times keep a type they already have, so a table that is read typed passes through.
    """
    df = _lower_case(df)
    return df.withColumns({n: c for n, c in _current_columns(df).items() if n in _TYPED})


def normalise_legacy(df: DataFrame, legacy_key: str = "ride") -> DataFrame:
    """The older format in canonical columns.

    It has no ride id. ``legacy_key="ride"`` builds one from bike, start time and both stations;
    ``"bike"`` takes the bike id itself, which lets a later deduplication keep one trip per bike.
    """
    df = _lower_case(df)
    derived = _legacy_columns(df, legacy_key)
    return df.select(*(derived[name].alias(name) for name in S.CURRENT_COLUMNS))


def canonical_trips(rows: DataFrame, legacy_key: str = "ride") -> DataFrame:
    """Rows of both formats side by side, told apart by ``schema_version``, in canonical columns."""
    current, legacy = _current_columns(rows), _legacy_columns(rows, legacy_key)
    is_current = F.col("schema_version") == "current"
    return conform(rows.select(*(
        F.when(is_current, current[name]).otherwise(legacy[name]).alias(name) for name in S.CURRENT_COLUMNS)))


def _current_columns(df: DataFrame) -> dict[str, Column]:
    return {name: _typed(df, name, name) for name in S.CURRENT_COLUMNS if name in df.columns}


def _legacy_columns(df: DataFrame, legacy_key: str) -> dict[str, Column]:
    if legacy_key == "bike":
        ride_id = F.col("bikeid").cast("string")
    else:
        identity = ("bikeid", "starttime", "stoptime", "start station id", "end station id")
        ride_id = F.sha2(F.concat_ws(_KEY_SEPARATOR, *(
            F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in identity
        )), 256)
    subscriber = F.lower(F.col("usertype")) == "subscriber"
    return {
        "ride_id": ride_id,
        "rideable_type": F.lit("classic_bike"),
        "member_casual": F.when(subscriber, "member").otherwise("casual"),
        **{name: _typed(df, source, name) for name, source in _LEGACY_NAMES.items()},
    }


def normalise(df: DataFrame, legacy_key: str = "ride") -> DataFrame:
    """Apply the branch that fits the columns; unknown columns are an error."""
    version = detect_schema(df.columns)
    if version == "current":
        return cast_current(df)
    if version == "legacy":
        return normalise_legacy(df, legacy_key)
    raise ValueError(f"unrecognised trip columns: {df.columns}")


def conform(df: DataFrame) -> DataFrame:
    """Exactly the canonical columns in order; absent ones are NULL, extra ones dropped."""
    return df.select(*(
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in S.TRIP_SCHEMA
    ))


def tag_month(df: DataFrame, yyyymm: str | None = None) -> DataFrame:
    """Add ``year_month``: the month given, or else the month in which the trip started."""
    tag = F.lit(yyyymm) if yyyymm else year_month(F.col("started_at"))
    return df.withColumn("year_month", tag)


def drop_null_critical(
    df: DataFrame, columns: Sequence[str] = S.CRITICAL_COLUMNS,
) -> DataFrame:
    return df.dropna(subset=list(columns))


def dedupe_rides(
    df: DataFrame, key: str = "ride_id", order_by: Sequence[str] | None = None,
    strict_ref: bool = False,
) -> DataFrame:
    """One row per ride: the least in ``order_by``, by default in all columns of the trip.

    A row number compared with 1 lets Spark cut each map task's rows to one per key before the
    shuffle, so a key with very many copies costs one row per task. Trips without an id are all
    kept; with ``strict_ref`` they collapse to one and the survivor is arbitrary.
    """
    if strict_ref:
        return df.dropDuplicates([key])
    names = order_by or [c for c in (*S.CURRENT_COLUMNS, "year_month") if c in df.columns and c != key]
    first = ("started_at", "ended_at")
    names = [c for c in first if c in names] + [c for c in names if c not in first]
    window = Window.partitionBy(key).orderBy(*(F.col(c).asc_nulls_last() for c in names))
    with_id = (
        df.where(F.col(key).isNotNull())
        .withColumn("_copy", F.row_number().over(window))
        .where(F.col("_copy") == 1)
        .drop("_copy")
    )
    return with_id.unionByName(df.where(F.col(key).isNull()))


def trip_duration(df: DataFrame) -> DataFrame:
    seconds = whole_seconds(F.col("started_at"), F.col("ended_at"))
    return df.withColumn("trip_duration_seconds", seconds)


def duration_filter(
    df: DataFrame, low: int = S.MIN_TRIP_SECONDS, high: int = S.MAX_TRIP_SECONDS,
) -> DataFrame:
    """Keep trips of at least ``low`` and at most ``high`` seconds."""
    return df.where(F.col("trip_duration_seconds").between(low, high))


def temporal_features(df: DataFrame) -> DataFrame:
    """Hour, day of week (1 = Sunday) and date of the start."""
    start = F.col("started_at")
    return df.withColumns({
        "hour_of_day": F.hour(start),
        "day_of_week": F.dayofweek(start),
        "trip_date": F.to_date(start),
    })


def with_features(rides: DataFrame) -> DataFrame:
    """Deduplicated trips of plausible length, with their features."""
    return temporal_features(duration_filter(trip_duration(rides)))


def to_silver(bronze: DataFrame, strict_ref: bool = False) -> DataFrame:
    """The cleaning steps in their order: complete, deduplicated, plausible, with features.

    The survivor among copies is chosen before the duration filter, so a ride whose earliest
    copy is implausible is dropped with all its copies.
    """
    rides = dedupe_rides(drop_null_critical(bronze), strict_ref=strict_ref)
    return with_features(rides)


_TYPED = {f.name for f in S.TRIP_SCHEMA if f.dataType.simpleString() != "string"}


def _typed(df: DataFrame, source: str, target: str) -> Column:
    column = F.col(f"`{source}`")
    wanted = S.TRIP_SCHEMA[target].dataType
    if df.schema[source].dataType.simpleString() != "string":
        return column if wanted.simpleString() == "timestamp" else column.cast(wanted)
    if wanted.simpleString() == "timestamp":
        return F.try_to_timestamp(column)
    return column.try_cast(wanted)


def _lower_case(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.lower() for c in df.columns))
