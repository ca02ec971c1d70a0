"""One month at a time through silver and gold, with the same tables as a rebuild of everything.

Beside the layers a state folder holds what later months need of earlier ones:

* ``rides``: a Bloom filter of each month's ride ids. A month being loaded looks its ids up there, so only
  months that may hold a copy of one of its rides are read, and of these the rows of such ids.
* ``contested``: the rides known to be in several months. When a month is loaded again without such a ride, the
  other months get it back.
* ``parts``: counts and sums of each month for the three gold tables. Gold is put together from them; of the
  daily table only the days touched are replaced.

A month whose rides don't change is neither read nor written. State is written last, so a load that was
broken off is simply repeated.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikenet import schema as S
from bikenet.operators.cleaning import dedupe_rides, drop_null_critical, with_features
from bikenet.operators.gold import GOLD_KEYS, assemble, partial_tables
from bikenet.operators.ride_filter import may_be_in, ride_filter
from bikenet.session import shared_folder
from bikenet.sinks import write_gold, write_month, write_silver
from bikenet.sources.files import list_files
from bikenet.sources.layers import read_bronze, read_silver

_CONTESTED = "ride_id string, year_month string"
_FILTER = "size bigint, block bigint, " + ", ".join(f"w{k} bigint" for k in range(8)) + ", year_month string"


def index_months(spark: SparkSession, bronze: str, silver: str, state: str) -> None:
    """The state that belongs to layers built as a whole."""
    rides = drop_null_critical(read_bronze(spark, bronze)).where("ride_id IS NOT NULL").select("ride_id", "year_month")
    forget_state(spark, state)
    for month in _months(spark, bronze):
        write_month(ride_filter(rides.where(F.col("year_month") == month)), f"{state}/rides", month)
    for month in _months(spark, silver):
        _write_parts(read_silver(spark, silver).where(F.col("year_month") == month), state, month)
    contested = rides.distinct().groupBy("ride_id").agg(F.collect_set("year_month").alias("months"))
    contested = contested.where(F.size("months") > 1).select("ride_id", F.explode("months").alias("year_month"))
    contested.write.mode("overwrite").parquet(f"{state}/contested")


def silver_month(spark: SparkSession, bronze: str, silver: str, state: str, month: str) -> list[str]:
    """Clean the rows of one month; returns the months of silver that changed, this one first."""
    complete = drop_null_critical(read_bronze(spark, bronze))
    own = complete.where(F.col("year_month") == month)
    contested = _read(spark, f"{state}/contested", _CONTESTED)
    filters = _read(spark, f"{state}/rides", _FILTER).where(F.col("year_month") != month)
    before = contested.join(contested.where(F.col("year_month") == month).select("ride_id"), "ride_id", "left_semi")
    asked = _kept(may_be_in(own, filters).union(before.where(F.col("year_month") != month)).distinct(), "asked")
    others = sorted(row["year_month"] for row in asked.select("year_month").distinct().collect())

    # exact: the rows of those ids in those months, and in the month loaded
    copies = complete.where(F.col("year_month").isin(others)).join(asked, ["ride_id", "year_month"], "left_semi")
    copies = _kept(copies.select(*own.columns), "copies")
    shared = copies.select("ride_id").distinct()
    rows = copies.unionByName(own.join(shared, "ride_id", "left_semi").select(*own.columns))
    winners = _kept(with_features(dedupe_rides(rows)), "winners")

    rest = with_features(dedupe_rides(own.join(shared, "ride_id", "left_anti")))
    mine = winners.where(F.col("year_month") == month)
    write_silver(rest.unionByName(mine).select(*_silver_columns()), silver, [month])
    changed = [month]
    for other in others:
        there = read_silver(spark, silver).where(F.col("year_month") == other)
        new = winners.where(F.col("year_month") == other).select(*_silver_columns())
        old = there.join(shared, "ride_id", "left_semi").select(*_silver_columns())
        if old.exceptAll(new).isEmpty() and new.exceptAll(old).isEmpty():
            continue
        kept = there.join(shared, "ride_id", "left_anti").select(*_silver_columns()).unionByName(new)
        write_silver(_kept(kept, "silver"), silver, [other])
        changed.append(other)

    pairs = rows.select("ride_id", "year_month").distinct().groupBy("ride_id").agg(F.collect_set("year_month").alias("months"))
    pairs = pairs.where(F.size("months") > 1).select("ride_id", F.explode("months").alias("year_month"))
    gone = before.select("ride_id").union(shared).distinct()
    _kept(contested.join(gone, "ride_id", "left_anti").unionByName(pairs), "contested").write.mode("overwrite").parquet(f"{state}/contested")
    write_month(ride_filter(own), f"{state}/rides", month)
    return changed


def gold_months(spark: SparkSession, silver: str, gold: str, state: str, months: Iterable[str]) -> None:
    """Bring gold up to date after the months given have changed in silver."""
    days: set = set()
    for month in months:
        days |= _days(spark, state, month)
        _write_parts(read_silver(spark, silver).where(F.col("year_month") == month), state, month)
        days |= _days(spark, state, month)
    daily = assemble("trips_per_station", _parts(spark, state, "trips_per_station").where(F.col("trip_date").isin(days)))
    daily = _kept(daily, "daily")
    path = f"{gold}/trips_per_station"
    write_gold(daily, path, "trip_date", only_those=True)
    left = {row["trip_date"] for row in daily.select("trip_date").distinct().collect()}
    for day in days - left:  # no trip is left on these
        daily.where(F.lit(False)).drop("trip_date").write.mode("overwrite").parquet(f"{path}/trip_date={day}")
    for name in ("hourly_pattern", "rideable_split"):
        write_gold(assemble(name, _parts(spark, state, name)), f"{gold}/{name}")


def load_month(spark: SparkSession, bronze: str, silver: str, gold: str, state: str, month: str) -> list[str]:
    """One month of bronze into silver and gold; returns the months of silver that changed."""
    changed = silver_month(spark, bronze, silver, state, month)
    gold_months(spark, silver, gold, state, changed)
    return changed


def has_state(spark: SparkSession, state: str) -> bool:
    """Whether the layers were indexed since they were last built whole."""
    return _exists(spark, f"{state}/contested")


def forget_state(spark: SparkSession, state: str) -> None:
    """Drop what belongs to an earlier build; the next month loaded alone builds anew."""
    if _exists(spark, state):
        path = spark._jvm.org.apache.hadoop.fs.Path(state)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def _write_parts(silver: DataFrame, state: str, month: str) -> None:
    for name, part in partial_tables(silver).items():
        write_month(part, f"{state}/parts/{name}", month)


def _parts(spark: SparkSession, state: str, name: str) -> DataFrame:
    return spark.read.schema(GOLD_KEYS[name]).parquet(f"{state}/parts/{name}")


def _days(spark: SparkSession, state: str, month: str) -> set:
    """The days of a month's part, as far as it has been written."""
    if month not in _months(spark, f"{state}/parts/trips_per_station"):
        return set()
    own = _parts(spark, state, "trips_per_station").where(F.col("year_month") == month)
    return {row["trip_date"] for row in own.select("trip_date").distinct().collect()}


def _silver_columns() -> list[str]:
    return [field.name for field in S.SILVER_SCHEMA]


def _months(spark: SparkSession, path: str) -> list[str]:
    """The months that a table has directories of."""
    if not _exists(spark, path):
        return []
    key = F.regexp_extract("source_file", r"year_month=(\d{6})", 1)
    return sorted(r[0] for r in list_files(spark, path, "*.parquet").select(key).distinct().collect() if r[0])


def _exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(jpath)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A state table; before the first month there is none, which is the same as an empty one."""
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def _kept(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written down, so that what it was read from may be replaced."""
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
