"""Raw files to bronze, silver and gold tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from bikenet import schema as S
from bikenet.operators.cleaning import tag_month, to_silver
from bikenet.operators.gold import gold_tables
from bikenet.operators.quality import require_valid, validate_csv
from bikenet.operators.serving import gold_smoke
from bikenet.operators.spatial import compute_accessibility_scores, geo_scores
from bikenet.plans import monthly
from bikenet.sinks import write_bronze, write_geo_scores, write_gold, write_silver
from bikenet.sources.feeds import read_station_info
from bikenet.sources.geo import read_neighborhoods
from bikenet.sources.landing import ingest_range, land_all
from bikenet.sources.layers import read_bronze, read_layer, read_silver
from bikenet.sources.trips import read_raw_trips

STAGES = ("ingest", "validate", "bronze", "silver", "gold", "spatial", "smoke")
GOLD_SCHEMAS = {
    "trips_per_station": S.TRIPS_PER_STATION_SCHEMA,
    "hourly_pattern": S.HOURLY_PATTERN_SCHEMA,
    "rideable_split": S.RIDEABLE_SPLIT_SCHEMA,
}
_GOLD_PARTITIONS = {"trips_per_station": "trip_date"}


@dataclass(frozen=True)
class LayerPaths:
    """Where each layer lives; object-store or file paths alike."""

    raw: str
    bronze: str
    silver: str
    gold: str
    archives: str | None = None
    station_info: str | None = None
    neighborhoods: str | None = None
    scores: str | None = None
    state: str | None = None

    @classmethod
    def below(cls, root: str, **extra: str) -> LayerPaths:
        names = ("raw", "bronze", "silver", "gold", "state")
        return cls(**{n: f"{root.rstrip('/')}/{n}" for n in names}, **extra)

    def raw_files(self, yyyymm: str | None = None) -> str:
        """The raw area, or the folder of one month as the ingest stage lays it out."""
        return f"{self.raw}/yyyymm={yyyymm}" if yyyymm else self.raw


def raw_to_bronze(
    spark: SparkSession, raw: str, bronze: str, yyyymm: str | None = None,
    legacy_key: str = "ride",
) -> DataFrame:
    """Type the raw files. With ``yyyymm`` exactly that month's directory is replaced and all
    rows belong to it; without, months come from the start times and the table is rebuilt."""
    typed = tag_month(read_raw_trips(spark, raw, legacy_key), yyyymm)
    write_bronze(typed, bronze, yyyymm)
    return read_bronze(spark, bronze)


def bronze_to_silver(
    spark: SparkSession, bronze: str, silver: str, months: list[str] | None = None,
    strict_ref: bool = False,
) -> DataFrame:
    """Clean all months, or only ``months``; copies of a ride are sought within what is read."""
    source = read_bronze(spark, bronze)
    if months is not None:
        source = source.where(source["year_month"].isin(months))
    write_silver(to_silver(source, strict_ref), silver, months)
    return read_silver(spark, silver)


def silver_to_gold(spark: SparkSession, silver: str, gold: str) -> dict[str, DataFrame]:
    """Write the three aggregate tables and return them as read back."""
    for name, table in gold_tables(read_silver(spark, silver)).items():
        write_gold(table, f"{gold}/{name}", _GOLD_PARTITIONS.get(name))
    return read_gold(spark, gold)


def read_gold(spark: SparkSession, gold: str) -> dict[str, DataFrame]:
    return {name: read_layer(spark, f"{gold}/{name}", s) for name, s in GOLD_SCHEMAS.items()}


def score_neighborhoods(spark: SparkSession, paths: LayerPaths) -> DataFrame:
    """Accessibility scores from the gold table, written with the polygons."""
    polygons = read_neighborhoods(spark, paths.neighborhoods)
    stations = read_station_info(spark, paths.station_info)
    daily = read_gold(spark, paths.gold)["trips_per_station"]
    scores = compute_accessibility_scores(daily, stations, polygons)
    write_geo_scores(geo_scores(polygons, scores), paths.scores)
    return spark.read.parquet(paths.scores)


def ingest(spark: SparkSession, paths: LayerPaths, yyyymm: str | None = None) -> DataFrame:
    """Land all archives and tell each member's state, or land one month's archive and insist on that month."""
    if yyyymm is None:
        return land_all(spark, paths.archives, paths.raw)
    year = int(yyyymm[:4])
    landed = ingest_range(spark, paths.archives, paths.raw, year, year, months=[yyyymm])
    if landed.where(landed["yyyymm"] == yyyymm).isEmpty():
        raise RuntimeError(f"no archive data for {yyyymm}")
    return landed


def run_batch(
    spark: SparkSession, paths: LayerPaths, yyyymm: str | None = None,
    stages: Iterable[str] = ("bronze", "silver", "gold"),
) -> dict[str, DataFrame]:
    """Run the stages asked for, in their fixed order; an invalid file stops the batch.

    A month given goes through silver and gold alone (see :mod:`bikenet.plans.monthly`) once the layers
    have their state; the first such run, and one without a month, builds them whole.
    """
    wanted = set(stages)
    if wanted - set(STAGES):
        raise ValueError(f"unknown stages {sorted(wanted - set(STAGES))}, expected {STAGES}")
    out: dict[str, DataFrame] = {}
    if "ingest" in wanted:
        out["ingest"] = ingest(spark, paths, yyyymm)
    if "validate" in wanted:
        out["validate"] = require_valid(validate_csv(spark, paths.raw_files(yyyymm)))
    if "bronze" in wanted:
        out["bronze"] = raw_to_bronze(spark, paths.raw_files(yyyymm), paths.bronze, yyyymm)
    alone = yyyymm is not None and paths.state is not None and {"silver", "gold"} <= wanted
    if alone and monthly.has_state(spark, paths.state):
        monthly.load_month(spark, paths.bronze, paths.silver, paths.gold, paths.state, yyyymm)
        out.update({"silver": read_silver(spark, paths.silver), **read_gold(spark, paths.gold)})
    else:
        if "silver" in wanted:
            out["silver"] = bronze_to_silver(spark, paths.bronze, paths.silver)
        if "gold" in wanted:
            out.update(silver_to_gold(spark, paths.silver, paths.gold))
        if alone:
            monthly.index_months(spark, paths.bronze, paths.silver, paths.state)
        elif paths.state is not None and "silver" in wanted:
            monthly.forget_state(spark, paths.state)
    if "spatial" in wanted:
        out["spatial"] = score_neighborhoods(spark, paths)
    if "smoke" in wanted:
        out["smoke"] = gold_smoke(read_gold(spark, paths.gold)["trips_per_station"])
    return out
