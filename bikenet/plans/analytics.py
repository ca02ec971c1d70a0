"""The serving queries by name, and a run that writes their results."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from bikenet.operators import serving, status
from bikenet.sinks import write_result_csv

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class Tables:
    """Inputs of the serving queries; leave out what the queries asked for do not need."""

    trips_per_station: DataFrame | None = None
    hourly_pattern: DataFrame | None = None
    rideable_split: DataFrame | None = None
    scores: DataFrame | None = None
    status: DataFrame | None = None
    #: ``station_id, neighborhood_id`` of placed stations; without it ids are compared directly.
    stations: DataFrame | None = None


QUERIES: Mapping[str, Callable[[Tables], DataFrame]] = {
    "top_stations": lambda t: serving.top_stations_by_trips(t.trips_per_station),
    "top_stations_minutes": lambda t: serving.top_stations(t.trips_per_station),
    "hourly": lambda t: serving.hourly_usage_pattern(t.hourly_pattern),
    "hourly_totals": lambda t: serving.hourly_pattern(t.hourly_pattern),
    "rideable_split": lambda t: serving.rideable_split(t.rideable_split),
    "neighborhoods": lambda t: serving.neighborhood_trip_summary(
        t.trips_per_station, t.scores, t.stations),
    "realtime": lambda t: status.current_station_availability(t.status),
    "equity_gap": lambda t: serving.equity_gap_stations(t.trips_per_station, t.status),
}
DEFAULT_QUERIES = ("top_stations", "hourly", "rideable_split")


def run_query(name: str, tables: Tables) -> DataFrame:
    if name not in QUERIES:
        raise ValueError(f"unknown query {name!r}, expected one of {sorted(QUERIES)}")
    return QUERIES[name](tables)


def run_analytics(
    tables: Tables, output: str, names: tuple[str, ...] = DEFAULT_QUERIES,
) -> dict[str, str]:
    """Write each query's result as CSV and return the paths of those that succeeded.

    A failing query is logged and does not stop the others.
    """
    written: dict[str, str] = {}
    for name in names:
        path = f"{output.rstrip('/')}/{name}_results"
        try:
            written[name] = write_result_csv(run_query(name, tables), path)
        except Exception:
            logger.exception("query %s failed", name)
    return written
