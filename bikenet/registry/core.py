"""Registration of a query next to its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bikenet.registry.tables import DriverTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function of :class:`DriverTables` under its own name."""
    def register(build: Callable[[DriverTables], DataFrame]) -> Callable:
        name = build.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(DriverTables(spark, sf_dir))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register
