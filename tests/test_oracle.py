"""Every registered query against its SQL, exactly: column names, types, rows and values."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from bikenet.registry import load

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(load().ORACLE))
def test_matches_sql(spark, duck, name):
    result = entry_module.queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    actual = _sorted(tuple(r[c] for c in columns) for r in result.collect())

    cursor = duck.execute(entry_module.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(names) == columns
    expected = _sorted(tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall())

    assert {c: TYPES[t] for c, t in result.dtypes} == types
    assert len(actual) == len(expected)
    assert actual == expected
    assert expected or name == "empty_station_sample"


def test_every_query_is_registered_once():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
