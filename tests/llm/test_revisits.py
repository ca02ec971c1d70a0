"""Revisits against DuckDB and on hand-made captures."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from bikenet.llm import revisits

SCHEMA = ("capture_id bigint, url string, time bigint, kind string, etag string, last_modified string, "
          "headers map<string,string>, html string, found string, slice int")


@pytest.fixture
def resolved(spark):
    def run(*rows):
        full = [(*r, None, "x", 1) for r in rows]
        out = revisits.resolve_revisits(spark.createDataFrame(full, SCHEMA)).collect()
        return {r["capture_id"]: (r["status"], r["response_id"], r["headers"]) for r in out}

    return run


def test_pages_equal_sql(spark):
    path = "/root/testdata/sf0.1/pages.parquet"
    found = revisits.resolve_revisits(revisits.captures_of_pages(spark.read.parquet(path))).select(
        "capture_id", "url_key", "status", "response_id", revisits.header_lines(F.col("headers")).alias("header_lines"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{path}'")
    assert sorted(map(tuple, found.collect())) == sorted(con.execute(revisits.PAGES_SQL).fetchall())


def test_latest_earlier_response_and_validators(resolved):
    own = {"content-type": "text/html", "etag": '"a"', "server": "s"}
    found = resolved(
        (1, "http://www.A.org/x/", 10, "response", '"a"', "m1", own),
        (2, "https://a.org:443/x#part", 20, "response", '"b"', None, {"etag": '"b"'}),
        (3, "a.org/x", 15, "revisit", 'W/"a"', None, {"date": "d", "server": "no", "content-length": "0"}),
        (4, "a.org/x", 20, "revisit", None, "m1", {}),  # a response of the same time is not earlier
        (5, "a.org/x", 21, "revisit", '"a"', None, {}),  # the latest one differs; older ones don't count
        (6, "a.org/x", 22, "revisit", None, "m1", None),
        (7, "a.org/x", 10, "revisit", '"a"', None, {}),
        (8, None, 30, "revisit", '"a"', None, {}),
        (9, "a.org/x", None, "revisit", '"a"', None, {}),
        (10, "a.org/y", 30, "revisit", '"a"', None, {}),
        (11, "a.org/x", 30, "request", '"b"', None, {}),
        (12, "a.org/x", 30, None, '"b"', None, {}),
        (13, None, 5, "response", '"a"', None, {}),
    )
    assert found == {
        3: ("resolved", 1, {**own, "date": "d"}), 4: ("resolved", 1, own), 5: ("mismatch", None, None),
        6: ("unchecked", None, None), 7: ("missing", None, None), 8: ("missing", None, None),
        9: ("missing", None, None), 10: ("missing", None, None),
    }


def test_ties_repeats_and_empty(resolved):
    found = resolved(
        (1, "a.org", 10, "response", '"a"', None, None), (2, "a.org", 10, "response", '"b"', None, None),
        (3, "a.org", 11, "revisit", '"b"', None, None))
    assert found == {3: ("resolved", 2, {})}
    assert resolved() == {}


def test_one_url_over_many_slices(resolved):
    rows = [(2 * i, "h.org/", 1000 * i, "response", f'"{i}"', None, {}) for i in range(0, 300, 3)]
    rows += [(2 * i + 1, "H.org", 1000 * i + 1, "revisit", f'"{i - i % 3}"', None, {}) for i in range(300)]
    assert resolved(*rows) == {2 * i + 1: ("resolved", 2 * (i - i % 3), {}) for i in range(300)}


def test_canonical_url(spark):
    urls = {"HTTP://WWW.Ex.org:80/A/?b=2&utm_source=f&a=1#top": "ex.org/A?a=1&b=2", "https://m.ex.org": "m.ex.org",
            "ex.org/p?utm_x=1": "ex.org/p", "": "", None: None}
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select("u", revisits.canonical_url(F.col("u")))
    assert {r[0]: r[1] for r in rows.collect()} == urls
