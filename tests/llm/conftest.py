from __future__ import annotations

import pytest

from bikenet.session import ship_package

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, digest string"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def small(spark):
    """Tables of the smallest data set by name."""
    return lambda name: spark.read.parquet(f"{SMALL}/{name}.parquet")


@pytest.fixture
def docs(spark):
    """Documents from pairs of id and text, with columns whose names the operators use inside."""
    def make(*rows: tuple[int | None, str | None]):
        full = [(i, t, "en", "src0", len(t or ""), "n", "d") for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture
def edge_rows():
    """Null, empty, blank and long texts, a null id, repeated rows and code points of all lengths."""
    long = " ".join(f"word{i % 977} é" for i in range(60_000))
    return [
        (1, None), (2, ""), (3, "  \n\t "), (None, "a text without an id, told in nine words"), (5, "a"),
        (6, "the same row is here two times"), (6, "the same row is here two times"), (7, "Ünï €uro 😀 　 ́x"),
        (8, long), (None, None),
    ]
