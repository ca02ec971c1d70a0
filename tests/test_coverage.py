"""The coverage table names only what exists, and names every query."""

from __future__ import annotations

import re
from importlib import import_module
from pathlib import Path

from bikenet.registry import load

ROWS = [
    [cell.strip() for cell in line.strip("|\n").split("|")]
    for line in Path(__file__).parents[1].joinpath("COVERAGE.md").read_text().splitlines()
    if re.match(r"\| [A-Z]\d", line)
]


def test_functions_exist():
    names = {name for row in ROWS for name in re.findall(r"`([\w.]+)`", row[1])}
    assert len(names) > 90
    for name in names:
        module, function = name.rsplit(".", 1)
        assert callable(getattr(import_module(f"bikenet.{module}"), function)), name


def test_queries_exist_and_have_sql():
    queries = set(load().QUERIES)
    named = {
        q for row in ROWS for part in row[2].split(";") if "tests" not in part
        for q in re.findall(r"\b[a-z]\w*_\w+|\bkpis\b|\bfreshness\b", part)
    }
    assert named <= queries, named - queries
    assert queries <= named, queries - named
    assert queries == set(load().ORACLE)


def test_every_id_is_listed():
    listed = {i for row in ROWS for i in re.findall(r"[A-Z]\d+", row[0])}
    last = {"S": 14, "K": 8, "P": 23, "J": 7, "A": 27, "U": 3, "W": 2, "T": 11, "F": 26, "R": 6,
            "C": 18}
    assert listed == {f"{letter}{n}" for letter, top in last.items() for n in range(1, top + 1)}
