from __future__ import annotations

import json

import pytest

from bikenet import schema as S
from bikenet.__main__ import main
from helpers import CURRENT_ROW, csv_text
from test_plans import _zip


def test_from_archives_to_results(spark, tmp_path, capsys):
    zips, root, out = tmp_path / "zips", tmp_path / "data", tmp_path / "out"
    zips.mkdir()
    rows = [{**CURRENT_ROW, "ride_id": str(i)} for i in range(7)]
    _zip(zips / "2023-tripdata.zip", {"202301-trips.csv": csv_text(rows, S.CURRENT_COLUMNS)})

    def run(*argv):
        return main([str(a) for a in argv], spark)

    assert run("ingest", zips, root / "raw", "--start-year", 2023, "--end-year", 2023) == 0
    assert "1 months landed: 202301" in capsys.readouterr().out
    assert run("validate", root / "raw") == 0
    assert run("batch", root, "--yyyymm", "202301") == 0
    assert run("query", "top_stations", "hourly", "--gold", root / "gold", "--output", out) == 0
    top = spark.read.option("header", True).csv(str(out / "top_stations_results")).first()
    assert top["total_trips"] == "7"
    assert run("query", "realtime", "--output", out) == 1
    (tmp_path / "bad.csv").write_text("x,y\n1,2\n")
    assert run("validate", tmp_path / "bad.csv") == 1
    with pytest.raises(SystemExit):
        main(["query", "nothing", "--output", "x"], spark)


def test_publish_documents_of_many_stations(spark, tmp_path):
    """Multi-line documents as a feed serves them; a station without an id does not stop the job."""
    feed = tmp_path / "feed"
    feed.mkdir()
    for n in range(2):
        stations = [{"station_id": f"A{i}", "num_bikes_available": n} for i in range(5)]
        document = {"last_updated": 1712000000 + n, "data": {"stations": [*stations, {"num_bikes_available": 1}]}}
        (feed / f"{n}.json").write_text(json.dumps(document, indent=2))
    out = tmp_path / "messages"
    argv = ["publish", str(feed), "--checkpoint", str(tmp_path / "c"), "--path", str(out), "--once"]
    for _ in range(2):  # a restart repeats nothing
        assert main(argv, spark) == 0
        messages = [json.loads(r["value"]) for r in spark.read.text(str(out)).collect()]
        assert sorted((m["station_id"], m["num_bikes_available"]) for m in messages) == sorted(
            (f"A{i}", n) for n in range(2) for i in range(5))
    assert main(["publish", str(feed), "--checkpoint", "c"], spark) == 1
