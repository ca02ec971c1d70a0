from __future__ import annotations

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from bikenet import schema as S
from bikenet.operators import monitoring
from bikenet.sinks import message_values, write_status_messages
from bikenet.sources import feeds, layers
from bikenet.streaming import lag, status
from helpers import plan_of
from test_sources import SNAPSHOT


def messages(spark, tmp_path, stations=None):
    doc = dict(SNAPSHOT)
    if stations is not None:
        doc["data"] = {"stations": stations}
    path = tmp_path / "feed"
    path.mkdir(exist_ok=True)
    (path / "s.json").write_text(json.dumps(doc))
    return status.build_messages(feeds.read_status_snapshots(spark, str(path)))


def test_message_fields_and_defaults(spark, tmp_path):
    rows = {r["station_id"]: r.asDict() for r in messages(spark, tmp_path).collect()}
    assert rows["A01"] == {
        "station_id": "A01", "num_bikes_available": 4, "num_docks_available": 8,
        "num_ebikes_available": 1, "is_installed": 1, "is_renting": 1,
        "last_reported": 1711999990, "ingested_at": 1712000000,
    }
    assert rows["A02"] == {
        "station_id": "A02", "num_bikes_available": 0, "num_docks_available": 0,
        "num_ebikes_available": 0, "is_installed": 0, "is_renting": 0,
        "last_reported": 0, "ingested_at": 1712000000,
    }


def test_missing_station_id_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="station_id"):
        messages(spark, tmp_path, [{"num_bikes_available": 1}]).collect()
    with pytest.raises(ValueError, match="station_id"):
        status.build_messages(spark.createDataFrame([(1,)], "last_updated long"))


def test_messages_survive_json(spark, tmp_path):
    sent = messages(spark, tmp_path)
    back = message_values(sent).select(F.from_json("value", S.STATUS_SCHEMA).alias("m")).select("m.*")
    assert sorted(back.collect()) == sorted(sent.collect())
    write_status_messages(sent, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 2


def _records(spark, tmp_path):
    """A file source in the shape of the topic: value and timestamp."""
    schema = "value string, timestamp timestamp"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))


def _put(spark, tmp_path, values):
    rows = spark.createDataFrame([(v,) for v in values], "value string")
    rows.select("value", F.current_timestamp().alias("timestamp")).coalesce(1).write.mode(
        "append").json(str(tmp_path / "in"))


GOOD = json.dumps({"station_id": "A", "num_bikes_available": 3, "ingested_at": 5})


def _run(spark, tmp_path, **options):
    stream = status.build_status_stream(_records(spark, tmp_path), **options)
    query = status.start_status_sink(
        stream, str(tmp_path / "layer"), str(tmp_path / "checkpoint"), once=True)
    query.awaitTermination()
    return query, layers.read_status_layer(spark, str(tmp_path / "layer"))


def test_restart_adds_only_what_is_new(spark, tmp_path):
    _put(spark, tmp_path, [GOOD, "not json"])
    _put(spark, tmp_path, [GOOD])
    assert _run(spark, tmp_path)[1].count() == 3
    assert _run(spark, tmp_path)[1].count() == 3
    _put(spark, tmp_path, [GOOD] * 4)
    _, layer = _run(spark, tmp_path)
    assert layer.count() == 7
    broken = layer.where("station_id is null").collect()
    assert len(broken) == 1 and broken[0]["processed_at"] is not None
    assert broken[0]["num_bikes_available"] is None
    # one processing time per micro-batch; each file was its own batch
    assert layer.select("processed_at").distinct().count() == 3
    assert layer.where("processing_date = to_date(processed_at)").count() == 7


def test_uncommitted_files_are_not_read(spark, tmp_path):
    _put(spark, tmp_path, [GOOD])
    _, layer = _run(spark, tmp_path)
    part = next((tmp_path / "layer").glob("processing_date=*/*.parquet"))
    shutil.copy(part, part.with_name("part-stray.snappy.parquet"))
    assert layers.read_status_layer(spark, str(tmp_path / "layer")).count() == 1
    assert layers.read_plain_glob(spark, str(tmp_path / "layer")).count() == 1


def test_malformed_payloads_can_be_left_out(spark, tmp_path):
    _put(spark, tmp_path, [GOOD, "{", "[1]"])
    assert _run(spark, tmp_path, drop_malformed=True)[1].count() == 1


def test_snapshot_stream_to_messages(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "1.json").write_text(json.dumps(SNAPSHOT))
    for _ in range(2):
        snapshots = feeds.read_status_snapshots(
            spark, str(tmp_path / "feed"), streaming=True, files_per_trigger=1)
        status.start_message_job(
            snapshots, str(tmp_path / "cp"), str(tmp_path / "out"), once=True).awaitTermination()
    assert spark.read.text(str(tmp_path / "out")).count() == 2


KAFKA_PROGRESS = [
    {"sources": [{"description": "KafkaV2[Subscribe[status]]",
                  "endOffset": {"status": {"0": 100}}, "latestOffset": {"status": {"0": 150, "1": 9}}}]},
    {"sources": [{"description": "KafkaV2[Subscribe[status]]",
                  "endOffset": '{"status": {"0": 140}}',
                  "latestOffset": '{"status": {"0": 160, "1": 12000}}'}]},
]


def test_lag_is_latest_minus_processed(spark):
    rows = {r["partition"]: r["lag"] for r in lag.partition_lag(spark, KAFKA_PROGRESS).collect()}
    assert rows == {"0": 20, "1": 12000}
    total = lag.stream_lag(spark, KAFKA_PROGRESS, "status").first()
    assert (total["total_lag"], total["threshold"], total["ok"]) == (12020, 10000, False)
    assert lag.stream_lag(spark, KAFKA_PROGRESS, "other").first()["total_lag"] == 0


def test_lag_of_a_running_query(spark, tmp_path):
    _put(spark, tmp_path, [GOOD])
    query, _ = _run(spark, tmp_path)
    assert lag.stream_lag(spark, lag.query_progress(query)).first()["ok"] is True


def test_lag_from_stored_reports(spark, tmp_path):
    """Read by a process that has no query: the same lag as from the reports themselves."""
    log = str(tmp_path / "log")
    stamped = [{**r, "id": "q", "runId": "r", "batchId": k, "timestamp": f"2024-05-0{k + 1}T10:00:00.000Z"}
               for k, r in enumerate(KAFKA_PROGRESS)]
    stamped[1]["sources"][0] = {**stamped[1]["sources"][0], "endOffset": {"status": {"0": 140}},
                                "latestOffset": {"status": {"0": 160, "1": 12000}, "other": {"0": 5}}}
    stamped[0]["sources"].append({"description": "FileStreamSource[x]", "endOffset": {"logOffset": 3}, "latestOffset": None})
    lag.append_reports(spark, stamped[:1], log)
    lag.append_reports(spark, stamped[1:], log)
    lag.append_reports(spark, [], log)
    reports = lag.read_reports(spark, log, as_of=F.lit("2024-05-02"))
    rows = {(r["topic"], r["partition"]): r["lag"] for r in lag.reported_offsets(reports).collect()}
    assert rows == {("status", "0"): 20, ("status", "1"): 12000, ("other", "0"): 5}
    assert tuple(lag.stored_lag(reports, "status").first()) == (12020, 10000, False)
    assert lag.stored_lag(lag.read_reports(spark, log, days=1, as_of=F.lit("2024-05-01"))).first()["total_lag"] == 59
    assert tuple(lag.stored_lag(reports.limit(0)).first()) == (None, 10000, True)
    later = lag.read_reports(spark, log, as_of=F.lit("2024-06-01"))
    assert later.count() == 0 and "PartitionFilters: [isnotnull(report_date" in plan_of(later)


def test_a_followed_query_files_its_reports(spark, tmp_path):
    _put(spark, tmp_path, [GOOD])
    query = status.start_status_sink(
        status.build_status_stream(_records(spark, tmp_path)), str(tmp_path / "layer"), str(tmp_path / "cp"), once=True)
    lag.follow(query, str(tmp_path / "log"), seconds=1)
    reports = spark.read.parquet(str(tmp_path / "log"))
    assert reports.where("report like '%numInputRows%'").count() == reports.distinct().count() >= 1
    assert {r["query"] for r in reports.collect()} == {str(query.id)}


def test_reports_of_a_failed_query_are_filed(spark, tmp_path):
    _put(spark, tmp_path, [GOOD])
    broken = _records(spark, tmp_path).select(F.raise_error(F.lit("no good")).cast("string").alias("value"))
    query = broken.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp")).start()
    with pytest.raises(Exception, match="no good"):
        lag.follow(query, str(tmp_path / "log"), seconds=1)


def test_freshness_from_the_log_of_the_sink(spark, tmp_path, monkeypatch):
    """Committed files only, by the newest batch of the log, also when that added none."""
    for k in range(3):
        (tmp_path / "in").mkdir(exist_ok=True)
        _put(spark, tmp_path, [GOOD])
        _run(spark, tmp_path)
    layer = str(tmp_path / "layer")
    newest = max(p.stat().st_mtime for p in (tmp_path / "layer").glob("processing_date=*/*.parquet"))
    part = next((tmp_path / "layer").glob("processing_date=*/*.parquet"))
    stray = part.with_name("part-stray.snappy.parquet")
    shutil.copy(part, stray)
    os.utime(stray, (newest + 500, newest + 500))
    read = []
    plain = monitoring.committed_files
    monkeypatch.setattr(monitoring, "committed_files", lambda s, names: read.append(len(names)) or plain(s, names))
    row = monitoring.file_freshness(spark, layer).first()
    assert abs(row["latest"].timestamp() - newest) < 1.5 and read == [1]
    log = sorted((tmp_path / "layer" / "_spark_metadata").glob("[0-9]*"), key=lambda p: int(p.name.split(".")[0]))
    (log[-1].parent / str(int(log[-1].name.split(".")[0]) + 1)).write_text("v1")  # a batch without files
    assert monitoring.file_freshness(spark, layer).first()["latest"] == row["latest"] and read[1:] == [1, len(log) + 1]


def test_file_freshness_and_health(spark, tmp_path):
    _put(spark, tmp_path, [GOOD])
    _, layer = _run(spark, tmp_path)
    fresh = monitoring.file_freshness(spark, str(tmp_path / "layer"))
    row = fresh.first()
    assert row["age_minutes"] < 10 and row["stale"] is False
    assert monitoring.require_fresh(fresh) is fresh
    old = monitoring.freshness_minutes(layer, F.current_timestamp() + F.expr("interval 11 minutes"))
    with pytest.raises(monitoring.StaleStream, match="minutes old"):
        monitoring.require_fresh(old)
    with pytest.raises(monitoring.StaleStream, match="no data"):
        monitoring.require_fresh(monitoring.freshness_minutes(layer.limit(0)))
    report = monitoring.health_report(
        fresh, layer.select("station_id", "num_bikes_available"), lag.stream_lag(spark, []))
    assert {r["check"]: r["ok"] for r in report.collect()} == {
        "freshness": True, "empty_stations": True, "stream_lag": True}
