"""Command line: ``python -m bikenet <ingest|validate|batch|query|publish|stream|health> ...``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from bikenet.operators.monitoring import file_freshness, health_report
from bikenet.operators.quality import validate_csv
from bikenet.operators.spatial import join_stations_to_neighborhoods
from bikenet.operators.status import current_station_availability
from bikenet.plans.analytics import QUERIES, Tables, run_analytics
from bikenet.plans.layers import STAGES, LayerPaths, read_gold, run_batch
from bikenet.schema import MICRO_BATCH_INTERVAL
from bikenet.session import get_spark
from bikenet.sources.feeds import (
    read_station_info, read_status_snapshots, read_status_stream_kafka,
)
from bikenet.sources.geo import read_neighborhoods
from bikenet.sources.landing import ingest_archives
from bikenet.sources.layers import read_scores, read_status_layer
from bikenet.streaming.lag import follow, read_reports, stored_lag
from bikenet.streaming.status import build_status_stream, start_message_job, start_status_sink


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="bikenet", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    ingest = commands.add_parser("ingest", help="unpack archives into the raw area")
    ingest.add_argument("archives")
    ingest.add_argument("raw")
    ingest.add_argument("--start-year", type=int, required=True)
    ingest.add_argument("--end-year", type=int, required=True)

    validate = commands.add_parser("validate", help="report on raw CSV files")
    validate.add_argument("path")

    batch = commands.add_parser("batch", help="build the layers")
    batch.add_argument("root")
    batch.add_argument("--yyyymm")
    batch.add_argument("--stage", choices=[*STAGES, "all"], nargs="+", default=["all"])
    for name in ("archives", "station-info", "neighborhoods", "scores"):
        batch.add_argument(f"--{name}")

    query = commands.add_parser("query", help="write the result of serving queries as CSV")
    query.add_argument("name", choices=sorted(QUERIES), nargs="+")
    query.add_argument("--gold")
    query.add_argument("--status")
    query.add_argument("--scores")
    query.add_argument("--station-info", help="with --polygons, assigns stations to neighborhoods")
    query.add_argument("--polygons")
    query.add_argument("--output", required=True)

    publish = commands.add_parser("publish", help="turn status documents into messages")
    publish.add_argument("feed", help="folder that status documents are put into")
    publish.add_argument("--checkpoint", required=True)
    publish.add_argument("--path", help="write text files here instead of a topic")
    publish.add_argument("--servers")
    publish.add_argument("--topic")
    publish.add_argument("--once", action="store_true", help="work off what is there and stop")

    stream = commands.add_parser("stream", help="append the status topic to the status layer")
    for name in ("servers", "topic", "layer", "checkpoint"):
        stream.add_argument(f"--{name}", required=True)
    stream.add_argument("--interval", default=MICRO_BATCH_INTERVAL)
    stream.add_argument("--log", help="folder of progress reports, by default beside the checkpoint")

    health = commands.add_parser("health", help="freshness, empty stations and lag of the status layer")
    health.add_argument("layer")
    health.add_argument("--lookback-minutes", type=int, default=15)
    health.add_argument("--log", help="folder of progress reports of the stream, adds its lag to the checks")
    health.add_argument("--topic")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    return _COMMANDS[args.command](spark or get_spark(f"bikenet-{args.command}"), args)


def _ingest(spark: SparkSession, args) -> int:
    states = ingest_archives(spark, args.archives, args.raw, args.start_year, args.end_year).collect()
    months = sorted({row["yyyymm"] for row in states if row["state"] == "landed"})
    print(f"{len(months)} months landed: {', '.join(months)}")
    for row in sorted(states, key=lambda r: (r["archive"], r["path"] or "", r["member"] or "")):
        if row["state"] != "landed":
            print(" ".join(filter(None, (row["archive"], row["state"], row["path"], row["member"], row["reason"]))))
    return 0 if months else 1


def _validate(spark: SparkSession, args) -> int:
    reports = validate_csv(spark, args.path).collect()
    for report in reports:
        print(report.asDict())
    return 0 if all(report["is_valid"] for report in reports) else 1


def _batch(spark: SparkSession, args) -> int:
    inputs = {
        name: getattr(args, name)
        for name in ("archives", "station_info", "neighborhoods", "scores")
    }
    stages = args.stage
    if "all" in stages:
        stages = ("bronze", "silver", "gold")
    run_batch(spark, LayerPaths.below(args.root, **inputs), args.yyyymm, stages)
    return 0


def _query(spark: SparkSession, args) -> int:
    tables = Tables(
        **(read_gold(spark, args.gold) if args.gold else {}),
        status=read_status_layer(spark, args.status) if args.status else None,
        scores=read_scores(spark, args.scores) if args.scores else None,
        stations=join_stations_to_neighborhoods(
            read_station_info(spark, args.station_info), read_neighborhoods(spark, args.polygons),
        ) if args.station_info and args.polygons else None,
    )
    written = run_analytics(tables, args.output, tuple(args.name))
    for name, path in written.items():
        print(f"{name}: {path}")
    return 0 if len(written) == len(args.name) else 1


def _publish(spark: SparkSession, args) -> int:
    if not args.path and not (args.servers and args.topic):
        print("publish needs --path, or --servers and --topic")
        return 1
    snapshots = read_status_snapshots(spark, args.feed, streaming=True)
    job = start_message_job(
        snapshots, args.checkpoint, args.path, args.servers, args.topic, once=args.once)
    job.awaitTermination()
    return 0


def _stream(spark: SparkSession, args) -> int:
    records = read_status_stream_kafka(spark, args.servers, args.topic)
    job = start_status_sink(
        build_status_stream(records), args.layer, args.checkpoint, args.interval,
    )
    follow(job, args.log or f"{args.checkpoint.rstrip('/')}-reports")
    return 0


def _health(spark: SparkSession, args) -> int:
    status = current_station_availability(
        read_status_layer(spark, args.layer), args.lookback_minutes,
    )
    lag = stored_lag(read_reports(spark, args.log), args.topic) if args.log else None
    checks = health_report(file_freshness(spark, args.layer), status, lag).collect()
    for check in checks:
        print(check.asDict())
    return 0 if all(check["ok"] for check in checks) else 1


_COMMANDS = {
    "ingest": _ingest, "validate": _validate, "batch": _batch, "query": _query,
    "publish": _publish, "stream": _stream, "health": _health,
}

if __name__ == "__main__":
    sys.exit(main())
