"""Small fixtures shared by the tests."""

from __future__ import annotations

import io
import contextlib

from bikenet import schema as S

CURRENT_ROW = {
    "ride_id": "0", "rideable_type": "classic_bike",
    "started_at": "2023-01-01 08:00:00", "ended_at": "2023-01-01 08:15:00",
    "start_station_name": "Station A", "start_station_id": "S001",
    "end_station_name": "Station B", "end_station_id": "S002",
    "start_lat": "40.7128", "start_lng": "-74.0060", "end_lat": "40.7589", "end_lng": "-73.9851",
    "member_casual": "member",
}
LEGACY_ROW = {
    "tripduration": "900", "starttime": "2019-01-01 08:00:00", "stoptime": "2019-01-01 08:15:00",
    "start station id": "72", "start station name": "Station A",
    "start station latitude": "40.7696", "start station longitude": "-73.9936",
    "end station id": "79", "end station name": "Station B",
    "end station latitude": "40.7191", "end station longitude": "-74.0063",
    "bikeid": "14969", "usertype": "Subscriber", "birth year": "1969", "gender": "1",
}


def text_frame(spark, rows, columns):
    fields = ", ".join(f"`{c}` string" for c in columns)
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], fields)


def current(spark, *changes, columns=S.CURRENT_COLUMNS):
    rows = [{**CURRENT_ROW, "ride_id": str(i), **c} for i, c in enumerate(changes)]
    return text_frame(spark, rows, columns)


def legacy(spark, *changes):
    return text_frame(spark, [{**LEGACY_ROW, **c} for c in changes], list(LEGACY_ROW))


def csv_text(rows, columns, delimiter=","):
    lines = [delimiter.join(columns)]
    lines += [delimiter.join("" if r.get(c) is None else r[c] for c in columns) for r in rows]
    return "\n".join(lines) + "\n"


def plan_of(df, mode="formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()
