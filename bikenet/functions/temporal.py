"""Time-of-trip features and day labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bikenet.schema import DAY_NAMES, WEEKEND_DAYS


def whole_seconds(start: Column, end: Column) -> Column:
    """Seconds between two instants, each cut to the full second; negative when reversed."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMM")


def previous_month(day: Column) -> Column:
    return F.date_format(F.add_months(day, -1), "yyyyMM")


def day_name(day_of_week: Column) -> Column:
    """Short day name of a 1 = Sunday day number; NULL for any other number."""
    pairs = [F.lit(v) for item in DAY_NAMES.items() for v in item]
    return F.try_element_at(F.create_map(*pairs), day_of_week.cast("int"))


def monday_first(day_of_week: Column) -> Column:
    """Sort key 0..6 that puts Monday first and Sunday last."""
    return (day_of_week + 5) % 7


def day_type(day_of_week: Column) -> Column:
    return F.when(day_of_week.isin(*WEEKEND_DAYS), "Weekend").otherwise("Weekday")


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes from ``start`` to ``end`` as double, with fractions."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return micros.cast("double") / F.lit(60_000_000.0)


def minutes_before(instant: Column, minutes: int) -> Column:
    return instant - F.make_dt_interval(mins=F.lit(minutes))
