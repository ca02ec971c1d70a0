"""Guarded ratios, shares and the score formula."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bikenet.schema import EBIKE_DOMINANCE


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double; NULL for a zero or missing denominator."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    """``100 * part / whole`` as double, rounded half up when ``digits`` is given."""
    value = F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))
    return value if digits is None else F.round(value, digits)


def percent_even(part: Column, whole: Column, digits: int) -> Column:
    """As :func:`percent`, rounded half to even like the dashboard figures."""
    return F.bround(percent(part, whole), digits)


def flag_sum(condition: Column) -> Column:
    """Number of rows for which ``condition`` holds; 0 rather than NULL for an empty group."""
    return F.count_if(condition)


def dominance(ebike_share: Column, threshold: float = EBIKE_DOMINANCE) -> Column:
    """Vehicle type that dominates a station; an unknown share counts as classic."""
    electric = F.coalesce(ebike_share, F.lit(0.0)) >= threshold
    return F.when(electric, "electric_bike").otherwise("classic_bike")


def accessibility(station_count: Column, area_km2: Column, avg_daily_trips: Column) -> Column:
    """Station density damped by the logarithm of daily use, four digits, half to even."""
    return F.bround(ratio(station_count, area_km2) * F.log1p(avg_daily_trips), 4)
