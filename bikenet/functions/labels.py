"""Display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def vehicle_label(rideable_type: Column) -> Column:
    """``electric_bike`` -> ``Electric Bike``."""
    return F.initcap(F.replace(rideable_type, F.lit("_"), F.lit(" ")))


def short_station_name(name: Column) -> Column:
    """The part of a station name before the first ampersand."""
    return F.trim(F.split_part(name, F.lit("&"), F.lit(1)))
