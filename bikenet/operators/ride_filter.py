"""Stored Bloom filters of ride ids, one a month, as a table.

An id falls into one block of eight words and sets one bit in each. A month's filter is the ``bit_or`` of its
ids, block by block; whether an id may be in a month is a join on the block and eight bit tests. Filters have as
many blocks as it takes for at most eight ids a block on average: about one id in ten million passes wrongly, and
none is ever missed. The number of blocks is a power of two, so ids are looked up once for each size in use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
IDS_PER_BLOCK = 8


def _block(ride_id: Column, size: Column) -> Column:
    return F.xxhash64(ride_id).bitwiseAND(size - 1)


def _bits(ride_id: Column) -> list[Column]:
    """The bit of each word: six bits of a second hash."""
    mixed = F.xxhash64(ride_id, F.lit("bits"))
    places = [F.shiftright(mixed, 6 * k).bitwiseAND(63).cast("int") for k in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), place) for place in places]


def ride_filter(rides: DataFrame, key: str = "ride_id") -> DataFrame:
    """``(size, block, w0 .. w7)`` of the ids of one month; null ids take no part."""
    ids = rides.select(F.col(key).alias("id")).where("id IS NOT NULL")
    wanted = F.greatest(F.ceil(F.log2(F.greatest(F.count("*"), F.lit(1)) / IDS_PER_BLOCK)), F.lit(0)).cast("int")
    blocks = 1 << ids.agg(wanted).first()[0]
    words = [F.bit_or(bit).alias(f"w{k}") for k, bit in enumerate(_bits(F.col("id")))]
    return (
        ids.groupBy(_block(F.col("id"), F.lit(blocks).cast("bigint")).alias("block")).agg(*words)
        .select(F.lit(blocks).cast("bigint").alias("size"), "block", *(f"w{k}" for k in range(WORDS)))
    )


def may_be_in(rides: DataFrame, filters: DataFrame, key: str = "ride_id") -> DataFrame:
    """``(ride_id, year_month)``: the months of ``filters`` that may hold each id of ``rides``."""
    sizes = [row["size"] for row in filters.select("size").distinct().collect()]
    ids = rides.select(F.col(key).alias("ride_id")).where("ride_id IS NOT NULL").distinct()
    asked = ids.select("ride_id", F.explode(F.array(*[F.lit(s).cast("bigint") for s in sizes]) if sizes else F.array().cast("array<bigint>")).alias("size"))
    asked = asked.select("*", _block(F.col("ride_id"), F.col("size")).alias("block"))
    held = F.lit(True)
    for k, bit in enumerate(_bits(F.col("ride_id"))):
        held = held & (F.col(f"w{k}").bitwiseAND(bit) != 0)
    return asked.join(filters, ["size", "block"]).where(held).select("ride_id", "year_month")
