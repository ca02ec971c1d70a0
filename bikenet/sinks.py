"""Writers of the layers and of query results.

Silver and gold rows come out of a shuffle on other keys, so every task holds rows of every month
or day. A rebalance on the partition column before the write lets adaptive execution split large
months over several tasks and gather small ones: no slow task, no file per task and month. Bronze
rows come straight from month-wise files and are written without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bikenet.functions.wkb import COLUMN_METADATA, to_wkb


def _write(df: DataFrame, path: str, partition: str | None) -> None:
    writer = df.write.mode("overwrite")
    if partition:
        writer = writer.partitionBy(partition)
    writer.parquet(path)


def rebalanced(df: DataFrame, partition: str | None) -> DataFrame:
    return df.hint("rebalance", partition) if partition else df


def write_bronze(df: DataFrame, path: str, yyyymm: str | None = None) -> None:
    """Replace exactly the directory of month ``yyyymm``, or without it the whole table.

    Months derived from the data need the whole table: a few strays of another month must not
    replace that month's directory.
    """
    if yyyymm is None:
        _write(df, path, "year_month")
    else:
        _write(df.drop("year_month"), f"{path}/year_month={yyyymm}", None)


def write_silver(df: DataFrame, path: str, months: list[str] | None = None) -> None:
    """Replace the whole table, or exactly the ``months`` given, also those left without rows."""
    if months is None:
        _write(rebalanced(df, "year_month"), path, "year_month")
        return
    for month in months:
        write_month(df.where(F.col("year_month") == month).hint("rebalance"), path, month)


def write_month(df: DataFrame, path: str, month: str) -> None:
    """Replace exactly one month's directory of a table."""
    _write(df.drop("year_month"), f"{path}/year_month={month}", None)


def write_gold(df: DataFrame, path: str, partition_col: str | None = None, only_those: bool = False) -> None:
    """Replace the whole table, or with ``only_those`` the partitions that have rows in ``df``."""
    if only_those:
        (rebalanced(df, partition_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition_col).parquet(path))
        return
    _write(rebalanced(df, partition_col), path, partition_col)


def write_result_csv(df: DataFrame, path: str) -> str:
    """A query result as one CSV file with a header; for top-k and summary results only."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_geo_scores(geo: DataFrame, path: str) -> None:
    """The score table with its polygons in well-known binary, which geometry tools read.

    What GeoParquet tells of the column in the file's footer is in the column's metadata, since
    Spark's writer takes no keys of others.
    """
    binary = to_wkb(F.col("geometry")).alias("geometry", metadata=COLUMN_METADATA)
    geo.select(*(binary if c == "geometry" else F.col(f"`{c}`") for c in geo.columns)).write.mode(
        "overwrite").parquet(path)


def message_values(messages: DataFrame) -> DataFrame:
    """One JSON document per row in the ``value`` column a message sink expects."""
    return messages.select(F.to_json(F.struct("*")).alias("value"))


def write_status_messages(
    messages: DataFrame, path: str | None = None, servers: str | None = None,
    topic: str | None = None,
) -> None:
    """Send messages to a Kafka topic, or append them as text lines below ``path``."""
    values = message_values(messages)
    if topic:
        (
            values.write.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("kafka.acks", "all").option("topic", topic).save()
        )
    else:
        values.write.mode("append").text(path)
