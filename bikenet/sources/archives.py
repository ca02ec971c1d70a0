"""Month manifest, zipped trip archives and the raw landing area."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bikenet.sources.files import FILE_COLUMN, list_files, open_file, spread

ARCHIVE_SUFFIX = "-tripdata.zip"
LAST_ANNUAL_YEAR = 2023
LINES_PER_BATCH = 20_000

_MEMBERS = "archive string, member string"
_LINES = "archive string, member string, line_no long, line string"


def archive_name(yyyymm: Column, suffix: str = ARCHIVE_SUFFIX) -> Column:
    """Archives are yearly up to 2023 and monthly from 2024 on."""
    year = F.substring(yyyymm, 1, 4)
    yearly = year.cast("int") <= LAST_ANNUAL_YEAR
    return F.concat(F.when(yearly, year).otherwise(yyyymm), F.lit(suffix))


def months_between(first: Column, last: Column) -> Column:
    """Array of ``yyyyMM`` keys from the month of ``first`` to the month of ``last``."""
    start, end = F.trunc(first, "month"), F.trunc(last, "month")
    days = F.sequence(start, end, F.make_ym_interval(months=F.lit(1)))
    return F.transform(days, lambda d: F.date_format(d, "yyyyMM"))


def month_manifest(
    spark: SparkSession, start_year: int, end_year: int, suffix: str = ARCHIVE_SUFFIX,
) -> DataFrame:
    """One row per month of the years given: ``yyyymm`` and the ``archive`` that holds it."""
    span = spark.range(1).select(
        F.explode(months_between(
            F.make_date(F.lit(start_year), F.lit(1), F.lit(1)),
            F.make_date(F.lit(end_year), F.lit(12), F.lit(1)),
        )).alias("yyyymm"),
    )
    return span.withColumn("archive", archive_name(F.col("yyyymm"), suffix))


def archives_to_fetch(manifest: DataFrame) -> DataFrame:
    """Each archive once, though a yearly one serves twelve months."""
    return manifest.select("archive").distinct()


def list_members(
    archives: DataFrame, mode: str = "all", skip_broken: bool = False,
) -> DataFrame:
    """CSV members of each archive: the first one or all of them. ``archives`` has ``path``.

    An archive that is damaged or holds no CSV file is an error. With ``skip_broken`` it is left
    out instead, which takes reading it once to check it before any line is passed on.
    """
    if mode not in ("first", "all"):
        raise ValueError(f"mode must be 'first' or 'all', not {mode!r}")

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                try:
                    names = csv_members(path, check=skip_broken)
                except (ValueError, zipfile.BadZipFile, zlib.error):
                    if not skip_broken:
                        raise
                    continue
                kept = names[:1] if mode == "first" else names
                yield pd.DataFrame({"archive": path, "member": kept})

    return spread(archives.select("path")).mapInPandas(members, _MEMBERS)


def read_members(members: DataFrame) -> DataFrame:
    """Lines of each member, unpacked as a stream so that no member is held in memory.

    Members are spread over the cluster one by one; the tasks read only the byte ranges they need.
    """
    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, member in zip(batch["archive"], batch["member"], strict=True):
                with open_file(path) as stream, zipfile.ZipFile(stream) as archive:
                    with archive.open(member) as raw:
                        yield from _line_batches(path, member, raw)

    return spread(members).mapInPandas(lines, _LINES)


def list_archives(spark: SparkSession, path: str) -> DataFrame:
    """Paths of the zip files below ``path``; archive contents are not read."""
    return list_files(spark, path, "*.zip").select(F.col(FILE_COLUMN).alias("path"))


def read_zipped_trips(
    spark: SparkSession, path: str, mode: str = "all", skip_broken: bool = False,
) -> DataFrame:
    """``archive, member, line_no, line`` of the CSV members of the zip files at ``path``."""
    return read_members(list_members(list_archives(spark, path), mode, skip_broken))


def member_month(member: Column, archive: Column) -> Column:
    """Month key: first six digits in a row of the member's name, else of the archive's."""
    of_member = F.regexp_extract(F.substring_index(member, "/", -1), r"(\d{6})", 1)
    of_archive = F.regexp_extract(F.substring_index(archive, "/", -1), r"(\d{6})", 1)
    key = F.when(of_member != "", of_member).otherwise(of_archive)
    return F.when(key != "", key)


def land_raw(lines: DataFrame, root: str) -> DataFrame:
    """Write member lines by month, archive and member, and list the months present at ``root``.

    A member's lines are all in one task; sorting by line number there keeps its header in front
    of its one file. A member without a month is an error, and nothing lands. A checksum of the path tells archives of the same name apart.
    """
    name = F.substring_index("archive", "/", -1)
    nameless = F.raise_error(F.concat(F.lit("no month in the name of "), "member", F.lit(" in "), "archive"))
    folders = ("yyyymm", "archive", "member")
    (
        lines.withColumns({
            "yyyymm": F.coalesce(member_month(F.col("member"), F.col("archive")), nameless),
            "archive": F.concat_ws("-", name, F.hex(F.crc32(F.col("archive").cast("binary")))),
            "member": F.replace("member", F.lit("/"), F.lit("__")),
        })
        .sortWithinPartitions(*folders, "line_no")
        .select(*folders, F.col("line").alias("value"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders).text(root)
    )
    return landed_months(lines.sparkSession, root)


def landed_months(spark: SparkSession, root: str) -> DataFrame:
    """Months with at least one file below ``root``; file listing only, no contents."""
    files = list_files(spark, root, "part-*")
    key = F.regexp_extract(FILE_COLUMN, r"yyyymm=(\d{6})", 1)
    return files.select(key.alias("yyyymm")).where(F.col("yyyymm") != "").distinct()


def wanted_archives(
    spark: SparkSession, archive_path: str, start_year: int, end_year: int,
    suffix: str | None = None, months: list[str] | None = None,
) -> DataFrame:
    """``archive, yearly, path`` of the archives of the years (or months) given; no path: absent.

    ``archive`` are the four or six digits that the file's name begins with.
    """
    manifest = month_manifest(spark, start_year, end_year, "")
    asked = manifest if months is None else manifest.where(F.col("yyyymm").isin(months))
    name = F.substring_index("path", "/", -1)
    expected = archives_to_fetch(asked).withColumn("yearly", F.length("archive") == 4)
    files = (
        list_archives(spark, archive_path).where(name.endswith((suffix or ARCHIVE_SUFFIX).rsplit("-", 1)[-1]))
        .withColumn("archive", F.regexp_extract(name, r"^(\d{6}|\d{4})(?!\d)", 1))
    )
    return expected.join(files, "archive", "left")


def missing_months(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Months of the manifest without landed data."""
    return manifest.join(landed, "yyyymm", "left_anti")


def csv_members(path: str, check: bool = False) -> list[str]:
    """Names of an archive's CSV files; none, or with ``check`` a damaged one, is an error."""
    with open_file(path) as stream, zipfile.ZipFile(stream) as archive:
        names = [
            n for n in archive.namelist()
            if n.lower().endswith(".csv") and not n.startswith("__MACOSX")
        ]
        if check and (damaged := archive.testzip()):
            raise zipfile.BadZipFile(f"damaged member {damaged} in {path}")
    if not names:
        raise ValueError(f"no CSV files in archive {path}")
    return names


def _line_batches(path: str, member: str, raw) -> Iterator[pd.DataFrame]:
    text = io.TextIOWrapper(raw, encoding="utf-8-sig", errors="replace", newline=None)
    chunk: list[str] = []
    start = 0
    for line in text:
        chunk.append(line.rstrip("\n"))
        if len(chunk) == LINES_PER_BATCH:
            yield _frame(path, member, start, chunk)
            start += len(chunk)
            chunk = []
    if chunk:
        yield _frame(path, member, start, chunk)


def _frame(path: str, member: str, start: int, lines: list[str]) -> pd.DataFrame:
    return pd.DataFrame({
        "archive": path, "member": member,
        "line_no": range(start, start + len(lines)), "line": lines,
    })
