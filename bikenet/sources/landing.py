"""Landing of archive members in two phases, byte for byte.

1. *Stage.* Each member is copied in blocks to a name of its own below ``_landing/<run>/staged``; the archive's
   checksum is tested on the way, so a member is unpacked once. What came of it is a row, and the rows are
   written as a table: of several attempts of a task only the one whose rows were committed counts.
2. *Publish.* The staged files of that table are renamed into place. A rename is repeated safely, so tasks may
   be lost and run again. Nothing of an archive is published if one of its members is damaged.

The table with the final states stays below ``_landing/<run>``; readers of the raw area skip that folder.
"""

from __future__ import annotations

import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikenet.sources.archives import csv_members, list_archives, member_month, wanted_archives
from bikenet.sources.files import locate, open_file, spread

BLOCK_BYTES = 1 << 20
FOLDER = "_landing"
#: What a damaged, encrypted or oddly packed member raises.
DAMAGE = (ValueError, zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError)

_LISTED = "archive string, path string, member string, reason string"
_STAGED = "archive string, path string, member string, yyyymm string, state string, reason string, bytes long, crc32 long, staged string, target string"


def list_contents(wanted: DataFrame, monthly_mode: str = "all") -> DataFrame:
    """``archive, path, member, reason``: the members to land; an archive that can't be opened has a reason instead."""
    if monthly_mode not in ("first", "all"):
        raise ValueError(f"mode must be 'first' or 'all', not {monthly_mode!r}")

    def contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, path, yearly in zip(batch["archive"], batch["path"], batch["yearly"], strict=True):
                members, reason = [None], None
                try:
                    members = csv_members(path)
                    members = members if yearly or monthly_mode == "all" else members[:1]
                except DAMAGE as error:
                    reason = str(error)
                yield pd.DataFrame({"archive": archive, "path": path, "member": pd.Series(members, dtype="object"), "reason": reason})

    return spread(wanted.select("archive", "path", "yearly")).mapInPandas(contents, _LISTED)


def copy_member(path: str, member: str, target: str) -> tuple[int, int]:
    """Unpack one member into the file ``target``; its size and checksum. A wrong checksum is an error."""
    size = checksum = 0
    system, inner = locate(target)
    system.create_dir(inner.rsplit("/", 1)[0])
    with open_file(path) as stream, zipfile.ZipFile(stream) as archive, archive.open(member) as source:
        with system.open_output_stream(inner) as out:
            while block := source.read(BLOCK_BYTES):
                out.write(block)
                size += len(block)
                checksum = zlib.crc32(block, checksum)
    return size, checksum


def stage(contents: DataFrame, raw: str, run: str) -> DataFrame:
    """Copy the members listed and record each: staged, broken, or rejected for want of a month."""
    staging = f"{_run_folder(raw, run)}/staged"

    def copies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                row |= {"state": "broken", "bytes": None, "crc32": None, "staged": None}
                if row["reason"] is None and row["yyyymm"] is None:
                    row |= {"state": "rejected", "reason": f"no month in the name of {row['member']}"}
                elif row["reason"] is None:
                    target = f"{staging}/{uuid.uuid4().hex}"
                    try:
                        size, checksum = copy_member(row["path"], row["member"], target)
                        row |= {"state": "staged", "bytes": size, "crc32": checksum, "staged": target}
                    except DAMAGE as error:
                        row["reason"] = str(error)
                yield pd.DataFrame([row], columns=_names(_STAGED))

    name = F.substring_index("path", "/", -1)
    folder = F.concat_ws("-", name, F.hex(F.crc32(F.col("path").cast("binary"))))  # archives of one name stay apart
    placed = contents.withColumns({
        "yyyymm": member_month(F.col("member"), F.col("path")),
        "target": F.concat(F.lit(f"{raw.rstrip('/')}/yyyymm="), member_month(F.col("member"), F.col("path")),
                           F.lit("/archive="), _folder_name(folder), F.lit("/member="), _folder_name(F.col("member")),
                           F.lit("/part-00000.csv")),
    })
    path = f"{_run_folder(raw, run)}/members"
    spread(placed).mapInPandas(copies, _STAGED).write.parquet(path)
    return contents.sparkSession.read.schema(_STAGED).parquet(path)


def publish(staged: DataFrame, raw: str, run: str) -> DataFrame:
    """Rename what was staged into place, and record the final state of every member.

    Members of an archive with a damaged one are withheld. Returns the table of states.
    """
    damaged = staged.where("state = 'broken'").select("path").distinct().withColumn("withheld", F.lit(True))
    judged = staged.join(damaged, "path", "left").withColumns({
        "reason": F.when(F.col("withheld") & (F.col("state") == "staged"), "another member is damaged").otherwise(F.col("reason")),
        "state": F.when(F.col("withheld") & (F.col("state") == "staged"), "withheld").otherwise(F.col("state")),
    }).select(*_names(_STAGED))

    def moves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                _rename(row["staged"], row["target"], int(row["bytes"]))
            yield batch.assign(state="landed")

    landed = spread(judged.where("state = 'staged'")).mapInPandas(moves, _STAGED)
    path = f"{_run_folder(raw, run)}/states"
    landed.unionByName(judged.where("state <> 'staged'")).drop("staged").write.parquet(path)
    system, inner = locate(f"{_run_folder(raw, run)}/staged")
    if system.get_file_info(inner).is_file is False and system.get_file_info(inner).type.name == "Directory":
        system.delete_dir(inner)  # copies of lost attempts and of withheld archives
    return staged.sparkSession.read.parquet(path)


def land(spark: SparkSession, wanted: DataFrame, raw: str, monthly_mode: str = "all") -> DataFrame:
    """Land the archives of ``wanted (archive, yearly, path)``; a row per member, or per archive absent or unreadable.

    Columns: ``archive, path, member, yyyymm, state, reason, bytes, crc32, target``; states are landed, broken,
    withheld (another member of the archive is broken), rejected (no month) and absent.
    """
    run = uuid.uuid4().hex
    contents = list_contents(wanted.where("path IS NOT NULL"), monthly_mode)
    states = publish(stage(contents, raw, run), raw, run)
    absent = wanted.where("path IS NULL").select("archive", F.lit("absent").alias("state"))
    return states.unionByName(absent, allowMissingColumns=True)


def ingest_archives(
    spark: SparkSession, archive_path: str, raw: str, start_year: int, end_year: int,
    suffix: str | None = None, monthly_mode: str = "all", months: list[str] | None = None,
) -> DataFrame:
    """Land the archives of the years given, or of ``months`` only; the states as :func:`land` tells them.

    Archives are known by the four or six digits that their names begin with, so a brand between those
    and the ending makes no difference. A yearly archive is read once.
    """
    return land(spark, wanted_archives(spark, archive_path, start_year, end_year, suffix, months), raw, monthly_mode)


def ingest_range(
    spark: SparkSession, archive_path: str, raw: str, start_year: int, end_year: int,
    suffix: str | None = None, monthly_mode: str = "all", months: list[str] | None = None,
) -> DataFrame:
    """As :func:`ingest_archives`, telling the months of the years given of which something landed."""
    states = ingest_archives(spark, archive_path, raw, start_year, end_year, suffix, monthly_mode, months)
    within = F.substring("yyyymm", 1, 4).cast("int").between(start_year, end_year)
    return states.where((F.col("state") == "landed") & within).select("yyyymm").distinct()


def land_all(spark: SparkSession, archive_path: str, raw: str) -> DataFrame:
    """Land every archive below a folder, whatever its name."""
    every = list_archives(spark, archive_path).select(
        F.substring_index("path", "/", -1).alias("archive"), F.lit(True).alias("yearly"), "path")
    return land(spark, every, raw)


def last_states(spark: SparkSession, raw: str) -> DataFrame:
    """The states of all runs so far below ``raw``, with the run of each."""
    return (
        spark.read.option("basePath", raw).parquet(f"{raw.rstrip('/')}/{FOLDER}/*/states")
        .withColumn("run", F.regexp_extract("_metadata.file_path", rf"/{FOLDER}/([0-9a-f]+)/", 1))
    )


def _run_folder(raw: str, run: str) -> str:
    return f"{raw.rstrip('/')}/{FOLDER}/{run}"


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _folder_name(name) -> F.Column:
    return F.replace(F.url_encode(F.replace(name, F.lit("/"), F.lit("__"))), F.lit("+"), F.lit(" "))


def _rename(staged: str, target: str, size: int) -> None:
    """Move a file into place; done before counts as done."""
    system, source = locate(staged)
    place = locate(target)[1]
    there, new = system.get_file_info([place, source])
    if not new.is_file:
        if there.is_file and there.size == size:
            return
        raise FileNotFoundError(f"{staged} is gone and {target} is not it")
    folder = place.rsplit("/", 1)[0]
    system.create_dir(folder)
    system.delete_dir_contents(folder)  # what an earlier landing wrote here, in whatever files
    system.move(source, place)
