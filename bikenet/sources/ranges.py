"""Objects inside large JSON documents, read by byte ranges.

Whether a brace counts depends on all that stands before it: it may lie in a string, and its depth is
the number of brackets still open. Both are sums. A first pass reads each range but the last of a file
and counts its quotes and, for either state it may begin in, the brackets it opens less those it
closes; running sums over the thin rows of a file tell the state in which each range begins. A second
pass cuts out the objects that begin in a range, reading on behind its end until the last of them is
closed. Files of one range, and compressed ones, are read once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bikenet.sources.files import open_file, plain_path, spread

BLOCK_BYTES = 4 << 20
#: Objects of about so many bytes leave a task at a time.
_BATCH_BYTES = 4 << 20
_PACKED = r"\.(gz|bz2|lz4|zst)$"
_QUOTE, _ESCAPE = 34, 92
_STEP = np.zeros(256, dtype=np.int8)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1


def nested_objects(spark: SparkSession, path: str, depth: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``value``: the text of every object of the JSON documents below ``path`` inside ``depth`` brackets.

    Documents are in UTF-8. A file cut off within an object loses that object only. Empty files give no row.
    """
    if block_bytes < 1:
        raise ValueError(f"a range has at least one byte, not {block_bytes}")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where(F.col("length") > 0)
    packed = plain_path().rlike(_PACKED)
    ranges = F.when(packed, F.lit(1)).otherwise(F.ceil(F.col("length") / block_bytes))
    blocks = files.select(
        plain_path().alias("file"), F.explode(F.sequence(F.lit(1), ranges)).alias("block"), ranges.alias("blocks"))
    blocks = blocks.select(
        "file", ((F.col("block") - 1) * block_bytes).alias("begin"), (F.col("block") == F.col("blocks")).alias("last"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [_sums(row["file"], row["begin"], block_bytes) if not row["last"] else (0, 0, 0)
                    for row in batch.to_pylist()]
            columns = [pa.array([s[k] for s in sums], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "quotes", "outside", "inside"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                size = None if row["last"] else block_bytes
                found = _objects(row["file"], row["begin"], size, bool(row["quoted"]), row["open"], depth)
                for values in _gathered(found):
                    yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["value"])

    before = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    counted = spread(blocks).mapInArrow(
        count, "file string, begin bigint, last boolean, quotes bigint, outside bigint, inside bigint")
    begun = counted.withColumn("quoted", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    steps = F.when(F.col("quoted") == 0, F.col("outside")).otherwise(F.col("inside"))
    begun = begun.withColumn("step", steps).withColumn("open", F.coalesce(F.sum("step").over(before), F.lit(0)))
    return spread(begun.select("file", "begin", "last", "quoted", "open")).mapInArrow(cut, "value string")


def _marks(data: np.ndarray, slashes: int) -> np.ndarray:
    """Where a quote opens or closes a string; ``slashes`` backslashes stand right before ``data``."""
    quotes = np.flatnonzero(data == _QUOTE)
    marks = np.zeros(len(data), dtype=bool)
    marks[quotes] = True
    for at in quotes[data[quotes - 1] == _ESCAPE] if len(quotes) else ():
        run = at - 1
        while run >= 0 and data[run] == _ESCAPE:
            run -= 1
        marks[at] = (at - 1 - run + (slashes if run < 0 else 0)) % 2 == 0
    if len(quotes) and quotes[0] == 0:
        marks[0] = slashes % 2 == 0
    return marks


def _slashes_before(file, begin: int) -> int:
    """Backslashes that stand right before a place of a file."""
    count, end, step = 0, begin, 64
    while end > 0:
        start = max(0, end - step)
        data = file.read_at(end - start, start)
        own = len(data) - len(data.rstrip(b"\\"))
        count += own
        if own < len(data):
            break
        end, step = start, 2 * step
    return count


def _sums(path: str, begin: int, size: int) -> tuple[int, int, int]:
    """Quotes of a range, and its brackets' sum if it begins outside and if it begins inside a string."""
    with open_file(path) as file:
        data = np.frombuffer(file.read_at(size, begin), dtype=np.uint8)
        marks = _marks(data, _slashes_before(file, begin))
    steps, within = _STEP[data], np.bitwise_xor.accumulate(marks)
    inside = int(steps[within].sum(dtype=np.int64))
    return int(marks.sum()), int(steps.sum(dtype=np.int64)) - inside, inside


def _objects(path: str, begin: int, size: int | None, quoted: bool, depth: int, wanted: int) -> Iterator[bytes]:
    """Objects that begin in a range (without ``size`` in all that follows), each inside ``wanted`` brackets."""
    with open_file(path, stream=begin == 0 and size is None) as file:
        slashes = 0
        if begin:
            slashes = _slashes_before(file, begin)
            file.seek(begin)
        left = size
        pending: list[bytes] = []  # of the object that is open
        while left is None or left > 0 or pending:
            ours = left is None or left > 0
            block = file.read(BLOCK_BYTES if left is None or left <= 0 else min(left, BLOCK_BYTES))
            if not block:
                return
            data = np.frombuffer(block, dtype=np.uint8)
            marks = _marks(data, slashes)
            within = np.bitwise_xor.accumulate(marks) ^ quoted
            steps = np.where(within, 0, _STEP[data])
            level = depth + np.cumsum(steps, dtype=np.int64)
            starts = np.flatnonzero((steps == 1) & (level == wanted + 1) & (data == ord("{")))
            ends = np.flatnonzero((steps == -1) & (level == wanted) & (data == ord("}")))
            at = 0
            if pending:
                if not len(ends):
                    pending.append(block)
                else:
                    at = int(ends[0]) + 1
                    yield b"".join((*pending, block[:at]))
                    pending = []
            if ours and not pending:
                for start in starts[starts >= at]:
                    end = np.searchsorted(ends, start)
                    if end == len(ends):
                        pending = [block[start:]]
                        break
                    yield block[start : int(ends[end]) + 1]
            quoted, depth = bool(within[-1]), int(level[-1])
            tail = len(block) - len(block.rstrip(b"\\"))
            slashes = tail + (slashes if tail == len(block) else 0)
            left = None if left is None else left - len(block)


def _gathered(objects: Iterator[bytes]) -> Iterator[list[str]]:
    values, size = [], 0
    for one in objects:
        values.append(one.decode("utf-8", errors="replace"))
        size += len(one)
        if size >= _BATCH_BYTES:
            yield values
            values, size = [], 0
    if values:
        yield values
