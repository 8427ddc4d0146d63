"""Numbered text with a stored index, so that a slice reads only the bytes that hold it.

One pass counts the lines that begin in each byte range of each file. The table of these counts, a row
for some megabytes of text, says where every position is; later reads open only the ranges they
need. Lines end with a line feed; a carriage return before it is no part of the line. Paths are local
or of any file system that Arrow knows by its scheme.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.sources.document_files import located
from millrace.storage import materialize

RANGE_BYTES = 32 << 20
_READ = 1 << 20
_LINES = 8192
_RANGE = "source int, path string, begin long, end long"


def _ranges(spark: SparkSession, paths: Sequence[str], size: int) -> DataFrame:
    """Byte ranges of the files of each source; the listing is Spark's and reads no content."""
    files = None
    for i, path in enumerate(paths):
        listed = spark.read.format("binaryFile").load(path).select(F.lit(i).alias("source"), "path", "length")
        files = listed if files is None else files.union(listed)
    begins = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))
    cut = files.filter("length > 0").select("source", "path", "length", F.explode(begins).alias("begin"))
    return cut.select("source", "path", "begin", F.least(F.col("begin") + size, F.col("length")).alias("end"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = []
        for row in batch.to_pylist():
            where, name = located(row["path"])
            with where.open_input_file(name) as file:
                # a line begins at 0 and behind every line feed
                at, found = max(0, row["begin"] - 1), int(row["begin"] == 0)
                file.seek(at)
                while at < row["end"] - 1:
                    part = file.read(min(_READ, row["end"] - 1 - at))
                    found += part.count(b"\n")
                    at += len(part)
            lines.append(found)
        yield batch.append_column("lines", pa.array(lines, pa.int64()))


def index_lines(spark: SparkSession, paths: str | Sequence[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``source, path, begin, end, lines, first``: a stored row for each byte range; one pass over the text.

    ``first`` is the 0-based position of the first line that begins in the range. ``paths`` is one
    file or directory (its files in name order), or a list of them in the order that counts.
    """
    listed = [paths] if isinstance(paths, str) else list(paths)
    ranges = _ranges(spark, listed, range_bytes).repartition("path", "begin")
    counted = materialize(ranges.mapInArrow(_count, f"{_RANGE}, lines long"), "line-counts")
    earlier = W.orderBy("source", "path", "begin").rowsBetween(W.unboundedPreceding, -1)
    first = F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("first")
    return materialize(counted.select("*", first), "line-index")


def _lines(data: Iterator[bytes]) -> Iterator[bytes]:
    """Lines of a byte stream, without their ends."""
    left = b""
    for part in data:
        *whole, left = (left + part).split(b"\n")
        yield from whole
    if left:
        yield left


def ranges_of(index: DataFrame, start: int, stop: int) -> DataFrame:
    """The rows of the index whose lines are among positions ``start`` to ``stop`` (exclusive)."""
    return index.filter((F.col("first") < stop) & (F.col("first") + F.col("lines") > start))


def read_positions(index: DataFrame, start: int, stop: int) -> DataFrame:
    """``(pos, value)`` of the lines at positions ``start`` to ``stop`` (exclusive).

    Only the byte ranges that hold them are read, each to the end of its last line.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                where, name = located(row["path"])
                with where.open_input_file(name) as file:
                    yield from _numbered(file, row, start, stop)

    # a task for each range
    wanted = ranges_of(index, start, stop).repartition("path", "begin")
    return wanted.select("path", "begin", "end", "lines", "first").mapInArrow(read, "pos long, value string")


def _numbered(file: pa.NativeFile, row: dict, start: int, stop: int) -> Iterator[pa.RecordBatch]:
    file.seek(max(0, row["begin"] - 1))
    lines = _lines(iter(lambda: file.read(_READ), b""))
    if row["begin"]:  # what is left of a line that began before, or just its line feed
        next(lines, None)
    pos, last = row["first"], min(stop, row["first"] + row["lines"])
    held: list[bytes] = []
    for line in lines:
        if pos >= last:
            break
        if pos >= start:
            held.append(line.removesuffix(b"\r"))
        pos += 1
        if len(held) == _LINES:
            yield _batch(pos, held)
            held = []
    if held:
        yield _batch(pos, held)


def _batch(end: int, lines: list[bytes]) -> pa.RecordBatch:
    numbers = pa.array(range(end - len(lines), end), pa.int64())
    return pa.RecordBatch.from_pydict({"pos": numbers, "value": pa.array(lines, pa.binary()).cast(pa.string())})
