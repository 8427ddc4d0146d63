"""Helpers shared by the operators: texts as bytes, temporary names, row identity."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.packs import _bytes_of, bound_batches  # noqa: F401

#: The ASCII white space that separates words: \x20 and \x09-\x0D. bytes.split() uses the same set.
SPACES = b" \t\n\x0b\x0c\r"

#: Stands for a null id where ids are compared: such a row counts as the last one.
LAST_ID = 2**63 - 1


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(array: pa.Array) -> list[bytes]:
    """The rows of a string array as bytes; null becomes empty."""
    return [b or b"" for b in array.cast(pa.binary()).to_pylist()]


def blocks(rows: list[bytes], size: int) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of rows of about ``size`` bytes with their first index; a longer row stands alone."""
    begin, total = 0, 0
    for i, row in enumerate(rows):
        if total and total + len(row) > size:
            yield begin, rows[begin:i]
            begin, total = i, 0
        total += len(row)
    if begin < len(rows):
        yield begin, rows[begin:]


def structs(fields: dict[str, Iterable], types: dict[str, pa.DataType]) -> pa.StructArray:
    return pa.StructArray.from_arrays(
        [pa.array(fields[name], kind) for name, kind in types.items()], names=list(types)
    )


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def row_key(doc: str, key: str) -> list[Column]:
    """Two columns that name a (doc_id, text) row; rows that repeat share them."""
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias(doc),
        F.xxhash64("text").alias(key),
    ]
