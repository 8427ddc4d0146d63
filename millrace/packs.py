"""Many rows as one binary value, so that a shuffle which copies rows moves a few bytes for each; the size of batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import SparkSession

#: Rows that a task gathers before it packs them.
ROWS = 1 << 20

#: Bytes of one batch of rows between a task and its Python worker.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Keep what tasks exchange with Python to a few megabytes at a time, however long texts are.

    The session's own setting stays if it is as small. A larger one is lowered for good: results are
    computed later, when the setting must still hold, so only the application can restore it.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < _bytes_of(spark.conf.get(name)) <= BATCH_BYTES:
        spark.conf.set(name, BATCH_BYTES)


def _bytes_of(setting: str) -> int:
    """A size setting in bytes; Spark takes units of powers of 1024, as in ``4m`` or ``1gb``."""
    found = re.fullmatch(r"\s*(-?\d+)\s*([kmgtp]?)i?b?\s*", setting.lower())
    return int(found[1]) << 10 * " kmgtp".index(found[2] or " ") if found else 0

def pack(rows: pa.Table) -> bytes:
    """Rows as a small Parquet file: integers as differences, other values by a dictionary."""
    whole = [f.name for f in rows.schema if pa.types.is_integer(f.type)]
    sink = pa.BufferOutputStream()
    pq.write_table(
        rows, sink, compression="zstd", write_statistics=False,
        use_dictionary=[c for c in rows.column_names if c not in whole],
        column_encoding=dict.fromkeys(whole, "DELTA_BINARY_PACKED") or None,
    )
    return sink.getvalue().to_pybytes()


def unpack(value: pa.Scalar) -> pa.Table:
    return pq.read_table(pa.BufferReader(value.as_buffer()), use_threads=False)


def gathered(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The rows of all batches, in tables of about ``most`` rows."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= most:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held)


def encoded(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """The rows as places among the different values, in as few bytes as hold them, and the values as they first occur."""
    found = column.combine_chunks().dictionary_encode()
    return found.indices.to_numpy().astype(np.min_scalar_type(len(found.dictionary))), found.dictionary


def _sort_key(column: pa.ChunkedArray) -> np.ndarray:
    """Numbers that rows can be grouped by: integers as they are, else places among the different values."""
    return column.to_numpy() if pa.types.is_integer(column.type) else encoded(column)[0]


def grouped(rows: pa.Table, group: str, order: list[str]) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each value of the integer column ``group``, without it; rows with equal ``order`` stand together."""
    rows = rows.take(np.lexsort([_sort_key(rows[c]) for c in [*reversed(order), group]]))
    value = rows[group].to_numpy()
    cuts = [0, *(np.flatnonzero(value[1:] != value[:-1]) + 1), len(value)]
    rows = rows.drop_columns(group)
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        if high > low:
            yield int(value[low]), rows.slice(low, high - low)


def unified(values: list[pa.Array]) -> tuple[list[np.ndarray], pa.Array]:
    """For each array the places of its different values among those of all arrays, and all values."""
    together = pa.chunked_array([v.dictionary_encode() for v in values]).unify_dictionaries()
    return [c.indices.to_numpy() for c in together.chunks], together.chunk(0).dictionary


class Numbers:
    """Numbers for values that come in parts: from 0, as the values first occur. Few values are held at a time."""

    def __init__(self) -> None:
        self.codes: list[np.ndarray] = []
        self._known: pa.Array | None = None
        self._parts: list[pa.Array] = []
        self._size = 0

    def add(self, column: pa.ChunkedArray) -> None:
        self._parts.append(column.combine_chunks())
        self._size += len(column)
        if self._size >= ROWS:
            self.values()

    def values(self) -> pa.Array | None:
        """The different values so far; ``codes`` then has the numbers of all parts."""
        if self._parts:
            before = [] if self._known is None else [self._known]
            chunks = pa.chunked_array([*before, *self._parts]).dictionary_encode().chunks
            self.codes += [c.indices.to_numpy().copy() for c in chunks[len(before) :]]
            self._known, self._parts, self._size = chunks[-1].dictionary, [], 0
        return self._known


def opened(batches: Iterable[pa.RecordBatch], new: Callable) -> Iterator:
    """For each ``cell`` a ``new()`` to which its packs were added, opened one at a time: the other columns, and the rows."""
    cells = {}
    for batch in batches:
        others = [batch[c].to_pylist() for c in batch.schema.names if c not in ("cell", "rows")]
        for cell, value, *other in zip(batch["cell"].to_pylist(), batch["rows"], *others, strict=True):
            if cell not in cells:
                cells[cell] = new()
            cells[cell].add(*other, unpack(value))
    while cells:
        pa.default_memory_pool().release_unused()  # what opening took
        yield cells.popitem()[1]
