"""Column statistics of tall matrices, by one path for every width.

A matrix is a DataFrame and either a list of numeric columns or the name of one array
column. Tasks fold their rows, batch by batch, into states of fixed size (counts, means, squared
deviations, products of columns), and Spark's aggregates merge the states. Entries of
(columns x columns) results stay distributed: their upper half is cut into ranges of rows that a task
can hold, and only numbers per column reach the driver.

A row with a null in any of its cells is left out as a whole; :func:`incomplete_rows` counts such
rows. NaN is a value: it makes its column's sums, means, norms, variances and all its products and
cosines NaN, is the largest value of a column, and its smallest only if there is no other. A matrix
without complete rows has an empty result. Rows of different lengths raise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.storage import materialize

#: Entries of a result that a task holds at once: 64 MB of doubles.
HELD_ENTRIES = 1 << 23
#: Entries of one row of a result that travel together.
STRIP = 64
_BATCH_ROWS = 4096
#: Entries of products that a task adds to its sums at once.
_SLAB = 1 << 20

Columns = list[str] | str


def row_matrix(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Gather numeric columns into one array column ``features``."""
    features = F.array(*[F.col(c).cast("double") for c in columns])
    return df.select(*(keep or []), features.alias("features"))


def matrix_shape(df: DataFrame, features: str = "features") -> DataFrame:
    """Number of rows and columns."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.max(F.size(features)), F.lit(0)).cast("long").alias("n_cols"),
    )


def feature_array(columns: Columns) -> Column:
    if isinstance(columns, str):
        return F.col(columns).cast("array<double>")
    return F.array(*[F.col(c).cast("double") for c in columns])


def _complete(columns: Columns) -> Column:
    if isinstance(columns, str):
        missing = F.exists(columns, lambda x: x.isNull())
        return F.col(columns).isNotNull() & ~F.coalesce(missing, F.lit(True))
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def complete_rows(df: DataFrame, columns: Columns) -> DataFrame:
    """The rows without a null cell, which all statistics are computed from."""
    return df.filter(_complete(columns))


def incomplete_rows(df: DataFrame, columns: Columns) -> DataFrame:
    """One row: ``n_rows``, and ``n_incomplete`` of them that are left out."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count(F.when(~_complete(columns), 1)).alias("n_incomplete"),
    )


def vectors(df: DataFrame, columns: Columns) -> DataFrame:
    """One vector column ``v`` of the complete rows."""
    rows = complete_rows(df, columns)
    return rows.select(array_to_vector(feature_array(columns)).alias("v"))


def matrix_width(df: DataFrame, columns: Columns) -> int:
    """Number of columns, 0 if an array matrix has no complete rows."""
    if not isinstance(columns, str):
        return len(columns)
    first = complete_rows(df, columns).select(F.size(columns)).first()
    return first[0] if first else 0


def _has_rows(df: DataFrame, columns: Columns) -> bool:
    return matrix_width(df, columns) > 0 and not complete_rows(df, columns).isEmpty()


def _no_entries(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], "i long, j long, value double")


def mllib_rows(df: DataFrame, columns: Columns) -> RowMatrix:
    return RowMatrix(MLUtils.convertVectorColumnsFromML(vectors(df, columns), "v"))


def matrix_entries(df: DataFrame, values: np.ndarray, names: tuple[str, str]) -> DataFrame:
    """Small local matrix as ``(row, column, value)`` rows."""
    i, j = np.indices(values.shape)
    local = pd.DataFrame(
        {names[0]: i.ravel(), names[1]: j.ravel(), "value": values.ravel().astype(float)}
    )
    schema = f"{names[0]} long, {names[1]} long, value double"
    return df.sparkSession.createDataFrame(local, schema)


def _rows(df: DataFrame, columns: Columns) -> DataFrame:
    return complete_rows(df, columns).select(feature_array(columns).alias("x"))


def blocks_of_rows(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[np.ndarray]:
    """The rows of an array column as matrices of a bounded number of rows."""
    width = None
    for batch in batches:
        lists = batch.column(column)
        if not len(lists):
            continue
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        sizes = np.diff(lists.offsets.to_numpy())
        width = int(sizes[0]) if width is None else width
        if (sizes != width).any():
            raise ValueError(f"rows of {int(sizes[sizes != width][0])} and {width} cells in one matrix")
        x = flat.reshape(len(sizes), width)
        for begin in range(0, len(x), _BATCH_ROWS):
            yield x[begin : begin + _BATCH_ROWS]


_STATE = "i long, n long, non_zeros long, max double, min double, mean double, m2 double, l1 double, squares double"


def _summary_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One state for each column of a task's rows."""
    state = None
    with np.errstate(all="ignore"):
        for x in blocks_of_rows(batches):
            n, mean = len(x), x.mean(axis=0)
            part = [
                np.count_nonzero(x, axis=0), x.max(axis=0), np.fmin.reduce(x, axis=0), mean,
                ((x - mean) ** 2).sum(axis=0), np.abs(x).sum(axis=0), (x * x).sum(axis=0),
            ]
            if state is None:
                count, state = n, part
                continue
            gap, both = mean - state[3], count + n
            state = [
                state[0] + part[0], np.maximum(state[1], part[1]), np.fmin(state[2], part[2]),
                state[3] + gap * (n / both), state[4] + part[4] + gap * gap * (count * n / both),
                state[5] + part[5], state[6] + part[6],
            ]
            count = both
    if state is not None:
        names = ("non_zeros", "max", "min", "mean", "m2", "l1", "squares")
        width = len(state[0])
        fixed = {"i": np.arange(width, dtype=np.int64), "n": np.full(width, count, np.int64)}
        yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in {**fixed, **dict(zip(names, state, strict=True))}.items()})


def column_summary(df: DataFrame, columns: Columns) -> DataFrame:
    """One row per column: count, non-zeros, max, min, mean, variance, L1 and L2 norm."""
    states = _rows(df, columns).mapInArrow(_summary_states, _STATE)
    column = W.partitionBy("i")
    centre = F.sum(F.col("n") * F.col("mean")).over(column) / F.sum("n").over(column)
    away = F.col("mean") - F.col("centre")
    n, m2 = F.sum("n"), F.sum(F.col("m2") + F.col("n") * away * away)
    return (
        states.withColumn("centre", centre)
        .groupBy("i")
        .agg(
            n.alias("n"),
            F.sum("non_zeros").alias("non_zeros"),
            F.max("max").alias("max"),
            F.min("min").alias("min"),
            F.max("centre").alias("mean"),
            F.when(n > 1, m2 / (n - 1)).alias("variance"),
            F.sum("l1").alias("l1"),
            F.sqrt(F.sum("squares")).alias("l2"),
        )
    )


Block = Callable[[np.ndarray, int, int], np.ndarray]


def _products(rows: np.ndarray, begin: int, end: int) -> np.ndarray:
    """Columns ``begin`` to ``end`` times all columns from ``begin`` on."""
    return rows[:, begin:end].T @ rows[:, begin:]


def upper_entries(rows: DataFrame, width: int, block: Block, no_entry: np.ndarray | None = None) -> DataFrame:
    """``(i, j, value)`` for i <= j: sums over blocks of rows of the matrices that ``block`` makes.

    ``rows`` has an array column ``x`` of ``width`` cells. ``block(rows, a, b)`` gives the entries
    of rows a to b of the result, from column a on. The ranges of rows of a wide result are
    separate scans, so that a task holds one range; strips of entries are summed by key. Columns marked
    in ``no_entry`` have none.
    """
    if not width:
        return _no_entries(rows)
    strip = min(STRIP, width)
    if width > 4 * STRIP:  # as many rows for a task as make its sums smaller than its rows
        rows = materialize(rows, "wide-rows")  # scanned once for each range
        rows = rows.coalesce(max(1, rows.count() // (4 * width)))
    step = max(strip, HELD_ENTRIES // width // strip * strip)
    slab = max(strip, _SLAB // width // strip * strip)
    kind = "i int, strip int, " + ", ".join(f"c{k} double" for k in range(strip))
    absent = np.zeros(width, bool) if no_entry is None else no_entry

    def sums(begin: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        end = min(width, begin + step)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for x in blocks_of_rows(batches):
                if total is None:
                    total = np.zeros((end - begin, width - begin))
                for low in range(begin, end, slab):  # the products of a few rows of the result at a time
                    high = min(end, low + slab)
                    total[low - begin : high - begin, low - begin :] += block(x, low, high)
            if total is None:
                return
            first = begin // strip
            strips = -(-width // strip) - first
            none = np.ones(strips * strip, bool)
            none[: width - begin] = absent[begin:]
            for s in range(strips):  # rows of the upper half that reach into this strip
                i = np.arange(begin, min(end, (first + s + 1) * strip))
                cells = np.zeros((len(i), strip))
                there = total[: len(i), s * strip : (s + 1) * strip]
                cells[:, : there.shape[1]] = there
                mask = none[None, s * strip : (s + 1) * strip] | absent[i][:, None]
                columns = {f"c{k}": pa.array(cells[:, k], mask=mask[:, k]) for k in range(strip)}
                key = {"i": pa.array(i, pa.int32()), "strip": pa.array(np.full(len(i), first + s), pa.int32())}
                yield pa.RecordBatch.from_pydict({**key, **columns})

        return work

    with_numbers = reduce(
        DataFrame.union, [rows.mapInArrow(sums(begin), kind) for begin in range(0, width, step)]
    )
    cells = [f"c{k}" for k in range(strip)]
    summed = with_numbers.groupBy("i", "strip").agg(*[F.sum(c).alias(c) for c in cells])
    entries = summed.select("i", "strip", F.posexplode(F.array(*cells)).alias("at", "value"))
    j = F.col("strip") * F.lit(strip) + F.col("at")
    entries = entries.select(F.col("i").cast("long").alias("i"), j.cast("long").alias("j"), "value")
    return entries.filter((F.col("i") <= F.col("j")) & F.col("value").isNotNull())


def mirrored(upper: DataFrame) -> DataFrame:
    """Both halves of a symmetric matrix."""
    other = upper.filter("i < j").select(F.col("j").alias("i"), F.col("i").alias("j"), "value")
    return upper.union(other)  # both sides read one shuffle, and filters reach it


def column_dot(df: DataFrame, columns: Columns) -> DataFrame:
    """Products of all column pairs ``i <= j``."""
    return upper_entries(_rows(df, columns), matrix_width(df, columns), _products)


def gramian(df: DataFrame, columns: Columns) -> DataFrame:
    """``(i, j, value)`` of the transposed matrix times itself."""
    return mirrored(column_dot(df, columns))


def _per_column(df: DataFrame, columns: Columns, *names: str) -> tuple[int, list[np.ndarray]]:
    """The number of complete rows and some summary columns, as arrays over the matrix columns."""
    found = column_summary(df, columns).select("i", "n", *names).toPandas().sort_values("i")
    return (int(found["n"].iloc[0]) if len(found) else 0), [found[name].to_numpy(float) for name in names]


def covariance(df: DataFrame, columns: Columns) -> DataFrame:
    """``(i, j, value)`` of the sample covariance (n - 1); a single complete row raises.

    Rows are centred before they are multiplied.
    """
    n, (mean,) = _per_column(df, columns, "mean")
    if not n:
        return _no_entries(df)
    if n < 2:
        raise ValueError("covariance needs at least two rows")

    def centred(rows: np.ndarray, begin: int, end: int) -> np.ndarray:
        return _products(rows - mean, begin, end) / (n - 1)

    return mirrored(upper_entries(_rows(df, columns), len(mean), centred))


def column_cosine(df: DataFrame, columns: Columns) -> DataFrame:
    """Exact cosine of all column pairs ``i < j``; an all-zero column has no entry."""
    _, (norm,) = _per_column(df, columns, "l2")
    scale = 1 / np.where(norm == 0, 1.0, norm)

    def cosines(rows: np.ndarray, begin: int, end: int) -> np.ndarray:
        return _products(rows, begin, end) * scale[begin:end, None] * scale[begin:]

    return upper_entries(_rows(df, columns), len(norm), cosines, norm == 0).filter("i < j")


#: A prime, and factors, of the coin that decides which products are sampled.
COIN_PRIME = 2_147_483_647
COIN_ROW, COIN_I, COIN_J, COIN_LAST = 48_271, 69_621, 40_692, 16_807


def coins(row: np.ndarray, i: int, j: np.ndarray, seed: int) -> np.ndarray:
    """Whole numbers below ``COIN_PRIME`` for each row and pair (i, j), the same in any engine.

    ``row`` holds ids, reduced by the prime.
    """
    x = (row * COIN_ROW)[:, None] + (i * COIN_I + j * COIN_J + seed)[None, :]
    x %= COIN_PRIME
    return (x * x % COIN_PRIME * COIN_LAST + x) % COIN_PRIME


def column_cosine_seeded(
    df: DataFrame, columns: Columns, row_id: str, threshold: float, seed: int = 1
) -> DataFrame:
    """Cosines of column pairs ``i < j`` estimated from a sample of the products, by DIMSUM.

    The product of a row's cells i and j counts with probability p(i) p(j), where
    p(i) = min(1, sqrt(g) / norm(i)) and g = 10 ln(columns) / threshold, so frequent columns are
    sampled and cosines from ``threshold`` on come out close to exact. Columns are first divided by their
    largest magnitude, which changes no cosine and keeps the rate free of units. Whether a
    product counts follows from (``row_id``, i, j, seed) alone: the result is the same for any partitioning. Rows
    without an id count as id 0; estimates are not clipped.
    """
    if threshold <= 0:
        raise ValueError("threshold must be positive")
    _, (top, low, norm) = _per_column(df, columns, "max", "min", "l2")
    width = len(norm)
    peak = np.maximum(np.abs(top), np.abs(low))
    peak = np.where(peak == 0, 1.0, peak)
    size, root = norm / peak, float(np.sqrt(10 * np.log(max(width, 2)) / threshold))
    rate = np.minimum(1.0, root / np.where(size == 0, 1.0, size))
    divisor = np.minimum(root, np.where(size == 0, 1.0, size)) * peak

    def sampled(rows: np.ndarray, begin: int, end: int) -> np.ndarray:
        ids, x = rows[:, 0].astype(np.int64), rows[:, 1:] / divisor
        found = np.zeros((end - begin, width - begin))
        for i in range(begin, min(end, width - 1)):
            j = np.arange(i + 1, width)
            counts = coins(ids, i, j, seed) < rate[i] * rate[j] * COIN_PRIME
            found[i - begin, i + 1 - begin :] = (x[:, i, None] * x[:, i + 1 :] * counts).sum(axis=0)
        return found

    # the id travels as the first cell: below the prime it is exact as a double
    place = F.pmod(F.coalesce(F.col(row_id).cast("long"), F.lit(0)), F.lit(COIN_PRIME)).cast("double")
    rows = complete_rows(df, columns).select(F.concat(F.array(place), feature_array(columns)).alias("x"))
    return upper_entries(rows, width, sampled, norm == 0).filter("i < j")


def column_cosine_sampled(
    df: DataFrame, columns: Columns, threshold: float, exact: bool = True
) -> DataFrame:
    """Cosines of column pairs that reach ``threshold``: exact ones, whatever the input.

    With ``exact=False`` MLlib's DIMSUM sampling estimates them: entries above the threshold
    are found with high probability, values are estimates, clipped to [-1, 1], and vary with
    the partitioning. Columns are scaled by their largest magnitude first, which leaves the
    cosine unchanged and keeps the sampling rate from depending on units.
    """
    if threshold < 0:
        raise ValueError("threshold must not be negative")
    if exact:
        return column_cosine(df, columns).filter(F.col("value") >= threshold)
    if not _has_rows(df, columns):
        return _no_entries(df)
    rows = complete_rows(df, columns).select(feature_array(columns).alias("features"))
    peaks = rows.select(array_to_vector("features").alias("v")).agg(
        Summarizer.metrics("max", "min").summary(F.col("v")).alias("s")
    )
    top, low = peaks.select(vector_to_array("s.max"), vector_to_array("s.min")).first()
    scale = [1 / p if (p := max(abs(a), abs(b))) > 0 else 0.0 for a, b in zip(top, low)]
    scaled = F.zip_with("features", F.lit(scale), lambda x, s: x * s)
    found = mllib_rows(rows.select(scaled.alias("features")), "features").columnSimilarities(threshold)
    # MLlib's own table of the entries: no Python code touches them
    entries = callMLlibFunc("getMatrixEntries", found._java_matrix_wrapper._java_model)
    clipped = F.least(F.greatest(F.col("value"), F.lit(-1.0)), F.lit(1.0))
    return entries.select("i", "j", clipped.alias("value"))
