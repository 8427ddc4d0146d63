"""Principal components, singular values and what is drawn from them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.columns import (
    Columns,
    blocks_of_rows,
    complete_rows,
    feature_array,
    matrix_entries,
    matrix_width,
    mllib_rows,
    vectors,
)


def _sign(components: np.ndarray) -> np.ndarray:
    """+1 or -1 per column, such that its entry of largest magnitude becomes positive."""
    size = np.abs(components)
    lead = np.argmax(size >= size.max(axis=0) * (1 - 1e-9), axis=0)
    return np.where(components[lead, np.arange(components.shape[1])] < 0, -1.0, 1.0)


def _check_rank(df: DataFrame, columns: Columns, k: int, what: str) -> None:
    width = matrix_width(df, columns)
    if not width or complete_rows(df, columns).isEmpty():
        raise ValueError("the matrix has no complete rows")
    if k > width:
        raise ValueError(f"more {what} than columns")


def principal_components(df: DataFrame, columns: Columns, k: int) -> DataFrame:
    """``(i, component, value, explained)`` of the ``k`` leading covariance eigenvectors.

    ``explained`` is the component's share of the total variance. Each component's entry of
    largest magnitude (the first among equals) is positive.
    """
    _check_rank(df, columns, k, "components")
    model = PCA(k=k, inputCol="v", outputCol="projected").fit(vectors(df, columns))
    values = model.pc.toArray()
    share = F.lit([float(x) for x in model.explainedVariance.toArray()])
    entries = matrix_entries(df, values * _sign(values), ("i", "component"))
    return entries.withColumn("explained", F.get(share, F.col("component").cast("int")))


@dataclass(frozen=True)
class Decomposition:
    """Singular values and right singular vectors; at most columns x k numbers."""

    sigma: np.ndarray
    right: np.ndarray

    def spectrum(self, df: DataFrame) -> DataFrame:
        """``(k, sigma)``."""
        entries = matrix_entries(df, self.sigma[:, None], ("k", "unused"))
        return entries.select("k", F.col("value").alias("sigma"))

    def right_vectors(self, df: DataFrame) -> DataFrame:
        """``(i, component, value)``."""
        return matrix_entries(df, self.right, ("i", "component"))


def svd(df: DataFrame, columns: Columns, k: int, rcond: float = 1e-7) -> Decomposition:
    """The ``k`` largest singular values with their right vectors, at any width.

    MLlib takes square roots of Gramian eigenvalues, so values below about 1e-8 of the
    largest are noise; ``rcond`` drops them. Signs follow :func:`principal_components`.
    """
    _check_rank(df, columns, k, "singular values")
    found = mllib_rows(df, columns).computeSVD(k, computeU=False, rCond=rcond)
    right = found.V.toArray()
    return Decomposition(found.s.toArray(), right * _sign(right))


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The R of a task's rows: each block of rows is put under the R so far and reduced again."""
    r = None
    for x in blocks_of_rows(batches):
        r = np.linalg.qr(x if r is None else np.vstack([r, x]), mode="r")
    if r is not None:
        offsets = pa.array(np.arange(len(r) + 1) * r.shape[1], pa.int32())
        yield pa.RecordBatch.from_pydict({"x": pa.ListArray.from_arrays(offsets, pa.array(r.ravel()))})


def triangular_factor(df: DataFrame, columns: Columns) -> np.ndarray:
    """R of the QR decomposition of the complete rows: at most (columns x columns) numbers.

    Tasks reduce their rows to an R each; these are stacked by ``spark.sql.shuffle.partitions``
    tasks and then by sixteenths of them, until one is left.
    """
    factors = complete_rows(df, columns).select(feature_array(columns).alias("x")).mapInArrow(_folded, "x array<double>")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        tasks = max(1, tasks)
        # all rows of a factor move together
        factors = factors.repartitionById(tasks, F.spark_partition_id()).mapInArrow(_folded, "x array<double>")
        if tasks == 1:
            break
        tasks = tasks // 16
    return np.array([row.x for row in factors.collect()])


def svd_tall(df: DataFrame, columns: Columns, k: int, rcond: float = 1e-14) -> Decomposition:
    """:func:`svd` through QR: singular values far below 1e-8 of the largest keep their digits.

    The matrix is never multiplied with itself, so values are exact to about 1e-16 of the largest; those
    below ``rcond`` of it are dropped. The last R, columns x columns, is decomposed on the driver.
    """
    _check_rank(df, columns, k, "singular values")
    _, sigma, right = np.linalg.svd(triangular_factor(df, columns), full_matrices=False)
    kept = sigma[:k] > rcond * sigma[0]
    vectors_ = right[:k][kept].T
    return Decomposition(sigma[:k][kept], vectors_ * _sign(vectors_))


def _projection(weights: np.ndarray):
    """Arrow-batched ``features -> features . weights``."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def project(features: pd.Series) -> pd.Series:
        if features.empty:
            return features
        return pd.Series(list(np.stack(features.to_numpy()) @ weights))

    return project


def _projected(
    df: DataFrame, row_id: str, columns: Columns, weights: np.ndarray, name: str
) -> DataFrame:
    """``row_id`` and the complete rows times ``weights`` as an array; nothing is shuffled."""
    project = _projection(weights)
    return complete_rows(df, columns).select(row_id, project(feature_array(columns)).alias(name))


def svd_left(
    df: DataFrame, row_id: str, columns: Columns, decomposition: Decomposition
) -> DataFrame:
    """``(row_id, left)``: the left vectors' entries of each row, rows times V / sigma."""
    return _projected(df, row_id, columns, decomposition.right / decomposition.sigma, "left")


def svd_left_rows(
    df: DataFrame, row_id: str, columns: Columns, decomposition: Decomposition
) -> DataFrame:
    """:func:`svd_left` as ``(row_id, component, value)``."""
    left = svd_left(df, row_id, columns, decomposition)
    entries = left.select(row_id, F.posexplode("left").alias("component", "value"))
    return entries.withColumn("component", F.col("component").cast("long"))


def svd_reconstructed(
    left: DataFrame, row_id: str, decomposition: Decomposition
) -> DataFrame:
    """``(row_id, features)``: left vectors times singular values and right vectors."""
    weights = (decomposition.right * decomposition.sigma).T
    return _projected(left, row_id, "left", weights, "features")


def cumulative_spectrum(spectrum: DataFrame) -> DataFrame:
    """Add the running sum of ``sigma`` by ``k`` and its share of the total.

    A spectrum has at most one row per matrix column, so one window partition holds it.
    """
    so_far = W.orderBy("k").rowsBetween(W.unboundedPreceding, 0)
    whole = W.orderBy("k").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    cumulative = F.sum("sigma").over(so_far)
    return spectrum.withColumns(
        {"cumulative": cumulative, "share": cumulative / F.sum("sigma").over(whole)}
    )


def component_grid(matrix: DataFrame, height: int, width: int) -> DataFrame:
    """Lay each column of ``(row_id, component, value)`` out as a row-major image.

    Adds ``y``, ``x`` and the 1-based ``label``. Every component must have each of the
    height x width row ids once; the task that meets another one fails.
    """
    size = height * width
    whole, ordered = W.partitionBy("component"), W.partitionBy("component").orderBy("row_id")
    # as many rows as cells, and each the next one in order: none is missing, none stands twice
    next_one = F.row_number().over(ordered) - 1 == F.col("row_id")
    complete = F.coalesce(next_one, F.lit(False)) & (F.count("*").over(whole) == size)
    message = F.format_string(
        f"component %s does not fill a {height} x {width} grid", F.col("component").cast("string")
    )
    row = F.when(complete, F.col("row_id")).otherwise(F.raise_error(message).cast("long"))
    return matrix.withColumn("row_id", row).select(
        "component",
        (F.col("component") + 1).alias("label"),
        F.expr(f"row_id div {width}").alias("y"),
        (F.col("row_id") % width).alias("x"),
        "value",
    )
