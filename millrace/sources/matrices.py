"""Reader for matrices stored as delimited text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.lines import numbered_lines


def parse_numeric_rows(lines: DataFrame, delimiter: str = ",") -> DataFrame:
    """Each line of ``value`` as an array ``features``; an unreadable number is null.

    Other columns, such as a row id, are kept.
    """
    cells = F.split("value", f"\\Q{delimiter}\\E")
    features = F.transform(cells, lambda x: x.try_cast("double"))
    return lines.withColumn("features", features).drop("value")


def check_numeric_rows(rows: DataFrame, width: int | None = None) -> DataFrame:
    """Fail in the task that meets a row with something else than ``width`` numbers.

    Without ``width``, rows must be as long as the longest one, which takes a pass of its own.
    """
    longest = F.lit(width) if width is not None else rows.agg(F.max(F.size("features"))).scalar()
    numeric = ~F.exists("features", lambda x: x.isNull())
    problem = F.when(~numeric, F.lit("a row holds something that is not a number")).when(
        F.size("features") != longest, F.lit("rows differ in their number of values")
    )
    checked = F.when(problem.isNotNull(), F.raise_error(problem)).otherwise(F.col("features"))
    return rows.withColumn("features", checked)


def read_numeric_matrix(
    spark: SparkSession,
    paths: str | Sequence[str],
    delimiter: str = ",",
    width: int | None = None,
) -> DataFrame:
    """Text files as ``(row_id, features)`` in source order; rows must agree in length."""
    lines = numbered_lines(spark, paths).withColumnRenamed("pos", "row_id")
    return check_numeric_rows(parse_numeric_rows(lines, delimiter), width)


def matrix_cells(rows: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Matrix rows as ``(row_id, component, value)``."""
    cells = rows.select(row_id, F.posexplode("features").alias("component", "value"))
    return cells.withColumn("component", F.col("component").cast("long"))
