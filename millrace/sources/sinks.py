"""Text sinks whose part files, concatenated in name order, keep the row order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.splits import rating_line, rating_order, sort_ratings, split_outputs


def write_split(split: DataFrame, path: str, order_by: str = "pos") -> None:
    """Write the unchanged line (``value``) of each row under ``part=test`` or ``part=base``."""
    partitions = int(split.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        split.repartitionByRange(partitions, order_by)
        .sortWithinPartitions("part", order_by)
        .select("part", "value")
        .write.partitionBy("part")
        .text(path)
    )


def write_sorted(log: DataFrame, path: str) -> None:
    """Write the log as tab-separated text ordered by user, then item; a null is an empty field."""
    sort_ratings(log).select(rating_line(log).alias("value")).write.text(path)


def write_sorted_splits(suite: DataFrame, path: str, folds: int = 5, ranges=("ua", "ub")) -> None:
    """Write every output of a split suite under ``split=<name>``, sorted by user and item.

    One range shuffle over (output, user, item, line) serves all outputs, so neither a large
    output nor a user with very many rows fills one task.
    """
    partitions = int(suite.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("split"), *rating_order(suite)]
    rows = split_outputs(suite, folds, ranges)
    (
        rows.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .select("split", rating_line(suite).alias("value"))
        .write.partitionBy("split")
        .text(path)
    )
