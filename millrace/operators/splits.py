"""Train/test splits of an ordered rating log.

The log carries a unique order column (``order_by``); ``userid`` and ``itemid`` are its keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.fields import leading_number
from millrace.functions.ordering import (
    group_ordinal,
    positions_between,
    row_position,
    segmented_scan,
    sorted_position,
)


def user_ordinal(log: DataFrame, order_by: str = "pos", hot_rows: int = 1_000_000) -> DataFrame:
    """Add ``ordinal``: this is the user's n-th row, counting from 1."""
    return group_ordinal(log, "userid", order_by, "ordinal", hot_rows)


def in_range(start: int, stop: int) -> Column:
    return F.col("ordinal").between(start, stop)


def capped_running_count(
    log: DataFrame, start: int, stop: int, max_test: int, order_by: str = "pos"
) -> DataFrame:
    """Add ``held``: rows held out so far, which stops growing at ``max_test`` (if positive)."""
    counted = segmented_scan(log, "userid", order_by, "ordinal", {"held": (start, stop)})
    return counted.withColumn("held", F.least("held", F.lit(max_test))) if max_test > 0 else counted


def route_rows(
    log: DataFrame, start: int, stop: int, max_test: int = 0, order_by: str = "pos"
) -> DataFrame:
    """Add ``ordinal`` and the boolean ``held_out``.

    A row is held out when it is its user's ``start``-th to ``stop``-th row and fewer than
    ``max_test`` earlier rows were; ``max_test <= 0`` means no cap.
    """
    candidate = in_range(start, stop)
    if max_test <= 0:
        return user_ordinal(log, order_by).withColumn("held_out", candidate)
    counted = segmented_scan(log, "userid", order_by, "ordinal", {"_held": (start, stop)})
    return counted.withColumn("held_out", candidate & (F.col("_held") <= max_test)).drop("_held")


def split_leave_range(
    log: DataFrame, start: int, stop: int, max_test: int = 0, order_by: str = "pos"
) -> DataFrame:
    """Every row of the log plus ``part``: ``test`` for held-out rows, else ``base``."""
    routed = route_rows(log, start, stop, max_test, order_by)
    part = F.when(F.col("held_out"), "test").otherwise("base")
    return routed.withColumn("part", part).drop("ordinal", "held_out")


def slice_rows(positioned: DataFrame, start: int, stop: int) -> DataFrame:
    """Rows at positions ``start`` (inclusive) to ``stop`` (exclusive)."""
    return positioned.filter((F.col("pos") >= start) & (F.col("pos") < stop))


def slice_log(log: DataFrame, start: int, stop: int, order_by: str) -> DataFrame:
    """Rows at positions ``start`` (inclusive) to ``stop`` (exclusive) in the order of ``order_by``, with ``pos``.

    Only the order buckets that hold these positions are shuffled and ranked.
    """
    return positions_between(log, order_by, start, stop)


def _fold(folds: int) -> Column:
    """Fold of a row at ``pos`` of ``_rows``."""
    return F.expr(f"(pos * {folds}L) div _rows") + 1


def assign_folds(log: DataFrame, folds: int = 5, order_by: str = "pos") -> DataFrame:
    """Add ``pos`` and ``fold`` (1-based): contiguous blocks of equal size, give or take one."""
    if order_by == "pos":
        positioned = log.withColumn("_rows", log.agg(F.count("*")).scalar())
    else:
        positioned = row_position(log, order_by, total="_rows")
    return positioned.withColumn("fold", _fold(folds)).drop("_rows")


def kfold_test(log: DataFrame, fold: int, folds: int = 5, order_by: str = "pos") -> DataFrame:
    return assign_folds(log, folds, order_by).filter(F.col("fold") == fold)


def kfold_base(log: DataFrame, fold: int, folds: int = 5, order_by: str = "pos") -> DataFrame:
    return assign_folds(log, folds, order_by).filter(F.col("fold") != fold)


def split_suite(
    log: DataFrame,
    folds: int = 5,
    ranges: dict[str, tuple[int, int]] | None = None,
    max_test: int = 100_000,
    order_by: str = "pos",
) -> DataFrame:
    """All splits as columns of one frame: ``fold`` and one boolean ``in_<name>`` per range.

    Ordinals, positions and capped counts come from one shuffle by order bucket. Every test and
    base set is a filter on these columns; nothing is copied per split.
    """
    ranges = ranges or {"ua": (1, 10), "ub": (11, 20)}
    candidates = {name: in_range(*bounds) for name, bounds in ranges.items()}
    counted = segmented_scan(
        log, "userid", order_by, "ordinal",
        {f"_{name}": bounds for name, bounds in ranges.items()},
        position=None if order_by == "pos" else "pos", total="_rows",
    )
    marks = {}
    for name, candidate in candidates.items():
        free = F.lit(max_test <= 0) | (F.col(f"_{name}") <= max_test)
        marks[f"in_{name}"] = candidate & free
    marked = counted.withColumns({"fold": _fold(folds), **marks})
    return marked.drop("ordinal", "_rows", *[f"_{n}" for n in ranges])


def split_outputs(suite: DataFrame, folds: int = 5, ranges: Sequence[str] = ("ua", "ub")) -> DataFrame:
    """The rows of every output of a :func:`split_suite`, with the output's name as ``split``.

    A row is in ``u<fold>.test`` and in ``u<other>.base`` for the other folds, and in
    ``<range>.test`` or ``<range>.base`` for each range.
    """
    names = [
        F.concat(F.lit(f"u{k}."), F.when(F.col("fold") == k, "test").otherwise("base"))
        for k in range(1, folds + 1)
    ]
    names += [F.concat(F.lit(f"{r}."), F.when(F.col(f"in_{r}"), "test").otherwise("base")) for r in ranges]
    return suite.withColumn("split", F.explode(F.array(*names)))


def rating_order(log: DataFrame) -> list[Column]:
    """User, then item, both as numbers, then the rest of the row as text."""
    kinds = dict(log.dtypes)
    keys = [
        leading_number(F.col(c)) if kinds[c] == "string" else F.coalesce(F.col(c), F.lit(0))
        for c in ("userid", "itemid")
    ]
    return [*keys, rating_line(log)]


def rating_line(log: DataFrame) -> Column:
    """The log's own line, or its columns separated by tabs; a null is an empty field."""
    if "value" in log.columns:
        return F.col("value")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in log.columns]
    return F.concat_ws("\t", *fields)


def sort_ratings(log: DataFrame) -> DataFrame:
    """Global order by user, item (numerically) and then the whole line."""
    return log.orderBy(*rating_order(log))


def sorted_rating_position(log: DataFrame, name: str = "sort_pos") -> DataFrame:
    """Add each row's 0-based position in the order of :func:`sort_ratings`."""
    return sorted_position(log, *rating_order(log), name=name)
