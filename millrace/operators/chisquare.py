"""Pearson goodness-of-fit tests against a uniform expectation, one per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.chisquare import METHOD, NULL_HYPOTHESIS, chisq_pvalue, presumption


def chisq_gof(
    df: DataFrame, groups: list[str], category: str, categories: int | None = None
) -> DataFrame:
    """``(groups..., categories, observations, df, statistic)`` of the category counts.

    ``categories`` defaults to the number of distinct categories in the whole input; a
    category that is missing from a group counts as observed zero times. Null is no
    category: such rows are not observations. Rows are counted
    per (group, category) before the shuffle, so a dominant group or category is only one
    row there. With E = N / k, sum((O - E)^2 / E) = (k * sum(O^2) - N^2) / N; the numerator
    is an exact integer.
    """
    counts = df.filter(F.col(category).isNotNull()).groupBy(*groups, category).agg(F.count("*").alias("n"))
    if categories is None:
        k = counts.agg(F.count_distinct(category).alias("k")).scalar()
    else:
        k = F.lit(categories)
    exact = F.col("n").cast("decimal(19,0)")
    totals = counts.groupBy(*groups).agg(
        F.sum("n").alias("observations"),
        F.count("*").alias("seen"),
        F.sum((exact * exact).cast("decimal(38,0)")).alias("squares"),
    )
    total = F.col("observations").cast("decimal(19,0)")
    spread = F.col("categories").cast("decimal(10,0)") * F.col("squares") - total * total
    few = F.raise_error(F.lit("a group has more categories than were given")).cast("long")
    return totals.withColumn("categories", k.cast("long")).select(
        *groups,
        F.when(F.col("seen") > F.col("categories"), few)
        .otherwise(F.col("categories"))
        .alias("categories"),
        "observations",
        (F.col("categories") - 1).alias("df"),
        (spread.cast("double") / F.col("observations")).alias("statistic"),
    )


def chisq_gof_vectors(df: DataFrame, observed: str) -> DataFrame:
    """Add ``df`` and ``statistic`` for an array of observed counts per row.

    All-zero counts give NaN, negative counts raise.
    """
    values = F.col(observed).cast("array<double>")
    size = F.size(values)
    zero = F.lit(0.0)
    total = F.aggregate(values, zero, lambda a, x: a + x)
    expected = total / size

    def add(acc: Column, x: Column) -> Column:
        return acc + (x - expected) * (x - expected) / expected

    negative = F.exists(values, lambda x: x < 0)
    statistic = (
        F.when(negative, F.raise_error(F.lit("negative observed count")).cast("double"))
        .when(total == 0, F.lit(float("nan")))
        .otherwise(F.aggregate(values, zero, add))
    )
    return df.withColumns({"df": (size - 1).cast("long"), "statistic": statistic})


def with_pvalue(tests: DataFrame) -> DataFrame:
    """Add ``p_value`` to rows of (``df``, ``statistic``)."""
    return tests.withColumn("p_value", chisq_pvalue(F.col("statistic"), F.col("df")))


def with_verdict(tests: DataFrame) -> DataFrame:
    """Add ``method``, ``null_hypothesis`` and the ``verdict`` in words."""
    return tests.withColumns(
        {
            "method": F.lit(METHOD),
            "null_hypothesis": F.lit(NULL_HYPOTHESIS),
            "verdict": presumption(F.col("p_value")),
        }
    )
