"""Exact length histogram of a corpus: totals for every context limit from suffix sums.

The corpus shrinks to one row per encoded length. Running sums over these rows, taken per
range of lengths and then over the ranges, answer every question about a context limit:
documents within it, tokens left when longer ones are truncated, quantiles.

A null text encodes to no tokens and counts as length 0. Every row counts, repeated ones too.
An empty table has an empty histogram. Only ``text`` is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.byte_bpe import token_count
from millrace.storage import materialize

#: Lengths that one window task ranks; the sums of the ranges are one row per so many lengths.
RANGE = 256


def length_histogram(docs: DataFrame, path: str) -> DataFrame:
    """``n_tokens, n_docs``: how many documents have each encoded length.

    The rows, one for each length, are stored: whatever is asked of them, texts are encoded once.
    """
    lengths = docs.select(token_count(path)("text").alias("n_tokens"))
    return materialize(lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "lengths")


def context_totals(histogram: DataFrame) -> DataFrame:
    """Per occurring length, taken as the context limit, from ``n_tokens, n_docs``:

    ``docs_within, tokens_within`` (documents up to the limit), ``docs_over, tokens_over``,
    ``truncated_tokens`` (what all documents hold when cut at the limit), and ``rank_from,
    rank_to``: the 1-based places of its documents in order of length, so a quantile is the
    row whose places hold it.
    """
    rows = histogram.select(
        "n_tokens",
        "n_docs",
        (F.col("n_tokens") * F.col("n_docs")).alias("tokens"),
        F.floor(F.col("n_tokens") / RANGE).alias("range"),
    )
    ranges = rows.groupBy("range").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    after = W.orderBy("range").rowsBetween(1, W.unboundedFollowing)
    ranges = ranges.select(
        "range",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in "dt"],
        *[F.coalesce(F.sum(c).over(after), F.lit(0)).alias(f"{c}_after") for c in "dt"],
    )
    inside = W.partitionBy("range").orderBy("n_tokens")
    up_to = inside.rowsBetween(W.unboundedPreceding, 0)
    beyond = inside.rowsBetween(1, W.unboundedFollowing)
    return (
        rows.join(ranges, "range")
        .select(
            "n_tokens",
            "n_docs",
            (F.col("d_before") + F.sum("n_docs").over(up_to)).alias("docs_within"),
            (F.col("t_before") + F.sum("tokens").over(up_to)).alias("tokens_within"),
            (F.col("d_after") + F.coalesce(F.sum("n_docs").over(beyond), F.lit(0))).alias("docs_over"),
            (F.col("t_after") + F.coalesce(F.sum("tokens").over(beyond), F.lit(0))).alias("tokens_over"),
        )
        .withColumn(
            "truncated_tokens", F.col("tokens_within") + F.col("n_tokens") * F.col("docs_over")
        )
        .withColumn("rank_from", F.col("docs_within") - F.col("n_docs") + 1)
        .withColumn("rank_to", F.col("docs_within"))
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """Totals at the given context limits, whether or not a document has that length."""
    limit = F.explode(F.array(*[F.lit(x).cast("long") for x in limits])).alias("limit")
    fits = F.col("n_tokens") <= F.col("limit")
    return (
        histogram.select("*", limit)
        .groupBy("limit")
        .agg(
            F.sum(F.when(fits, F.col("n_docs")).otherwise(0)).alias("docs_within"),
            F.sum(F.when(fits, 0).otherwise(F.col("n_docs"))).alias("docs_over"),
            F.sum(F.least("n_tokens", "limit") * F.col("n_docs")).alias("truncated_tokens"),
        )
    )


def quantiles(totals: DataFrame, shares: list[float]) -> DataFrame:
    """Per share, the smallest length that at least this share of the documents stays within."""
    total = F.col("docs_within") + F.col("docs_over")
    share = F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share")
    place = F.greatest(F.ceil(F.col("share") * total), F.lit(1))
    return (
        totals.select("*", share)
        .filter((F.col("rank_from") <= place) & (place <= F.col("rank_to")))
        .select("share", F.col("n_tokens").alias("quantile"))
    )
