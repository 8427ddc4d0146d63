"""Purchase-history analytics over ``(user, product, price)`` rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def purchase_count(purchases: DataFrame) -> DataFrame:
    """Number of purchase rows (rows, not quantities)."""
    return purchases.agg(F.count("*").alias("purchases"))


def unique_users(purchases: DataFrame) -> DataFrame:
    """Exact number of distinct users."""
    return purchases.agg(F.count_distinct("user").alias("unique_users"))


def total_revenue(purchases: DataFrame) -> DataFrame:
    """Sum of price; 0 for an empty history."""
    return purchases.agg(F.coalesce(F.sum("price"), F.lit(0.0)).alias("revenue"))


def product_counts(purchases: DataFrame) -> DataFrame:
    """Purchases per product."""
    return purchases.groupBy("product").agg(F.count("*").alias("purchases"))


def most_popular_product(purchases: DataFrame) -> DataFrame:
    """Product bought most often; the smallest product among equals."""
    counts = product_counts(purchases)
    return counts.orderBy(F.desc("purchases"), "product").limit(1)


def purchase_summary(purchases: DataFrame) -> DataFrame:
    """One row with total, unique users, revenue and the top product.

    A single pass over the input: every row is pre-aggregated under its product and under
    its user before the shuffle, and all five figures follow from those two sets of groups.
    """
    groups = purchases.groupingSets(
        [[F.col("product")], [F.col("user")]], "product", "user"
    ).agg(
        F.grouping("user").alias("by_product"),
        F.count("*").alias("n"),
        F.sum("price").alias("amount"),
    )
    per_product = F.col("by_product") == 1
    best = F.min(F.when(per_product, F.struct((-F.col("n")).alias("neg"), F.col("product"))))
    return groups.agg(
        F.coalesce(F.sum(F.when(per_product, F.col("n"))), F.lit(0)).alias("purchases"),
        F.count(F.when(~per_product, F.col("user"))).alias("unique_users"),
        F.coalesce(F.sum(F.when(per_product, F.col("amount"))), F.lit(0.0)).alias("revenue"),
        best.alias("best"),
    ).select(
        "purchases",
        "unique_users",
        "revenue",
        F.col("best.product").alias("top_product"),
        F.coalesce(-F.col("best.neg"), F.lit(0)).alias("top_purchases"),
    )


def purchase_report(purchases: DataFrame) -> DataFrame:
    """The summary as formatted report lines, one per column."""
    # fixed values: the report's line formats
    return purchase_summary(purchases).select(
        F.format_string("Total purchases: %d", "purchases").alias("purchases_line"),
        F.format_string("Unique users: %d", "unique_users").alias("users_line"),
        F.format_string("Total revenue: %.2f", "revenue").alias("revenue_line"),
        F.format_string(
            "Most popular product: %s with %d purchases",
            F.col("top_product").cast("string"),
            F.col("top_purchases"),
        ).alias("product_line"),
    )


def user_sketches(purchases: DataFrame, by: str, precision: int = 12) -> DataFrame:
    """``(by, sketch)``: a mergeable sketch of the users of each value of ``by``, of a few kilobytes.

    Stored once, sketches answer :func:`sketched_users` for any union of them without reading a
    purchase again. Null users do not count.
    """
    return purchases.groupBy(by).agg(F.hll_sketch_agg("user", precision).alias("sketch"))


def sketched_users(sketches: DataFrame, *by: str) -> DataFrame:
    """About how many different users the sketches of each group have seen; opt-in, not exact.

    The relative standard error is about 0.83 / sqrt(2 ** precision): 1.3 % at 12.
    """
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("users"))
