"""The library's input relations, taken from the star-schema tables in ``sf_dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_lines(spark, sf_dir).select(
        F.col("o_custkey").alias("user"),
        F.col("l_partkey").alias("product"),
        F.col("l_extendedprice").alias("price"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_lines(spark, sf_dir).select(
        F.col("o_custkey").alias("userid"),
        F.col("l_partkey").alias("itemid"),
        F.col("l_quantity").alias("pref"),
    )


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*MEASURES)


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"),
        F.col("embedding").cast("array<double>").alias("features"),
    )


def rating_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered log: ``event_id`` gives the order, the number in ``props`` is the item."""
    item = F.regexp_extract("props", r"(\d+)", 1)
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("userid"),
        item.cast("long").alias("itemid"),
        F.concat_ws("\t", "user_id", item, "event_type", "event_id").alias("value"),
    )
