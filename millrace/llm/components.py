"""Connected components of a link table: alternating stars, a few shuffles a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.storage import discard, store


def _least(links: DataFrame, made: list[str]) -> DataFrame:
    """``node, least``: the smallest neighbour of each ``a``.

    Stored, so that its join with the links is between plain exchanges and adaptive execution
    can split a node with very many neighbours.
    """
    least = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    made.append(store(least, "least"))
    return links.sparkSession.read.parquet(made[-1])


def _large_star(links: DataFrame, made: list[str]) -> DataFrame:
    """Tie every larger neighbour of a node to the node's smallest neighbour."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both, made).select("node", F.least("node", "least").alias("least"))
    tied = both.join(least, both["a"] == least["node"]).filter(F.col("b") > F.col("a"))
    return tied.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame, made: list[str]) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them; links go large to small."""
    made.append(store(links, "large-star"))
    links = links.sparkSession.read.parquet(made[-1])
    least = _least(links, made)
    tied = links.join(least, links["a"] == least["node"]).filter(F.col("b") != F.col("least"))
    return (
        least.select(F.col("node").alias("a"), F.col("least").alias("b"))
        .union(tied.select(F.col("b").alias("a"), F.col("least").alias("b")))
        .distinct()
    )


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node that has a link; the root is the smallest node reachable.

    ``links`` has two columns of one ordered type. Links of a node to itself are ignored. Each
    round is written to the shared folder and replaces the one before, so that no round is
    ever computed again; rounds end when the links no longer change.
    """
    spark = links.sparkSession
    a, b = links.columns
    sorted_links = links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")
    )
    path = store(sorted_links.distinct(), "links")
    current = spark.read.parquet(path)
    now, before = _fingerprint(current), None
    while now != before and now[0]:
        done = [path]
        path = store(_small_star(_large_star(current, done), done), "links")
        current = spark.read.parquet(path)
        for old in done:
            discard(spark, old)
        now, before = _fingerprint(current), now
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
