"""Dense positions and running counts over a global order, without a single-partition window.

Rows are assigned to order buckets by *value* (cut points are approximate quantiles of the
order column), so a recomputed task makes the same assignment. Only the per-bucket counts
are cumulated; ranking happens inside a bucket. The number of buckets follows
``spark.sql.shuffle.partitions``. Rows whose order key is null come first, NaN comes last; both
are ordered, and dealt into as many buckets as the others, by a hash of the row.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.storage import materialize

_ID_BITS = 33  # monotonically_increasing_id: row number within the partition


def default_buckets(df: DataFrame) -> int:
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _order_key(df: DataFrame, order_by: str) -> Column:
    kind = df.schema[order_by].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(order_by).cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(order_by).cast("double")
    if isinstance(kind, T.NumericType):
        return F.col(order_by).cast("double")
    raise TypeError(f"order column {order_by!r} must be numeric, date or timestamp")


def _row_order(df: DataFrame, order_by: str) -> list[Column]:
    """The order column, then a hash of the row: rows without a key are told apart by it."""
    plain = [F.col(f"`{f.name}`") for f in df.schema if isinstance(f.dataType, T.AtomicType)]
    return [F.col(order_by).asc_nulls_first(), F.xxhash64(*plain)]


def order_cuts(df: DataFrame, order_by: str, buckets: int) -> list[float]:
    """At most ``buckets - 1`` increasing cut points that split ``df`` about evenly."""
    if buckets < 2:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    keys = df.select(_order_key(df, order_by).alias("_key"))
    return sorted(set(keys.approxQuantile("_key", shares, 1 / (4 * buckets))))


def with_order_bucket(df: DataFrame, order_by: str, cuts: list[float], tie: Column) -> DataFrame:
    """Add ``_bucket``, from 0 in row order: the interval between cut points that holds the row.

    Rows without a number fall in ranges of ``tie``, their hash: those without a key before all
    intervals, NaN behind them.
    """
    keyed = df.withColumn("_key", _order_key(df, order_by))
    ranges = len(cuts) + 1
    if not cuts:
        bucket = F.lit(0)
    else:
        keyed = Bucketizer(
            splits=[-math.inf, *cuts, math.inf],
            inputCol="_key",
            outputCol="_bucket",
            handleInvalid="keep",  # NaN is taken out below
        ).transform(keyed)
        bucket = F.col("_bucket").cast("int")
    by_hash = F.floor((F.shiftright(tie, 32) + 2**31) * ranges / 2**32).cast("int")
    known = (
        F.when(F.col("_key").isNull(), by_hash)
        .when(F.isnan("_key"), by_hash + 2 * ranges)
        .otherwise(bucket + ranges)
    )
    return keyed.withColumn("_bucket", known).drop("_key")


def _bucket_offsets(bucketed: DataFrame, names: list[str]) -> DataFrame:
    """Sum of each column over all earlier buckets, as ``_before_<name>``; a row per bucket.

    ``_total`` is the number of rows in all buckets.
    """
    earlier = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    sums = bucketed.groupBy("_bucket").agg(
        F.count("*").alias("_size"), *[F.sum(n).alias(n) for n in names]
    )
    return sums.select(
        "_bucket",
        F.sum("_size").over(everything).alias("_total"),
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_before_{n}") for n in names],
    )


def running_counts(
    df: DataFrame,
    conditions: dict[str, Column],
    order_by: str,
    buckets: int | None = None,
    total: str | None = None,
) -> DataFrame:
    """Add, per name, how many rows up to and including this one satisfy the condition.

    ``order_by`` must be unique, apart from nulls. All counts share one shuffle of the rows by
    order bucket. ``total`` names a column for the number of all rows. The input is read for
    the cut points, the bucket sums and the result, so an input that is expensive to compute
    should be stored first.
    """
    names = list(conditions)
    hits = {n: F.when(c, 1).otherwise(0).cast("long") for n, c in conditions.items()}
    cuts = order_cuts(df, order_by, buckets or default_buckets(df))
    order = _row_order(df, order_by)
    bucketed = with_order_bucket(df.withColumns(hits), order_by, cuts, order[1])
    so_far = W.partitionBy("_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    counted = bucketed.join(_bucket_offsets(bucketed, names), "_bucket").withColumns(
        {n: F.col(f"_before_{n}") + F.sum(n).over(so_far) for n in names}
    )
    if total:
        counted = counted.withColumn(total, F.col("_total"))
    return counted.drop("_bucket", "_total", *[f"_before_{n}" for n in names])


def positions_between(
    df: DataFrame, order_by: str, start: int, stop: int, name: str = "pos", buckets: int | None = None
) -> DataFrame:
    """The rows at positions ``start`` to ``stop`` (exclusive) of :func:`row_position`.

    The counts per bucket, some hundreds of numbers, say which buckets hold these positions; the
    others are filtered out before anything is shuffled.
    """
    cuts = order_cuts(df, order_by, buckets or default_buckets(df))
    order = _row_order(df, order_by)
    bucketed = with_order_bucket(df, order_by, cuts, order[1])
    sizes = dict(bucketed.groupBy("_bucket").count().collect())
    before, held = 0, {}
    for bucket in sorted(sizes):
        if before < stop and before + sizes[bucket] > start:
            held[bucket] = before
        before += sizes[bucket]
    if not held:
        return df.limit(0).withColumn(name, F.lit(0).cast("long"))
    shift = F.element_at(F.create_map(*[F.lit(x).cast("long") for pair in held.items() for x in pair]), F.col("_bucket").cast("long"))
    local = F.row_number().over(W.partitionBy("_bucket").orderBy(*order)) - 1
    chosen = bucketed.filter(F.col("_bucket").isin(list(held)))
    ranked = chosen.withColumn(name, (shift + local).cast("long")).drop("_bucket")
    return ranked.filter((F.col(name) >= start) & (F.col(name) < stop))


def segmented_scan(
    df: DataFrame,
    group: str,
    order_by: str,
    ordinal: str,
    ranges: dict[str, tuple[int, int]],
    buckets: int | None = None,
    position: str | None = None,
    total: str | None = None,
) -> DataFrame:
    """Ordinals within groups and running counts over all rows, from one shuffle of the rows.

    Adds ``ordinal``, the 1-based number of the row within ``group``, and per name of ``ranges`` how
    many rows up to and including this one have an ordinal in that range; ``position`` names the
    0-based place of the row and ``total`` the number of all rows. ``order_by`` must be unique,
    apart from nulls.

    Rows meet by order bucket only, so neither a large group nor a large bucket of one group fills a
    task. What earlier buckets hold of each group is a table of counts; it goes along as rows that stand
    before the group's own. How many ordinals of a bucket fall into a range follows from the same
    table, so running counts need no further pass. The input is read for the cut points, the counts and
    the result; one that is expensive to compute should be stored first.
    """
    cuts = order_cuts(df, order_by, buckets or default_buckets(df))
    key, tie = _row_order(df, order_by)
    bucketed = with_order_bucket(df, order_by, cuts, tie).withColumn("_tie", tie)
    earlier = W.partitionBy(group).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    counts = materialize(
        bucketed.groupBy("_bucket", group)
        .agg(F.count("*").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))),
        "group-counts",
    )
    inside = {
        name: F.greatest(
            F.lit(0),
            F.least(F.lit(last), F.col("_before") + F.col("_rows")) - F.greatest(F.lit(first - 1), F.col("_before")),
        )
        for name, (first, last) in ranges.items()
    }
    names = [*ranges, *([position] if position else [])]
    if position:
        inside[position] = F.col("_rows")
    per_bucket = counts.groupBy("_bucket").agg(F.sum("_rows").alias("_size"), *[F.sum(c).alias(n) for n, c in inside.items()])
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    offsets = per_bucket.select(  # a row for each bucket
        "_bucket",
        F.sum("_size").over(everything).alias("_total"),
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before_{n}") for n in names],
    )
    went_before = counts.filter("_before > 0").select("_bucket", F.col(group), "_before")
    together = bucketed.withColumn("_before", F.lit(None).cast("long")).unionByName(went_before, allowMissingColumns=True)
    of_group = W.partitionBy("_bucket", group).orderBy(F.col("_before").desc_nulls_last(), key, "_tie")
    so_far = W.partitionBy("_bucket").orderBy(key, "_tie").rowsBetween(W.unboundedPreceding, 0)
    first = F.first("_before").over(of_group.rowsBetween(W.unboundedPreceding, 0))
    number = F.row_number().over(of_group)
    numbered = (
        together.repartitionById(3 * (len(cuts) + 1), "_bucket")
        .withColumn(ordinal, F.when(first.isNull(), number).otherwise(first + number - 1).cast("long"))
        .filter(F.col("_before").isNull())
    )
    hits = {n: F.when(F.col(ordinal).between(*bounds), 1).otherwise(0).cast("long") for n, bounds in ranges.items()}
    if position:
        hits[position] = F.lit(1).cast("long")
    scanned = numbered.join(F.broadcast(offsets), "_bucket")
    counted = scanned.withColumns({n: F.col(f"_before_{n}") + F.sum(hits[n]).over(so_far) for n in names})
    if position:
        counted = counted.withColumn(position, F.col(position) - 1)
    if total:
        counted = counted.withColumn(total, F.col("_total"))
    return counted.drop("_bucket", "_tie", "_before", "_total", *[f"_before_{n}" for n in names])


def row_position(
    df: DataFrame,
    order_by: str,
    name: str = "pos",
    buckets: int | None = None,
    total: str | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in the order of a unique ``order_by`` column."""
    counted = running_counts(df, {name: F.lit(True)}, order_by, buckets, total)
    return counted.withColumn(name, F.col(name) - 1)


def sorted_position(df: DataFrame, *keys: Column | str, name: str = "pos") -> DataFrame:
    """Add the 0-based position of each row in a sort on several keys of any type.

    Rows with equal keys are interchangeable; a random last key spreads a large group of
    them over many range partitions. The sorted rows are written once, so the counting pass
    and the result see the same assignment.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(k) if isinstance(k, str) else k for k in keys]
    salted = df.withColumn("_salt", F.rand(17))
    ranged = (
        salted.repartitionByRange(partitions, *order, F.col("_salt"))
        .sortWithinPartitions(*order, F.col("_salt"))
        .drop("_salt")
        .withColumn("_id", F.monotonically_increasing_id())
    )
    stored = (
        materialize(ranged, "sorted")
        .withColumn("_bucket", F.shiftright("_id", _ID_BITS).cast("int"))
        .withColumn("_local", F.col("_id").bitwiseAND(F.lit((1 << _ID_BITS) - 1)))
        .withColumn("_one", F.lit(1).cast("long"))
    )
    return (
        stored.join(_bucket_offsets(stored, ["_one"]), "_bucket")
        .withColumn(name, F.col("_before__one") + F.col("_local"))
        .drop("_bucket", "_local", "_one", "_before__one", "_id", "_total")
    )


def group_ordinal(
    df: DataFrame, group: str, order_by: str, name: str = "ordinal", hot_rows: int = 1_000_000
) -> DataFrame:
    """Add the 1-based running row number within ``group``, in the order of ``order_by``.

    Groups of at most ``hot_rows`` rows use one window per group. Larger ones, however many
    there are, are ranked inside (group, order bucket) and shifted by the count of the
    group's earlier buckets; a null group is a group like any other.
    """
    sizes = df.groupBy(F.col(group).alias("_hot")).agg(F.count("*").alias("_size"))
    hot = sizes.filter(F.col("_size") > hot_rows)
    order = _row_order(df, order_by)
    in_group = F.row_number().over(W.partitionBy(group).orderBy(*order)).cast("long")
    large_rows = hot.agg(F.sum("_size")).first()[0]
    if not large_rows:
        return df.withColumn(name, in_group)

    keys = hot.select("_hot")
    is_hot = F.col(group).eqNullSafe(F.col("_hot"))
    regular = df.join(keys, is_hot, "left_anti").withColumn(name, in_group)

    large = df.join(keys, is_hot, "left_semi")
    cuts = order_cuts(large, order_by, 2 * -(-large_rows // hot_rows))
    bucketed = with_order_bucket(large, order_by, cuts, order[1])
    earlier = W.partitionBy("_group").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy(F.col(group).alias("_group"), F.col("_bucket").alias("_at"))
        .agg(F.count("*").alias("_amount"))
        .select(
            "_group", "_at", F.coalesce(F.sum("_amount").over(earlier), F.lit(0)).alias("_offset")
        )
    )
    local = F.row_number().over(W.partitionBy(group, "_bucket").orderBy(*order))
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_bucket") == F.col("_at"))
    ranked = (
        bucketed.withColumn("_local", local)
        .join(offsets, same)
        .withColumn(name, F.col("_offset") + F.col("_local"))
    )
    return regular.unionByName(ranked.select(*df.columns, name))
