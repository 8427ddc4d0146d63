"""Every operator applied to whole tables, by name.

Doubles are rounded where the summation order of the engine would otherwise show.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.ordering import row_position as add_position
from millrace.operators import (
    chisquare,
    columns,
    decomposition,
    purchases,
    recommend,
    similarity,
    splits,
)
from millrace.plans import itemcf, relations
from millrace.sources import lines as text
from millrace.sources import corpus, document_files, matrices, positions, sinks
from millrace.storage import materialize, new_path
from millrace.streaming.purchases import (
    accumulate_windows,
    current_windows,
    windowed_purchase_summary,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MEASURES = relations.MEASURES
FOLDS, FOLD = 5, 2
FIRST, LAST, CAP = 1, 10, 1000


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Round columns; adding 0.0 turns -0.0 into 0.0."""
    return df.withColumns({n: F.round(n, digits) + F.lit(0.0) for n in names})


def significant(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Round columns to significant digits, for values of very different size."""

    def keep(name: str) -> Column:
        x = F.col(name)
        power = F.floor(F.log10(F.abs(x))) - (digits - 1)
        scale = F.pow(F.lit(10.0), power.cast("double"))
        return F.when(x == 0, F.lit(0.0)).otherwise(F.round(x / scale, 0))

    def magnitude(name: str) -> Column:
        x = F.col(name)
        return F.when(x == 0, F.lit(0)).otherwise(F.floor(F.log10(F.abs(x)))).cast("long")

    extra = {f"{n}_magnitude": magnitude(n) for n in names}
    return df.withColumns({**extra, **{n: keep(n) for n in names}})


# --- purchases -----------------------------------------------------------------------------


def _purchase_lines(spark: SparkSession, sf_dir: str, price: Column) -> DataFrame:
    joined = relations.table(spark, sf_dir, "lineitem").join(
        relations.table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return joined.select(
        F.concat_ws(",", F.col("o_custkey"), F.col("l_partkey"), price).alias("value")
    )


def _rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = relations.ratings(spark, sf_dir)
    return rows.select(F.concat_ws(",", "userid", "itemid", "pref").alias("value"))


@query
def parse_purchases(spark, sf_dir):
    return text.parse_purchases(_purchase_lines(spark, sf_dir, F.col("l_extendedprice")))


@query
def parse_purchases_rejected(spark, sf_dir):
    """Lines for untaxed items lack the price here."""
    price = F.when(F.col("l_tax") != 0, F.col("l_extendedprice"))
    return text.rejected_lines(_purchase_lines(spark, sf_dir, price))


@query
def parse_ratings(spark, sf_dir):
    return text.parse_ratings(_rating_lines(spark, sf_dir))


@query
def purchase_count(spark, sf_dir):
    return purchases.purchase_count(relations.purchases(spark, sf_dir))


@query
def unique_users(spark, sf_dir):
    return purchases.unique_users(relations.purchases(spark, sf_dir))


@query
def total_revenue(spark, sf_dir):
    return rounded(purchases.total_revenue(relations.purchases(spark, sf_dir)), 2, "revenue")


@query
def product_counts(spark, sf_dir):
    return purchases.product_counts(relations.purchases(spark, sf_dir))


@query
def most_popular_product(spark, sf_dir):
    return purchases.most_popular_product(relations.purchases(spark, sf_dir))


@query
def purchase_summary(spark, sf_dir):
    return rounded(purchases.purchase_summary(relations.purchases(spark, sf_dir)), 2, "revenue")


@query
def purchase_report(spark, sf_dir):
    return purchases.purchase_report(relations.purchases(spark, sf_dir))


@query
def sketched_users(spark, sf_dir):
    """Users per year from stored daily sketches, beside exact counts: within four standard errors."""
    bought = relations.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user"), F.to_date("o_orderdate").alias("day"))
    daily = materialize(purchases.user_sketches(bought, "day"), "sketches")
    found = purchases.sketched_users(daily.withColumn("year", F.year("day")), "year")
    exact = bought.groupBy(F.year("day").alias("year")).agg(F.countDistinct("user").alias("exact_users"))
    near = F.abs(F.col("users") - F.col("exact_users")) <= 0.052 * F.col("exact_users")
    return exact.join(found, "year").select("year", "exact_users", near.alias("near"))


@query
def windowed_purchases(spark, sf_dir):
    """Count and revenue per day and event type, over all events.

    The operator is the one that a stream uses; on a table every window is complete.
    """
    events = relations.table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp"),
        F.col("event_type").alias("product"),
        F.col("value").alias("price"),
    )
    days = windowed_purchase_summary(events).select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "product", "purchases", "revenue"
    )
    return rounded(days, 4, "revenue")


def _streamed_events(spark: SparkSession, sf_dir: str) -> str:
    """Stream all events by time, in three files, then a seventh of them again, in two runs.

    Returns the folder with the stream's tables.
    """
    root = new_path(spark, "stream")
    events = relations.table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("product"), F.col("value").alias("price")
    )
    third = F.ntile(3).over(W.orderBy("day")).alias("third")
    days = events.select(F.to_date("ts").alias("day")).distinct().select("day", third)  # a row for each day
    parted = events.join(days, F.to_date("ts") == F.col("day"))
    for parts in ((1, 2), (3, None)):
        for part in parts:
            rows = parted.filter(F.col("third") == part) if part else events.filter("event_id % 7 = 0")
            rows.select(events.columns).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        accumulate_windows(stream, f"{root}/out", f"{root}/state")
    return f"{root}/out"


@query
def streaming_purchase_summary(spark, sf_dir):
    """All windows of a stream, stored batch by batch and restarted from its checkpoint."""
    days = current_windows(spark, _streamed_events(spark, sf_dir)).select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "product", "purchases", "revenue"
    )
    return rounded(days, 4, "revenue")


@query
def streaming_late_rows(spark, sf_dir):
    """The events that came again after their window had closed."""
    late = spark.read.parquet(f"{_streamed_events(spark, sf_dir)}/late")
    return late.select("event_id", "product", "price")


# --- ordered log and splits ----------------------------------------------------------------


@query
def row_position(spark, sf_dir):
    log = relations.rating_log(spark, sf_dir)
    return add_position(log, "event_id").select("event_id", "pos")


@query
def user_ordinal(spark, sf_dir):
    log = relations.rating_log(spark, sf_dir)
    return splits.user_ordinal(log, "event_id").select("event_id", "userid", "ordinal")


@query
def capped_running_count(spark, sf_dir):
    log = relations.rating_log(spark, sf_dir)
    counted = splits.capped_running_count(log, FIRST, LAST, CAP, "event_id")
    return counted.select("event_id", "ordinal", "held")


@query
def route_rows(spark, sf_dir):
    log = relations.rating_log(spark, sf_dir)
    routed = splits.route_rows(log, FIRST, LAST, CAP, "event_id")
    return routed.select("event_id", "ordinal", F.col("held_out").cast("int").alias("held_out"))


@query
def split_leave_range(spark, sf_dir):
    log = relations.rating_log(spark, sf_dir)
    return splits.split_leave_range(log, FIRST, LAST, CAP, "event_id").drop("itemid")


@query
def slice_rows(spark, sf_dir):
    """Positions 100 to 699; only the order buckets that hold them are ranked."""
    found = splits.slice_log(relations.rating_log(spark, sf_dir), 100, 700, "event_id")
    return found.select("event_id", "pos", "value")


@query
def slice_text(spark, sf_dir):
    """The same positions of the log as text, read by a positional index of small byte ranges."""
    path = new_path(spark, "log")
    relations.rating_log(spark, sf_dir).orderBy("event_id").select("value").write.text(path)
    index = positions.index_lines(spark, path, range_bytes=1 << 16)
    return positions.read_positions(index, 100, 700)


@query
def sort_ratings(spark, sf_dir):
    log = relations.rating_log(spark, sf_dir)
    return splits.sorted_rating_position(log).select("sort_pos", "userid", "itemid", "value")


@query
def kfold_test(spark, sf_dir):
    fold = splits.kfold_test(relations.rating_log(spark, sf_dir), FOLD, FOLDS, "event_id")
    return splits.sorted_rating_position(fold).select("sort_pos", "fold", "pos", "value")


@query
def kfold_base(spark, sf_dir):
    rest = splits.kfold_base(relations.rating_log(spark, sf_dir), FOLD, FOLDS, "event_id")
    return splits.sorted_rating_position(rest).select("sort_pos", "fold", "pos", "value")


@query
def split_suite(spark, sf_dir):
    suite = splits.split_suite(
        relations.rating_log(spark, sf_dir), FOLDS, max_test=CAP, order_by="event_id"
    )
    marks = [F.col(c).cast("int").alias(c) for c in ("in_ua", "in_ub")]
    return suite.select("event_id", "pos", "fold", *marks)


@query
def read_rating_log(spark, sf_dir):
    """Write the log as text in order, then read it back with positions."""
    path = new_path(spark, "log")
    log = relations.rating_log(spark, sf_dir)
    log.orderBy("event_id").select("value").write.text(path)
    return text.read_rating_log(spark, path)


@query
def write_split(spark, sf_dir):
    """Write both parts as text, then read them back."""
    path = new_path(spark, "split")
    log = relations.rating_log(spark, sf_dir)
    split = splits.split_leave_range(log, FIRST, LAST, CAP, "event_id")
    sinks.write_split(split, path, "event_id")
    parts = [
        text.read_rating_log(spark, f"{path}/part={part}").withColumn("part", F.lit(part))
        for part in ("test", "base")
    ]
    return parts[0].unionByName(parts[1]).select("part", "pos", "value")


@query
def read_rating_logs(spark, sf_dir):
    """Two directories, one with a space in its name, read against the order of their names."""
    root = new_path(spark, "logs")
    log = relations.rating_log(spark, sf_dir)
    later, earlier = f"{root}/b late", f"{root}/a"
    odd = F.col("event_id") % 2 == 1
    for part, path in ((odd, later), (~odd, earlier)):
        log.filter(part).orderBy("event_id").select("value").write.text(path)
    return text.read_rating_log(spark, [later, earlier])


@query
def sorted_splits(spark, sf_dir):
    """Every fold and hold-out output, written sorted by user and item, with its line numbers."""
    path = new_path(spark, "sorted-splits")
    log = relations.rating_log(spark, sf_dir)
    suite = splits.split_suite(log, FOLDS, max_test=CAP, order_by="event_id")
    sinks.write_sorted_splits(suite, path, FOLDS)
    names = [f"u{k}" for k in range(1, FOLDS + 1)] + ["ua", "ub"]
    parts = [
        text.numbered_lines(spark, f"{path}/split={name}.{part}").withColumn(
            "split", F.lit(f"{name}.{part}")
        )
        for name in names
        for part in ("test", "base")
    ]
    return reduce(DataFrame.unionByName, parts).select("split", "pos", "value")


@query
def write_sorted(spark, sf_dir):
    """Write the log sorted by user and item, then read it back with line numbers."""
    path = new_path(spark, "sorted-text")
    sinks.write_sorted(relations.rating_log(spark, sf_dir), path)
    return text.numbered_lines(spark, path)


@query
def read_dimension(spark, sf_dir):
    """Nations written as ``name|id`` lines and read back."""
    path = new_path(spark, "dimension")
    nations = relations.table(spark, sf_dir, "nation")
    nations.select(F.concat_ws("|", "n_name", "n_nationkey").alias("value")).write.text(path)
    return text.read_dimension(spark, path, "name|id")


@query
def read_dimension_names(spark, sf_dir):
    """Region names, one on a line, with blank lines between."""
    path = new_path(spark, "names")
    names = relations.table(spark, sf_dir, "region").select(F.explode(F.array("r_name", F.lit(" "))).alias("value"))
    names.write.text(path)
    return text.read_dimension(spark, path, "name")


@query
def read_dimension_counts(spark, sf_dir):
    """``count label`` lines: suppliers per nation."""
    path = new_path(spark, "counts")
    suppliers = relations.table(spark, sf_dir, "supplier").groupBy("s_nationkey").count()
    nations = relations.table(spark, sf_dir, "nation")
    counted = nations.join(suppliers, nations["n_nationkey"] == suppliers["s_nationkey"])
    counted.select(F.concat_ws(" ", "count", F.concat("n_name", F.lit(" suppliers"))).alias("value")).write.text(path)
    return text.read_dimension(spark, path, "count label")


def _document_tree(spark: SparkSession, sf_dir: str) -> str:
    """Documents as one file each, in folders by language and source."""
    root = new_path(spark, "tree")
    docs = relations.table(spark, sf_dir, "documents")
    tree = docs.select(F.col("lang").alias("split"), F.col("source").alias("label"), "doc_id", "text")
    document_files.write_document_tree(tree, root)
    return root


def _read_back(found: DataFrame) -> DataFrame:
    return found.select(
        F.col("split").alias("lang"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


@query
def read_document_tree(spark, sf_dir):
    """Documents written as one file each and read back as whole files."""
    return _read_back(corpus.read_document_tree(spark, _document_tree(spark, sf_dir)))


@query
def read_document_files(spark, sf_dir):
    """The same, read by the data source that wrote them, packed into tasks by bytes."""
    return _read_back(document_files.read_document_files(spark, _document_tree(spark, sf_dir)))


# --- statistics ----------------------------------------------------------------------------


def _daily_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = relations.table(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    return chisquare.chisq_gof(events.select(day, "event_type"), ["day"], "event_type")


@query
def chisq_gof(spark, sf_dir):
    return rounded(_daily_tests(spark, sf_dir), 9, "statistic")


@query
def chisq_pvalue(spark, sf_dir):
    tests = chisquare.with_pvalue(_daily_tests(spark, sf_dir))
    return rounded(tests.select("day", "df", "p_value"), 9, "p_value")


@query
def chisq_pvalue_odd(spark, sf_dir):
    """Line status has two values, so one degree of freedom."""
    rows = relations.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linestatus")
    tests = chisquare.chisq_gof(rows, ["l_suppkey"], "l_linestatus")
    return rounded(chisquare.with_pvalue(tests), 9, "statistic", "p_value")


@query
def chisq_pvalue_df3(spark, sf_dir):
    """Four quarters of shipping, so three degrees of freedom: odd, and more than one."""
    rows = relations.table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.quarter("l_shipdate").alias("kind")
    )
    tests = chisquare.chisq_gof(rows, ["l_suppkey"], "kind", categories=4)
    return rounded(chisquare.with_pvalue(tests), 9, "statistic", "p_value")


@query
def chisq_gof_vectors(spark, sf_dir):
    """Quarterly order counts of each customer as an observed vector."""
    orders = relations.table(spark, sf_dir, "orders")
    quarters = [F.count(F.when(F.quarter("o_orderdate") == q, 1)).alias(f"q{q}") for q in range(1, 5)]
    counts = orders.groupBy("o_custkey").agg(*quarters)
    tests = chisquare.chisq_gof_vectors(
        counts.select("o_custkey", F.array("q1", "q2", "q3", "q4").alias("observed")), "observed"
    )
    return rounded(tests.drop("observed"), 9, "statistic")


@query
def chisq_verdict(spark, sf_dir):
    tests = chisquare.with_verdict(chisquare.with_pvalue(_daily_tests(spark, sf_dir)))
    return tests.select("day", "method", "null_hypothesis", "verdict")


@query
def row_matrix(spark, sf_dir):
    rows = columns.row_matrix(relations.measures(spark, sf_dir), MEASURES)
    cells = [F.get("features", F.lit(i)).alias(f"f{i}") for i in range(len(MEASURES))]
    return rows.select(F.size("features").cast("long").alias("n"), *cells)


@query
def matrix_shape(spark, sf_dir):
    return columns.matrix_shape(relations.embeddings(spark, sf_dir))


@query
def read_numeric_matrix(spark, sf_dir):
    """Embeddings written as comma-separated text, read back as a matrix; all its cells."""
    path = new_path(spark, "matrix")
    rows = relations.embeddings(spark, sf_dir).orderBy("row_id")
    rows.select(F.concat_ws(",", F.col("features").cast("array<string>"))).write.text(path)
    return matrices.matrix_cells(matrices.read_numeric_matrix(spark, path))


@query
def column_summary(spark, sf_dir):
    stats = columns.column_summary(relations.measures(spark, sf_dir), MEASURES)
    return significant(stats, 9, "mean", "variance", "l1", "l2")


@query
def column_summary_wide(spark, sf_dir):
    stats = columns.column_summary(relations.embeddings(spark, sf_dir), "features")
    return rounded(stats, 9, "max", "min", "mean", "variance", "l1", "l2")


@query
def column_dot(spark, sf_dir):
    return significant(columns.column_dot(relations.measures(spark, sf_dir), MEASURES), 9, "value")


@query
def gramian(spark, sf_dir):
    return significant(columns.gramian(relations.measures(spark, sf_dir), MEASURES), 9, "value")


@query
def gramian_wide(spark, sf_dir):
    return rounded(columns.gramian(relations.embeddings(spark, sf_dir), "features"), 8, "value")


@query
def covariance(spark, sf_dir):
    return rounded(columns.covariance(relations.measures(spark, sf_dir), MEASURES), 4, "value")


@query
def covariance_wide(spark, sf_dir):
    return rounded(columns.covariance(relations.embeddings(spark, sf_dir), "features"), 9, "value")


@query
def column_cosine(spark, sf_dir):
    return rounded(columns.column_cosine(relations.measures(spark, sf_dir), MEASURES), 9, "value")


@query
def column_cosine_wide(spark, sf_dir):
    cosines = columns.column_cosine(relations.embeddings(spark, sf_dir), "features")
    return rounded(cosines, 9, "value")


@query
def column_cosine_threshold(spark, sf_dir):
    measures = relations.measures(spark, sf_dir)
    return rounded(columns.column_cosine_sampled(measures, MEASURES, 0.75), 9, "value")


def _mixed_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measures, and two columns about a middle value: cosines from about 0 to 1. Rows have ids."""
    rows = relations.table(spark, sf_dir, "lineitem")
    return rows.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"),
        *MEASURES,
        (F.col("l_quantity") - 25.5).alias("about_quantity"),
        (F.col("l_discount") - 0.05).alias("about_discount"),
    )


@query
def column_cosine_sampled(spark, sf_dir):
    """Sampled cosines of six columns, of which some are orthogonal and some nearly alike.

    Which products are sampled follows from row ids, so SQL repeats the sample.
    """
    rows = _mixed_measures(spark, sf_dir)
    return rounded(columns.column_cosine_seeded(rows, rows.columns[1:], "row_id", 0.1, seed=3), 9, "value")


@query
def gramian_blocks(spark, sf_dir):
    """The Gramian of 8,192 columns made from pairs of embedding entries; a fixed set of its entries.

    Column 64 k + c is entry c times entry c + k for k below 64, and their difference from there on.
    All entries are computed; the query shows every pair of columns that are multiples of 509.
    """
    rows = relations.embeddings(spark, sf_dir)

    def turned(k: int) -> Column:
        return F.concat(F.slice("features", k + 1, 64 - k), F.slice("features", 1, k)) if k else F.col("features")

    products = [F.zip_with("features", turned(k), lambda x, y: x * y) for k in range(64)]
    differences = [F.zip_with("features", turned(k), lambda x, y: x - y) for k in range(64)]
    cells = F.concat(*products, *differences)
    wide = rows.repartition("row_id").select(cells.alias("features"))
    found = columns.gramian(wide, "features")
    return rounded(found.filter("i % 509 = 0 and j % 509 = 0"), 9, "value")


# --- decompositions ------------------------------------------------------------------------


def _scaled_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns brought to similar size."""
    return relations.measures(spark, sf_dir).select(
        (F.col("l_quantity") / 50).alias("x"), (F.col("l_extendedprice") / 100000).alias("y")
    )


@query
def principal_components(spark, sf_dir):
    """Both components of two columns, which have a closed form."""
    found = decomposition.principal_components(_scaled_pair(spark, sf_dir), ["x", "y"], 2)
    return rounded(found, 6, "value", "explained")


@query
def principal_components_wide(spark, sf_dir):
    """Shares of variance of all 64 components: they add up to 1, in falling order."""
    found = decomposition.principal_components(relations.embeddings(spark, sf_dir), "features", 64)
    per = found.groupBy("component").agg(
        F.sum(F.col("value") * F.col("value")).alias("norm"), F.max("explained").alias("explained")
    )
    checks = per.agg(
        F.count("*").alias("components"),
        F.sum("norm").alias("squared_entries"),
        F.sum("explained").alias("explained"),
        F.sum(F.col("explained") * F.col("explained")).alias("squared_shares"),
    )
    return rounded(checks, 8, "squared_entries", "explained", "squared_shares")


@query
def svd(spark, sf_dir):
    """Singular values and right vectors of two columns, which have a closed form."""
    pair = _scaled_pair(spark, sf_dir)
    found = decomposition.svd(pair, ["x", "y"], 2)
    values = found.spectrum(pair).withColumnRenamed("k", "component")
    both = found.right_vectors(pair).join(values, "component")
    return rounded(both, 6, "value", "sigma")


@query
def svd_small_values(spark, sf_dir):
    """Two columns that differ by a ten-billionth of a third: the second singular value shows it.

    Leading digits and magnitude of both values; those of the smaller one are lost in a Gramian.
    """
    pair = _scaled_pair(spark, sf_dir).select("x", (F.col("x") + 1e-10 * F.col("y")).alias("z"))
    spectrum = decomposition.svd_tall(pair, ["x", "z"], 2).spectrum(pair)
    return significant(spectrum, 4, "sigma")


def _scaled_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four measures, brought to similar size."""
    scales = {"l_quantity": 50, "l_extendedprice": 100_000, "l_discount": 0.1, "l_tax": 0.08}
    rows = relations.measures(spark, sf_dir)
    return rows.select(*[(F.col(c) / F.lit(x)).alias(c) for c, x in scales.items()])


def _eigen_residuals(entries: DataFrame, symmetric: DataFrame, rank: str) -> DataFrame:
    """Matrix times vector minus value times vector, per entry; and the vectors' lengths.

    ``entries`` has (i, ``rank``, value, eigenvalue), ``symmetric`` (i, j, cell).
    """
    product = (
        symmetric.join(entries.select(F.col("i").alias("j"), rank, F.col("value").alias("x")), "j")
        .groupBy("i", rank)
        .agg(F.sum(F.col("cell") * F.col("x")).alias("moved"))
    )
    lengths = entries.groupBy(rank).agg(F.sum(F.col("value") * F.col("value")).alias("length"))
    left = F.col("moved") - F.col("eigenvalue") * F.col("value")
    both = entries.join(product, ["i", rank]).join(lengths, rank)
    return rounded(both.select("i", rank, (left / F.col("eigenvalue")).alias("residual"), "length"), 6, "residual", "length")


@query
def principal_components_measures(spark, sf_dir):
    """Three components of all four measures: eigenvectors of their covariance."""
    rows = _scaled_measures(spark, sf_dir)
    found = decomposition.principal_components(rows, MEASURES, 3)
    cells = columns.covariance(rows, MEASURES).withColumnRenamed("value", "cell")
    trace = cells.filter("i = j").agg(F.sum("cell")).scalar()
    found = found.withColumn("eigenvalue", F.col("explained") * trace)
    shares = found.groupBy("component").agg(F.max("explained").alias("explained"))
    order = F.coalesce(F.lag("explained").over(W.orderBy("component")), F.lit(1.0))
    falling = shares.select("component", (F.col("explained") <= order).alias("falling"))
    return _eigen_residuals(found, cells, "component").join(falling, "component")


@query
def svd_measures(spark, sf_dir):
    """All four singular values of the measures: right vectors of A, so of A'A with sigma squared."""
    rows = _scaled_measures(spark, sf_dir)
    found = decomposition.svd(rows, MEASURES, 4)
    spectrum = found.spectrum(rows).withColumnRenamed("k", "component")
    entries = found.right_vectors(rows).join(spectrum, "component")
    entries = entries.withColumn("eigenvalue", F.col("sigma") * F.col("sigma"))
    cells = columns.gramian(rows, MEASURES).withColumnRenamed("value", "cell")
    energy = cells.filter("i = j").agg(F.sum("cell").alias("e"))
    total = spectrum.agg(F.sum(F.col("sigma") * F.col("sigma")).alias("t"))
    share = F.round(total.scalar() / energy.scalar(), 9)
    return _eigen_residuals(entries, cells, "component").withColumn("energy", share)


@query
def svd_energy(spark, sf_dir):
    """At full rank the squared singular values add up to the squared entries."""
    rows = relations.embeddings(spark, sf_dir)
    spectrum = decomposition.svd(rows, "features", 64).spectrum(rows)
    energy = spectrum.agg(
        F.count("*").alias("n_values"), F.sum(F.col("sigma") * F.col("sigma")).alias("energy")
    )
    return rounded(energy, 6, "energy")


@query
def svd_left_rows(spark, sf_dir):
    """Left vectors of the embeddings: their products with each other are 0 or 1."""
    rows = relations.embeddings(spark, sf_dir)
    left = decomposition.svd_left(rows, "row_id", "features", decomposition.svd(rows, "features", 4))
    return rounded(columns.gramian(left, "left"), 6, "value")


@query
def svd_reconstruction(spark, sf_dir):
    """All left vectors times singular values and right vectors give the embeddings back."""
    rows = relations.embeddings(spark, sf_dir)
    found = decomposition.svd(rows, "features", 64)
    left = decomposition.svd_left(rows, "row_id", "features", found)
    back = decomposition.svd_reconstructed(left, "row_id", found)
    cells = back.select("row_id", F.posexplode("features").alias("i", "value"))
    return rounded(cells.withColumn("i", F.col("i").cast("long")), 6, "value")


@query
def cumulative_spectrum(spark, sf_dir):
    """Running sum over the column norms of the embeddings."""
    norms = columns.column_summary(relations.embeddings(spark, sf_dir), "features")
    spectrum = norms.select(F.col("i").alias("k"), F.col("l2").alias("sigma"))
    return rounded(
        decomposition.cumulative_spectrum(spectrum), 8, "sigma", "cumulative", "share"
    )


@query
def component_grid(spark, sf_dir):
    """Each embedding as a column of 64 numbers, laid out 8 x 8."""
    cells = relations.embeddings(spark, sf_dir).select(
        F.col("row_id").alias("component"), F.posexplode("features").alias("row_id", "value")
    )
    cells = cells.withColumn("row_id", F.col("row_id").cast("long"))
    return decomposition.component_grid(cells, 8, 8)


# --- collaborative filtering ---------------------------------------------------------------


@query
def item_similarity(spark, sf_dir):
    return rounded(similarity.item_similarity(relations.ratings(spark, sf_dir)), 9, "similar")


@query
def similarity_size(spark, sf_dir):
    pairs = similarity.item_similarity(relations.ratings(spark, sf_dir))
    return pairs.agg(F.count("*").alias("pairs"))


@query
def item_recommend(spark, sf_dir):
    ratings = relations.ratings(spark, sf_dir)
    sim = similarity.item_similarity(ratings)
    return rounded(recommend.item_recommend(sim, ratings), 6, "pref")


@query
def recommend_topn(spark, sf_dir):
    """The 30 best-rated items of each user."""
    rated = similarity.average_ratings(relations.ratings(spark, sf_dir))
    return rounded(recommend.recommend_topn(rated, 30), 6, "pref")


@query
def recommendation_size(spark, sf_dir):
    found = itemcf.itemcf(relations.ratings(spark, sf_dir))
    return found.agg(F.count("*").alias("recommendations"))


@query
def itemcf_from_lines(spark, sf_dir):
    """From rating lines; user and item ids stay strings, also in the order of equals."""
    return rounded(itemcf.itemcf_from_lines(_rating_lines(spark, sf_dir)), 6, "pref")
