"""Purchase figures over event-time windows of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def windowed_purchase_summary(
    events: DataFrame, window: str = "1 day", delay: str = "1 hour"
) -> DataFrame:
    """Purchases and revenue per tumbling window and product.

    ``events`` has ``(ts, product, price)``; rows later than ``delay`` are dropped once their
    window is closed, and in append mode a window is emitted when it closes. State is one
    row per open window and product, whatever the number of events.
    """
    return (
        events.withWatermark("ts", delay)
        .groupBy(F.window("ts", window).alias("w"), "product")
        .agg(F.count("*").alias("purchases"), F.sum("price").alias("revenue"))
        .select(F.col("w.start").alias("window_start"), "product", "purchases", "revenue")
    )


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything that has arrived into Parquet files, then stop."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def accumulate_windows(
    events: DataFrame, path: str, checkpoint: str, window: str = "1 day", delay: str = "1 hour"
) -> None:
    """Process everything that has arrived: sums per window and product, and the late rows, by batch.

    ``events`` is a stream of ``(ts, product, price)`` and any other columns. A row is late if its window ended
    ``delay`` or more before the greatest time of earlier batches; Spark's own watermark lags by a batch
    more and keeps no late rows. Under ``path``, ``seen`` has each batch's greatest time, ``late`` its late
    rows and ``sums`` what its other rows add to each window. A batch that runs again replaces its own
    tables, and the checkpoint says which batch is next, so a run that was killed anywhere goes on
    without loss or repetition. Open windows are there too, also the last.
    """

    def put(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        rows.agg(F.max("ts").alias("ts")).write.mode("overwrite").parquet(f"{path}/seen/batch={batch}")
        seen = spark.read.schema("ts timestamp, batch long").parquet(f"{path}/seen").filter(F.col("batch") < batch)
        closed = seen.agg((F.max("ts") - F.expr(f"interval {delay}")).alias("closed")).first()[0]
        late = F.coalesce(F.window("ts", window)["end"] <= F.lit(closed), F.lit(False))
        marked = rows.withColumn("_late", late)
        marked.filter("_late").drop("_late").write.mode("overwrite").parquet(f"{path}/late/batch={batch}")
        sums = (
            marked.filter("not _late")
            .groupBy(F.window("ts", window)["start"].alias("window_start"), "product")
            .agg(F.count("*").alias("purchases"), F.sum("price").alias("revenue"))
        )
        sums.write.mode("overwrite").parquet(f"{path}/sums/batch={batch}")

    (
        events.writeStream.foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def current_windows(spark: SparkSession, path: str) -> DataFrame:
    """Purchases and revenue of every window and product that :func:`accumulate_windows` has seen."""
    sums = spark.read.parquet(f"{path}/sums")
    return sums.groupBy("window_start", "product").agg(
        F.sum("purchases").alias("purchases"), F.sum("revenue").alias("revenue")
    )
