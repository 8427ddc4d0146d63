"""Shared-storage helpers for results that several later jobs read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_made: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, or else the session's warehouse folder.

    Both are the application's own choice of a place that the driver and all executors reach; on a
    cluster one of them must be set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = (configured or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    chosen = configured or spark.sparkContext.getConf().contains("spark.sql.warehouse.dir")
    if not chosen and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir: the default warehouse is a folder of the driver's machine")
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """Unused path under the shared folder; ``discard_all`` deletes what was written there."""
    path = f"{shared_dir(spark)}/millrace/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def store(df: DataFrame, label: str) -> str:
    """Write ``df`` once to shared storage; returns the path."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Cuts the lineage, so a lost executor costs a re-read instead of a recomputation, and
    gives the planner exact sizes, column pruning and a row count from file footers.
    """
    return df.sparkSession.read.schema(df.schema).parquet(store(df, label))


def discard(spark: SparkSession, path: str) -> None:
    """Delete a path made by ``new_path``; a path that was never written is fine."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    made = _made.get(spark.sparkContext.applicationId, [])
    if path in made:
        made.remove(path)


def discard_all(spark: SparkSession) -> None:
    """Delete everything this application stored; results that read it must be done with.

    Results of the library read stored tables until they are computed, so nothing is deleted behind
    them: an application that runs for long calls this between its jobs.
    """
    for path in list(_made.get(spark.sparkContext.applicationId, [])):
        discard(spark, path)
