"""Reader for a corpus of one text file per document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_document_tree(spark: SparkSession, path: str) -> DataFrame:
    """``.../<split>/<label>/<doc_id>`` files as ``(split, label, doc_id, text)``.

    File names repeat across directories: the key is all three, as they are on disk. Spark's
    listing passes over empty files; ``document_files.read_document_files`` reads them. Small files are packed into
    tasks by Spark (``spark.sql.files.maxPartitionBytes`` and ``openCostInBytes``).
    """
    parts = F.split(F.col("_metadata.file_path"), "/")

    def from_end(n: int):
        return F.url_decode(F.replace(F.element_at(parts, -n), F.lit("+"), F.lit("%2B")))

    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return files.select(
        from_end(3).alias("split"),
        from_end(2).alias("label"),
        from_end(1).alias("doc_id"),
        F.col("value").alias("text"),
    )
