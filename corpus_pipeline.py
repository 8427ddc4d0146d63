"""From raw documents to token ids: five stages, each written and read again by the next.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of ``documents``.
Null or empty texts, and an empty table, go through every stage as its operator defines.
"""

from __future__ import annotations

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import byte_bpe, decontamination, line_dedup, quality, simhash
from millrace.llm.rows import bound_batches, read
from millrace.shipping import ship_by_value
from millrace.storage import discard, store

ship_by_value()  # executors need not have this package

VOCABULARY = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove bad lines; rejected documents go."""
    bound_batches(spark)
    return quality.clean_documents(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove later occurrences of three-line passages; every document stays."""
    bound_batches(spark)
    return line_dedup.drop_repeated_lines(docs)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    bound_batches(spark)
    return simhash.keep_one_each(docs, width=4, distance=4, seed=42)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    bound_batches(spark)
    return decontamination.drop_contaminated(docs, read(spark, sf_dir, "benchmark"), width=10)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the text decoded from them."""
    bound_batches(spark)
    return byte_bpe.round_trip(docs, path(VOCABULARY), with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_deduplication", line_deduplication),
    ("near_deduplication", near_deduplication),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: Fingerprints, BPE and the line rules are not SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what one stage wrote is deleted when the next has read it."""
    docs, written = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path_ = store(stage(spark, docs, sf_dir), name)
        docs, done, written = spark.read.parquet(path_), written, path_
        if done:
            discard(spark, done)
    return STAGES[-1][1](spark, docs, sf_dir)
