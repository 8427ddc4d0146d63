"""Repeated passages by overlapping windows of three lines, in DataFrame functions only.

A line counts if it has a character other than a space or tab; the others stay where they
are and belong to no window. Every three consecutive lines of a document are a window. Its
first occurrence, in order of ``doc_id`` and then of place, stays; lines covered by any
later occurrence are removed, with the blank lines between them. Windows are judged on the input, not on what is left.

Null texts have no lines and stay null, texts of fewer than three lines have no window. Rows
with a null id count as the last ones. Rows with equal ids are told apart by place alone:
a window that stands further on than its first occurrence is a later one, also when another
row holds that first one. At equal ids and equal places nothing says which row comes first,
so they all stay, and the same row twice loses nothing to its repetition. Any text is one
row, at any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.rows import quoted, row_key, unused
from millrace.storage import materialize

WIDTH = 3


def _counted(lines: Column) -> Column:
    """Places of the lines that count."""
    placed = F.transform(lines, lambda line, i: F.when(F.trim(F.translate(line, "\t\r", "")) != "", i))
    return F.filter(placed, lambda i: i.isNotNull())


def line_windows(docs: DataFrame) -> DataFrame:
    """``doc, key, nth, a, b``: each window's row, its number in the text, 128 bits of hash."""
    lines = F.split("text", "\n", -1)
    hashed = docs.filter(F.col("text").isNotNull()).select(
        *row_key("doc", "key"),
        F.filter(lines, lambda line: F.trim(F.translate(line, "\t\r", "")) != "").alias("lines"),
    )
    starts = F.sequence(F.lit(0), F.size("lines") - WIDTH)

    def window(i: Column) -> Column:
        three = [F.get("lines", i + k) for k in range(WIDTH)]
        # the second half hashes the same lines behind a prefix, so its bits are independent
        return F.struct(
            i.alias("nth"),
            F.xxhash64(*three).alias("a"),
            F.xxhash64(F.lit("second"), *three).alias("b"),
        )

    return (
        hashed.filter(F.size("lines") >= WIDTH)
        .select("doc", "key", F.explode(F.transform(starts, window)).alias("w"))
        .select("doc", "key", "w.nth", "w.a", "w.b")
    )


def later_windows(docs: DataFrame) -> DataFrame:
    """``doc, key, starts``: per row, the sorted numbers of its windows that occurred before."""
    windows = line_windows(docs)
    place = F.struct("doc", "nth")
    # stored, so that the windows of a passage that very many texts share can be split in the join
    repeated = materialize(
        windows.groupBy("a", "b")
        .agg(F.count("*").alias("n"), F.min(place).alias("first"))
        .filter("n > 1")
        .select("a", "b", "first"),
        "repeated-lines",
    )
    later = windows.join(repeated, ["a", "b"]).filter(place > F.col("first"))
    return later.groupBy("doc", "key").agg(F.array_sort(F.collect_set("nth")).alias("starts"))


def with_kept_lines(docs: DataFrame, kept: str, removed: str) -> DataFrame:
    """``docs`` with the text that is left as ``kept`` and the number of removed lines.

    Covered windows merge in order: between one and the next stay the lines from the end of
    the first to the start of the second, and so only slices are copied.
    """
    doc, key, starts, lines, at, cuts = (
        unused(docs, n) for n in ("doc", "key", "starts", "lines", "at", "cuts")
    )
    found = later_windows(docs.select("doc_id", "text")).toDF(doc, key, starts)
    joined = docs.select("*", *row_key(doc, key)).join(found, [doc, key], "left")
    cut = (
        joined.withColumn(lines, F.split("text", "\n", -1))
        .withColumn(at, F.when(F.col(starts).isNotNull(), _counted(F.col(lines))))
        # the first and the last line of each window, as places among all lines
        .withColumn(
            cuts,
            F.concat(
                F.array(F.struct(F.lit(-1).alias("from"), F.lit(-1).alias("to"))),
                F.transform(
                    starts,
                    lambda s: F.struct(
                        F.get(at, s).alias("from"), F.get(at, s + WIDTH - 1).alias("to")
                    ),
                ),
                F.array(
                    F.struct(F.size(lines).alias("from"), F.size(lines).alias("to"))
                ),
            ),
        )
    )
    between = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.size(cuts) - 1),
            lambda i: F.slice(
                lines,
                F.get(cuts, i - 1)["to"] + 2,
                F.greatest(F.lit(0), F.get(cuts, i)["from"] - F.get(cuts, i - 1)["to"] - 1),
            ),
        )
    )
    left = cut.withColumn(cuts, F.when(F.col(starts).isNotNull(), between).otherwise(F.col(lines)))
    return (
        left.withColumn(removed, (F.size(lines) - F.size(cuts)).cast("long"))
        .withColumn(kept, F.when(F.col("text").isNotNull(), F.array_join(cuts, "\n")))
        .drop(doc, key, starts, lines, at, cuts)
    )


def line_dedup_report(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_lines, n_removed, kept_sha256``; lines are cut at line feeds."""
    rows = with_kept_lines(docs.select("doc_id", "text"), "kept", "n_removed")
    has = F.col("text").isNotNull()
    return rows.select(
        "doc_id",
        F.when(has, F.size(F.split("text", "\n", -1))).otherwise(0).cast("long").alias("n_lines"),
        F.when(has, F.col("n_removed")).otherwise(0).cast("long").alias("n_removed"),
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"),
    )


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with what is left of each text; ``n_chars``, if there, follows it."""
    kept, removed = unused(docs, "kept"), unused(docs, "removed")
    rows = with_kept_lines(docs, kept, removed).withColumn("text", F.col(kept))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select([quoted(c) for c in docs.columns])
