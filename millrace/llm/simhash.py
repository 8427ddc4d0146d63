"""SimHash near-duplicates by multi-index hashing.

A fingerprint takes, bit by bit, the majority of the 64-bit hashes of a text's shingles.
Equal fingerprints collapse first. Two different ones at ``distance`` or fewer bits agree,
by the pigeonhole principle, within few bits on one of the segments; so each fingerprint
enumerates that small Hamming ball in each segment, the segment tables are joined on the exact
value, and the join itself keeps only pairs whose complete distance fits.

Null and empty texts have the fingerprint zero, which links like any other. Texts are
hashed whole. Repeated rows share their fingerprint. A null id is never a component's
smallest id unless the component has no other, then the component id is null. An empty
table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import connected_components
from millrace.llm.rows import LAST_ID, row_key, texts, unused
from millrace.storage import materialize

BITS = 64

#: Hashes counted at once in a long text.
BLOCK = 1 << 16

#: Ways to cut fingerprints, from few probes against short values to many against long ones.
SEGMENTS = (3, 2)


def shingle_hashes(text: bytes, width: int, seed: int) -> np.ndarray:
    """XXH64 of every shingle; the whole sequence is the shingle of a shorter text."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    begins = (ends + 1 - sizes)[: 1 - width]
    digest = xxhash.xxh64_intdigest
    hashes = [
        digest(joined[a:b], seed)
        for a, b in zip(begins.tolist(), ends[width - 1 :].tolist(), strict=True)
    ]
    return np.array(hashes, np.uint64)


def fingerprint(text: bytes, width: int, seed: int) -> int:
    hashes = shingle_hashes(text, width, seed)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), BLOCK):
        rows = hashes[i : i + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(majority.view("<i8")[0])


def simhash(width: int = 4, seed: int = 42) -> Column:
    """Function of a text column: the fingerprint as a signed long."""

    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in batches:
            yield pa.array([fingerprint(t, width, seed) for t in texts(array)], pa.int64())

    return of


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def segment_balls(segments: int, distance: int) -> list[tuple[int, list[int]]]:
    """Per segment: its bit mask, and the patterns to flip in it.

    With distance = segments * r + rest, two fingerprints in reach differ in at most r bits on
    one of the first rest + 1 segments, or in at most r - 1 bits on one of the others.
    """
    radius, rest = divmod(distance, segments)
    bounds = [BITS * i // segments for i in range(segments + 1)]
    balls = []
    for i in range(segments):
        bits = range(bounds[i], bounds[i + 1])
        reach = radius if i <= rest else radius - 1
        flips = [
            _signed(sum(1 << b for b in chosen))
            for size in range(reach + 1)
            for chosen in combinations(bits, size)
        ]
        if flips:
            balls.append((_signed(sum(1 << b for b in bits)), flips))
    return balls


def choose_segments(prints: DataFrame, distance: int) -> int:
    """The cut of distinct fingerprints with the least probes and candidates; all find the same pairs.

    A probe meets the fingerprints that share a segment's value: on average the sum of squared
    counts of the values over their number, which is measured. More probes than the
    next cut has even without candidates mean that the next is looked at.
    """
    costs = {}
    for segments in SEGMENTS:
        balls = segment_balls(segments, distance)
        if costs and min(costs.values()) <= sum(len(flips) for _, flips in balls):
            break
        parts = [F.struct(F.lit(i).alias("segment"), F.col("fingerprint").bitwiseAND(F.lit(mask)).alias("value")) for i, (mask, _) in enumerate(balls)]
        counts = prints.select(F.inline(F.array(*parts))).groupBy("segment", "value").agg(F.count("*").cast("double").alias("c"))
        loads = dict(counts.groupBy("segment").agg(F.sum(F.col("c") * F.col("c")) / F.sum("c")).collect())
        costs[segments] = sum(len(flips) * (1 + loads.get(i, 0.0)) for i, (_, flips) in enumerate(balls))
    return min(costs, key=costs.get)


def fingerprint_links(prints: DataFrame, distance: int, segments: int) -> DataFrame:
    """``a, b``: all pairs of different fingerprints (``fingerprint``, distinct) within reach."""
    balls = segment_balls(segments, distance)

    def entry(i: int, value: Column) -> Column:
        return F.struct(F.lit(i).alias("segment"), value.alias("value"))

    value = F.col("fingerprint")
    table = prints.select(
        value.alias("b"),
        F.explode(
            F.array(*[entry(i, value.bitwiseAND(F.lit(mask))) for i, (mask, _) in enumerate(balls)])
        ).alias("at"),
    ).select("b", "at.segment", "at.value")

    def ball(i: int, mask: int, flips: list[int]) -> Column:
        part = value.bitwiseAND(F.lit(mask))
        flips = F.array(*[F.lit(f).cast("long") for f in flips])
        return F.transform(flips, lambda flip: entry(i, part.bitwiseXOR(flip)))

    probes = prints.select(
        value.alias("a"),
        F.explode(F.concat(*[ball(i, mask, flips) for i, (mask, flips) in enumerate(balls)])).alias("at"),
    ).select("a", "at.segment", "at.value")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    same = (F.col("p.segment") == F.col("t.segment")) & (F.col("p.value") == F.col("t.value"))
    return probes.alias("p").join(table.alias("t"), same & near).select("a", "b").distinct()


def labelled(
    docs: DataFrame, width: int, distance: int, seed: int, segments: int | None = None
) -> DataFrame:
    """``doc_id, key, fingerprint, root, component_id`` of every row; ``key`` hashes its text."""
    prints = materialize(
        docs.select(
            "doc_id",
            F.xxhash64("text").alias("key"),
            simhash(width, seed)("text").alias("fingerprint"),
        ),
        "fingerprints",
    )
    firsts = materialize(
        prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct-fingerprints"
    )
    if segments is None:
        segments = choose_segments(firsts, distance)
    links = fingerprint_links(firsts.select("fingerprint"), distance, segments)
    parts = connected_components(links)
    # the smallest id of a component, from one row for each fingerprint that has a link
    linked = parts.join(firsts, parts["node"] == firsts["fingerprint"]).select("node", "root", "first")
    smallest = materialize(linked.groupBy("root").agg(F.min("first").alias("smallest")), "smallest")
    alone = F.col("node").isNull()
    labels = materialize(
        firsts.join(linked.drop("first").join(smallest, "root"), F.col("fingerprint") == F.col("node"), "left")
        .select(
            F.col("fingerprint").alias("print"),
            F.when(alone, F.col("fingerprint")).otherwise(F.col("root")).alias("root"),
            F.when(alone, F.col("first")).otherwise(F.col("smallest")).alias("component_id"),
        ),
        "components",
    )
    return prints.join(labels, prints["fingerprint"] == labels["print"]).drop("print")


def near_duplicates(
    docs: DataFrame, width: int = 4, distance: int = 4, seed: int = 42, segments: int | None = None
) -> DataFrame:
    """``doc_id, fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row.

    The component id is the smallest id among all documents that links lead to.
    """
    return labelled(docs, width, distance, seed, segments).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), BITS // 4, "0").alias("fingerprint"),
        "component_id",
    )


def keep_one_each(docs: DataFrame, width: int = 4, distance: int = 4, seed: int = 42) -> DataFrame:
    """One row of each component, with all its columns.

    It has the component's smallest id (a null id counts as the last), then the smallest text
    hash; of rows with equal id and text any one stays. Such rows meet before the shuffle.
    """
    doc, key = unused(docs, "doc"), unused(docs, "key")
    members = labelled(docs, width, distance, seed)
    place = F.struct(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"), F.col("key")
    )
    stay = members.groupBy("root").agg(F.min(place).alias("one"))
    stay = stay.select(F.col("one.doc").alias(doc), F.col("one.key").alias(key))
    rows = docs.select("*", *row_key(doc, key)).dropDuplicates([doc, key])
    return rows.join(stay, [doc, key], "left_semi").drop(doc, key)
