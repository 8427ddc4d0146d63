"""URL verdicts: explicit rules, and a Bloom filter cascade for a list of keys.

The first filter of a cascade holds the listed keys, the second the other keys of the
universe that pass the first, the third the listed keys that pass the second, and so on until
no key passes wrongly. Over the universe it was built for, membership is exact, and
a row is judged by hashing its key. To build it, the hashes of all keys are grouped once, which tells
listed keys from others; nothing is joined.

Keys are dealt by hash into blocks of at most ``block_keys`` listed keys, so that the filters
a task holds have a fixed bound. Each block of rows is judged on its own; with one block
that is a single scan.

A null url, or one without ``://``, has an empty host and path, hence the empty key, which is a
key like any other. Repeated rows get equal verdicts, keys may repeat in the list, an empty
list blocks nothing and an empty table stays empty. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.repeats import mix
from millrace.llm.rows import unused
from millrace.storage import discard, materialize, new_path, store

#: Listed keys of one block; with some ten bits a key its filters take a few megabytes.
BLOCK_KEYS = 4_000_000

#: Once no more keys than this are left, the remaining levels are built on the driver.
TAIL_KEYS = 200_000

_LEVELS = 200  # far beyond any cascade: sets halve from level to level
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path, both empty where the url has none."""
    pattern = r"^[\s\S]*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), _UPPER, _UPPER.lower())
    path = F.regexp_extract(url, pattern, 2)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest rule (``host/path``) that fits, or null: subdomains and deeper paths fit."""

    def fits(rule: str) -> Column:
        name, slash, rest = rule.partition("/")
        return ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)

    ordered = sorted(set(rules), key=lambda rule: (-len(rule), rule))
    return F.coalesce(*[F.when(fits(r), F.lit(r)) for r in ordered], F.lit(None).cast("string"))


class Bloom:
    """Bits of one filter and how many of them a key sets."""

    def __init__(self, bits: int, hashes: int, words: np.ndarray | None = None):
        self.bits, self.hashes, self.words = bits, hashes, words

    @staticmethod
    def sized(keys: int, share: float) -> Bloom:
        """For so many keys, with about this share of other keys passing."""
        share = min(max(share, 1e-9), 0.5)
        bits = max(64, math.ceil(-keys * math.log(share) / math.log(2) ** 2))
        return Bloom(-(-bits // 64) * 64, max(1, round(-math.log2(share))))

    def places(self, level: int, a: np.ndarray, b: np.ndarray) -> Iterator[np.ndarray]:
        first, step = mix(a, 2 * level + 1), mix(b, 2 * level + 2) | np.uint64(1)
        for i in range(self.hashes):
            yield (first + np.uint64(i) * step) % np.uint64(self.bits)

    def passes(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        ok = np.ones(len(a), bool)
        for place in self.places(level, a, b):
            ok &= (self.words[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        return ok


def _unsigned(array: pa.Array) -> np.ndarray:
    return array.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _passes(filter_: Bloom, level: int) -> Column:
    """Whether the key with hashes ``a, b`` passes one filter."""

    @F.arrow_udf("boolean")
    def passes(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in batches:
            yield pa.array(filter_.passes(level, _unsigned(a), _unsigned(b)))

    return passes("a", "b")


def _filled(keys: DataFrame, count: int, share: float, level: int) -> Bloom:
    """A filter of the keys; the words are put together before they reach the driver."""
    empty = Bloom.sized(count, share)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(empty.bits // 64, np.uint64)
        for batch in batches:
            a, b = (_unsigned(batch.column(c)) for c in ("a", "b"))
            for place in empty.places(level, a, b):
                np.bitwise_or.at(own, place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63)))
        used = np.flatnonzero(own)
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array(used), "bits": pa.array(own[used].view(np.int64))}
        )

    whole = keys.select("a", "b").mapInArrow(words, "word long, bits long")
    rows = whole.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    empty.words = np.zeros(empty.bits // 64, np.uint64)
    empty.words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return empty


def build_cascade(listed: DataFrame, others: DataFrame) -> list[Bloom]:
    """Filters that tell apart two disjoint sets of keys, given by their hashes ``a, b``."""
    spark = listed.sparkSession
    sets = [store(listed, "cascade"), store(others, "cascade")]
    sizes = [spark.read.parquet(path).count() for path in sets]
    filters: list[Bloom] = []
    while sizes[0]:
        level = len(filters)
        if sum(sizes) <= TAIL_KEYS:
            filters += _tail([spark.read.parquet(path) for path in sets], level)
            break
        if level > _LEVELS:
            raise RuntimeError("two different keys share both of their hashes")
        share = 0.5 * sizes[0] / max(1, sizes[1]) if level == 0 else 0.5
        filters.append(_filled(spark.read.parquet(sets[0]), sizes[0], share, level))
        wrong = spark.read.parquet(sets[1]).filter(_passes(filters[-1], level))
        path = store(wrong, "cascade")
        discard(spark, sets[1])
        # those that pass wrongly are encoded next; the keys just encoded are what may pass there
        sets = [path, sets[0]]
        sizes = [spark.read.parquet(path).count(), sizes[0]]
    for path in sets:
        discard(spark, path)
    return filters


def _tail(sets: list[DataFrame], level: int) -> list[Bloom]:
    """The rest of a cascade, from at most ``TAIL_KEYS`` keys: the same filters, without jobs."""
    tables = [keys.select("a", "b").toArrow() for keys in sets]
    (a, b), (c, d) = ((_unsigned(t["a"]), _unsigned(t["b"])) for t in tables)
    filters: list[Bloom] = []
    while len(a):
        if level > _LEVELS:
            raise RuntimeError("two different keys share both of their hashes")
        share = 0.5 * len(a) / max(1, len(c)) if level == 0 else 0.5
        filter_ = Bloom.sized(len(a), share)
        filter_.words = np.zeros(filter_.bits // 64, np.uint64)
        for place in filter_.places(level, a, b):
            np.bitwise_or.at(filter_.words, place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63)))
        filters.append(filter_)
        wrong = filter_.passes(level, c, d)
        a, b, c, d = c[wrong], d[wrong], a, b
        level += 1
    return filters


def in_cascade(filters: list[Bloom], a: str, b: str) -> Column:
    """Whether the key with these hashes is listed: it is if a filter of other keys drops it."""

    @F.arrow_udf("boolean")
    def member(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            first, second = _unsigned(left), _unsigned(right)
            found = np.zeros(len(first), bool)
            open_ = np.arange(len(first))
            for level, filter_ in enumerate(filters):
                passed = filter_.passes(level, first[open_], second[open_])
                found[open_[~passed]] = level % 2 == 1
                open_ = open_[passed]
            found[open_] = len(filters) % 2 == 1
            yield pa.array(found)

    return member(a, b)


def _hashes(key: Column, a: str, b: str) -> list[Column]:
    return [F.xxhash64(key).alias(a), F.xxhash64(F.lit("second"), key).alias(b)]


def mark_listed(
    rows: DataFrame, key: str, listed: DataFrame, name: str, block_keys: int = BLOCK_KEYS
) -> DataFrame:
    """``rows`` with a boolean ``name``: whether ``key`` is among the keys of ``listed``.

    The universe is every key of ``rows``; ``listed`` has a column of the same name.
    """
    spark = rows.sparkSession
    value = F.coalesce(key, F.lit(""))
    a, b, at = unused(rows, "a"), unused(rows, "b"), unused(rows, "block")
    # one grouped pass over all keys says which are listed; every other key comes from the rows
    both = rows.select(*_hashes(value, "a", "b"), F.lit(False).alias("listed")).union(
        listed.select(*_hashes(value, "a", "b"), F.lit(True).alias("listed"))
    )
    all_keys = store(both.groupBy("a", "b").agg(F.max("listed").alias("listed")), "keys")
    keys = spark.read.parquet(all_keys)
    blocks = max(1, -(-keys.filter("listed").count() // block_keys))
    hashed = rows.select("*", *_hashes(value, a, b))
    if blocks == 1:
        filters = build_cascade(keys.filter("listed"), keys.filter("not listed"))
        discard(spark, all_keys)
        return hashed.withColumn(name, in_cascade(filters, a, b)).drop(a, b)

    def block(hash_: str) -> Column:
        return F.pmod(F.shiftright(hash_, 32), F.lit(blocks))

    # dealt once, so that each block reads its own keys and rows; one block's filters at a time
    key_path, row_path = new_path(spark, "keys-by-block"), new_path(spark, "rows-by-block")
    keys.withColumn("block", block("a")).repartition("block").write.partitionBy("block").parquet(key_path)
    discard(spark, all_keys)
    hashed.withColumn(at, block(a)).repartition(at, F.rand(5)).write.partitionBy(at).parquet(row_path)
    whole = T.StructType([*hashed.schema.fields, T.StructField(at, T.IntegerType())])
    done = []
    for i in range(blocks):
        mine = spark.read.parquet(key_path).filter(F.col("block") == i)
        own = spark.read.schema(whole).parquet(row_path).filter(F.col(at) == i)
        filters = build_cascade(mine.filter("listed"), mine.filter("not listed"))
        done.append(materialize(own.withColumn(name, in_cascade(filters, a, b)).drop(a, b, at), "judged"))
    discard(spark, key_path)
    discard(spark, row_path)
    return reduce(DataFrame.union, done)


def judge_urls(
    pages: DataFrame,
    rules: dict[str, str],
    listed: DataFrame,
    block_keys: int = BLOCK_KEYS,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages`` (page_id, url).

    A rule that fits decides; without one, a page is blocked if its key ``host || path`` is
    listed (column ``key`` of ``listed``).
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    keyed = parts.withColumn("key", F.concat("host", "path"))
    marked = mark_listed(keyed, "key", listed, "listed", block_keys)
    verdicts = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])
    rule = longest_rule(F.col("host"), F.col("path"), list(rules))
    own = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return marked.withColumn("rule", rule).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce(F.element_at(verdicts, F.col("rule")), own).alias("verdict"),
    )
