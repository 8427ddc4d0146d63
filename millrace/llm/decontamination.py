"""Benchmark decontamination: an Aho-Corasick automaton of test passages over whole texts.

Text is normalised byte for byte: A-Z to lower case, every other ASCII character that is no
digit or letter to a space. Positions therefore stay those of the original. The passages
are all windows of ``width`` consecutive words of the benchmark items, or the whole item
where it is shorter. The automaton runs over word numbers: a word that no passage uses gets
a number that no passage has, so one pass over a text finds all passages, overlaps included.

A null or empty text has no words and no hits; a null or empty item has no passage, a null item id is
reported as the empty string. Items
that share a passage are all reported, repeated documents each get their row. With no
benchmark rows nothing is contaminated. Texts are scanned whole. Ids may be of any type. Only ``doc_id, text`` and
``item_id, text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.rows import structs, texts, unused
from millrace.storage import materialize

_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B))
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT or b >= 0x80 else 0x20 for b in range(256)
)

#: Passages in one automaton: about 10 nodes of 60 bytes each, so some 120 MB a task.
MAX_PASSAGES = 200_000


def normalised(text: bytes) -> bytes:
    """As long as ``text``: lower-case words with spaces for everything between them."""
    return text.translate(_TABLE)


def passages_of(text: bytes, width: int) -> list[bytes]:
    words = normalised(text).split()
    if not words:
        return []
    return [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]


def passages(benchmark: DataFrame, width: int) -> DataFrame:
    """``item_id, passage`` for every different passage of every item."""

    @F.arrow_udf("array<string>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in batches:
            found = [[p.decode() for p in passages_of(t, width)] for t in texts(array)]
            yield pa.array(found, pa.list_(pa.string()))

    rows = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.explode(cut("text")).alias("passage"),
    )
    return rows.distinct()


class _WordNumbers(dict):
    """Numbers of the words that passages use; 0 for any other word."""

    def __missing__(self, word: bytes) -> int:
        return 0


class PassageFinder:
    """An automaton over word numbers; ``rows`` are (passage, item ids)."""

    def __init__(self, rows: list[tuple[str, list[str]]]):
        self._number = _WordNumbers()
        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        self._shortest = 0
        for passage, items in rows:
            words = passage.encode().split()
            for word in words:
                self._number.setdefault(word, len(self._number) + 1)
            key = tuple(self._number[w] for w in words)
            self._automaton.add_word(key, (len(key), items))
            self._shortest = min(self._shortest or len(key), len(key))
        if rows:
            self._automaton.make_automaton()

    def find(self, words: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, word after the last, item ids) of every occurrence, by its end.

        A passage lies inside a run of words that passages use, and most runs are shorter
        than the shortest passage; the automaton sees only the others.
        """
        if not self._shortest or not words:
            return
        numbers = np.fromiter(map(self._number.__getitem__, words), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.r_[0, numbers > 0, 0]))
        begins, ends = edges[::2], edges[1::2]
        long = ends - begins >= self._shortest
        for begin, end in zip(begins[long].tolist(), ends[long].tolist(), strict=True):
            for last, (size, items) in self._automaton.iter(tuple(numbers[begin:end].tolist())):
                yield begin + last + 1 - size, begin + last + 1, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Unions of overlapping or touching half-open spans, in order."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def word_bounds(text: bytes, wanted: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte spans in the original text of spans of words."""
    clean, bounds, at = normalised(text), [], 0
    words = clean.split()
    for word in words:
        begin = clean.index(word, at)
        at = begin + len(word)
        bounds.append((begin, at))
    return [(bounds[a][0], bounds[b - 1][1]) for a, b in wanted]


FIELDS = {
    "n_words": pa.int64(),
    "word_spans": pa.list_(pa.list_(pa.int64())),
    "byte_spans": pa.list_(pa.list_(pa.int64())),
    "items": pa.list_(pa.string()),
}
_TYPES = "n_words long, word_spans array<array<bigint>>, byte_spans array<array<bigint>>, items array<string>"


def find_passages(finder_rows: list[tuple[str, list[str]]]) -> Column:
    """Function of a text column: words, hit spans in words and in bytes, items that occur."""

    @F.arrow_udf(_TYPES)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        finder = PassageFinder(finder_rows)
        for array in batches:
            found: dict[str, list] = {name: [] for name in FIELDS}
            for text in texts(array):
                words = normalised(text).split()
                spans, items = [], set()
                for begin, end, ids in finder.find(words):
                    spans.append((begin, end))
                    items.update(ids)
                spans = merged(spans)
                found["n_words"].append(len(words))
                found["word_spans"].append(spans)
                found["byte_spans"].append(word_bounds(text, spans) if spans else [])
                found["items"].append(sorted(items))
            yield structs(found, FIELDS)

    return scan


def with_hits(
    docs: DataFrame, benchmark: DataFrame, name: str, width: int = 10, max_passages: int = MAX_PASSAGES
) -> DataFrame:
    """``docs`` with a struct column ``name`` of ``FIELDS``.

    One automaton, with the items of its passages, needs no shuffle. A benchmark with more
    (passage, item) pairs than fit one goes block by block.
    """
    pairs = passages(benchmark, width)
    total = pairs.count()
    if total <= max_passages:
        grouped = pairs.groupBy("passage").agg(F.collect_set("item_id").alias("items"))
        return docs.withColumn(name, find_passages([(p, sorted(i)) for p, i in grouped.collect()])("text"))
    key, more, items = (unused(docs, n) for n in ("key", "more", "items"))
    found = _hits_by_block(docs.select("text"), pairs, -(-total // max_passages))
    return (
        docs.withColumn(name, find_passages([])("text"))
        .withColumn(key, _text_key())
        .join(found.toDF(key, more, items), key, "left")
        .withColumn(name, _united(name, more, items))
        .drop(key, more, items)
    )


def _text_key() -> Column:
    """128 bits of the text: hits depend on nothing else, so equal texts share them."""
    return F.unhex(F.md5("text"))


def _hits_by_block(docs: DataFrame, pairs: DataFrame, count: int) -> DataFrame:
    """``key, more, items``: hits of all blocks and items that occur, for every text with any.

    Passages fall into blocks by hash. The hits of one block are stored before the next one is
    fetched, so the driver and a task hold one block at a time, and automata know passages by
    digest only: the items, however many share a passage, come from a join.
    """
    named = pairs.select("item_id", "passage", F.md5("passage").alias("id"))
    named = materialize(named.withColumn("block", F.pmod(F.xxhash64("passage"), F.lit(count))), "passages")
    stored = []
    for b in range(count):
        rows = named.filter(F.col("block") == b).select("passage", "id").distinct().collect()
        scan = docs.select(_text_key().alias("key"), find_passages([(p, [i]) for p, i in rows])("text").alias("hit"))
        stored.append(materialize(scan.filter(F.size("hit.items") > 0).dropDuplicates(["key"]), "block-hits"))
    hits = reduce(DataFrame.union, stored)
    items = (
        hits.select("key", F.explode("hit.items").alias("id"))
        .join(named.select("id", "item_id"), "id")
        .groupBy("key")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    spans = hits.groupBy("key").agg(F.collect_list("hit").alias("more"))
    return materialize(spans.join(items, "key"), "hits")


def _united(first: str, others: str, items: str) -> Column:
    """Union of the spans in a hit struct and in a list of such structs of the same text."""

    @F.arrow_udf(_TYPES)
    def union(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right, known in batches:
            found: dict[str, list] = {name: [] for name in FIELDS}
            rows = zip(left.to_pylist(), right.to_pylist(), known.to_pylist(), strict=True)
            for one, many, ids in rows:
                found["n_words"].append(one["n_words"])
                for spans in ("word_spans", "byte_spans"):
                    found[spans].append(merged([tuple(s) for h in many or [] for s in h[spans]]))
                found["items"].append(ids or [])
            yield structs(found, FIELDS)

    return union(first, others, items)


def contamination_report(
    docs: DataFrame, benchmark: DataFrame, width: int = 10, max_passages: int = MAX_PASSAGES
) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` and spans."""

    hits = with_hits(docs.select("doc_id", "text"), benchmark, "hits", width, max_passages)
    sizes = F.transform("hits.word_spans", lambda s: s[1] - s[0])
    n_hit = F.aggregate(sizes, F.lit(0).cast("long"), lambda total, size: total + size)
    return hits.select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hits.items"), 256).alias("items_sha256"),
        (F.size("hits.word_spans") > 0).alias("contaminated"),
        F.col("hits.byte_spans").alias("byte_spans"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """The documents in which no passage occurs, with all their columns."""
    name = unused(docs, "hits")
    return with_hits(docs, benchmark, name, width).filter(F.size(f"{name}.word_spans") == 0).drop(name)
