"""Repeated windows of fixed width in a sequence of symbols, over a whole corpus.

Shared by the substring operators: symbols are words or bytes, a window is ``width`` of them.

1. Every window has a minimiser: the least hash among its grams. Consecutive windows with
   the same minimiser make one super-window, known by hashes of the gram and of the
   content, so a copied text costs a few short rows per copy.
2. Per gram, counts decide most cases: a gram met once has no repeated window, unless it
   stands several times in its super-window; where all super-windows of a gram are
   equal, they are repeated as a whole.
3. What is left - different super-windows around one gram - travels as one packed string
   each to its gram's bucket: equal ones collapse to their first occurrence, in one row or in
   many rows of one id alike. In the bucket the windows are
   sorted exactly, by refining buckets of equal grams with the bucket numbers of later offsets.
   Where only earlier ids count, the spans found join back to the equal ones of the first id.
4. A gram with many different surroundings (a passage that very many texts share) would fill
   one task. Each of its strings is cut into a few runs of windows by where the gram stands in
   them: a run shares not only the gram but most of what must surround it, and that longer gram is its
   key. Runs go through the same steps as packed strings, not window by window; what a window has
   beyond its key shrinks to an eighth each time, so three rounds end with keys as long as the window.
   Equal runs of one string, as periodic text has them, are one row.

Every step is a shuffle of short rows, or a scan; no task holds more than one bucket, and a
lost task is computed again from the texts or from rows in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.rows import blocks, row_key
from millrace.storage import discard, materialize, store

#: Symbols of a long text that are looked at together; the windows between parts are kept whole.
SEGMENT = 1 << 21
#: Bytes of texts, and of packed strings, that a task works on at once.
TEXT_BLOCK = 1 << 19
BUCKET_BYTES = 1 << 20
#: Windows of a super-window in periodic text, in widths; others are shorter than one width.
LONGEST_RUN = 8
#: Runs that the windows around a frequent gram are cut into.
WAYS = 8

_BASE = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 24) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ np.uint64(salt)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class SuperWindows:
    """Finds the super-windows of sequences that stand behind each other in one array."""

    def __init__(self, width: int, gram: int):
        self.width, self.gram = width, gram
        self._powers = self._inverse = np.zeros(0, np.uint64)

    def _prepare(self, n: int) -> None:
        if len(self._powers) < n + 1:
            self._powers = _powers(_BASE, n + 1)
            self._inverse = _powers(pow(_BASE, -1, 1 << 64), n + 1)

    def _prefix(self, hashes: np.ndarray) -> np.ndarray:
        prefix = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * self._powers[: len(hashes)], out=prefix[1:])
        return prefix

    def _least(self, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hash of every gram, and for every window the place of its least one."""
        n = len(prefix) - 1
        grams = mix((prefix[self.gram :] - prefix[: -self.gram]) * self._inverse[: n + 1 - self.gram])
        place = np.arange(len(grams), dtype=np.uint64)
        least = sliding_min((grams & ~_PLACE) | place, self.width - self.gram + 1)
        return grams, (least & _PLACE).astype(np.int64)

    def find(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Per super-window: row, first window in the array, number of windows, gram hash,
        content hash, and whether its windows take the gram from several places.

        Periodic text has its gram everywhere; such runs are cut at a fixed length, from their
        start on, so that equal runs are cut alike.
        """
        width, gram, n = self.width, self.gram, len(hashes)
        sizes = np.maximum(ends - starts - width + 1, 0)
        if not sizes.sum():
            return [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, bool)]
        self._prepare(n)
        grams, least = self._least(self._prefix(hashes))
        row = np.repeat(np.arange(len(sizes)), sizes)
        window = np.arange(len(row)) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
        at = least[window]
        kept = grams[at]
        new = np.r_[True, (kept[1:] != kept[:-1]) | (row[1:] != row[:-1])]
        place = np.arange(len(row))
        since = place - np.maximum.accumulate(np.where(new, place, 0))
        first = np.flatnonzero(since % (LONGEST_RUN * width) == 0)
        count = np.diff(np.r_[first, len(row)])
        begin = window[first]
        # over hashes of grams, not of symbols: a sum of powers alone has known long collisions
        whole = self._prefix(grams)
        content = (whole[begin + count + width - gram] - whole[begin]) * self._inverse[begin]
        several = at[first] != at[first + count - 1]
        return row[first], begin, count, kept[first], mix(content, 0xA5A5), several

    def cut(self, hashes: np.ndarray, place: int, length: int) -> tuple[np.ndarray, ...]:
        """Runs of windows of one string: first window, number, their common gram's place and
        length, its hash, that of the run's content, and how far the last equal run is from the first.

        Periodic text holds equal runs again and again, less than a width apart. They are one row: the
        symbols that they cover, or that equal parts of each of them cover, are without a gap.

        All windows of the string hold the gram of ``length`` at ``place``; with length 0 each
        holds its minimiser. A window that has a symbols in front of the gram falls in part
        a // step, and all windows of a part agree on how far they reach to both sides at least.
        """
        width, windows = self.width, len(hashes) - self.width + 1
        self._prepare(len(hashes))
        prefix = self._prefix(hashes)
        if length:
            at = np.full(windows, place)
        else:
            at, length = self._least(prefix)[1], self.gram
        missing = width - length
        step = max(1, -(-missing // WAYS))
        part = (at - np.arange(windows)) // step
        first = np.flatnonzero(np.r_[True, (np.diff(part) != 0) | (np.diff(at) != 0)])
        count = np.diff(np.r_[first, windows])
        left = part[first] * step
        longer = length + left + missing - np.minimum(missing, left + step - 1)
        begin = at[first] - left
        key = (prefix[begin + longer] - prefix[begin]) * self._inverse[begin]
        content = (prefix[first + count - 1 + width] - prefix[first]) * self._inverse[first]
        m, s = mix(mix(key) + longer.astype(np.uint64)), mix(content + count.astype(np.uint64), 0xA5A5)
        order = np.lexsort((first, s, m))
        head = np.r_[True, (np.diff(m[order]) != 0) | (np.diff(s[order]) != 0) | (np.diff(first[order]) > width)]
        heads = np.flatnonzero(head)
        kept, last = order[heads], order[np.r_[heads[1:], len(order)] - 1]
        return *(x[kept] for x in (first, count, begin, longer, m, s)), first[last] - first[kept]


def byte_hashes(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    return table[np.frombuffer(b"".join(rows), np.uint8)], np.array([len(r) for r in rows], np.int64)


class WordHashes(dict):
    """Hashes of words; remembers words of a task's texts, up to a bound."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def __call__(self, rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > 300_000:
            self.clear()
        split = [r.split() for r in rows]
        sizes = np.array([len(ws) for ws in split], np.int64)
        words = chain.from_iterable(split)
        return np.fromiter(map(self.__getitem__, words), np.uint64, int(sizes.sum())), sizes


@dataclass(frozen=True)
class Kind:
    """What a symbol is, how wide a window is, and which grams its minimisers are taken from."""

    symbols: str  # "words" or "bytes"
    width: int
    gram: int
    #: Whether a window is repeated if it occurs in a row with a smaller id, or anywhere else.
    earlier: bool
    #: Different super-windows around one gram that one bucket takes.
    hot: int = 500

    def hasher(self) -> Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]:
        return byte_hashes if self.symbols == "bytes" else WordHashes()

    def cut(self, text: bytes, spans: list[tuple[int, int]]) -> list[bytes]:
        """The symbols [begin, end) of a text, packed, for each span."""
        if self.symbols == "bytes":
            return [text[a:b] for a, b in spans]
        words = text.split()
        return [b" ".join(words[a:b]) for a, b in spans]

    def numbers(self, rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Equal symbols get equal numbers; and how many symbols each row has."""
        if self.symbols == "bytes":
            flat = np.frombuffer(b"".join(rows), np.uint8).astype(np.int64)
            return flat, np.array([len(r) for r in rows], np.int64)
        seen: dict[bytes, int] = {}
        split = [r.split() for r in rows]
        flat = np.array([seen.setdefault(w, len(seen)) for ws in split for w in ws], np.int64)
        return flat, np.array([len(ws) for ws in split], np.int64)


# --- exact sorting of the windows in a bucket -----------------------------------------------


def _heads(ranked: np.ndarray) -> np.ndarray:
    """For each place in sorted order, the first place with the same value."""
    place = np.arange(len(ranked))
    return np.maximum.accumulate(np.where(np.r_[True, ranked[1:] != ranked[:-1]], place, 0))


def window_classes(symbols: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All window starts in rows of symbols, and a number that equal windows share.

    The first buckets hold equal grams. A bucket is known by the place of its first member
    in sorted order. Round by round, the members of buckets with several members are sorted
    by the bucket numbers some offset later, which doubles the length that the buckets
    agree on; a bucket of one is done.
    """
    total = len(symbols)
    room = np.repeat(np.cumsum(sizes), sizes) - np.arange(total)
    starts = np.flatnonzero(room >= width)
    if not len(starts):
        return starts, starts
    length = 8 if width >= 8 and symbols.max() < 256 else 1
    members = np.flatnonzero(room >= length)
    gram = symbols[members].astype(np.uint64)
    for i in range(1, length):
        gram = gram << np.uint64(8) | symbols[members + i].astype(np.uint64)
    order = np.argsort(gram)
    bucket = np.zeros(total, np.int64)
    bucket[members[order]] = _heads(gram[order])
    while length < width:
        offset = min(length, width - length)
        # a member that is too short to go on cannot be part of a window at this offset
        members = members[room[members] >= length + offset]
        members = members[np.bincount(bucket[members], minlength=total)[bucket[members]] > 1]
        if not len(members):
            break
        key = bucket[members] * np.int64(total) + bucket[members + offset]
        order = np.argsort(key)
        key, sorted_members = key[order], members[order]
        old = bucket[sorted_members]
        # members that stopped here keep the old number; nobody compares them again
        bucket[sorted_members] = old + _heads(key) - _heads(old)
        length += offset
    return starts, bucket[starts]


def _repeated_rows(symbols: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Rows with a window whose hash stands twice; in the others no window is repeated."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.flatnonzero(np.cumsum(sizes)[row] - np.arange(len(row)) >= width)
    prefix = np.zeros(len(symbols) + 1, np.uint64)
    hashes = mix((symbols + 1).astype(np.uint64) * np.uint64(_BASE))
    np.cumsum(hashes * _powers(_BASE, len(symbols)), out=prefix[1:])
    inverse = _powers(pow(_BASE, -1, 1 << 64), len(symbols))
    windows = (prefix[starts + width] - prefix[starts]) * inverse[starts]
    order = np.argsort(windows)
    same = windows[order][1:] == windows[order][:-1]
    return np.unique(row[starts[order[np.r_[same, False] | np.r_[False, same]]]])


def repeated_runs(kind: Kind, rows: list[bytes], docs: np.ndarray):
    """Row, first window, number of windows for each run of repeated windows in a bucket."""
    nothing = [np.zeros(0, np.int64)] * 3
    symbols, sizes = kind.numbers(rows)
    if not len(symbols):
        return nothing
    chosen = _repeated_rows(symbols, sizes, kind.width)
    if not len(chosen):
        return nothing
    wanted = np.zeros(len(sizes), bool)
    wanted[chosen] = True
    symbols, sizes = symbols[np.repeat(wanted, sizes)], sizes[chosen]
    docs = docs[chosen]
    starts, classes = window_classes(symbols, sizes, kind.width)
    begins = np.cumsum(sizes) - sizes
    row = np.searchsorted(begins, starts, side="right") - 1
    if kind.earlier:
        order = np.lexsort((docs[row], classes))
        head = np.r_[True, classes[order][1:] != classes[order][:-1]]
        first = np.empty(len(starts), np.int64)
        first[order] = docs[row][order][np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))]
        hit = docs[row] > first
    else:
        _, inverse, counts = np.unique(classes, return_inverse=True, return_counts=True)
        hit = counts[inverse] > 1
    at = np.flatnonzero(hit)
    if not len(at):
        return nothing
    new = np.r_[True, (np.diff(at) != 1) | (row[at][1:] != row[at][:-1])]
    first = np.flatnonzero(new)
    count = np.diff(np.r_[first, len(at)])
    return chosen[row[at[first]]], starts[at[first]] - begins[row[at[first]]], count


# --- the steps over a table ----------------------------------------------------------------

#: A text: (doc, key) name its row, ``base`` is where it starts in that row's symbols.
TEXT = "doc long, key long, base long, text binary"
#: Repeated windows: ``base`` is that of the text, or where the packed string starts.
SPAN = "doc long, key long, base long, start long, n long"
#: ``place`` and ``length``: where in the text the gram stands that a run's windows share, if all
#: windows have it there. ``reach``: see ``SuperWindows.cut``; a span of the run is longer by that.
OCCURRENCE = f"{TEXT.removesuffix(', text binary')}, at long, n long, m long, s long, several boolean, place long, length long, reach long"
PACKED = "m long, doc long, key long, start long, hot boolean, place long, length long, text binary"


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})


def _bytes(batch: pa.RecordBatch, name: str) -> list[bytes]:
    return [b or b"" for b in batch.column(name).to_pylist()]


def _segments(sizes: np.ndarray, width: int):
    """Row, begin, end of overlapping parts of at most SEGMENT window starts."""
    if not len(sizes) or sizes.max() <= SEGMENT:
        ends = np.cumsum(sizes)
        yield np.arange(len(sizes)), ends - sizes, ends
        return
    ends = np.cumsum(sizes)
    for row, (begin, end) in enumerate(zip((ends - sizes).tolist(), ends.tolist(), strict=True)):
        for part in range(begin, max(begin + 1, end - width + 1), SEGMENT):
            yield np.array([row]), np.array([part]), np.array([min(end, part + SEGMENT + width - 1)])


def occurrences(texts: DataFrame, kind: Kind) -> DataFrame:
    """A row for each super-window of each text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, hasher = SuperWindows(kind.width, kind.gram), kind.hasher()
        for batch in batches:
            doc, key, base = (_column(batch, c) for c in ("doc", "key", "base"))
            for begin, rows in blocks(_bytes(batch, "text"), TEXT_BLOCK):
                hashes, sizes = hasher(rows)
                starts = np.cumsum(sizes) - sizes
                for which, a, b in _segments(sizes, kind.width):
                    low, high = int(a[0]), int(b[-1])
                    row, at, n, m, s, several = finder.find(hashes[low:high], a - low, b - low)
                    own = which[row] + begin
                    yield _batch(
                        doc=doc[own], key=key[own], base=base[own],
                        at=at + low - starts[which[row]], n=n, m=m.view(np.int64), s=s.view(np.int64), several=several,
                        place=np.zeros(len(n), np.int64), length=np.zeros(len(n), np.int64), reach=np.zeros(len(n), np.int64),
                    )

    return texts.select("doc", "key", "base", "text").mapInArrow(scan, OCCURRENCE)


def runs(strings: DataFrame, kind: Kind) -> DataFrame:
    """A row for each part of each string of a hot gram; the key is a longer gram."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, hasher = SuperWindows(kind.width, kind.gram), kind.hasher()
        for batch in batches:
            ids = [_column(batch, c) for c in ("doc", "key", "base", "place", "length")]
            found: list[list[np.ndarray]] = []
            for text, doc, key, base, place, length in zip(_bytes(batch, "text"), *ids, strict=True):
                at, n, begin, longer, m, s, reach = finder.cut(hasher([text])[0], place, length)
                own = [np.full(len(at), x) for x in (doc, key, base)]
                found.append([*own, at, n, m.view(np.int64), s.view(np.int64), np.zeros(len(at), bool), begin, longer, reach])
            if found:
                names = ("doc", "key", "base", "at", "n", "m", "s", "several", "place", "length", "reach")
                yield _batch(**dict(zip(names, map(np.concatenate, zip(*found, strict=True)), strict=True)))

    return strings.select("doc", "key", "base", "place", "length", "text").mapInArrow(scan, OCCURRENCE)


def _packed(texts: DataFrame, wanted: DataFrame, kind: Kind) -> DataFrame:
    """The strings of wanted super-windows, cut from their texts."""
    places = wanted.groupBy("doc", "key", "base").agg(
        F.collect_set(F.struct("at", "n", "m", "hot", "place", "length")).alias("places")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            ids = list(zip(*(batch.column(c).to_pylist() for c in ("doc", "key", "base")), strict=True))
            lists = batch.column("places")
            for i, text in enumerate(_bytes(batch, "text")):
                if ids[i] == last:  # the same row again: its strings are there already
                    continue
                last = doc, key, base = ids[i]
                places = lists[i].as_py()
                spans = [(p["at"], p["at"] + p["n"] - 1 + kind.width) for p in places]
                size = len(places)
                yield pa.RecordBatch.from_pydict({
                    "m": pa.array([p["m"] for p in places], pa.int64()),
                    "doc": pa.array([doc] * size, pa.int64()),
                    "key": pa.array([key] * size, pa.int64()),
                    "start": pa.array([base + p["at"] for p in places], pa.int64()),
                    "hot": pa.array([p["hot"] for p in places], pa.bool_()),
                    "place": pa.array([p["place"] - p["at"] for p in places], pa.int64()),
                    "length": pa.array([p["length"] for p in places], pa.int64()),
                    "text": pa.array(kind.cut(text, spans), pa.binary()),
                })

    return texts.join(places, ["doc", "key", "base"]).mapInArrow(cut, PACKED)


def _sorted_buckets(packed: DataFrame, kind: Kind) -> DataFrame:
    """Spans of repeated windows among packed strings, bucket by bucket."""

    def work(m: list, doc: list, key: list, start: list, text: list) -> pa.RecordBatch:
        docs, keys, starts = (np.array(x, np.int64) for x in (doc, key, start))
        row, at, n = repeated_runs(kind, text, docs)
        return _batch(doc=docs[row], key=keys[row], base=starts[row], start=starts[row] + at, n=n)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], [], []]
        size = 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("m", "doc", "key", "start", "text")]
            for row in zip(*columns, strict=True):
                if size > BUCKET_BYTES and row[0] != held[0][-1]:
                    yield work(*held)
                    held, size = [[], [], [], [], []], 0
                for values, value in zip(held, row, strict=True):
                    values.append(value)
                size += len(row[-1])
        if size:
            yield work(*held)

    rows = packed.select("m", "doc", "key", "start", "text")
    return rows.repartition("m").sortWithinPartitions("m").mapInArrow(sort, SPAN)


def _level(texts: DataFrame, kind: Kind, hot_strings: bool = False) -> DataFrame:
    """Spans of repeated windows in ``texts``, or in the strings of hot grams; those of grams
    that are still hot go through it again."""
    spark = texts.sparkSession
    # stored, as both the counts and the join below read them; the texts are scanned once
    stored = store((runs if hot_strings else occurrences)(texts, kind), "occurrences")
    found = spark.read.parquet(stored)
    # a super-window with its gram in several places may repeat windows inside itself
    inside = F.lit(False) if kind.earlier else (F.count("*") == 1) & F.max("several")
    times = F.sum(F.when(F.col("reach") > 0, 2).otherwise(1))  # equal runs in one row are two at least
    grams = store(
        found.groupBy("m")
        .agg(
            times.alias("c"),
            F.min("doc").alias("first"),
            ((F.min("s") != F.max("s")) | inside).alias("mixed"),
        )
        .filter("c > 1 or mixed"),
        "grams",
    )
    met = materialize(found.join(spark.read.parquet(grams), "m"), "super-windows")
    discard(spark, grams)
    discard(spark, stored)
    repeated = F.col("doc") > F.col("first") if kind.earlier else F.lit(True)
    own = ["doc", "key", "base", (F.col("base") + F.col("at")).alias("start"), (F.col("n") + F.col("reach")).alias("n")]
    spans = met.filter(~F.col("mixed") & repeated).select(*own)

    mixed = met.filter("mixed").drop("c", "first", "mixed", "several")
    here = F.struct("doc", "key", "base", "at")
    each = materialize(
        mixed.groupBy("m", "s").agg(times.alias("c"), F.min(here).alias("first")), "each"
    )
    # only the hot grams are listed: few rows, whose join can be split like the others
    hot = each.groupBy("m").agg(F.count("*").alias("k")).filter(F.col("k") > kind.hot)
    hot = materialize(hot.select("m", F.lit(True).alias("hot")), "hot-grams")
    known = each.join(hot, "m", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    rows = mixed.join(known, ["m", "s"])
    covered = F.col("doc") > F.col("first.doc") if kind.earlier else F.col("c") > 1
    spans = spans.union(rows.filter(covered).select(*own))
    packed = materialize(_packed(texts, rows.filter(here == F.col("first")), kind), "packed")
    inside = _sorted_buckets(packed.filter(~F.col("hot")), kind)
    rest = packed.filter("hot")
    if not rest.isEmpty():
        rest = rest.select("doc", "key", F.col("start").alias("base"), "place", "length", "text")
        inside = inside.union(_level(rest, kind, hot_strings=True))
    if not kind.earlier:  # one that occurs again is covered as a whole, so the others stand alone
        return spans.union(inside)
    # stored, so that the join below can be split
    inside = materialize(
        inside.select(
            *(F.col(c).alias(f"first_{c}") for c in ("doc", "key")),
            F.col("base").alias("first_start"),
            (F.col("start") - F.col("base")).alias("offset"),
            F.col("n").alias("length"),
        ),
        "inside",
    )
    alike = rows.filter(F.col("doc") == F.col("first.doc")).select(
        "doc", "key", "base", "at", "reach",
        F.col("first.doc").alias("first_doc"), F.col("first.key").alias("first_key"),
        (F.col("first.base") + F.col("first.at")).alias("first_start"),
    )
    start = (F.col("base") + F.col("at") + F.col("offset")).alias("start")
    back = alike.join(inside, ["first_doc", "first_key", "first_start"])
    return spans.union(back.select("doc", "key", "base", start, (F.col("length") + F.col("reach")).alias("n")))


def repeated_windows(docs: DataFrame, kind: Kind) -> DataFrame:
    """``doc, key, spans``: per row of ``docs`` (doc_id, text) its runs of repeated windows.

    ``doc`` and ``key`` are those of ``rows.row_key``. A span (start, n) stands for the windows
    that start at start, ..., start + n - 1.
    """
    texts = docs.filter(F.col("text").isNotNull()).select(
        *row_key("doc", "key"),
        F.lit(0).cast("long").alias("base"),
        F.col("text").cast("binary").alias("text"),
    )
    spans = _level(texts, kind)
    return spans.groupBy("doc", "key").agg(F.collect_set(F.struct("start", "n")).alias("spans"))


def covered(spans: list[dict] | None, size: int, width: int) -> np.ndarray:
    """Which of a text's symbols lie in a window of the spans."""
    change = np.zeros(size + 1, np.int64)
    for span in spans or ():
        change[span["start"]] += 1
        change[span["start"] + span["n"] - 1 + width] -= 1
    return np.cumsum(change[:-1]) > 0
