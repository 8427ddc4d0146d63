"""Repeated word windows, byte strings and lines against brute force."""

from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from millrace.llm import line_dedup, repeats, substring_dedup, suffix_dedup

from .conftest import CLASHING, edge_rows, found

LAST = 2**63 - 1


def words_left(rows, width):
    first = {}
    for d, t in rows:
        w, d = (t or "").encode().split(), LAST if d is None else d
        for i in range(len(w) - width + 1):
            k = tuple(w[i : i + width])
            first[k] = min(first.get(k, LAST), d)
    out = []
    for d, t in rows:
        w, own = (t or "").encode().split(), LAST if d is None else d
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] < own:
                gone[i : i + width] = [True] * width
        left = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), sha256(left).hexdigest()))
    return sorted(out, key=repr)


def bytes_left(rows, width):
    count = Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[i : i + width] for i in range(len(b) - width + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - width + 1):
            if count[b[i : i + width]] > 1:
                gone[i : i + width] = True
        left = np.frombuffer(b, np.uint8)[~gone].tobytes()
        runs = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(b) else 0
        out.append((d, len(b), int(gone.sum()), runs, sha256(left).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [2000, 1])
@pytest.mark.parametrize("width", [50, 10])
def test_words(edge, width, hot):
    got = substring_dedup.remove_repeated_words(edge, width, hot).drop("kept")
    assert found(got) == words_left(edge_rows(), width)


@pytest.mark.parametrize("hot", [2000, 1])
@pytest.mark.parametrize("width", [400, 60])
def test_bytes(edge, width, hot):
    got = suffix_dedup.remove_repeated_bytes(edge, width, hot).drop("kept")
    assert found(got) == bytes_left(edge_rows(), width)


def test_long_texts_are_cut_into_overlapping_parts(edge, monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 500)
    monkeypatch.setattr(repeats, "TEXT_BLOCK", 2000)
    got = suffix_dedup.remove_repeated_bytes(edge, 60).drop("kept")
    assert found(got) == bytes_left(edge_rows(), 60)


def passage_rows():
    """One passage in many rows without ids, and edited in a few others."""
    rng = np.random.default_rng(8)
    passage = [f"w{x}" for x in rng.integers(0, 500, 200)]
    rows = [(None, " ".join([f"head{i}", *passage, f"tail{i}"])) for i in range(60)]
    rows += [(3, " ".join([*passage[: 40 * i], f"edit{i}", *passage[40 * i + 1 :]])) for i in range(1, 4)]
    return rows + [(None, " ".join(passage + ["mid"] + passage)), rows[0]]


@pytest.mark.parametrize("hot", [500, 1])
def test_equal_strings_of_one_id_are_sorted_once(spark, monkeypatch, hot):
    copies, sort = [], repeats._sorted_buckets

    def watched(packed, kind):
        copies.append(packed.groupBy("m", "text").count().filter("count > 1").count())
        return sort(packed, kind)

    monkeypatch.setattr(repeats, "_sorted_buckets", watched)
    rows = passage_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(substring_dedup.remove_repeated_words(df, 20, hot).drop("kept")) == words_left(rows, 20)
    assert found(suffix_dedup.remove_repeated_bytes(df, 60, hot).drop("kept")) == bytes_left(rows, 60)
    assert copies and not any(copies)


def test_kept_text_matches_its_digest(edge):
    for row in suffix_dedup.remove_repeated_bytes(edge, 100).collect():
        assert sha256(row.kept).hexdigest() == row.kept_sha256


def test_window_classes_equal_grouping():
    rng = np.random.default_rng(3)
    for width in (1, 2, 3, 7, 16, 50):
        sizes = rng.integers(0, 120, 12)
        symbols = rng.integers(0, 2, sizes.sum())
        starts, classes = repeats.window_classes(symbols, sizes, width)
        ends = np.repeat(np.cumsum(sizes), sizes)
        assert starts.tolist() == [i for i in range(len(symbols)) if i + width <= ends[i]]
        by_class = {}
        for s, c in zip(starts.tolist(), classes.tolist()):
            by_class.setdefault(c, set()).add(symbols[s : s + width].tobytes())
        assert all(len(v) == 1 for v in by_class.values())
        assert len(by_class) == len({symbols[s : s + width].tobytes() for s in starts.tolist()})


def test_empty_tables(empty):
    assert substring_dedup.remove_repeated_words(empty).count() == 0
    assert suffix_dedup.remove_repeated_bytes(empty).count() == 0
    assert line_dedup.line_dedup_report(empty).count() == 0


def test_clashing_columns(wide, edge):
    assert found(substring_dedup.remove_repeated_words(wide)) == found(
        substring_dedup.remove_repeated_words(edge)
    )
    assert found(suffix_dedup.remove_repeated_bytes(wide)) == found(
        suffix_dedup.remove_repeated_bytes(edge)
    )


def lines_left(rows):
    def counted(text):
        lines = (text or "").split("\n") if text is not None else []
        return lines, [i for i, x in enumerate(lines) if x.strip(" \t\r")]

    first = {}
    order = sorted(range(len(rows)), key=lambda i: LAST if rows[i][0] is None else rows[i][0])
    for i in order:
        lines, at = counted(rows[i][1])
        own = LAST if rows[i][0] is None else rows[i][0]
        for n in range(len(at) - 2):
            w = tuple(lines[x] for x in at[n : n + 3])
            first[w] = min(first.get(w, (LAST, 1 << 60)), (own, n))
    out = []
    for d, text in rows:
        lines, at = counted(text)
        own = LAST if d is None else d
        gone = set()
        for n in range(len(at) - 2):
            if first[tuple(lines[x] for x in at[n : n + 3])] < (own, n):
                gone.update(range(at[n], at[n + 2] + 1))
        left = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append((d, len(lines), len(gone), sha256(left.encode()).hexdigest()))
    return sorted(out, key=repr)


def line_rows():
    block = "one\ntwo\n\nthree\nfour"
    rows = [
        (1, block), (2, block), (3, f"new\n{block}\nend"), (4, "one\ntwo"), (5, None), (6, ""),
        (7, "\n\n\n\n\n"), (8, "x\nx\nx\nx\nx\nx"), (9, "x\nx\nx"), (None, block), (None, None),
        (10, "a\nb\nc\na\nb\nc\nd"), (11, "two\nthree\nfour\nfive"), (12, " one\ntwo\nthree"), (12, block),
    ]
    rows += [(100 + i, f"head {i}\n{block}\ntail {i}\ntail") for i in range(20)]
    return rows + edge_rows()


def test_lines(spark):
    rows = line_rows()
    # equal ids with one place: which row comes first is open, so leave those pairs out here
    rows = [r for i, r in enumerate(rows) if r not in rows[:i] and r[0] not in (12, 41)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(line_dedup.line_dedup_report(df)) == lines_left(rows)


def test_repeated_rows_lose_the_same_lines(spark):
    rows = [(1, "a\nb\nc\nd")] * 3 + [(2, "a\nb\nc\ne")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(line_dedup.line_dedup_report(df).select("doc_id", "n_removed"))
    assert got == [(1, 0), (1, 0), (1, 0), (2, 3)]


def test_lines_of_rows_with_equal_ids(spark):
    rows = line_rows() + [
        (200, "p\nq\nr"), (200, "x\np\nq\nr"),  # the second row has the passage further on
        (None, "k\nl\nm\nn"), (None, "y\nk\nl\nm\nn"), (None, "y\nz\nk\nl\nm\nn"),
        (8, "u\nv\nw\n1"), (8, "u\nv\nw\n2"),  # equal places: both stay
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = found(line_dedup.line_dedup_report(df))
    assert got == lines_left(rows)
    assert sorted(r[2] for r in got if r[0] == 200) == [0, 3]


def test_lines_keep_the_other_columns(wide):
    out = line_dedup.drop_repeated_lines(wide)
    assert out.columns == wide.columns
    rows = out.collect()
    assert len(rows) == wide.count() and all(r[n] == "own" for r in rows for n in CLASHING)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)


def shared_rows(n):
    """A passage in ``n`` texts with different surroundings, periodic texts, null ids, repeated rows."""
    rng = np.random.default_rng(13)

    def some(k):
        return [f"w{x}" for x in rng.integers(0, 900, k)]

    passage = some(160)
    rows = [(i, " ".join([*some(12 + i % 7), *passage[i % 5 :], *some(9)])) for i in range(n)]
    rows += [(None if i % 3 else 5000 + i, " ".join([*some(3), *["ab"] * (30 + i), *some(4)])) for i in range(n // 3)]
    return rows + [rows[0], (None, rows[1][1]), (9000, "x " * 700), (9001, "- " * 200 + "end")]


@pytest.mark.parametrize("hot", [500, 20, 1])
def test_a_passage_that_many_texts_share(spark, hot):
    rows = shared_rows(90)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(substring_dedup.remove_repeated_words(df, 50, hot).drop("kept")) == words_left(rows, 50)
    assert found(suffix_dedup.remove_repeated_bytes(df, 100, hot).drop("kept")) == bytes_left(rows, 100)


def test_rows_of_hot_grams_grow_with_the_texts(spark, monkeypatch):
    made, cut = [], repeats.runs

    def watched(strings, kind):
        rows = cut(strings, kind)
        made[-1].append((strings.count(), rows.count()))
        return rows

    monkeypatch.setattr(repeats, "runs", watched)
    for n in (100, 200):
        made.append([])
        plain = [r for r in shared_rows(n) if r[0] is not None and r[0] < 5000]
        df = spark.createDataFrame(plain, "doc_id long, text string").repartition(5)
        suffix_dedup.remove_repeated_bytes(df, 400, 20).count()
    small, large = ([sum(x) for x in zip(*m)] for m in made)
    assert 0 < large[1] <= 10 * large[0]  # a few runs for each string, not one for each window
    assert large[1] <= 2.5 * small[1]


def periodic_rows(n, pairs):
    """A pair of words, or a longer line, again and again in ``n`` texts with different surroundings."""
    rng = np.random.default_rng(17)

    def some(k):
        return [f"w{x}" for x in rng.integers(0, 900, k)]

    line = [f"l{x}" for x in range(13)]
    rows = [(i, " ".join([*some(3 + i % 4), *["of", "the"] * (pairs + i % 3), *some(5)])) for i in range(n)]
    return rows + [(1000 + i, " ".join([*some(4), *line * (pairs // 6), *some(4)])) for i in range(n)]


@pytest.mark.parametrize("pairs", [60, 120])
def test_periodic_texts_around_a_hot_gram_make_few_runs(spark, monkeypatch, pairs):
    made, cut = [], repeats.runs

    def watched(strings, kind):
        rows = cut(strings, kind)
        made.append((strings.count(), rows.count()))
        return rows

    monkeypatch.setattr(repeats, "runs", watched)
    rows = periodic_rows(40, pairs)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(substring_dedup.remove_repeated_words(df, 50, 20).drop("kept")) == words_left(rows, 50)
    assert found(suffix_dedup.remove_repeated_bytes(df, 100, 20).drop("kept")) == bytes_left(rows, 100)
    strings, runs = map(sum, zip(*made))
    assert 0 < runs <= 25 * strings  # what a period has of runs, however often it stands there
