"""SimHash groups, connected components and URL verdicts against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import rows as llm_rows
from millrace.llm import simhash, url_filter
from millrace.llm.components import connected_components

from .conftest import CLASHING, edge_rows, found

LAST = 2**63 - 1


def print_of(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        parent[max(top(a), top(b))] = min(top(a), top(b))
    return {n: top(n) for n in nodes}


def grouped(rows, distance=4):
    prints = [print_of(t) for _, t in rows]
    nodes = sorted(set(prints))
    near = [(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= distance]
    root = roots(nodes, near)
    least = {}
    for (d, _), p in zip(rows, prints):
        if d is not None:
            least[root[p]] = min(least.get(root[p], LAST), d)
    return [(d, f"{p:016x}", least.get(root[p])) for (d, _), p in zip(rows, prints)]


def test_groups(edge, wide, empty):
    want = sorted(grouped(edge_rows()), key=repr)
    assert found(simhash.near_duplicates(edge)) == want
    assert found(simhash.near_duplicates(wide)) == want
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("segments", [1, 2, 3, 4])
@pytest.mark.parametrize("distance", [1, 4, 5])
def test_links_are_complete(spark, segments, distance):
    if segments == 1 and distance > 1:
        pytest.skip("a whole ball of 64 bits")
    rng = random.Random(7)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for p in list(prints):
        for _ in range(4):
            flips = rng.sample(range(64), rng.randint(1, 7))
            prints.add(p ^ sum(1 << b for b in flips))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.fingerprint_links(spark.createDataFrame(signed, "fingerprint long"), distance, segments)
    got = {frozenset((a % 2**64, b % 2**64)) for a, b in links.collect()}
    assert got == {frozenset((a, b)) for a in prints for b in prints if 0 < (a ^ b).bit_count() <= distance}


def test_one_of_each_group_stays(wide):
    rows = edge_rows()
    groups = {}
    for (d, t), (_, p, c) in zip(rows, grouped(rows)):
        groups.setdefault((c, p if c is None else None), []).append((LAST if d is None else d, t))
    out = simhash.keep_one_each(wide)
    kept = out.collect()
    assert out.columns == wide.columns and all(r[n] == "own" for r in kept for n in CLASHING)
    prints = [print_of(r.text) for r in kept]
    assert len(kept) == len(set(prints))
    assert all((a ^ b).bit_count() > 4 for i, a in enumerate(prints) for b in prints[:i])
    ids = {LAST if r.doc_id is None else r.doc_id for r in kept}
    assert ids <= {min(members)[0] for members in groups.values()}


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)]
    links += [(rng.randrange(1000, 1080), rng.randrange(1000, 1080)) for _ in range(60)]
    links += [(-5, 3), (3, -5), (3, 3), (9, 9)]
    want = roots({n for l in links for n in l}, links)
    got = dict(connected_components(spark.createDataFrame(links, "x long, y long")).collect())
    assert got == {n: r for n, r in want.items() if any(n in l and l[0] != l[1] for l in links)}


# --- urls -----------------------------------------------------------------------------------

RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block"}


def judged(url, rules, listed):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i, c in enumerate(rest) if c in "/?#"] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[: min([i for i, c in enumerate(rest) if c in "?#"] or [len(rest)])]
    fit = []
    for rule in rules:
        name, slash, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + start):
            fit.append(rule)
    rule = max(fit, key=len) if fit else None
    verdict = rules[rule] if rule else ("block" if host + path in listed else "allow")
    return host, path, rule, verdict


def urls():
    made = [
        None, "", "no scheme", "http://", "http://COM/", "HTTP://Example.COM/en/x?y#z", "http://com",
        "http://a.example.com/en/", "https://www.example.com/en/1", "http://notexample.com/en/", "x://net/es/1",
        "http://É.net/es", "http://a.net/es/#", "http://h.org?q=/x", "http://h.org#f://g/", "://b.org/p", "http://u\nv.org/a\nb?c",
    ]
    rng = random.Random(3)
    made += [f"http://h{rng.randrange(60)}.org/p{rng.randrange(60)}" for _ in range(1500)]
    return made + ["http://h1.org/hot"] * 500


@pytest.mark.parametrize("block_keys", [4_000_000, 150])
def test_urls(spark, block_keys):
    rows = list(enumerate(urls()))
    pages = spark.createDataFrame([(i, u, "k", "l") for i, u in rows], "page_id long, url string, key string, listed string")
    keys = sorted({"".join(judged(u, {}, ())[:2]) for _, u in rows})
    listed = set(random.Random(8).sample(keys, len(keys) // 3)) | {"", "not.in/corpus"}
    given = spark.createDataFrame([(k,) for k in [*listed, *listed]], "key string")
    got = url_filter.judge_urls(pages, RULES, given, block_keys)
    assert found(got) == sorted(((i, *judged(u, RULES, listed)) for i, u in rows), key=repr)


def test_urls_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    keys = spark.createDataFrame([("a.org/",)], "key string")
    assert found(url_filter.judge_urls(pages, RULES, keys.limit(0)))[0][-1] == "allow"
    assert found(url_filter.judge_urls(pages, RULES, keys))[0][-1] == "block"
    assert url_filter.judge_urls(pages.limit(0), RULES, keys).count() == 0


def test_cascade_tells_sets_apart(spark):
    keys = spark.range(6000).select(*url_filter._hashes(F.col("id").cast("string"), "a", "b"))
    listed, others = keys.limit(6000).filter("a % 3 = 0"), keys.filter("a % 3 <> 0")
    filters = url_filter.build_cascade(listed, others)
    assert len(filters) > 1
    wrong = keys.filter(url_filter.in_cascade(filters, "a", "b") != (F.col("a") % 3 == 0))
    assert wrong.count() == 0
    assert sum(f.bits for f in filters) < 12 * listed.count()
    assert all(np.any(f.words) for f in filters)


def test_the_cut_follows_the_load(spark):
    even = spark.range(3000).select(F.xxhash64("id").alias("fingerprint"))
    assert simhash.choose_segments(even, 4) == 3
    # one value in the first segment for all: probes there meet every fingerprint
    crowded = spark.range(3000).select((F.col("id") * F.lit(1 << 40)).alias("fingerprint"))
    balls = simhash.segment_balls(2, 4)
    assert sum(len(f) for _, f in balls) == 562 and simhash.choose_segments(crowded, 4) in (2, 3)
    assert simhash.choose_segments(even.limit(0), 4) == 3


@pytest.mark.parametrize("tail", [0, 200_000])
def test_the_tail_of_a_cascade_changes_nothing(spark, monkeypatch, tail):
    monkeypatch.setattr(url_filter, "TAIL_KEYS", tail)
    keys = spark.range(4000).select("id", F.xxhash64("id").alias("a"), F.xxhash64(F.lit("s"), "id").alias("b"))
    filters = url_filter.build_cascade(keys.filter("id % 5 = 0"), keys.filter("id % 5 <> 0"))
    wrong = keys.filter(url_filter.in_cascade(filters, "a", "b") != (F.col("id") % 5 == 0))
    assert len(filters) > 2 and wrong.count() == 0


@pytest.mark.parametrize("setting, size", [("4m", 4 << 20), ("262144", 262144), ("256MB", 256 << 20), ("1g", 1 << 30), ("-1", -1), ("8kb", 8192), ("100b", 100)])
def test_size_settings(setting, size):
    assert llm_rows._bytes_of(setting) == size
