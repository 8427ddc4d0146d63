"""Fill-in-the-middle, sharding and whitening against brute force."""

import re
import zlib
from collections import Counter, defaultdict
from decimal import Decimal
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import fill_middle, queries, sharding, whitening

from .conftest import CLASHING, edge_rows, found

# --- fill in the middle ----------------------------------------------------------------------


def filled(rows, plain=10, spm=20, seed=1):
    out = []
    for d, t in rows:
        t = t or ""
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", t)
        digest = sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
        n = len(units)
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
        if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100 - plain:
            out.append((d, n, "plain", None, None, t))
        elif h4 % 100 < spm:
            out.append((d, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"))
        else:
            out.append((d, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"))
    return sorted(out, key=repr)


HARD = ["a<P>b", "<S>", "x <M", "<", "P>", "<<S", "é√\x00 ü", "𝔘nicode 𝔘", "tab\there\nand\r\n", "ends<", "ABC", "﻿x"]


def hard_rows():
    return edge_rows() + [(100 + i, t) for i in range(40) for t in HARD]


@pytest.mark.parametrize("piece", [1 << 19, 200])
def test_fill_equals_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(fill_middle, "PIECE", piece)  # long texts go through in parts
    rows = hard_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = fill_middle.fill_in_middle(df).drop("text")
    assert found(got) == filled(rows)
    forms = Counter(r[2] for r in found(got))
    assert min(forms[f] for f in ("plain", "psm", "spm")) > 20


def test_pieces_end_between_units():
    text = ("Wort " * 300 + "langes" * 400 + "été中文" * 200).encode()
    fill_middle.PIECE, kept = 100, fill_middle.PIECE
    try:
        pieces = list(fill_middle._pieces(text))
    finally:
        fill_middle.PIECE = kept
    assert b"".join(pieces) == text and len(pieces) > 5
    units = [u for p in pieces for u in re.findall(r"[A-Za-z]+|[^A-Za-z]", p.decode())]
    assert units == re.findall(r"[A-Za-z]+|[^A-Za-z]", text.decode())


@pytest.mark.parametrize("plain, spm", [(0, 0), (0, 100), (100, 50)])
def test_every_form_is_read_back(spark, plain, spm):
    rows = hard_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made = fill_middle.fill_in_middle(df, seed=3, plain=plain, spm=spm)
    assert found(made.drop("text")) == filled(rows, plain, spm, 3)
    back = made.select(fill_middle.restored("output", "form").eqNullSafe(F.coalesce("text", F.lit(""))))
    assert all(r[0] for r in back.collect())


def test_fill_replaces_columns_of_its_names(wide, empty):
    odd = wide.withColumns({"n": F.lit("own"), "Output": F.lit(1), "made": F.lit(2)})
    got = fill_middle.fill_in_middle(odd)
    assert [c for c in got.columns if c.lower() == "output"] == ["output"]
    assert {*CLASHING, "made", "lang"} <= set(got.columns)
    assert found(got.select("doc_id", *fill_middle.FIELDS)) == filled(edge_rows())
    assert fill_middle.fill_in_middle(empty).count() == 0


# --- sharding --------------------------------------------------------------------------------


def check_shards(rows, got, shards):
    size = {(d, t): len((t or "").encode()) + 8 for d, t in rows}
    expected = sorted((repr(d), size[d, t], zlib.crc32((t or "").encode())) for d, t in rows)
    assert sorted((repr(r.doc_id), r["size"], r.text_crc32) for r in got) == expected
    places = defaultdict(list)
    for r in got:
        places[r.shard].append(r.slot)
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_shards_hold_every_row_once(wide):
    got = sharding.shard_report(wide, 5).collect()
    check_shards(edge_rows(), got, 5)


def many_rows(hot):
    rng = np.random.default_rng(2)
    rows = [(i, "x" * int(rng.integers(0, 400))) for i in range(3000)]
    return rows + [(hot, "the same text again") for _ in range(1500)]


@pytest.mark.parametrize("hot", [None, 7])
def test_a_hot_id_is_dealt_over_the_shards(spark, hot):
    rows = many_rows(hot)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sharding.shard_report(df, 24, 512).collect()
    check_shards(rows, got, 24)
    sums = Counter()
    for r in got:
        sums[r.shard] += r["size"]
    assert len(sums) == 24
    assert max(sums.values()) - min(sums.values()) < 0.02 * max(sums.values())
    shards = defaultdict(set)
    for r in got:
        shards[r.doc_id].add(r.shard)
    assert len(shards[hot]) > 5 and all(len(s) == 1 for d, s in shards.items() if d != hot)


def test_versions_of_the_map(spark):
    df = spark.createDataFrame(many_rows(None), "doc_id long, text string")
    records = sharding.records_of(df, 256)
    slot_map = sharding.balanced_map(records, 6, 256)
    first, second = (dict(map(tuple, slot_map.latest(spark, v).collect())) for v in (1, 2))
    assert first == {s: s % 6 for s in range(256)}
    assert set(second) == set(first)
    stays = sum(first[s] == second[s] for s in first)
    assert 256 * 0.7 < stays  # an edit, not another map
    filled = records.groupBy("vslot").agg(F.sum("size").alias("bytes"))
    slot_map.add(sharding.rebalanced(slot_map.latest(spark), filled, 7))
    third = dict(map(tuple, slot_map.latest(spark).collect()))
    assert slot_map.rows(spark).agg(F.max("version")).first()[0] == 3
    loads, moved = Counter(), Counter()
    for r in filled.collect():
        loads[third[r.vslot]] += r.bytes
        moved[third[r.vslot] == 6] += r.bytes * (third[r.vslot] != second[r.vslot])
    assert moved[True] > 5 * moved[False]  # the new shard fills, the others only even out
    assert max(loads.values()) - min(loads.values()) < 0.1 * max(loads.values())


def test_written_shards_hold_the_texts(spark, wide, tmp_path):
    records = sharding.records_of(wide)
    slot_map = sharding.balanced_map(records, 4)
    clashing = wide.withColumns({c: F.lit("own") for c in ("shard", "hot_id", "hot", "vslot", "size")})
    for docs, name in ((wide, "shard"), (clashing, "_shard")):
        assert sharding.write_shards(docs, f"{tmp_path}/{name}", slot_map, parts=2) == name
        back = spark.read.parquet(f"{tmp_path}/{name}")
        assert set(back.columns) == {*docs.columns, name}
        assert found(back.select(docs.columns)) == found(docs)


def test_no_rows_to_shard(empty):
    assert sharding.shard_report(empty, 3).count() == 0


# --- whitening -------------------------------------------------------------------------------


def vectors_frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def check_whitening(rows, got, k=4):
    """Against NumPy, up to a component's sign."""
    ok = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows if v and None not in v and np.isfinite(v).all()]
    x = np.array(sorted({tuple(v) for _, v in ok}))
    n, sums = len(x), x.sum(axis=0)
    cov = np.cov(x.T, bias=True).reshape(x.shape[1], -1)
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    by_component = defaultdict(list)
    for r in got:
        by_component[r.component].append(r)
    assert sorted(by_component) == list(range(1, min(k, x.shape[1]) + 1))
    for c, found_rows in by_component.items():
        assert sorted(repr(r.vec_id) for r in found_rows) == sorted(repr(i) for i, _ in ok)
        expected = {}
        for i, v in ok:
            expected.setdefault((repr(i), int(((n * v - sums) ** 2).sum())), []).append(
                (v - sums / n) @ u[:, c - 1] / np.sqrt(e[c - 1])
            )
        actual = defaultdict(list)
        for r in found_rows:
            assert r.n == n and r.deviation == r.deviation_exact
            assert abs(r.explained - e[c - 1] / e.sum()) < 1e-12
            actual[repr(r.vec_id), r.deviation].append(r.whitened)
        assert set(actual) == set(expected)
        a = np.concatenate([sorted(actual[key]) for key in sorted(actual)])
        b = np.concatenate([sorted(expected[key]) for key in sorted(actual)])
        opposite = np.concatenate([sorted(-y for y in expected[key]) for key in sorted(actual)])
        assert min(np.abs(a - b).max(), np.abs(a - opposite).max()) < 1e-8
    assert all(r.identity_error <= 1e-10 for r in got)


@pytest.mark.parametrize("dims", [60, 3])
def test_whitening_equals_numpy(spark, dims):
    rng = np.random.default_rng(dims)
    base = rng.normal(size=(400, dims)) * np.linspace(2, 0.1, dims) + rng.normal(size=dims)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(None, base[3].tolist()), (5, base[5].tolist())] + [(1000 + i, base[7].tolist()) for i in range(200)]
    bad = [None, [], [1.0], [None] * dims, [float("nan")] * dims, [float("inf")] + [0.0] * (dims - 1)]
    rows += [(2000 + i, v) for i, v in enumerate(bad)]
    got = whitening.whitening_report(vectors_frame(spark, rows).repartition(5)).collect()
    check_whitening([r for r in rows if r[0] is None or r[0] < 2000], got)


def test_a_flat_spectrum_and_a_cluster(spark):
    rng = np.random.default_rng(4)
    x = np.linalg.qr(rng.normal(size=(600, 50)))[0] * 40  # all eigenvalues nearly equal
    df = vectors_frame(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    _, fit = whitening.whiten(df)
    whole = np.floor(256 * x.astype(np.float32).astype(float))
    e = np.linalg.eigvalsh(np.cov(whole.T, bias=True))[::-1][:4]
    assert np.allclose(fit.values, e, rtol=1e-12) and fit.identity_error < 1e-10


def test_few_rows_and_no_rows(spark):
    assert whitening.whitening_report(vectors_frame(spark, [])).count() == 0
    assert whitening.whitening_report(vectors_frame(spark, [(1, None), (2, [])])).count() == 0
    alone = whitening.whitening_report(vectors_frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.identity_error) for r in alone] == [
        (1, 1, 0, None, None), (2, 1, 0, None, None)
    ] * 2
    two = whitening.whitening_report(vectors_frame(spark, [(1, [0.0, 0.0, 0.0]), (2, [1.0, 2.0, 2.0])])).collect()
    first = [abs(r.whitened) for r in two if r.component == 1]
    assert np.allclose(first, 1) and all(r.whitened is None for r in two if r.component > 1)


def test_deviations_beyond_64_bits_stay_exact(spark):
    df = vectors_frame(spark, [(i, [float(i) * 1e4, 1.0]) for i in range(50)])
    got = whitening.whitening_report(df).collect()
    x = [256 * i * 10**4 for i in range(50)]
    for r in got:
        exact = (50 * x[r.vec_id] - sum(x)) ** 2
        assert r.deviation_exact == Decimal(exact)
        assert r.deviation == (exact if exact < 2**63 else None)
    assert any(r.deviation is None for r in got) and any(r.deviation is not None for r in got)


def test_queries_add_only_digests(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    expected = [
        (d, n, form, p, m, sha256(out.encode()).hexdigest())
        for d, n, form, p, m, out in filled([tuple(r) for r in docs.collect()])
    ]
    got = queries.QUERIES["op11_fill_middle"](spark, sf_dir)
    assert found(got.drop("restored_sha256")) == sorted(expected, key=repr)
    whole = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256))
    assert found(got.select("doc_id", "restored_sha256")) == found(whole)
    check_whitening(
        [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()],
        queries.QUERIES["op13_whitening"](spark, sf_dir).collect(),
    )
