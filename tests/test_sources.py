import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace import storage
from millrace.operators import splits
from millrace.sources import corpus, document_files, positions, sinks
from millrace.sources import lines as text
from millrace.streaming import purchases
from millrace.streaming.purchases import run_available, windowed_purchase_summary


def test_dimensions(spark, tmp_path):
    files = {
        "genre": ("unknown|0\nAction|1\nChildren's|4\n\n", "name|id", {("unknown", 0), ("Action", 1), ("Children's", 4)}),
        "job": ("doctor\nnone\n", "name", {("doctor",), ("none",)}),
        "info": ("943 users\n100000 ratings\n", "count label", {(943, "users"), (100000, "ratings")}),
    }
    for name, (content, layout, expected) in files.items():
        (tmp_path / name).write_text(content)
        assert set(rows(text.read_dimension(spark, str(tmp_path / name), layout))) == expected
    with pytest.raises(ValueError):
        text.read_dimension(spark, str(tmp_path / "job"), "other")


def test_document_tree(spark, tmp_path):
    body = "From: someone\nSubject: x\n\nline one\n\nline two\n"
    for split in ("train", "test"):
        for label in ("space", "rec+x y"):
            folder = tmp_path / split / label
            folder.mkdir(parents=True)
            (folder / "10001").write_text(body + label)
    found = {(s, l, d): t for s, l, d, t in rows(corpus.read_document_tree(spark, str(tmp_path)))}
    assert set(found) == {(s, l, "10001") for s in ("train", "test") for l in ("space", "rec+x y")}
    assert found["test", "rec+x y", "10001"] == body + "rec+x y"


def test_sorted_sink(spark, log, tmp_path):
    sinks.write_sorted(log.drop("value"), str(tmp_path / "out"))
    back = [r[1].split("\t") for r in rows(text.numbered_lines(spark, str(tmp_path / "out")), "pos")]
    assert len(back) == log.count()
    keys = [(int(r[1]), int(r[2])) for r in back]
    assert keys == sorted(keys)


def test_shared_folder_is_the_configured_one(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert storage.shared_dir(spark) == folder
    kept = storage.materialize(spark.range(5), "numbers")
    assert kept.count() == 5
    assert all(f.removeprefix("file:").startswith(folder) for f in [p.replace("file://", "") for p in kept.inputFiles()])


def test_stored_tables_can_be_deleted(spark):
    path = storage.store(spark.range(5), "numbers")
    other = storage.store(spark.range(6), "numbers")
    assert spark.read.parquet(path).count() == 5
    storage.discard(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    assert spark.read.parquet(other).count() == 6
    storage.discard(spark, other)


def test_nulls_are_empty_fields(spark, tmp_path):
    log = spark.createDataFrame([(1, None, 5.0), (2, 3, None)], "userid long, itemid long, pref double")
    sinks.write_sorted(log, str(tmp_path / "out"))
    back = [r[1] for r in rows(text.numbered_lines(spark, str(tmp_path / "out")), "pos")]
    assert back == ["1\t\t5.0", "2\t3\t"]


def test_listed_directories_keep_their_order(spark, tmp_path):
    for name, lines in (("d0", ["a"]), ("s p+%20", ["b", "c"]), ("d1", ["d"])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.txt").write_text("\n".join(lines) + "\n")
    listed = [str(tmp_path / n) for n in ("d1", "s p+%20", "d0")]
    assert rows(text.numbered_lines(spark, listed), "pos") == [(0, "d"), (1, "b"), (2, "c"), (3, "a")]
    again = rows(text.numbered_lines(spark, [listed[2], listed[0], listed[2]]), "pos")
    assert [v for _, v in again] == ["a", "d", "a"]


def test_leading_white_space_is_no_field(spark, tmp_path):
    (tmp_path / "log").write_text("\t5\t6\t1\n \t 7 8\n")
    found = rows(text.read_rating_log(spark, str(tmp_path / "log")), "pos")
    assert [r[1:3] for r in found] == [("5", "6"), ("7", "8")]


def test_sorted_splits(spark, log, tmp_path):
    suite = splits.split_suite(log, 3, {"ua": (1, 2)}, max_test=50, order_by="event_id").cache()
    sinks.write_sorted_splits(suite, str(tmp_path / "s"), 3, ["ua"])
    for name, condition in (("u2.test", "fold = 2"), ("u2.base", "fold <> 2"), ("ua.test", "in_ua"), ("ua.base", "not in_ua")):
        back = [r[1] for r in rows(text.numbered_lines(spark, str(tmp_path / "s" / f"split={name}")), "pos")]
        assert back == [r.value for r in splits.sort_ratings(suite.filter(condition)).collect()]


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    source = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("ts").cast("timestamp"), F.col("event_type").alias("product"), F.col("value").alias("price")
    )
    source.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(source.schema).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    run_available(windowed_purchase_summary(stream, "6 hours"), out, str(tmp_path / "state"))
    closed = source.agg(F.max("ts") - F.expr("INTERVAL 1 HOUR")).first()[0]
    batch = (
        source.groupBy(F.window("ts", "6 hours").alias("w"), "product")
        .agg(F.count("*").alias("n"), F.round(F.sum("price"), 6).alias("v"))
        .filter(F.col("w.end") <= F.lit(closed))
        .select("w.start", "product", "n", "v")
    )
    found = spark.read.parquet(out).withColumn("revenue", F.round("revenue", 6))
    assert sorted(rows(found.select("window_start", "product", "purchases", "revenue"))) == sorted(rows(batch))


def test_split_suite_matches_single_splits(log):
    suite = splits.split_suite(log, 5, max_test=70, order_by="event_id").cache()
    for name, (start, stop) in {"in_ua": (1, 10), "in_ub": (11, 20)}.items():
        one = splits.split_leave_range(log, start, stop, 70, "event_id").filter("part = 'test'")
        assert suite.filter(name).count() == one.count() == 70
        assert suite.filter(name).join(one, "event_id").count() == 70


def test_tasks_run_without_the_package_on_their_path(tmp_path):
    """Worker processes import nothing from the package, wherever the driver finds it."""
    script = tmp_path / "job.py"
    script.write_text(
        "import sys\n"
        f"sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = (SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')\n"
        "    .config('spark.sql.shuffle.partitions', '2').getOrCreate())\n"
        "from millrace.operators import decomposition\n"
        "from millrace.shipping import ship_by_value\n"
        "ship_by_value()\n"
        "rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 1.0])], 'id long, v array<double>')\n"
        "left = decomposition.svd_left(rows, 'id', 'v', decomposition.svd(rows, 'v', 2))\n"
        "print('found', left.filter('size(left) = 2').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "found 2" in done.stdout, done.stderr[-2000:]


TREE = [
    ("train", "a b/c", "1", "line\n\nünïcode\n"), ("train", "a b/c", "x%2F..", ""), ("test", ".hidden", "7", "z" * 5000),
    ("test", "a+b", "8", "no newline"), ("test", "a+b", ".9", "\r\n"),
]


def test_document_files_round_trip(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([*TREE, ("test", "a+b", "none", None)], "split string, label string, doc_id string, text string")
    path = str(tmp_path / "tree")
    document_files.write_document_tree(docs.repartition(3), path)
    assert (tmp_path / "tree" / "_SUCCESS").read_text() == "6"
    plain = sorted([*TREE, ("test", "a+b", "none", "")])
    assert sorted(rows(document_files.read_document_files(spark, path))) == plain
    monkeypatch.setattr(document_files, "TASK_BYTES", 2 * document_files.OPEN_BYTES)
    packs = document_files.FilesReader(path).partitions()
    assert len(packs) > 1 and sum(len(p.names) for p in packs) == len(plain)
    with pytest.raises(Exception, match="exists"):
        document_files.write_document_tree(docs, path)


def test_a_failed_write_leaves_no_tree(spark, tmp_path):
    docs = spark.createDataFrame([("s", "l", "1", "x"), ("s", None, "2", "y")], "split string, label string, doc_id string, text string")
    with pytest.raises(Exception, match="no place in the tree"):
        document_files.write_document_tree(docs.repartition(2), str(tmp_path / "tree"))
    assert not (tmp_path / "tree").exists()


def test_both_tree_readers_agree(spark, tmp_path):
    docs = spark.createDataFrame([(f"s{i % 2}", f"l{i % 3}", str(i), f"text {i}\n") for i in range(40)], "split string, label string, doc_id string, text string")
    document_files.write_document_tree(docs, str(tmp_path / "tree"))
    own = sorted(rows(document_files.read_document_files(spark, str(tmp_path / "tree"))))
    assert own == sorted(rows(corpus.read_document_tree(spark, str(tmp_path / "tree")))) == sorted(rows(docs))


@pytest.mark.parametrize("killed_at", ["seen", "late", "sums"])
def test_a_killed_stream_goes_on(spark, sf_dir, tmp_path, monkeypatch, killed_at):
    """Killed within a batch, before or after it has written one of its tables."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("ts").cast("timestamp"), F.col("event_type").alias("product"), F.col("value").alias("price")
    )
    middle = events.agg(F.expr("percentile_approx(ts, 0.5)")).first()[0]
    for part in (events.filter(F.col("ts") < F.lit(middle)), events.filter(F.col("ts") >= F.lit(middle)), events.limit(50)):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run(out, state):
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        purchases.accumulate_windows(stream, str(tmp_path / out), str(tmp_path / state))

    run("whole", "state-whole")
    write = type(events.write).parquet

    def failing(self, path, *args, **kwargs):
        write(self, path, *args, **kwargs)
        if f"/{killed_at}/batch=1" in path:
            raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(type(events.write), "parquet", failing)
        with pytest.raises(Exception, match="killed"):
            run("out", "state")
    run("out", "state")
    found, want = (sorted(rows(purchases.current_windows(spark, str(tmp_path / o)).withColumn("revenue", F.round("revenue", 6)))) for o in ("out", "whole"))
    assert found == want
    late = [sorted(rows(spark.read.parquet(str(tmp_path / o / "late")).drop("batch"))) for o in ("out", "whole")]
    assert late[0] == late[1] and late[0]
    assert sum(r[2] for r in found) + len(late[0]) == events.count() + 50


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_positional_index(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(positions, "_READ", 16)
    texts = {"b/1": "one\ntwo\r\n\nfour", "b/2": "", "b/3": "\n\nx" * 40 + "\n", "a": "last\n" + "long" * 30 + "\n"}
    for name, content in texts.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content.encode())
    index = positions.index_lines(spark, [str(tmp_path / "b"), str(tmp_path / "a")], size)
    want = [line.removesuffix("\r") for t in texts.values() for line in t.removesuffix("\n").split("\n") if t]
    assert rows(positions.read_positions(index, 0, 10**6), "pos") == list(enumerate(want))
    for start, stop in ((0, 1), (3, 6), (60, 61), (len(want) - 1, len(want)), (10**6, 10**6 + 5)):
        assert rows(positions.read_positions(index, start, stop), "pos") == list(enumerate(want))[start:stop]


def test_a_slice_reads_few_of_many_ranges(spark, tmp_path):
    (tmp_path / "log").write_text("".join(f"line {i}\n" for i in range(20_000)))
    index = positions.index_lines(spark, str(tmp_path / "log"), 1 << 12)
    assert index.count() > 40
    assert 1 <= positions.ranges_of(index, 9_000, 9_300).count() <= 2
    assert rows(positions.read_positions(index, 9_000, 9_002), "pos") == [(9_000, "line 9000"), (9_001, "line 9001")]
