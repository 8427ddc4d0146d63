import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.functions import ordering
from millrace.operators import splits
from millrace.sources import lines as text
from millrace.sources import sinks


def sequential_split(log, start, stop, cap):
    """The rule, one row at a time; ``log`` holds (pos, user)."""
    seen, held, parts = {}, 0, {}
    for pos, user in sorted(log):
        seen[user] = seen.get(user, 0) + 1
        test = (cap <= 0 or held < cap) and start <= seen[user] <= stop
        held += test
        parts[pos] = "test" if test else "base"
    return parts


@pytest.fixture(scope="module")
def skewed(spark):
    """A log where one user owns about 40 % of the rows, in shuffled storage order."""
    rng = random.Random(11)
    data = [(p * 3, "hot" if rng.random() < 0.4 else f"u{rng.randrange(40)}") for p in range(2000)]
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "pos long, userid string").cache()


def ordinals(data):
    seen, out = {}, {}
    for pos, user in sorted(data):
        seen[user] = out[pos] = seen.get(user, 0) + 1
    return out


@pytest.mark.parametrize("hot_rows", [1_000_000, 100, 7])
def test_ordinal_with_a_dominant_user(skewed, hot_rows):
    data, df = skewed
    found = splits.user_ordinal(df, "pos", hot_rows).select("pos", "ordinal")
    assert dict(rows(found)) == ordinals(data)


def test_ordinal_of_null_group(spark):
    data = [(i, None if i % 2 else "a") for i in range(60)]
    df = spark.createDataFrame(data, "pos long, userid string")
    found = dict(rows(ordering.group_ordinal(df, "userid", "pos", hot_rows=5).select("pos", "ordinal")))
    assert found == ordinals(data)


@pytest.mark.parametrize("buckets", [1, 3, 50])
@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_row_position(skewed, buckets, partitions):
    data, df = skewed
    found = ordering.row_position(df.repartition(partitions), "pos", "place", buckets)
    assert dict(rows(found.select("pos", "place"))) == {p: p // 3 for p, _ in data}


def test_row_position_by_time(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("ts", "event_id")
    found = ordering.row_position(events, "ts", "place")
    assert found.filter("place <> event_id").count() == 0
    assert found.count() == events.count()


def test_row_position_needs_an_ordered_number(spark):
    with pytest.raises(TypeError):
        ordering.row_position(spark.createDataFrame([("a",)], "k string"), "k")


def test_positions_of_nothing(spark):
    empty = spark.createDataFrame([], "pos long, userid string")
    assert ordering.row_position(empty, "pos", "place").count() == 0
    assert splits.split_leave_range(empty, 1, 2, 5).count() == 0
    assert ordering.sorted_position(empty, "userid").count() == 0


def test_sorted_position_with_many_copies(spark):
    data = [("same", 1)] * 500 + [(f"k{i:03d}", i) for i in range(300)]
    df = spark.createDataFrame(data, "k string, v long").repartition(5)
    found = rows(ordering.sorted_position(df, F.col("k"), "v", name="place"), "place")
    assert [p for _, _, p in found] == list(range(800))
    assert [(k, v) for k, v, _ in found] == sorted(data)


@pytest.mark.parametrize("start,stop,cap", [(1, 10, 0), (1, 10, 50), (3, 7, 111), (5, 4, 10), (1, 10, 10**6)])
def test_split_equals_sequential_rule(skewed, start, stop, cap):
    data, df = skewed
    found = splits.split_leave_range(df, start, stop, cap).select("pos", "part")
    assert dict(rows(found)) == sequential_split(data, start, stop, cap)


def test_split_sizes(log):
    free = splits.split_leave_range(log, 1, 10, 0, "event_id")
    assert free.filter("part = 'test'").count() == 150
    capped = splits.split_leave_range(log, 1, 10, 50, "event_id")
    assert capped.filter("part = 'test'").count() == 50
    assert capped.count() == log.count()


def test_running_count(skewed):
    data, df = skewed
    counted = splits.capped_running_count(df, 2, 4, 30)
    held, expected = 0, {}
    ordinal = ordinals(data)
    for pos, _ in sorted(data):
        held += 2 <= ordinal[pos] <= 4
        expected[pos] = min(held, 30)
    assert dict(rows(counted.select("pos", "held"))) == expected


def test_folds_are_disjoint_contiguous_and_complete(log):
    folds = splits.assign_folds(log, 5, "event_id")
    bounds = rows(folds.groupBy("fold").agg(F.min("pos"), F.max("pos"), F.count("*")), "fold")
    assert bounds == [(i + 1, i * 200, i * 200 + 199, 200) for i in range(5)]
    test, base = (f(log, 2, 5, "event_id") for f in (splits.kfold_test, splits.kfold_base))
    assert test.count() + base.count() == log.count()
    assert test.join(base, "event_id").count() == 0


def test_uneven_folds_cover_everything(spark):
    folds = splits.assign_folds(spark.range(7).withColumnRenamed("id", "pos"), 5)
    assert [f for _, f in rows(folds, "pos")] == [p * 5 // 7 + 1 for p in range(7)]


def test_sort_order(spark):
    values = ["10\t1\tx", "9\t2\tx", "9\t10\tx", "9\t2\ta", "abc\t3\tx", "-1\t3\tx", "9\t1.5\tx"]
    df = spark.createDataFrame(
        [(v.split("\t")[0], v.split("\t")[1], v) for v in values],
        "userid string, itemid string, value string",
    )
    expected = ["-1\t3\tx", "abc\t3\tx", "9\t1.5\tx", "9\t2\ta", "9\t2\tx", "9\t10\tx", "10\t1\tx"]
    assert [r[2] for r in splits.sort_ratings(df).collect()] == expected
    assert [r[2] for r in rows(splits.sorted_rating_position(df), "sort_pos")] == expected


def test_read_log_keeps_source_order(spark, tmp_path):
    first, second = tmp_path / "z.data", tmp_path / "a.data"
    one = [f"{i}\t{i * 7 % 5}\t3" for i in range(400)]
    two = [f" {i}  {i % 3} 4" for i in range(50)]
    first.write_text("\n".join(one) + "\n")
    second.write_text("\n".join(two) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        found = text.read_rating_log(spark, [str(first), str(second)])
        assert found.rdd.getNumPartitions() > 3
        got = rows(found, "pos")
        swapped = rows(text.read_rating_log(spark, str(tmp_path)), "pos")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r[0] for r in got] == list(range(450))
    assert [r[3] for r in got] == one + two
    assert got[401][1:3] == ("1", "1")
    assert [r[3] for r in swapped] == two + one


def test_write_split_round_trip(spark, log, tmp_path):
    split = splits.split_leave_range(log, 1, 10, 50, "event_id")
    sinks.write_split(split, str(tmp_path / "s"), "event_id")
    for part, size in (("test", 50), ("base", 950)):
        back = [r[1] for r in rows(text.numbered_lines(spark, str(tmp_path / "s" / f"part={part}")), "pos")]
        kept = split.filter(F.col("part") == part).orderBy("event_id").select("value")
        assert len(back) == size
        assert back == [r[0] for r in kept.collect()]


def test_slice(spark):
    df = spark.range(100).withColumnRenamed("id", "pos")
    assert [r[0] for r in rows(splits.slice_rows(df, 20, 23), "pos")] == [20, 21, 22]


@pytest.fixture(scope="module")
def gaps(spark):
    """A log with rows that have no usable order key."""
    data = [(float(i), f"u{i % 4}", i % 7) for i in range(40)]
    data += [(None, "u1", 1), (None, "u2", 2), (float("nan"), "u1", 3)]
    return spark.createDataFrame(data, "at double, userid string, itemid int")


def test_rows_without_an_order_key_stay(gaps):
    size = gaps.count()
    positions = rows(ordering.row_position(gaps, "at").select("pos", "at"), "pos")
    assert [p for p, _ in positions] == list(range(size))
    assert [at for _, at in positions[:2]] == [None, None] and positions[-1][1] != positions[-1][1]
    assert splits.capped_running_count(gaps, 1, 3, 5, "at").count() == size
    for cap in (0, 5):
        assert splits.route_rows(gaps, 1, 3, cap, "at").count() == size
        parts = splits.split_leave_range(gaps, 1, 3, cap, "at")
        assert parts.count() == size
    suite = splits.split_suite(gaps, 5, max_test=5, order_by="at")
    assert suite.count() == size and suite.filter("fold is null").count() == 0
    hot = ordering.group_ordinal(gaps, "userid", "at", hot_rows=3)
    plain = ordering.group_ordinal(gaps, "userid", "at")
    assert sorted(map(repr, rows(hot))) == sorted(map(repr, rows(plain)))


def test_all_order_keys_null(spark):
    df = spark.createDataFrame([(None, i) for i in range(5)], "at long, x long")
    assert sorted(r[0] for r in rows(ordering.row_position(df, "at").select("pos"))) == list(range(5))


def test_capped_count_shuffles_the_log_once(spark, log):
    for frame in (splits.capped_running_count(log, 1, 10, 50, "event_id"), splits.split_suite(log, order_by="event_id")):
        plan = frame._jdf.queryExecution().toString()
        plan = plan[plan.index("== Physical Plan ==") :]
        # the small tables come from the shared folder; the ordinal and the counts share the exchange
        moved = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
        assert sum("REPARTITION" in line for line in moved) == 1
        assert sum("row_number()" in line and "Window [" in line for line in plan.splitlines()) == 1


def odd_log(spark, kind):
    """A third of the rows without an order key or with NaN, one user with most of the rest."""
    rng = random.Random(4)
    rows = []
    for i in range(900):
        key = None if i % 3 == 0 and kind != "nan" else float("nan") if i % 3 == 0 else float(i)
        rows.append((key, 7 if rng.random() < 0.6 else rng.randrange(20), i))
    return spark.createDataFrame(rows, "at double, userid long, itemid long").repartition(5)


@pytest.mark.parametrize("kind", ["null", "nan"])
def test_rows_without_a_key_are_ordered_and_spread(spark, kind):
    df = odd_log(spark, kind)
    _, tie = ordering._row_order(df, "at")
    ordered = [tuple(r) for r in df.withColumn("tie", tie).collect()]
    first = kind == "null"
    ordered.sort(key=lambda r: ((r[0] is not None, 0 if first and r[0] is None else (r[0] != r[0], r[0] if r[0] == r[0] else 0)), r[3])
                 if first else ((r[0] != r[0], r[0] if r[0] == r[0] else 0), r[3]))
    seen, held, want = {}, 0, {}
    for pos, (_, user, item, _) in enumerate(ordered):
        seen[user] = seen.get(user, 0) + 1
        held += 3 <= seen[user] <= 12
        want[item] = (seen[user], held, pos)
    got = ordering.segmented_scan(df, "userid", "at", "ordinal", {"held": (3, 12)}, buckets=6, position="pos", total="n")
    assert {r.itemid: (r.ordinal, r.held, r.pos) for r in got.collect()} == want
    assert {r.n for r in got.collect()} == {900}
    cuts = ordering.order_cuts(df, "at", 6)
    sizes = [r[1] for r in rows(ordering.with_order_bucket(df, "at", cuts, tie).groupBy("_bucket").count())]
    assert len(sizes) >= 10 and max(sizes) < 200


def test_scan_of_null_users_and_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, None), (4, 5), (5, None)], "at long, userid long")
    got = ordering.segmented_scan(df, "userid", "at", "ordinal", {"held": (2, 2)}, buckets=3)
    assert rows(got.select("at", "ordinal", "held"), "at") == [(1, 1, 0), (2, 1, 0), (3, 2, 1), (4, 2, 2), (5, 3, 2)]
    assert ordering.segmented_scan(df.limit(0), "userid", "at", "ordinal", {"held": (1, 2)}).count() == 0



def test_empty_log(spark):
    empty = spark.createDataFrame([], "at long, userid string, itemid long")
    assert splits.split_suite(empty, order_by="at").count() == 0
    assert splits.kfold_test(empty, 1, order_by="at").count() == 0


@pytest.mark.parametrize("start, stop", [(0, 3), (290, 330), (895, 2000), (2000, 2001)])
def test_slice_of_a_log(spark, start, stop):
    df = odd_log(spark, "null")
    whole = {p: i for i, p in rows(ordering.row_position(df, "at").select("itemid", "pos"))}
    part = splits.slice_log(df, start, stop, "at")
    assert {r.pos: r.itemid for r in part.collect()} == {p: i for p, i in whole.items() if start <= p < stop}
