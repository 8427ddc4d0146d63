import random
from collections import Counter

import pytest

from conftest import rows
from millrace.operators import purchases as P
from millrace.sources import lines as text

SCHEMA = "user string, product string, price double"

EDGES = ["a,b,", "a,b", "a,b,c", "a,b,1.5,x", "", " u , p , 2 ", '"x,y",p,3']


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_parse_edges(spark):
    accepted = rows(text.parse_purchases(lines(spark, EDGES)), "user")
    assert accepted == [(" u ", " p ", 2.0), ("a", "b", 1.5)]
    rejected = dict(rows(text.rejected_lines(lines(spark, EDGES))))
    assert rejected == {
        "a,b,": "third field is not a number",
        "a,b": "fewer than 3 fields",
        "a,b,c": "third field is not a number",
        "": "fewer than 3 fields",
        '"x,y",p,3': "third field is not a number",
    }


def test_parse_failfast(spark):
    good = lines(spark, ["a,b,1"])
    assert rows(text.parse_purchases(good, "failfast")) == [("a", "b", 1.0)]
    with pytest.raises(Exception, match="fewer than 3 fields"):
        text.parse_purchases(lines(spark, ["a,b"]), "failfast").collect()
    with pytest.raises(ValueError):
        text.parse_purchases(good, "other")


def test_parse_ratings_keeps_text_ids(spark):
    assert rows(text.parse_ratings(lines(spark, ["01,2,5.0"]))) == [("01", "2", 5.0)]


def test_summary_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(P.purchase_summary(empty)) == [(0, 0, 0.0, None, 0)]
    assert rows(P.total_revenue(empty)) == [(0.0,)]


def test_summary_ties_take_the_smallest_product(spark):
    data = [("u", "b", 1.0), ("u", "a", 2.0), ("v", "b", 3.0), ("v", "a", 4.0), ("w", "c", 0.5)]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(P.purchase_summary(df)) == [(5, 3, 10.5, "a", 2)]
    assert rows(P.most_popular_product(df)) == [("a", 2)]
    assert rows(P.purchase_report(df)) == [
        (
            "Total purchases: 5",
            "Unique users: 3",
            "Total revenue: 10.50",
            "Most popular product: a with 2 purchases",
        )
    ]


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_summary_with_dominant_keys(spark, partitions):
    rng = random.Random(5)
    data = [
        ("hot" if rng.random() < 0.4 else f"u{rng.randrange(200)}",
         "hit" if rng.random() < 0.4 else f"p{rng.randrange(50)}",
         float(rng.randrange(100)))
        for _ in range(3000)
    ]
    df = spark.createDataFrame(data, SCHEMA).repartition(partitions)
    top = min(Counter(p for _, p, _ in data).items(), key=lambda x: (-x[1], x[0]))
    expected = (3000, len({u for u, _, _ in data}), sum(x for _, _, x in data), *top)
    assert rows(P.purchase_summary(df)) == [expected]
