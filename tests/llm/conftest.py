import random

import pytest

#: Names that the operators use inside; a table may have such columns of its own.
CLASHING = ["key", "doc", "hits", "judged", "kept", "starts", "lines", "at", "cuts", "removed", "more",
            "fingerprint", "root", "copy", "n_words", "listed", "a", "b", "host"]


def prose(rng, n):
    words = ["the", "and", "of", "tion", "heer", "onan", "Ström", "été", "blue", "stone", "river"]
    return " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))


def edge_rows():
    """(doc_id, text): nulls, empties, copies, near copies, repeated rows and ids, long texts."""
    rng = random.Random(5)
    texts = [prose(rng, 120).replace(" the1", ".\nthe1") for _ in range(8)]
    long = "\n".join(prose(rng, 30) + "." for _ in range(400))
    rows = [(i, t) for i, t in enumerate(texts, 1)]
    rows += [(20, texts[0]), (21, texts[0]), (22, texts[1] + " tail"), (23, "head " + texts[1])]
    rows += [(24, texts[2].replace("blue", "blau", 1)), (25, texts[2])]
    rows += [(30, None), (31, ""), (32, " \n\t \n"), (33, "x"), (34, "two words"), (35, "\n\n\n\n")]
    rows += [(None, texts[3]), (None, None), (None, "unlike any other text of them")]
    rows += [(40, texts[4]), (40, texts[4]), (41, "same id " + texts[5]), (41, texts[6] + " same id")]
    rows += [(50, long), (51, long[3000:9000]), (52, "a" * 3000), (53, "ab " * 900), (54, "a" * 3000)]
    rows += [(60 + i, "First line here.\nSecond line here.\nThird line here.\n" + prose(rng, 12 + i)) for i in range(6)]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), "doc_id long, text string").repartition(3).cache()


@pytest.fixture(scope="session")
def wide(edge):
    """The same rows with further columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    extra = {name: F.lit("own") for name in CLASHING}
    return edge.withColumns({"lang": F.lit("en"), "n_chars": F.length("text").cast("long"), **extra})


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)
