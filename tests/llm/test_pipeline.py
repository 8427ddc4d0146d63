"""The pipeline's stages on their own inputs, and the whole against a plain computation."""

import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from millrace.llm import oracles, quality, queries

from .test_links import grouped
from .test_text_rules import split_words
from .test_windows import LAST


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def plain(rows, items):
    """doc_id to text after the first four stages."""
    left = []
    for d, text in rows:
        verdict = quality.judge(text.encode(), quality.LineRules(), True)
        if verdict[6]:
            left.append((d, verdict[8]))
    first, kept = {}, []
    for d, text in sorted(left):
        lines = text.split("\n")
        at = [i for i, x in enumerate(lines) if x.strip(" \t\r")]
        gone = set()
        for n in range(len(at) - 2):
            window = tuple(lines[x] for x in at[n : n + 3])
            if first.setdefault(window, (d, n)) != (d, n):
                gone.update(range(at[n], at[n + 2] + 1))
        kept.append((d, "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    one = [r for r, (d, _, c) in zip(kept, grouped(kept)) if d == c]
    windows = set()
    for text in items:
        w = split_words(text)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9)) if w}
    sizes = {len(w) for w in windows}

    def clean(text):
        w = split_words(text)
        return not any(tuple(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

    return {d: t for d, t in one if clean(t)}


def test_run(spark, sf_dir, docs):
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = plain([(r.doc_id, r.text or "") for r in docs.collect()], items)
    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == {d: tokenizer.encode(t, add_special_tokens=False).ids for d, t in want.items()}


def test_stages_return_the_columns_of_documents(spark, sf_dir, wide):
    table = wide.withColumn("source", F.lit("s"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, sf_dir)
        assert out.columns == table.columns and out.dtypes == table.dtypes, name
        out.collect()
        assert stage(spark, table.limit(0), sf_dir).count() == 0
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, table, sf_dir).count() == table.count()


def test_clean_documents_pass_the_filters(spark, sf_dir):
    """Labelled good documents with enough words stay under the quality rules."""
    sf = "/root/testdata/sf0.01"
    table, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    good = quality.quality_report(table).join(labels, "doc_id").filter("quality = 1 and not base_failed")
    assert good.filter("not kept").count() == 0


def test_registration():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].partition("_")[0]) for n in names) == list(range(1, 14))
    assert set(names) == set(queries.QUERIES) and "pipeline" in contract.queries()
    assert set(oracles.SQL) <= set(names)


def test_null_id_order():
    assert LAST == 2**63 - 1
