"""Repeated runs of words: super-k-mer partitioning over windows of consecutive words.

Consecutive windows that share a minimiser travel as one packed string to the minimiser's
bucket, where sorting compares windows exactly (``repeats`` has the steps). A word is removed if
a window that covers it also starts in a document with a smaller id. Windows are judged on
the input; they do not cross documents.

A null text has no words, and a text shorter than a window loses none. A null id counts as
the largest. Rows with equal ids do not remove each other's words. Texts are taken whole.
An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.repeats import Kind, covered, repeated_windows
from millrace.llm.rows import row_key, structs, texts

FIELDS = {
    "n_words": pa.int64(),
    "n_removed": pa.int64(),
    "kept_sha256": pa.string(),
    "kept": pa.string(),
}


def word_windows(width: int = 50, hot: int = 500) -> Kind:
    """Minimisers of 8 words."""
    return Kind("words", width, max(1, min(8, width // 2)), earlier=True, hot=hot)


def _kept_words(width: int, with_text: bool) -> Column:
    @F.arrow_udf("n_words long, n_removed long, kept_sha256 string, kept string")
    def keep(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for array, spans in batches:
            found: dict[str, list] = {name: [] for name in FIELDS}
            for i, text in enumerate(texts(array)):
                words = text.split()
                total = len(words)
                if spans[i].is_valid:
                    gone = covered(spans[i].as_py(), total, width)
                    words = [words[j] for j in np.flatnonzero(~gone).tolist()]
                left = b" ".join(words)
                found["n_words"].append(total)
                found["n_removed"].append(total - len(words))
                found["kept_sha256"].append(sha256(left).hexdigest())
                found["kept"].append(left.decode("utf-8", "replace") if with_text else None)
            yield structs(found, FIELDS)

    return keep


def remove_repeated_words(
    docs: DataFrame, width: int = 50, hot: int = 500, with_text: bool = True
) -> DataFrame:
    """Per document ``doc_id, n_words, n_removed, kept_sha256`` and the ``kept`` words.

    ``hot`` is how many different surroundings of one minimiser a bucket takes; it does not
    change the result.
    """
    rows = docs.select("doc_id", "text")
    spans = repeated_windows(rows, word_windows(width, hot))
    joined = rows.select("doc_id", "text", *row_key("doc", "key")).join(spans, ["doc", "key"], "left")
    kept = joined.select("doc_id", _kept_words(width, with_text)("text", "spans").alias("left"))
    return kept.select("doc_id", "left.*")
