"""Repeated byte strings: suffixes sorted by bucket-pointer refinement.

Suffixes of all texts are told apart up to the length of a match. They are first dealt into
buckets by content, so that equal strings meet, and where a bucket is not decided by counts its
suffixes are sorted: buckets of equal first bytes are refined by the bucket numbers of
later offsets, and each refinement is used by the next (``repeats`` has the steps). A byte is
removed if a string of ``width`` bytes that covers it also starts anywhere else.

Texts are UTF-8 bytes, null counts as empty. Strings do not cross documents; overlaps
count. Two equal rows are two documents, and both lose their strings. Texts are taken whole, an empty
table gives an empty result. Only ``doc_id`` and ``text`` are read.
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
    "n_bytes": pa.int64(),
    "n_removed": pa.int64(),
    "n_spans": pa.int64(),
    "kept_sha256": pa.string(),
    "kept": pa.binary(),
}


def byte_windows(width: int = 400, hot: int = 500) -> Kind:
    """Minimisers of 64 bytes."""
    return Kind("bytes", width, max(1, min(64, width // 2)), earlier=False, hot=hot)


def _kept_bytes(width: int, with_text: bool) -> Column:
    @F.arrow_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    def keep(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for array, spans in batches:
            found: dict[str, list] = {name: [] for name in FIELDS}
            for i, text in enumerate(texts(array)):
                left, runs = text, 0
                if spans[i].is_valid:
                    gone = covered(spans[i].as_py(), len(text), width)
                    left = np.frombuffer(text, np.uint8)[~gone].tobytes()
                    runs = int((gone & ~np.r_[False, gone[:-1]]).sum())
                found["n_bytes"].append(len(text))
                found["n_removed"].append(len(text) - len(left))
                found["n_spans"].append(runs)
                found["kept_sha256"].append(sha256(left).hexdigest())
                found["kept"].append(left if with_text else None)
            yield structs(found, FIELDS)

    return keep


def remove_repeated_bytes(
    docs: DataFrame, width: int = 400, hot: int = 500, with_text: bool = True
) -> DataFrame:
    """Per document ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and the ``kept`` bytes.

    ``n_spans`` counts maximal removed runs. ``hot`` is how many different surroundings of one
    minimiser a bucket takes; it does not change the result.
    """
    rows = docs.select("doc_id", "text")
    spans = repeated_windows(rows, byte_windows(width, hot))
    joined = rows.select("doc_id", "text", *row_key("doc", "key")).join(spans, ["doc", "key"], "left")
    kept = joined.select("doc_id", _kept_bytes(width, with_text)("text", "spans").alias("left"))
    return kept.select("doc_id", "left.*")
