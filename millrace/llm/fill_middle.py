"""Fill-in-the-middle: a text is cut into three parts, whose order and marks train infilling.

A unit is a run of ASCII letters, or any other single character. Per batch of rows, Arrow's
functions split texts into lists of units, flatten them with the index of their text, number
them, filter each part by number, rebuild the lists and join the pieces. Where a text is
cut follows from a hash of its id, so a lost task makes the same cuts again.

Null texts count as empty, and empty texts stay plain, as do texts that hold a mark of their
own. A null id hashes as an empty one; rows with equal ids draw the same numbers. Texts of any
length are taken whole: long ones go through the functions in pieces that end between units. An empty table
gives an empty result. Other columns are kept; new ones replace columns of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.rows import blocks, quoted, structs, unused

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ANY_MARK = "<[PSM]>"

_UNIT = "[A-Za-z]+|[^A-Za-z]"
_BREAK = b"\xff"  # a byte that UTF-8 never has
_BOUNDARY = re.compile(rb"[^A-Za-z\x80-\xbf]")  # a character that is a unit of its own starts here

#: Bytes of the pieces that are split into units at once; a longer run of letters stands alone.
PIECE = 1 << 19

FIELDS = {
    "n": pa.int64(),
    "form": pa.string(),
    "prefix_chars": pa.int64(),
    "middle_chars": pa.int64(),
    "output": pa.string(),
}


@dataclass(frozen=True)
class Draws:
    """Columns with four whole numbers of 32 bits that decide a row's cuts and form."""

    first: Column
    second: Column
    plain: Column
    order: Column


def draws(doc_id: Column, seed: int = 1) -> Draws:
    """The first four groups of eight hex digits of the SHA-256 of ``seed:doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return Draws(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)])


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in parts of about ``PIECE`` bytes that end between units."""
    begin = 0
    while len(text) - begin > PIECE:
        cut = _BOUNDARY.search(text, begin + PIECE)
        if not cut:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]


def _strings(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.large_binary()).cast(pa.large_string())


def unit_lists(pieces: pa.Array) -> pa.Array:
    """A list of units for each text."""
    broken = pc.replace_substring_regex(pieces, pattern=f"({_UNIT})", replacement=b"\\1" + _BREAK)
    # every unit is followed by a break, so the last entry of each list is empty
    whole = pc.split_pattern(broken, pattern=_BREAK)
    offsets = whole.offsets.to_numpy().astype(np.int64)
    keep = np.ones(offsets[-1] - offsets[0], bool)
    keep[offsets[1:] - offsets[0] - 1] = False
    units = whole.flatten().filter(pa.array(keep))
    shifted = offsets - offsets[0] - np.arange(len(offsets))
    return pa.LargeListArray.from_arrays(pa.array(shifted, pa.int64()), units)


def cut_parts(pieces: pa.Array, before: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[pa.Array]:
    """Three arrays of strings: the units of each piece below ``low``, up to ``high``, and above.

    ``before`` is how many units of its text precede a piece.
    """
    lists = unit_lists(pieces)
    units, parent = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    begins = lists.offsets.to_numpy()[:-1]
    ordinal = np.arange(len(units)) - begins[parent] + before[parent]
    role = (ordinal >= low[parent]).astype(np.int8) + (ordinal >= high[parent])
    parts = []
    for which in range(3):
        mine = role == which
        counts = np.bincount(parent[mine], minlength=len(pieces))
        offsets = pa.array(np.r_[0, np.cumsum(counts)], pa.int64())
        rebuilt = pa.LargeListArray.from_arrays(offsets, units.filter(pa.array(mine)))
        parts.append(pc.binary_join(rebuilt, pa.scalar("", pa.large_string())))
    return parts


def _joined(parts: pa.Array, owner: np.ndarray, total: int) -> pa.Array:
    """The strings of each owner, one behind the other."""
    offsets = pa.array(np.searchsorted(owner, np.arange(total + 1)), pa.int64())
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, parts), pa.scalar("", pa.large_string()))


def _transform(rows: list[bytes], h: np.ndarray, plain: int, spm: int) -> dict[str, list | pa.Array]:
    """The output columns for some rows; ``h`` has a row of four draws for each."""
    cut = [list(_pieces(row)) for row in rows]
    owner = np.repeat(np.arange(len(rows)), [len(c) for c in cut])
    pieces = [p for c in cut for p in c]
    counts, before = [], np.zeros(len(pieces), np.int64)
    grouped = [(first, _strings(part)) for first, part in blocks(pieces, PIECE)]
    for _, part in grouped:
        counts.append(pc.count_substring_regex(part, pattern=_UNIT).to_numpy())
    counts = np.concatenate(counts).astype(np.int64) if counts else np.zeros(0, np.int64)
    n = np.bincount(owner, counts, minlength=len(rows)).astype(np.int64)
    before = np.cumsum(counts) - counts
    before -= before[np.searchsorted(owner, np.arange(len(rows)))][owner]
    cuts = h[:, :2] % (n + 1)[:, None]
    low, high = cuts.min(axis=1), cuts.max(axis=1)

    found: list[list[pa.Array]] = [[], [], []]
    for first, part in grouped:
        own = slice(first, first + len(part))
        places = low[owner[own]], high[owner[own]]
        for into, strings in zip(found, cut_parts(part, before[own], *places), strict=True):
            into.append(strings)
    prefix, middle, suffix = (_joined(pa.concat_arrays(f), owner, len(rows)) for f in found)

    texts = _strings(rows)
    marked = pc.match_substring_regex(texts, pattern=ANY_MARK).to_numpy(zero_copy_only=False)
    is_plain = (n == 0) | marked | (h[:, 2] % 100 >= 100 - plain)
    is_spm = h[:, 3] % 100 < spm
    p, s, m, none = (pa.scalar(x, pa.large_string()) for x in (PREFIX, SUFFIX, MIDDLE, ""))
    psm_text = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none)
    spm_text = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none)
    form = np.where(is_plain, "plain", np.where(is_spm, "spm", "psm"))
    cases = pa.StructArray.from_arrays([pa.array(is_plain), pa.array(is_spm)], names=["plain", "spm"])
    hidden = pa.array(is_plain)
    nothing = pa.scalar(None, pa.int64())
    return {
        "n": n,
        "form": form.tolist(),
        "prefix_chars": pc.if_else(hidden, nothing, pc.utf8_length(prefix)),
        "middle_chars": pc.if_else(hidden, nothing, pc.utf8_length(middle)),
        "output": pc.case_when(cases, texts, spm_text, psm_text).cast(pa.string()),
    }


def _transformed(plain: int, spm: int) -> Column:
    kinds = "n long, form string, prefix_chars long, middle_chars long, output string"

    @F.arrow_udf(kinds)
    def transform(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for text, *numbers in batches:
            rows = [b or b"" for b in text.cast(pa.large_binary()).to_pylist()]
            h = np.stack([x.to_numpy(zero_copy_only=False) for x in numbers], axis=1)
            done = [
                structs(_transform(part, h[first : first + len(part)], plain, spm), FIELDS)
                for first, part in blocks(rows, 4 * PIECE)
            ]
            types = [pa.field(name, kind) for name, kind in FIELDS.items()]
            yield pa.concat_arrays(done) if done else pa.array([], pa.struct(types))

    return transform


def fill_in_middle(docs: DataFrame, seed: int = 1, plain: int = 10, spm: int = 20) -> DataFrame:
    """``docs`` with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and the ``output`` text.

    ``n`` counts units. ``plain`` percent of the texts stay as they are; of the others ``spm``
    percent begin with the suffix and the rest with the prefix, always ending with the middle.
    Lengths are in characters, and null for plain texts.
    """
    h, made = draws(F.col("doc_id"), seed), unused(docs, "made")
    kept = [quoted(c) for c in docs.columns if c.lower() not in FIELDS]
    cut = _transformed(plain, spm)("text", h.first, h.second, h.plain, h.order)
    rows = docs.withColumn(made, cut)
    return rows.select(*kept, *[F.col(made)[c].alias(c) for c in FIELDS])


@F.arrow_udf(T.StringType())
def restored(output: pa.Array, form: pa.Array) -> pa.Array:
    """The text that ``output`` was made from, found by its marks and its form."""
    output = output.cast(pa.large_string())
    # a transformed text holds exactly three marks: the text itself has none
    split = pc.split_pattern(pc.replace_substring_regex(output, pattern=ANY_MARK, replacement=_BREAK), pattern=_BREAK)
    plain = pc.equal(form, "plain")
    safe = pc.if_else(plain, pa.scalar(["", "", "", ""], split.type), split)
    first, second, middle = (pc.list_element(safe, i) for i in (1, 2, 3))
    is_psm = pc.equal(form, "psm")
    prefix, suffix = pc.if_else(is_psm, first, second), pc.if_else(is_psm, second, first)
    whole = pc.binary_join_element_wise(prefix, middle, suffix, pa.scalar("", pa.large_string()))
    return pc.if_else(plain, output, whole).cast(pa.string())
