"""Byte-level BPE with batched merge rounds in NumPy: encoding to ids and decoding back.

Texts are cut into words by the public pre-tokenisation pattern. Words not met before in a
task are encoded together: their bytes stand in one flat array of symbols, each round looks
up the rank of all neighbouring pairs by binary search over the sorted pair keys, and
merges the lowest-rank pairs of every word at once. Finished words leave the array.

A text is any string: null counts as empty and has no tokens, a text of any length is taken whole.
Equal texts get equal ids; rows are independent, so an empty table gives an empty table
and other columns are passed on untouched.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.rows import blocks, structs, texts

#: Unicode white space, and the pattern of the byte-level pre-tokeniser over it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)

#: Text handled at once, and how many different words a task remembers; neither changes results.
BLOCK_BYTES = 1_000_000
REMEMBERED_WORDS = 400_000

#: Cuts at white space only, as the full pattern does; the full pattern then sees each word once.
_CHUNKS = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
_WORDS = regex.compile(PATTERN)
_NO_PAIR = np.int64(2**62)


def byte_characters() -> dict[int, str]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def _gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenate ``flat[s : s + n]`` for all s, n."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts - ends + lengths, lengths)]


class _Numbered(dict):
    """Numbers strings in the order in which they are first asked for."""

    def __init__(self) -> None:
        super().__init__()
        self._new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        self._new.append(key)
        return number

    def take_new(self) -> list[str]:
        new, self._new = self._new, []
        return new


class ByteBpe:
    """A byte-level BPE vocabulary in the JSON format of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        to_byte = {c: b for b, c in byte_characters().items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = (
            re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
            if self.special
            else None
        )
        spelled = {i: bytes(to_byte[c] for c in t) for t, i in vocab.items()}
        spelled |= {i: t.encode() for t, i in self.special.items()}
        table = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
        self._token_bytes = np.frombuffer(b"".join(table), np.uint8)
        self._token_lengths = np.array([len(t) for t in table], np.int64)
        self._token_starts = np.cumsum(self._token_lengths) - self._token_lengths

        self._byte_ids = np.array([vocab[c] for _, c in sorted(byte_characters().items())], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self._pair_keys = keys[order]
        self._pair_ranks = order.astype(np.int64)
        self._pair_ids = np.array([vocab[a + b] for a, b in merges], np.int64)[order]
        self._forget()

    def _forget(self) -> None:
        self._index = _Numbered()
        self._starts = np.zeros(0, np.int64)
        self._lengths = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def _pairs_at(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For each place, the number of the merge of it and the next symbol, or -1."""
        found = np.full(len(at), -1)
        inside = np.flatnonzero(at + 1 < len(symbols))
        inside = inside[owner[at[inside]] == owner[at[inside] + 1]]
        keys = symbols[at[inside]] << 32 | symbols[at[inside] + 1]
        place = np.minimum(np.searchsorted(self._pair_keys, keys), len(self._pair_keys) - 1)
        known = self._pair_keys[place] == keys
        found[inside[known]] = place[known]
        return found

    def _ranks_of(self, pairs: np.ndarray) -> np.ndarray:
        return np.where(pairs >= 0, self._pair_ranks[pairs], _NO_PAIR)

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and how many belong to each word."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self._byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)
        pairs = self._pairs_at(symbols, owner, np.arange(len(symbols)))
        ranks = self._ranks_of(pairs)
        done_owner, done_symbols = [], []
        while len(symbols):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.repeat(
                np.minimum.reduceat(ranks, first), np.diff(np.r_[first, len(symbols)])
            )
            finished = lowest == _NO_PAIR
            if finished.any():
                done_owner.append(owner[finished])
                done_symbols.append(symbols[finished])
            at = np.flatnonzero((ranks == lowest) & ~finished)
            stays = ~finished
            if len(at):
                # in a run of overlapping pairs every second one merges, from the left
                new_run = np.r_[True, np.diff(at) != 1]
                begins = at[new_run]
                at = at[(at - begins[np.cumsum(new_run) - 1]) % 2 == 0]
                symbols[at] = self._pair_ids[pairs[at]]
                stays[at + 1] = False
            moved = np.cumsum(stays) - 1
            symbols, owner, pairs, ranks = symbols[stays], owner[stays], pairs[stays], ranks[stays]
            # only a merged symbol and the one before it have a new right neighbour
            touched = np.zeros(len(symbols) + 1, bool)
            touched[moved[at]] = touched[moved[at] - 1] = True  # -1 is the spare last place
            fresh = np.flatnonzero(touched[:-1])
            pairs[fresh] = self._pairs_at(symbols, owner, fresh)
            ranks[fresh] = self._ranks_of(pairs[fresh])
        if not done_owner:
            return np.zeros(0, np.uint32), sizes
        owner = np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        ids = np.concatenate(done_symbols)[order].astype(np.uint32)
        return ids, np.bincount(owner, minlength=len(words))

    def _learn(self, chunks: list[str]) -> None:
        """Append the ids of new chunks, in order, to the table."""
        pieces = [
            [c] if c.isascii() and c.removeprefix(" ").isalpha() else _WORDS.findall(c)
            for c in chunks
        ]
        marked = [i for i, c in enumerate(chunks) if c[0] == "\0" and c[1:] in self.special]
        for i in marked:
            pieces[i] = ["!"]  # any one symbol; its id is put in below
        ids, counts = self.merge_words([p.encode() for ps in pieces for p in ps])
        per_chunk = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.r_[0, np.cumsum(counts)][np.cumsum(per_chunk)]
        lengths = np.diff(np.r_[0, ends])
        for i in marked:
            ids[ends[i] - 1] = self.special[chunks[i][1:]]
        self._starts = np.r_[self._starts, ends - lengths + len(self._ids)]
        self._lengths = np.r_[self._lengths, lengths]
        self._ids = np.r_[self._ids, ids]

    def encode_batch(self, rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows in one array, and how many belong to each row."""
        if len(self._index) > REMEMBERED_WORDS:
            self._forget()
        chunks: list[str] = []
        ends = []
        for row in rows:
            if self._special and self._special.search(row):
                # a special token is marked by NUL; a chunk of text never holds a whole one
                for i, part in enumerate(self._special.split(row)):
                    chunks.extend([f"\0{part}"] if i % 2 else _CHUNKS.findall(part))
            else:
                chunks.extend(_CHUNKS.findall(row))
            ends.append(len(chunks))
        which = np.fromiter(map(self._index.__getitem__, chunks), np.int64, len(chunks))
        self._learn(self._index.take_new())
        lengths = self._lengths[which]
        ids = _gather(self._ids, self._starts[which], lengths)
        total = np.r_[0, np.cumsum(lengths)]
        return ids, np.diff(np.r_[0, total[np.array(ends, np.int64)]])

    def decode(self, ids: np.ndarray) -> str:
        """The text of one row of ids; bytes that are no UTF-8 become U+FFFD."""
        flat = _gather(self._token_bytes, self._token_starts[ids], self._token_lengths[ids])
        return flat.tobytes().decode("utf-8", "replace")


def _encoded(coder: ByteBpe, array: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for _, block in blocks(texts(array), BLOCK_BYTES):
        yield coder.encode_batch([b.decode("utf-8", "replace") for b in block])


def bpe_encode(path: str) -> Column:
    """Function of a text column: its ids as array<int>."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = ByteBpe(path)
        for array in batches:
            ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
            for some, each in _encoded(coder, array):
                ids.append(some)
                counts.append(each)
            offsets = np.r_[0, np.cumsum(np.concatenate(counts))].astype(np.int32)
            yield pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32))
            )

    return encode


def bpe_decode(path: str) -> Column:
    """Function of an ids column: the text; a null list gives the empty text."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = ByteBpe(path)
        for array in batches:
            yield pa.array(
                [coder.decode(np.array(row or [], np.int64)) for row in array.to_pylist()],
                pa.string(),
            )

    return decode


def token_count(path: str) -> Column:
    """Function of a text column: how many ids it encodes to."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = ByteBpe(path)
        for array in batches:
            counts = [each for _, each in _encoded(coder, array)]
            yield pa.array(np.concatenate([np.zeros(0, np.int64), *counts]), pa.int64())

    return count


DIGESTS = {
    "n_tokens": pa.int64(),
    "ids_sha256": pa.string(),
    "decoded_sha256": pa.string(),
    "ids": pa.list_(pa.int32()),
}


def bpe_digests(path: str, with_ids: bool = False) -> Column:
    """Function of a text column: number and digest of its ids, digest of the decoded text.

    Encodes and decodes in one pass; the ids themselves are returned only if asked for.
    """

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>")
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = ByteBpe(path)
        for array in batches:
            found: dict[str, list] = {name: [] for name in DIGESTS}
            for ids, counts in _encoded(coder, array):
                for row in np.split(ids, np.cumsum(counts)[:-1]):
                    found["n_tokens"].append(len(row))
                    found["ids_sha256"].append(sha256(row.astype("<u4").tobytes()).hexdigest())
                    text = coder.decode(row)
                    found["decoded_sha256"].append(sha256(text.encode()).hexdigest())
                    found["ids"].append(row.astype(np.int32) if with_ids else None)
            yield structs(found, DIGESTS)

    return digests


def round_trip(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id`` with the digests of its ids and of the text decoded from them."""
    coded = docs.select("doc_id", bpe_digests(path, with_ids)("text").alias("coded"))
    names = [n for n in DIGESTS if with_ids or n != "ids"]
    return coded.select("doc_id", *[f"coded.{n}" for n in names])
