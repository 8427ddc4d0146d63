"""Chat formatting as a prefix tree: turns that conversations share at their start occur once.

A node of the tree is a sequence of initial turns, known by the sums of the hashes of its (place,
turn) pairs, so equal beginnings meet whatever conversation they come from. Sums can be run in
pieces: rows are numbered by one distributed sort, a piece of a conversation is what one range of
these numbers holds of it, and pieces continue from the totals of those before. So no task holds
a whole conversation, even one with a third of all rows.

The nodes' tokens are emitted depth first in one stream. Every node has its place in the stream, the
position of its first token in any conversation through it, and the stream intervals of its
ancestors: the tokens it attends to, besides those before it in the node itself.

Depth-first order is a distributed sort of one short key for each different conversation: the nodes
on its path at which it leaves another one, which branches off or ends there. Leaving m others
takes m conversations of different lengths up to there, so m is below the root of twice the rows,
while paths may be as long as the table. A node belongs to the first conversation that has it. What
one conversation owns is a single run of the stream, so positions and ancestors need to be known
only at the beginning of the run. Texts are formatted and encoded once for each different turn.

A turn is written as start mark, role, line feed, text, end mark, line feed. Control strings
inside a role or text are escaped, reversibly, and none of them can be read as a mark. The loss
mask covers the texts of assistant turns.

Turns are ordered by ``turn``, then role, then a hash of the text; null turns come first. Null roles and
texts are empty. Rows without a conversation id make up one conversation. Rows that repeat are
turns of their own. An empty table gives empty results. Only the four columns are read. Reading back
runs through the turns of a conversation in order, as its digests ask, holding one at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.ordering import sorted_position
from millrace.llm.byte_bpe import ByteBpe
from millrace.llm.rows import structs
from millrace.storage import materialize

START, END = "<|im_start|>", "<|im_end|>"

#: Strings that must not stand in a text as they are: this template's marks and other common ones.
CONTROL = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\([\\.n])")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)
_RANGE = 1 << 16
_ID = 16


def escape(text: str) -> str:
    """``text`` without control strings: backslashes double, a control string is broken up."""
    doubled = text.replace("\\", "\\\\")
    return _CONTROL.sub(lambda found: found[0][0] + "\\." + found[0][1:], doubled)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda found: {"\\": "\\", ".": "", "n": "\n"}[found[1]], text)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """Head, body and tail of a formatted turn."""
    return f"{START}{escape(role).replace('\n', '\\n')}\n", escape(text), f"{END}\n"


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


@dataclass(frozen=True)
class ChatTree:
    """The emitted nodes, where every conversation ends, and the paths there.

    ``nodes``: node, parent, depth, start, n_tokens, position, ancestors (intervals of the
    stream), ids, loss_from, loss_to (tokens of the node under the loss mask), n_chars.
    ``conversations``: conv_id, node (the last one of its path). ``paths``: last, depth, node; a row
    for each turn of every different conversation.
    """

    nodes: DataFrame
    conversations: DataFrame
    paths: DataFrame


def _encoded(vocabulary: str) -> Column:
    types = {
        "ids": pa.list_(pa.int32()),
        "loss_from": pa.int64(),
        "loss_to": pa.int64(),
        "n_chars": pa.int64(),
    }

    @F.arrow_udf("ids array<int>, loss_from long, loss_to long, n_chars long")
    def encode(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        coder = ByteBpe(vocabulary)
        for roles, texts in batches:
            found: dict[str, list] = {name: [] for name in types}
            turns = list(zip(roles.to_pylist(), texts.to_pylist(), strict=True))
            parts = [p for role, text in turns for p in turn_parts(role, text)]
            ids, counts = coder.encode_batch(parts)
            ends = np.cumsum(counts).tolist()
            for i, (role, _) in enumerate(turns):
                begin = ends[3 * i - 1] if i else 0
                head, body, tail = ends[3 * i : 3 * i + 3]
                found["ids"].append(ids[begin:tail].astype(np.int32))
                found["loss_from"].append(head - begin)
                found["loss_to"].append((body if role == "assistant" else head) - begin)
                found["n_chars"].append(sum(map(len, parts[3 * i : 3 * i + 3])))
            yield structs(found, types)

    return encode("role", "text")


def _numbered(turns: DataFrame) -> DataFrame:
    """The rows in order: ``at``, place in the table; ``piece``, place of the first row that the
    same conversation has in the same range; ``first`` and ``size`` of the conversation."""
    rows = sorted_position(turns, "conv_id", "turn", "role", "hash", name="at")
    inside = W.partitionBy(F.floor(F.col("at") / _RANGE), "conv_id")
    rows = materialize(
        rows.select("conv_id", "hash", "at", F.min("at").over(inside).alias("piece")), "numbered"
    )
    whole = W.partitionBy("conv_id")
    pieces = rows.groupBy("conv_id", "piece").agg(F.count("*").alias("n"))
    pieces = pieces.select(
        "piece", F.min("piece").over(whole).alias("first"), F.sum("n").over(whole).alias("size")
    )
    return rows.join(pieces, "piece")


def _node(depth: Column, sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth, *sums)))


def _stepped(numbered: DataFrame) -> DataFrame:
    """Add ``depth``, ``node`` and ``parent`` to every row, from sums of 128 bits of hash."""
    depth = F.col("at") - F.col("first")
    digest = F.md5(F.concat(F.hex("hash"), depth.cast("string")))
    lanes = ["h0", "h1", "h2", "h3"]  # 32 bits each, so sums of 2**31 rows fit
    hashed = numbered.withColumn("depth", depth).withColumns(
        {h: F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i, h in enumerate(lanes)}
    )
    stored = materialize(hashed, "hashed")
    earlier = W.partitionBy("first").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    totals = stored.groupBy("first", "piece").agg(*[F.sum(h).alias(h) for h in lanes])
    before = totals.select(
        "piece", *[F.coalesce(F.sum(h).over(earlier), F.lit(0)).alias(f"{h}_before") for h in lanes]
    )
    inside = W.partitionBy("piece").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    summed = stored.join(before, "piece").withColumns(
        {f"{h}_sum": F.col(f"{h}_before") + F.sum(h).over(inside) for h in lanes}
    )
    above = _node(F.col("depth") - 1, [F.col(f"{h}_sum") - F.col(h) for h in lanes])
    return summed.select(
        "conv_id", "first", "size", "piece", "depth",
        F.col("hash").alias("turn"),
        _node(F.col("depth"), [F.col(f"{h}_sum") for h in lanes]).alias("node"),
        F.when(F.col("depth") > 0, above).alias("parent"),
    )


def _running_start(nodes: DataFrame) -> DataFrame:
    """Add ``start``: tokens of all nodes before, in order of ``owner`` and then ``depth``."""
    ordered = sorted_position(nodes, "owner", "depth", name="at")
    ranges = materialize(ordered.withColumn("range", F.floor(F.col("at") / _RANGE)), "ordered")
    sums = ranges.groupBy("range").agg(F.sum("n_tokens").alias("t"))
    earlier = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    before = sums.select("range", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("before"))
    inside = W.partitionBy("range").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    return (
        ranges.join(before, "range")
        .withColumn("start", F.col("before") + F.sum("n_tokens").over(inside) - F.col("n_tokens"))
        .drop("range", "before", "at")
    )


def _entry(heads: str, rank: str) -> Column:
    """Where the run of this conversation begins, its position there, and the intervals before."""
    interval = pa.struct({"begin": pa.int64(), "end": pa.int64()})
    types = {"run": pa.int64(), "offset": pa.int64(), "before": pa.list_(interval)}

    @F.arrow_udf("run long, offset long, before array<struct<begin:bigint,end:bigint>>")
    def enter(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for lists, ranks in batches:
            found: dict[str, list] = {name: [] for name in types}
            for path, own in zip(lists.to_pylist(), ranks.to_pylist(), strict=True):
                intervals: list[list[int]] = []
                for above, head in zip([None, *path], path):
                    if above and intervals and intervals[-1][1] == above["start"]:
                        intervals[-1][1] = head["leave"]
                    elif above:
                        intervals.append([above["start"], head["leave"]])
                    if head["owner"] == own:
                        break
                found["run"].append(head["start"])
                found["offset"].append(sum(end - begin for begin, end in intervals))
                found["before"].append([{"begin": b, "end": e} for b, e in intervals])
            yield structs(found, types)

    return enter(heads, rank)


def _ancestors() -> Column:
    """The intervals before the run, and what lies between its beginning and the node."""
    n = F.size("before")
    last = F.get("before", n - 1)

    def upto(begin: Column) -> Column:
        return F.array(F.struct(begin.alias("begin"), F.col("start").alias("end")))

    return (
        F.when(F.col("start") == F.col("run"), F.col("before"))
        .when(
            last["end"] == F.col("run"),
            F.concat(F.slice("before", 1, F.greatest(n - 1, F.lit(0))), upto(last["begin"])),
        )
        .otherwise(F.concat("before", upto(F.col("run"))))
    )


def chat_tree(conversations: DataFrame, vocabulary: str) -> ChatTree:
    """Build the tree from ``conv_id, turn, role, text``; tokens are those of ``vocabulary``.

    Joins on nodes, turns and owners have one row for each key on one side, and a stored table on
    the other, which adaptive execution splits where a key is hot.
    """
    turns = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("hash", F.unhex(F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text"))))

    each = turns.groupBy("hash").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    each = each.select(F.col("hash").alias("turn"), _encoded(vocabulary).alias("coded"))
    coded = materialize(
        each.select("turn", "coded.*", F.size("coded.ids").cast("long").alias("n_tokens")), "turns"
    )

    steps = materialize(_stepped(_numbered(turns.drop("text"))), "steps")
    ends = steps.filter(F.col("depth") == F.col("size") - 1).select("conv_id", "first", "node")
    one_each = ends.groupBy(F.col("node").alias("last")).agg(F.min("first").alias("first"))
    pieces = steps.groupBy("first", "piece").agg(F.lit(1).alias("one")).drop("one")
    own_pieces = materialize(pieces.join(one_each, "first").select("first", "piece", "last"), "pieces")
    own = steps.join(own_pieces.select("piece", "last"), "piece")

    links = own.select("node", "parent").distinct().filter("parent IS NOT NULL")
    branching = links.groupBy("parent").agg(F.count("*").alias("n")).filter("n > 1").select("parent")
    cuts = materialize(branching.union(one_each.select("last")).distinct(), "cuts")

    heads = own.join(cuts, "parent", "left_semi").select("first", "depth", "node")
    heads = heads.union(own.filter("depth = 0").select("first", "depth", "node"))
    keys = heads.groupBy("first").agg(F.array_sort(F.collect_list(F.struct("depth", "node"))).alias("heads"))
    joined = F.array_join(F.transform("heads", lambda h: F.hex(h["node"])), "")
    ranked = sorted_position(keys.select("first", F.unhex(joined).alias("key")), "key", name="rank")
    ranked = materialize(ranked, "ranked")

    rank_of = own_pieces.join(ranked.select("first", "rank"), "first").select("piece", "rank")
    owned = (
        steps.join(rank_of, "piece")
        .groupBy("node")
        .agg(
            F.min("rank").alias("owner"),
            F.first("depth").alias("depth"),
            F.first("parent").alias("parent"),
            F.first("turn").alias("turn"),
        )
    )
    placed = materialize(_running_start(owned.join(coded.select("turn", "n_tokens"), "turn")), "placed")

    leaving = placed.join(cuts.withColumnRenamed("parent", "node"), "node").select(
        F.col("node").alias("parent"), (F.col("start") + F.col("n_tokens")).alias("leave")
    )
    entered = placed.join(materialize(leaving, "leaving"), "parent").select("node", "owner", "start", "leave")
    roots = placed.filter("parent IS NULL").select("node", "owner", "start", F.lit(None).cast("long").alias("leave"))
    known = materialize(entered.union(roots), "entered")
    count = (F.length("key") / _ID).cast("int")
    along = ranked.select("rank", F.explode(F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.struct(i.alias("i"), F.substring(F.col("key"), i * _ID + 1, F.lit(_ID)).alias("node")),
    )).alias("h")).select("rank", "h.*")
    runs = (
        along.join(known, "node")
        .groupBy("rank")
        .agg(F.array_sort(F.collect_list(F.struct("i", "start", "leave", "owner"))).alias("heads"))
        .select(F.col("rank").alias("owner"), _entry("heads", "rank").alias("entry"))
        .select("owner", "entry.*")
    )
    nodes = (
        placed.join(materialize(runs, "runs"), "owner")
        .withColumn("position", F.col("offset") + F.col("start") - F.col("run"))
        .withColumn("ancestors", _ancestors())
        .join(coded.drop("n_tokens"), "turn")
        .select(
            "node", "parent", "depth", "start", "n_tokens", "position", "ancestors",
            "ids", "loss_from", "loss_to", "n_chars",
        )
    )
    return ChatTree(
        materialize(nodes, "nodes"), ends.select("conv_id", "node"), own.select("last", "depth", "node")
    )


READ_BACK = {
    "n_turns": pa.int64(),
    "turns_sha256": pa.string(),
    "loss_chars": pa.int64(),
    "loss_sha256": pa.string(),
    "formatted_chars": pa.int64(),
    "n_tokens": pa.int64(),
}
_READ = {"node": pa.binary(), **READ_BACK}


class _Reader:
    """Digests of one conversation, fed with the tokens of its nodes in order."""

    def __init__(self, coder: ByteBpe, last: bytes):
        self.last, self._coder = last, coder
        self._pending = ""
        self._said, self._loss = sha256(), sha256()
        self._turns = self._chars = self._loss_chars = self._tokens = 0

    def feed(self, ids: np.ndarray, loss_from: int, loss_to: int) -> None:
        formatted = self._coder.decode(ids)
        self._tokens += len(ids)
        self._chars += len(formatted)
        text, read = self._pending + formatted, 0
        for turn in _TURN.finditer(text):
            self._said.update(f"{unescape(turn[1])}\n{unescape(turn[2])}\n".encode())
            self._turns += 1
            read = turn.end()
        self._pending = text[read:]
        if loss_to > loss_from:
            loss = unescape(self._coder.decode(ids[loss_from:loss_to]))
            self._loss.update(loss.encode())
            self._loss_chars += len(loss)

    def row(self) -> tuple:
        return (
            self.last, self._turns, self._said.hexdigest(), self._loss_chars, self._loss.hexdigest(),
            self._chars, self._tokens,
        )


def read_back(tree: ChatTree, vocabulary: str) -> DataFrame:
    """Every conversation as decoded from the emitted tokens: digests of turns and of the loss.

    Different conversations are put together once each, then joined to all that are equal. A task
    gets their turns in order and keeps one turn and the digests so far.
    """

    def rows_of(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found, strict=True) if found else [()] * len(_READ)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, _READ.values(), strict=True)], names=list(_READ)
        )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ByteBpe(vocabulary)
        reader = None
        for batch in batches:
            found = []
            lasts, ids = batch.column("last").to_pylist(), batch.column("ids")
            spans = zip(batch.column("loss_from").to_pylist(), batch.column("loss_to").to_pylist(), strict=True)
            for i, (last, span) in enumerate(zip(lasts, spans, strict=True)):
                if reader is None or reader.last != last:
                    if reader:
                        found.append(reader.row())
                    reader = _Reader(coder, last)
                reader.feed(ids[i].values.to_numpy().astype(np.int64), *span)
            yield rows_of(found)
        if reader:
            yield rows_of([reader.row()])

    nodes = tree.nodes.select("node", "ids", "loss_from", "loss_to")
    read = (
        tree.paths.join(nodes, "node")
        .select("last", "depth", "ids", "loss_from", "loss_to")
        .repartition("last")
        .sortWithinPartitions("last", "depth")
        .mapInArrow(
            digests,
            "node binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
            " formatted_chars long, n_tokens long",
        )
    )
    # stored, so that a conversation that very many rows repeat can be split in the join
    return tree.conversations.join(materialize(read, "read-back"), "node").drop("node")
