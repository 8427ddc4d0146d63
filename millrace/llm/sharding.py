"""Shards of near equal bytes: fixed virtual slots and a versioned map from slots to shards.

Records are hashed by their id into some thousands of slots, whose number never changes. Bytes
are summed per slot, and a small table says which shard holds which slot. Rebalancing edits
that table: overfull shards give up their smallest slots, which go, largest first, to whichever
shard is least filled; all other slots stay. Every edit is stored as a new version, and rows
are touched only when they are written. DataFrame functions only.

An id that fills more than a slot's fair share several times over, as where many rows have none,
is dealt over all slots by a row number that is stored before anything reads it; rows of
such an id may be in several shards. Other rows with equal ids share a slot. Null ids are one
such id. Null texts have no bytes, but each record costs ``OVERHEAD``; texts are read whole, at any
length, and only for their size and checksum. An empty table gives an empty result. A
shard can exceed its share by a single record that is larger than what is left in it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.rows import unused
from millrace.storage import materialize, new_path

SLOTS = 4096
OVERHEAD = 8  # bytes that a record costs besides its text

#: An id is dealt by row number if it has more bytes than this many average slots.
HOT_SLOTS = 4


def record_size() -> Column:
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long")


def slot_of(slots: int, *record: Column | str) -> Column:
    return F.pmod(F.xxhash64(*record), F.lit(slots)).cast("int")


def _bytes_per_slot(records: DataFrame) -> DataFrame:
    return records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n_rows"))


def _hot_ids(records: DataFrame, slots: int) -> DataFrame:
    """Ids that fill several slots' shares; sought only among the rows of overfull slots."""
    sums = materialize(_bytes_per_slot(records), "slot-bytes")
    limit = F.ceil(HOT_SLOTS * F.sum("bytes").over(W.partitionBy()) / slots)
    overfull = sums.select("vslot", "bytes", limit.alias("limit")).filter(F.col("bytes") > F.col("limit"))
    rows = records.join(F.broadcast(overfull.select("vslot", "limit")), "vslot")  # at most ``slots`` rows
    per_id = rows.groupBy("vslot", "doc_id").agg(F.sum("size").alias("bytes"), F.first("limit").alias("limit"))
    return per_id.filter(F.col("bytes") > F.col("limit")).select(
        F.col("doc_id").alias("hot_id"), F.lit(True).alias("hot")
    )


def records_of(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, row, vslot`` of every row, stored: texts are read once.

    The number of hot ids is at most ``slots / HOT_SLOTS``, as each has that share of all bytes.
    """
    read = docs.select(
        "doc_id",
        record_size().alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
        slot_of(slots, "doc_id").alias("vslot"),
    )
    stored = materialize(read, "records")  # from here on a row keeps its number
    hot = materialize(_hot_ids(stored, slots), "hot-ids")
    dealt = stored.join(F.broadcast(hot), stored["doc_id"].eqNullSafe(hot["hot_id"]), "left")
    slot = F.when(F.col("hot"), slot_of(slots, "doc_id", "row")).otherwise(F.col("vslot"))
    return dealt.select("doc_id", "size", "text_crc32", "row", slot.alias("vslot"))


@dataclass(frozen=True)
class SlotMap:
    """A stored table (version, vslot, shard); a version is added, never changed."""

    path: str
    slots: int

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("version int, vslot int, shard int").parquet(self.path)

    def latest(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """``vslot, shard`` of a version, the newest by default."""
        rows = self.rows(spark)
        chosen = rows.agg(F.max("version")).scalar() if version is None else F.lit(version)
        return rows.filter(F.col("version") == chosen).select("vslot", "shard")

    def add(self, edited: DataFrame) -> None:
        """Store ``vslot, shard`` as the next version."""
        spark = edited.sparkSession
        last = self.rows(spark).agg(F.max("version")).first()[0]
        _write(edited, (last or 0) + 1, self.path)


def _write(rows: DataFrame, version: int, path: str) -> None:
    numbered = rows.select(F.lit(version).alias("version"), "vslot", F.col("shard").cast("int").alias("shard"))
    numbered.coalesce(1).write.mode("append").parquet(path)


def new_map(spark: SparkSession, shards: int, slots: int = SLOTS, path: str | None = None) -> SlotMap:
    """Version 1: slots are dealt in turn."""
    made = SlotMap(path or new_path(spark, "slot-map"), slots)
    slot = F.col("id").cast("int").alias("vslot")
    _write(spark.range(slots).select(slot, (F.col("id") % shards).alias("shard")), 1, made.path)
    return made


def _least_filled(kept: Column, moving: Column) -> Column:
    """``moving`` slots, largest first, each given the shard with the fewest bytes by then."""
    begin = F.struct(
        kept.alias("loads"),
        F.array().cast("array<struct<vslot:int,shard:int>>").alias("dealt"),
    )

    def put(state: Column, slot: Column) -> Column:
        at = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int") - 1
        loads = F.transform(state["loads"], lambda x, i: F.when(i == at, x + slot["bytes"]).otherwise(x))
        one = F.struct(slot["vslot"].alias("vslot"), at.alias("shard"))
        return F.struct(loads.alias("loads"), F.concat(state["dealt"], F.array(one)).alias("dealt"))

    return F.aggregate(moving, begin, put, lambda state: state["dealt"])


def rebalanced(current: DataFrame, filled: DataFrame, shards: int) -> DataFrame:
    """``vslot, shard`` edited so that every shard comes near an equal share of the bytes.

    ``filled`` has (vslot, bytes). Within a shard the largest slots stay as long as they fit
    its share. Only the map's slots, thousands of small rows, meet in one task. ``shards`` may
    be larger than the map's: the new ones begin empty.
    """
    all_slots = current.join(F.broadcast(filled), "vslot", "left").select(
        "vslot", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes")
    )
    share = F.sum("bytes").over(W.partitionBy()) / shards
    order = W.partitionBy("shard").orderBy(F.desc("bytes"), "vslot")
    so_far = F.sum("bytes").over(order.rowsBetween(W.unboundedPreceding, 0))
    # a shard's largest slot stays even if it exceeds the share: nowhere is more room
    stays = (so_far <= F.col("share")) | (F.row_number().over(order) == 1)
    marked = all_slots.withColumn("share", share).withColumn("stays", stays)
    load = F.sum(F.when(F.col("stays"), F.col("bytes")).otherwise(0)).over(W.partitionBy("shard"))
    moving = F.when(~F.col("stays"), F.struct((-F.col("bytes")).alias("less"), F.col("vslot").alias("vslot")))
    one_row = marked.withColumn("load", load).agg(
        F.map_from_entries(F.collect_set(F.struct("shard", "load"))).alias("loads"),
        F.array_sort(F.collect_list(moving)).alias("moving"),
    )
    kept = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda i: F.coalesce(F.try_element_at("loads", i), F.lit(0).cast("long")),
    )
    largest_first = F.transform(
        "moving", lambda s: F.struct(s["vslot"].alias("vslot"), (-s["less"]).alias("bytes"))
    )
    moved = one_row.select(F.inline(_least_filled(kept, largest_first)))
    return marked.filter("stays").select("vslot", "shard").union(moved)


def balanced_map(records: DataFrame, shards: int, slots: int = SLOTS) -> SlotMap:
    """A map whose second version follows the bytes of the records' slots."""
    spark = records.sparkSession
    slot_map = new_map(spark, shards, slots)
    filled = materialize(_bytes_per_slot(records), "slot-bytes")
    slot_map.add(rebalanced(slot_map.latest(spark), filled, shards))
    return slot_map


def shard_records(records: DataFrame, slot_map: SlotMap) -> DataFrame:
    """``records`` with ``shard`` and ``slot``, the row's place in its shard, without gaps from 0.

    Rows are ranked inside their virtual slot and shifted by the rows of the shard's earlier
    slots, so no task holds a shard. ``records`` are those of :func:`records_of`.
    """
    spark = records.sparkSession
    placed = _bytes_per_slot(records).join(F.broadcast(slot_map.latest(spark)), "vslot")
    earlier = W.partitionBy("shard").orderBy("vslot").rowsBetween(W.unboundedPreceding, -1)
    offsets = placed.select(
        "vslot", "shard", F.coalesce(F.sum("n_rows").over(earlier), F.lit(0)).alias("before")
    )
    inside = F.row_number().over(W.partitionBy("vslot").orderBy("row"))
    ranked = records.withColumn("inside", inside).join(F.broadcast(offsets), "vslot")
    return ranked.withColumn("slot", (F.col("before") + F.col("inside") - 1).cast("long")).drop("before", "inside")


def shard_report(docs: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """Per row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard`` and its virtual slot."""
    records = records_of(docs.select("doc_id", "text"), slots)
    placed = shard_records(records, balanced_map(records, shards, slots))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot",
    )


def write_shards(docs: DataFrame, path: str, slot_map: SlotMap, parts: int = 1) -> str:
    """Write the rows, with all their columns, as Parquet under ``shard=<number>`` folders.

    ``parts`` tasks write a shard. Ids that fill several slots are dealt by their texts here. The
    folders have another name if ``docs`` has a column ``shard``; the name is returned.
    """
    spark = docs.sparkSession
    hot, hot_id, where, name = (unused(docs, n) for n in ("hot", "hot_id", "vslot", "shard"))
    sizes = docs.select("doc_id", record_size().alias("size"), slot_of(slot_map.slots, "doc_id").alias("vslot"))
    found = _hot_ids(materialize(sizes, "sizes"), slot_map.slots)
    ids = materialize(found, "hot-ids").select(F.col("hot_id").alias(hot_id), F.col("hot").alias(hot))
    marked = docs.join(F.broadcast(ids), docs["doc_id"].eqNullSafe(ids[hot_id]), "left").drop(hot_id)
    slot = F.when(F.col(hot), slot_of(slot_map.slots, "doc_id", "text")).otherwise(slot_of(slot_map.slots, "doc_id"))
    shard = slot_map.latest(spark).select(F.col("vslot").alias(where), F.col("shard").alias(name))
    rows = marked.withColumn(where, slot).drop(hot).join(F.broadcast(shard), where)
    dealt = rows.repartition(F.col(name), F.pmod(F.col(where), F.lit(parts)))
    dealt.drop(where).write.partitionBy(name).parquet(path)
    return name
