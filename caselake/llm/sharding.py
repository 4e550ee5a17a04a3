"""Sharding by fixed virtual slots and a versioned map from slots to shards.

Every record hashes into one of ``SLOTS`` virtual slots; the number of slots
never changes. Bytes and rows are summed per slot, and a small map says which
shard owns which slot. Rebalancing edits the map: only slots that have to move
change their shard, and each edit is stored as a new version, so a reader can
name the version it used.

The map and the sums have one row per slot, whatever the table holds, which
bounds what the driver and a broadcast see.

Defined results: a null text counts as empty (size 1, CRC 0); null ids are
records like any other; identical repeated records share a slot; an empty table
gives an empty result and a map of empty slots.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caselake.llm.common import stored, table, text_or_empty
from caselake.sources.storage import fresh_dir

#: Virtual slots; fixed for the life of a data set.
SLOTS = 4096


def slot_of(*keys: Column | str, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def slot_sums(records: DataFrame) -> DataFrame:
    """One row per slot in use: its bytes and rows. ``records``: virtual_slot, size."""
    return records.groupBy("virtual_slot").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"))


def edit_map(before: np.ndarray, sizes: np.ndarray, shards: int) -> np.ndarray:
    """The next version of a slot map: shard loads near equal, few slots moved.

    ``before[slot]`` is the present shard (outside 0..shards-1: not placed),
    ``sizes[slot]`` its bytes. Shards above the mean give up the largest slots
    that leave them there, the free slots go to the lightest shards in order of size, and the
    heaviest and the lightest shard then exchange slots while that evens them.
    """
    owner = np.where((before >= 0) & (before < shards), before, -1)
    loads = np.bincount(owner[owner >= 0], weights=sizes[owner >= 0], minlength=shards)
    target = sizes.sum() / shards
    for shard in np.flatnonzero(loads > target):
        mine = np.flatnonzero((owner == shard) & (sizes > 0))
        for slot in mine[np.argsort(-sizes[mine], kind="stable")]:
            if loads[shard] - sizes[slot] >= target:
                owner[slot] = -1
                loads[shard] -= sizes[slot]
    free = np.flatnonzero(owner < 0)
    for slot in free[np.argsort(-sizes[free], kind="stable")]:
        shard = int(np.argmin(loads))
        owner[slot] = shard
        loads[shard] += sizes[slot]
    for _ in range(64 * shards):
        high, low = int(np.argmax(loads)), int(np.argmin(loads))
        gap = loads[high] - loads[low]
        ours = np.flatnonzero((owner == high) & (sizes > 0))
        theirs = np.concatenate([[-1], np.flatnonzero((owner == low) & (sizes > 0))])
        gain = sizes[ours][:, None] - np.where(theirs < 0, 0, sizes[theirs])[None, :]
        best = np.abs(gap - 2 * gain)
        if not best.size or best.min() >= gap:
            break
        i, j = np.unravel_index(int(np.argmin(best)), best.shape)
        owner[ours[i]] = low
        if theirs[j] >= 0:
            owner[theirs[j]] = high
        loads[high] -= gain[i, j]
        loads[low] += gain[i, j]
    return owner


class SlotMap:
    """Versions of a slot map in a folder, one Parquet folder per version."""

    def __init__(self, spark: SparkSession, folder: str, slots: int = SLOTS):
        self.spark, self.folder, self.slots = spark, folder.rstrip("/"), slots

    def write(self, version: int, owner: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> DataFrame:
        """Store a version: slot, shard, its bytes and rows, and where its rows begin in the shard."""
        begins = np.zeros(self.slots, dtype=np.int64)
        for shard in np.unique(owner):
            mine = np.flatnonzero(owner == shard)
            begins[mine] = np.cumsum(rows[mine]) - rows[mine]
        entries = zip(range(self.slots), owner.tolist(), sizes.tolist(), rows.tolist(), begins.tolist())
        df = self.spark.createDataFrame(
            [(s, int(o), int(b), int(r), int(f)) for s, o, b, r, f in entries],
            "virtual_slot int, shard int, bytes long, n_rows long, first long")
        df.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/version={version}")
        return self.read(version)

    def read(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/version={version}")

    def owners(self, version: int) -> np.ndarray:
        owner = np.full(self.slots, -1, dtype=np.int64)
        for r in self.read(version).select("virtual_slot", "shard").collect():
            owner[r[0]] = r[1]
        return owner


def sums_by_slot(records: DataFrame, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows per slot on the driver: one row per slot, bounded by ``slots``."""
    sizes, rows = np.zeros(slots, dtype=np.int64), np.zeros(slots, dtype=np.int64)
    for r in slot_sums(records).collect():
        sizes[r["virtual_slot"]], rows[r["virtual_slot"]] = r["bytes"], r["n_rows"]
    return sizes, rows


def place(records: DataFrame, slot_map: DataFrame, order: list[str]) -> DataFrame:
    """Shard of every record and its place in the shard, counted from 0 without gaps.

    A place is where the record's slot begins in the shard plus the record's
    rank inside the slot, so no window is wider than one virtual slot.
    """
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(*order))
    bounded = F.broadcast(slot_map.select("virtual_slot", "shard", "first"))  # one row per slot
    return (records.withColumn("rank_in_slot", rank).join(bounded, "virtual_slot")
            .withColumn("slot", F.col("first") + F.col("rank_in_slot") - 1)
            .drop("first", "rank_in_slot"))


def shard_documents(docs: DataFrame, shards: int = 16, slots: int = SLOTS, folder: str | None = None) -> DataFrame:
    """Documents dealt to shards of near equal bytes; the map is stored as versions 0 and 1 in ``folder``."""
    spark = docs.sparkSession
    text = text_or_empty()
    records = stored(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        slot_of(F.col("doc_id"), text, slots=slots).alias("virtual_slot")), "shard-records")
    sizes, rows = sums_by_slot(records, slots)
    versions = SlotMap(spark, folder or fresh_dir(spark, "slot-map"), slots)
    versions.write(0, np.arange(slots) % shards, sizes, rows)
    current = versions.write(1, edit_map(versions.owners(0), sizes, shards), sizes, rows)
    return place(records, current, ["doc_id", "text_crc32", "size"])


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")
