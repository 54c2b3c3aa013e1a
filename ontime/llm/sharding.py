"""Sharding by fixed virtual slots.

Records hash into a fixed number of slots. A versioned map gives the shard of each slot; adding a
shard or evening out bytes edits the map and moves whole slots, while a record never changes its
slot. Records are handled by DataFrame functions alone; only the map, whose length is the number of
slots, is edited on the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

SLOTS = 4096
COPIES = 10_000  # identical rows numbered by one array
MAP_SCHEMA = "version int, virtual_slot int, shard int"


def virtual_slot(*key: str, slots: int = SLOTS) -> Column:
    """The slot of a record. A null key has a slot like any other value."""
    return F.pmod(F.xxhash64(*key), F.lit(slots)).cast("int")


def record_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus one, so that empty records count."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def slot_bytes(records: DataFrame, slots: int = SLOTS) -> np.ndarray:
    """Bytes per slot of a frame with virtual_slot and size; ``slots`` numbers reach the driver."""
    found = records.groupBy("virtual_slot").agg(F.sum("size").alias("size")).collect()
    sizes = np.zeros(slots, np.int64)
    for row in found:
        sizes[row["virtual_slot"]] = row["size"]
    return sizes


def even_map(shards: int, slots: int = SLOTS) -> np.ndarray:
    """First version of a map: every shard gets as many slots, the same for any data."""
    if not 0 < shards <= slots:
        raise ValueError("there must be a shard, and a slot for every shard")
    return np.arange(slots) * shards // slots


def grow(shard_of: np.ndarray, shards: int) -> np.ndarray:
    """Map with one shard more, which takes an even part of the slots of each other shard."""
    edited = shard_of.copy()
    for shard in range(shards):
        own = np.flatnonzero(shard_of == shard)
        edited[own[: len(own) // (shards + 1)]] = shards
    return edited


def rebalance(shard_of: np.ndarray, sizes: np.ndarray, shards: int) -> np.ndarray:
    """Map with slots moved or swapped between the fullest and the emptiest shard.

    Every edit narrows the gap between the two; it ends where neither a move nor a swap does.
    """
    edited = shard_of.copy()
    loads = np.bincount(edited, weights=sizes, minlength=shards).astype(np.int64)
    while True:
        full, low = int(loads.argmax()), int(loads.argmin())
        gap = loads[full] - loads[low]
        given = np.flatnonzero((edited == full) & (sizes > 0))
        back = np.append(np.flatnonzero((edited == low) & (sizes > 0)), -1)
        returned = np.where(back < 0, 0, sizes[back])
        order = np.argsort(returned, kind="stable")
        back, returned = back[order], returned[order]
        # For each slot to give, the slot to take back that brings the two shards closest.
        at = np.searchsorted(returned, sizes[given] - gap // 2)
        best = None
        for near in (np.maximum(at - 1, 0), np.minimum(at, len(returned) - 1)):
            moved = sizes[given] - returned[near]
            left = np.where((moved > 0) & (moved < gap), np.abs(gap - 2 * moved), gap)
            if len(left) and (best is None or left.min() < best[0]):
                k = int(left.argmin())
                best = (int(left[k]), given[k], back[near[k]], int(moved[k]))
        if best is None or best[0] >= gap:
            return edited
        _, slot, other, moved = best
        edited[slot] = low
        if other >= 0:
            edited[other] = full
        loads[full] -= moved
        loads[low] += moved


def save_map(spark: SparkSession, folder: str, version: int, shard_of: np.ndarray) -> None:
    """Write one version of the map; a version is written once and never changed."""
    rows = [(version, slot, int(shard)) for slot, shard in enumerate(shard_of)]
    frame = spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1)
    frame.drop("version").write.mode("errorifexists").parquet(f"{folder}/version={version}")


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """One version of the stored map, the newest by default."""
    stored = spark.read.schema(MAP_SCHEMA).parquet(folder)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.filter(F.col("version") == version).select("virtual_slot", "shard", "version")


def assign(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Add shard and map_version to records with a virtual_slot; the map has a row per slot."""
    shards = slot_map.select(
        F.col("virtual_slot").alias("_slot"), "shard", F.col("version").alias("map_version")
    )
    kept = records.drop("shard", "map_version")
    return kept.join(F.broadcast(shards), kept["virtual_slot"] == shards["_slot"]).drop("_slot")


def number_rows(assigned: DataFrame, order: list[str]) -> DataFrame:
    """Add slot, the place of a row in its shard: 0 and up without gaps.

    ``assigned`` has virtual_slot, shard and the columns of ``order`` only. Rows are counted per
    virtual slot, the counts give each slot its first place, and windows run inside slots. Identical
    rows are counted before the shuffle and written out again afterwards, a bounded number at a
    time, so no key needs to fit in one task.
    """
    keys = ["shard", "virtual_slot", *order]
    distinct = assigned.groupBy(*assigned.columns).agg(F.count(F.lit(1)).alias("_copies"))
    inside = Window.partitionBy("virtual_slot").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = distinct.withColumn("_first", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = assigned.groupBy("shard", "virtual_slot").agg(F.count(F.lit(1)).alias("_rows")).select(
        F.col("virtual_slot").alias("_slot"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    joined = placed.join(F.broadcast(starts), placed["virtual_slot"] == starts["_slot"])
    block = F.explode(F.sequence(F.lit(0), F.col("_copies") - 1, F.lit(COPIES)))
    blocks = joined.select(*keys, "_copies", (F.col("_start") + F.col("_first")).alias("_at"), block.alias("_block"))
    last = F.least(F.col("_block") + COPIES, F.col("_copies")) - 1
    return blocks.select(
        *[c for c in assigned.columns], "_at",
        F.explode(F.sequence(F.col("_block"), last)).alias("_copy"),
    ).withColumn("slot", (F.col("_at") + F.col("_copy")).cast("long")).drop("_at", "_copy")
