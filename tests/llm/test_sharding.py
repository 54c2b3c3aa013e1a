"""Virtual slots, their maps, and places in shards."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from ontime.llm import sharding
from ontime.llm.queries import op9_sharding
from ontime.session import scratch_path
from tests.llm.helpers import ODD_TEXTS, clashing, documents


def test_growing_moves_rows_only_into_the_new_shard():
    for shards in (1, 7, 8):
        before = sharding.even_map(shards)
        after = sharding.grow(before, shards)
        assert set(after[after != before]) == {shards}
        counts = np.bincount(after)
        assert counts.max() - counts.min() <= shards + 1


def test_rebalancing_evens_out_bytes():
    sizes = np.random.default_rng(5).pareto(1.5, sharding.SLOTS) * 1000 // 1
    first = sharding.even_map(8)
    edited = sharding.rebalance(first, sizes.astype(np.int64), 8)
    loads = np.bincount(edited, weights=sizes)
    assert loads.max() - loads.min() < 0.001 * loads.mean()
    assert (edited != first).mean() < 0.2


def test_versions_are_kept(spark):
    folder = scratch_path(spark, "map")
    sharding.save_map(spark, folder, 1, sharding.even_map(2))
    sharding.save_map(spark, folder, 2, sharding.grow(sharding.even_map(2), 2))
    assert sharding.load_map(spark, folder).agg(F.max("shard")).first()[0] == 2
    assert sharding.load_map(spark, folder, 1).agg(F.max("shard")).first()[0] == 1


def test_places_without_gaps_for_repeated_rows(spark):
    rows = documents(spark, ODD_TEXTS).unionByName(documents(spark, ["copy"] * 5, first=50))
    rows = rows.unionByName(spark.createDataFrame([(77, "hot", "", "", 3)] * 300 + [(None, None, None, None, None)], rows.schema))
    light = clashing(rows).select("doc_id", sharding.record_size().alias("size"), F.lit(1).alias("text_crc32"), sharding.virtual_slot("doc_id").alias("virtual_slot"))
    folder = scratch_path(spark, "map")
    sharding.save_map(spark, folder, 1, sharding.even_map(8))
    found = sharding.number_rows(sharding.assign(light, sharding.load_map(spark, folder)), ["doc_id", "size", "text_crc32", "map_version"]).collect()
    assert len(found) == len(ODD_TEXTS) + 306
    by = {}
    for row in found:
        by.setdefault(row["shard"], []).append(row["slot"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())


def test_query_over_the_table(spark, sf_dir):
    found = op9_sharding(spark, sf_dir).toPandas()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(found["doc_id"]) == sorted(texts)
    for doc_id, size, crc in zip(found["doc_id"], found["size"], found["text_crc32"], strict=True):
        body = texts[doc_id].encode()
        assert (size, crc) == (len(body) + 1, zlib.crc32(body))
    loads = found.groupby("shard")["size"].sum()
    assert len(loads) == 8 and loads.max() - loads.min() <= found["size"].max()
