"""The corpus pipeline: quality, near-duplicates, decontamination, mixture, shards.

Every stage takes (spark, docs, sf_dir) and gives the documents it keeps; ``run`` writes what a
stage returns as Parquet to the shared folder and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ontime.llm import mixing, nbsvm, parity, sharding, tiling
from ontime.llm.queries import MIX_SEED, SHARDS, WEIGHTS, table, with_domain
from ontime.session import discard, handed_on, materialize, scope, scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
MIX_SHARE = 0.8  # of the tokens that reach the mixture; no document is used twice
SMALL_IDS = 1_000_000  # ids of 8 bytes that a broadcast may hold


def with_row_key(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with _key, a number for every doc_id and text, and the stored table of the keys.

    Null ids and several texts of one id get keys of their own; rows equal in both share one. The
    table has _key, doc_id, digest of the text and copies. Should two documents meet in one key, or
    one get the number that stands for null ids, all keys are made anew with another seed.
    """
    light = docs.select("doc_id", "text", F.sha2("text", 256).alias("digest"))
    seed = 0
    while True:
        key = F.xxhash64(F.lit(seed), "doc_id", "text")
        row = F.struct("doc_id", "digest")
        keys = materialize(light.groupBy(key.alias("_key")).agg(
            F.min(row).alias("row"), (F.min(row) != F.max(row)).alias("met"), F.count(F.lit(1)).alias("copies"),
        ))
        if keys.filter(F.col("met") | (F.col("_key") == -(2 ** 63))).isEmpty():
            return docs.withColumn("_key", key), keys.select("_key", "row.doc_id", "row.digest", "copies")
        seed += 1


def small(keys: DataFrame) -> DataFrame:
    """A stored list of keys, marked for broadcast where its size is bounded."""
    return F.broadcast(keys) if keys.count() <= SMALL_IDS else keys


def without(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose key is not listed."""
    return keyed.join(small(materialize(keys.select("_key").distinct())), "_key", "left_anti")


def one_of_each(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    """One row per key, the smallest by the other columns; only rows of repeated keys move."""
    repeated = materialize(keys.filter("copies > 1").select("_key"))
    if repeated.isEmpty():
        return keyed
    repeated = small(repeated)
    columns = [c for c in COLUMNS if c != "text"] + ["text"]
    merged = keyed.join(repeated, "_key", "left_semi").groupBy("_key").agg(F.min(F.struct(*columns)).alias("row"))
    single = keyed.select("_key", *columns).join(repeated, "_key", "left_anti")
    return single.unionByName(merged.select("_key", "row.*"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = nbsvm.train(docs, table(spark, sf_dir, "labels"))
    scored = nbsvm.score(docs, model)
    return scored.filter(F.col("score") >= nbsvm.THRESHOLD).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group linked by shingles of five words, at 0.8.

    A document is an id with a text: rows equal in both are kept once, rows of one id with other
    texts are compared like any others. Null ids come before all others, of equal ids the smallest
    digest counts. Texts without words link with nothing and stay, once for each id.
    """
    keyed, keys = with_row_key(docs)
    found = parity.linked_components(keyed.select(F.col("_key").alias("doc_id"), "text"), width=5, percent=80)
    members = found.select(F.col("doc_id").alias("_key"), "component_id").distinct().join(keys, "_key")
    first = members.groupBy("component_id").agg(F.min(F.struct("doc_id", "digest", "_key")).alias("row"))
    gone = keys.select("_key").join(first.select("row._key"), "_key", "left_anti")
    return one_of_each(without(keyed, gone), keys).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item; each text is judged by itself, null and repeated ids too."""
    keyed, _ = with_row_key(docs)
    found = tiling.contaminated(keyed.select(F.col("_key").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return without(keyed, found.select(F.col("doc_id").alias("_key"))).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whole, those at the cuts included, until the budgets of their sources are full."""
    plan = mixing.mix_plan(
        with_domain(docs), mixing.word_count(), share=MIX_SHARE, weights=WEIGHTS, max_epochs=1, seed=MIX_SEED
    )
    return plan.select(*COLUMNS)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with virtual_slot, shard and map_version; shards hold about the same bytes."""
    placed = docs.select(*COLUMNS).withColumns({
        "size": sharding.record_size(), "virtual_slot": sharding.virtual_slot("doc_id"),
    })
    folder = scratch_path(spark, "slot-map")
    first = sharding.even_map(SHARDS)
    sharding.save_map(spark, folder, 1, first)
    sharding.save_map(spark, folder, 2, sharding.rebalance(first, sharding.slot_bytes(placed), SHARDS))
    return sharding.assign(placed, sharding.load_map(spark, folder))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixture),
    ("sharding", shards),
]

# A fitted classifier decides what enters; SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; what a stage stored is deleted once the next has read it."""
    docs, stored = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        with scope(spark):
            docs = handed_on(stage(spark, docs, sf_dir))
        if stored is not None:
            discard(stored)
        stored = docs
    return docs
