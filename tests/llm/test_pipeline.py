"""The pipeline stage by stage against plain Python, and its use of the registered entry."""

from __future__ import annotations

import random

import corpus_pipeline as pipeline
from ontime.llm import nbsvm
from tests.llm.helpers import DOCUMENTS, documents, sentence
from tests.llm.test_parity import brute


def test_stages_over_the_given_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scores = {r["doc_id"]: r["score"] for r in nbsvm.score(docs, nbsvm.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))).collect()}
    kept = pipeline.quality(spark, docs, sf_dir)
    assert kept.columns == list(pipeline.COLUMNS)
    rows = sorted(kept.collect(), key=lambda r: r["doc_id"])
    assert {r["doc_id"] for r in rows} == {i for i, s in scores.items() if s >= nbsvm.THRESHOLD}
    expected = brute([r["text"] for r in rows], 5, 80)
    left = pipeline.near_duplicates(spark, kept, sf_dir)
    assert sorted(r["doc_id"] for r in left.collect()) == [r["doc_id"] for i, r in enumerate(rows) if expected[i][1] == i]
    clean = pipeline.decontamination(spark, left, sf_dir)
    items = [" ".join(r["text"].lower().replace(".", " ").replace(",", " ").split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for row in clean.collect():
        text = " ".join(row["text"].lower().replace(".", " ").replace(",", " ").split())
        assert not any(item in text for item in items)
    mixed = pipeline.mixture(spark, clean, sf_dir)
    words = sum(len(r["text"].split()) for r in clean.collect())
    taken = sum(len(r["text"].split()) for r in mixed.collect())
    assert taken < words and mixed.columns == list(pipeline.COLUMNS)
    placed = pipeline.shards(spark, mixed, sf_dir)
    assert placed.count() == mixed.count() and {r["shard"] for r in placed.select("shard").distinct().collect()} <= set(range(8))


def test_run_is_the_stages_in_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), stage(spark, docs, sf_dir).schema)
    made = pipeline.run(spark, sf_dir)
    assert sorted(map(str, made.collect())) == sorted(map(str, docs.select(*made.columns).collect()))


def test_stages_with_odd_and_without_rows(spark, sf_dir):
    source = random.Random(2)
    odd = [None, "", " ", "x", sentence(source, 30_000)]
    rows = documents(spark, odd, first=10**6).unionByName(spark.createDataFrame([(None, None, None, None, None), (7, "a b", None, None, None)], DOCUMENTS))
    for frame in (rows, rows.limit(0)):
        for _, stage in pipeline.STAGES:
            made = stage(spark, frame, sf_dir)
            assert made.count() <= frame.count()


def kept(frame):
    return sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=str)


def test_near_duplicates_with_null_and_repeated_ids(spark, sf_dir):
    source = random.Random(5)
    a, b, c, d, e, f = (sentence(source, 60, 10**6) for _ in range(6))
    rows = [
        (None, a), (3, a), (4, a + " more"),  # a group with a null id
        (5, b), (5, b), (5, b),  # exact repeats
        (None, c), (None, d),  # null ids of different texts
        (6, e), (6, f), (7, f),  # one id, two texts
        (8, None), (8, None), (8, ""), (9, ""), (None, None), (None, None),  # without words
    ]
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCUMENTS)
    wanted = [(None, a), (5, b), (None, c), (None, d), (6, e), (6, f), (8, None), (8, ""), (9, ""), (None, None)]
    assert kept(pipeline.near_duplicates(spark, frame, sf_dir)) == sorted(wanted, key=str)


def test_repeats_that_differ_in_other_columns_leave_one_row(spark, sf_dir):
    frame = spark.createDataFrame([(1, "a b c", lang, "s", 5) for lang in ("fr", None, "de")], DOCUMENTS)
    assert [tuple(r) for r in pipeline.near_duplicates(spark, frame, sf_dir).collect()] == [(1, "a b c", None, "s", 5)]


def test_decontamination_with_null_and_repeated_ids(spark, sf_dir):
    source = random.Random(6)
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    a, b, c = (sentence(source, 60, 10**6) for _ in range(3))
    rows = [(None, f"{a} {item}"), (None, a), (8, f"{b} {item}"), (8, b), (9, c), (9, c), (None, None)]
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCUMENTS)
    wanted = [(None, a), (8, b), (9, c), (9, c), (None, None)]
    assert kept(pipeline.decontamination(spark, frame, sf_dir)) == sorted(wanted, key=str)


def test_keys_that_meet_are_made_anew(spark, monkeypatch):
    frame = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, None)], "doc_id long, text string")
    real, seeds = pipeline.F.xxhash64, []

    def clash(seed, *columns):
        seeds.append(seed)
        return pipeline.F.lit(7).cast("long") if len(seeds) == 1 else real(seed, *columns)

    monkeypatch.setattr(pipeline.F, "xxhash64", clash)
    keyed, keys = pipeline.with_row_key(frame)
    assert len(seeds) == 2 and keys.count() == 3 and keyed.select("_key").distinct().count() == 3
    assert {(r["doc_id"], r["copies"]) for r in keys.collect()} == {(1, 1), (2, 2), (None, 1)}
