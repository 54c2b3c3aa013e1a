"""Quality and language models on texts of their own, held-out accuracy on the given tables."""

from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from ontime.llm import langid, nbsvm
from ontime.llm.queries import op4_quality_classifier, op5_language_id
from tests.llm.helpers import ODD_TEXTS, clashing, documents, sentence


def test_dual_coordinate_descent_reaches_the_optimum():
    """No row violates the conditions of the optimum, on separable and on overlapping rows."""
    source = np.random.default_rng(0)
    rows, labels = [], []
    for i in range(300):
        label = i % 3 == 0
        own = source.choice(np.arange(1, 60) + (30 if label else 0), 8, replace=False)
        rows.append(np.unique(np.r_[0, own]).astype(np.int32))
        labels.append(int(label))
    labels = np.array(labels)
    ratios = nbsvm.log_count_ratios(rows, labels)
    assert ratios[70] > 1 and ratios[5] < -1
    weights = nbsvm.dual_coordinate_descent(rows, labels, ratios, 1)
    margins = np.array([weights[r] @ (ratios[r] / np.sqrt((ratios[r] ** 2).sum())) for r in rows])
    assert ((margins > 0) == (labels == 1)).mean() > 0.95


def test_quality_separates_and_survives_odd_rows(spark):
    source = random.Random(4)
    good = [sentence(source, 60) for _ in range(60)]
    bad = [sentence(source, 60).upper().replace(" ", "!! ") for _ in range(60)]
    docs = clashing(documents(spark, good + bad + ODD_TEXTS))
    labels = spark.createDataFrame(
        [(i, int(i < 60), 0) for i in range(120)] + [(3, None, 0), (None, 1, 0), (5, 1, 1), (9999, 0, 0)], "doc_id long, quality int, toxic int"
    )
    model = nbsvm.train(docs, labels)
    scores = {r["doc_id"]: r["score"] for r in nbsvm.score(docs, model).collect()}
    assert all(0 <= s <= 1 for s in scores.values()) and len(scores) == 130
    held = [i for i in range(120) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all((scores[i] >= nbsvm.THRESHOLD) == (i < 60) for i in held)
    assert scores[120] == scores[121]  # null and empty


def test_quality_without_usable_labels(spark):
    docs = documents(spark, ["a b", "c d"])
    labels = "doc_id long, quality int"
    for rows, expected in ([], 0.5), ([(i, 1) for i in range(2)], 1.0):
        model = nbsvm.train(docs, spark.createDataFrame(rows, labels))
        assert {round(r["score"], 6) for r in nbsvm.score(docs, model).collect()} == {expected}
    assert nbsvm.score(docs.limit(0), model).count() == 0


def test_held_out_rows_are_not_learnt_from(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    wrong = labels.withColumn("quality", F.when(nbsvm.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert nbsvm.train(docs, labels).to_bytes() == nbsvm.train(docs, wrong).to_bytes()


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in op4_quality_classifier(spark, folder).collect() if r["held_out"] and r["doc_id"] in labels]
    hits = np.mean([r["predicted"] == labels[r["doc_id"]] for r in rows])
    assert len(rows) > 300 and hits > 0.95
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in op5_language_id(spark, folder).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in rows]) > 0.97


def test_language_of_odd_rows(spark):
    texts = ["the cat sat on the mat and then left", "der Hund und die Katze sind nicht hier", None, "", "123 !? \n", "ÉTÉ"] * 3
    frame = spark.createDataFrame(
        [(i, t, ["en", "de", None, "en", "de", None][i % 6]) for i, t in enumerate(texts)], "doc_id long, text string, lang string"
    )
    found = {r["doc_id"]: r for r in langid.predict(clashing(frame), sample=100).collect()}
    assert [found[i]["lang_pred"] for i in range(5)] == ["en", "de", "und", "und", "und"]
    assert all(0 <= r["score"] <= 1 for r in found.values()) and found[2]["score"] == 0
    assert found[0]["held_out"] == (zlib.crc32(b"0") % 5 == 0)
    unlearnt = langid.predict(frame.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in unlearnt} == {"und"} and len(unlearnt) == len(texts)
    assert langid.predict(frame.limit(0)).count() == 0


def test_counts_match_a_direct_count(spark):
    """The matrix holds the smoothed log-frequencies of the training n-grams."""
    frame = spark.createDataFrame([(i, "abc d", "en") for i in range(10)] + [(20 + i, "xyz", "de") for i in range(10)], "doc_id long, text string, lang string")
    names, table, prior = langid.train(frame)
    assert names == ["de", "en"] and table.shape == (langid.BUCKETS, 2)
    n = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(10))
    counts = np.bincount(langid.grams("abc d"), minlength=langid.BUCKETS) * n + langid.ALPHA
    assert np.allclose(table[:, 1], np.log(counts / counts.sum()), atol=1e-5)
    assert np.isclose(np.exp(prior).sum(), 1)


def test_more_languages_than_are_held_at_once(spark, monkeypatch):
    """Blocks of languages give what one block gives; rare languages are found too."""
    source = random.Random(8)
    alphabets = {"aa": "abcde", "bb": "fghij", "cc": "klmno", "dd": "pqrst", "ee": "uvwxy"}
    rows = []
    for n, (lang, letters) in enumerate(alphabets.items()):
        for _ in range(20 + 10 * n):
            text = " ".join("".join(source.choices(letters + "abf", k=5)) for _ in range(15))
            rows.append((len(rows), text, lang))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    results = []
    for held in (1000, 2, 1):
        monkeypatch.setattr(langid, "LANGUAGES", held)
        results.append({r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(frame).collect()})
    assert all(results[0][i][0] == lang for i, _, lang in rows)
    for other in results[1:]:
        assert {i: p for i, (p, _) in other.items()} == {i: p for i, (p, _) in results[0].items()}
        assert all(np.isclose(other[i][1], s) for i, (_, s) in results[0].items())
