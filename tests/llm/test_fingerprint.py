"""Closed syncmers against a direct definition, and the edited texts."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ontime.llm import fingerprint
from tests.llm.helpers import ODD_TEXTS, clashing, documents, sentence


def test_windows_are_chosen_by_their_own_words(spark):
    """A window is an anchor in any text exactly when it is one in a text of its own."""
    source = random.Random(3)
    text = sentence(source, 80)
    words = text.split()
    windows = [" ".join(words[i:i + fingerprint.K]) for i in range(len(words) - fingerprint.K + 1)]
    frame = spark.createDataFrame([(t,) for t in [text, *windows]], "t string")
    rows = {r["t"]: r["a"] for r in frame.select("t", fingerprint.anchors(F.col("t")).alias("a")).collect()}
    chosen = {(a["position"], a["hash"]) for a in rows[text]}
    alone = {(i, rows[w][0]["hash"]) for i, w in enumerate(windows) if rows[w]}
    assert chosen == alone
    assert 0.3 < len(chosen) / len(windows) < 0.7


@pytest.mark.parametrize("slices", [1, 3, 16])
def test_edited_texts(spark, slices):
    source = random.Random(slices)
    texts = ODD_TEXTS + [sentence(source, source.randint(1, 60)) for _ in range(30)]
    found = fingerprint.edited_likeness(clashing(documents(spark, texts)), slices).orderBy("doc_id").collect()
    prints = {}
    for i, (row, text) in enumerate(zip(found, texts, strict=True)):
        text, after = text or "", texts[(i + 1) % len(texts)] or ""
        quarter = len(text) // 4
        edited = text[:len(text) - quarter] + after[:quarter]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
        assert prints.setdefault(text, row["fingerprint"]) == row["fingerprint"]
        if edited == text:
            assert row["near_edited"] == 1 and row["edited_fingerprint"] == row["fingerprint"]
    assert found[8]["near_next"] == 1


def test_ties_nulls_and_empty_table(spark):
    rows = [(1, "b b b b"), (1, "a a a a"), (None, "n n n n"), (2, "c c c c"), (2, "c c c c")]
    found = fingerprint.with_next(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    after = {(r["doc_id"], r["text"]): r["next_text"] for r in found}
    assert len(found) == 5
    assert after == {(None, "n n n n"): "a a a a", (1, "a a a a"): "c c c c", (1, "b b b b"): "c c c c", (2, "c c c c"): "n n n n"}
    assert fingerprint.edited_likeness(documents(spark, []), 4).count() == 0


def test_matches_give_places(spark):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    both = documents(spark, [f"x y z {passage}", passage]).withColumn("anchors", fingerprint.anchors(F.col("text")))
    found = fingerprint.matches(both.filter("doc_id = 0"), both.filter("doc_id = 1")).collect()
    assert found and all(r["left_position"] == r["right_position"] + 3 for r in found)


@pytest.mark.parametrize("length", range(1, 8))
def test_short_texts_have_an_anchor_of_their_own(spark, length):
    source = random.Random(length)
    texts = [sentence(source, length, 10**6) for _ in range(40)] + [""]
    found = fingerprint.edited_likeness(documents(spark, texts), 3).orderBy("doc_id").collect()
    assert all(r["fingerprint"] for r in found[:-1]) and found[-1]["fingerprint"] == ""
    assert len({r["fingerprint"] for r in found}) == len(texts)
    assert all(r["near_next"] == 0 for r in found)


def test_a_window_stands_for_a_text_without_a_chosen_one(spark):
    """Only texts without a chosen window differ; their anchor is the window of the smallest hash."""
    source = random.Random(11)
    texts = [sentence(source, n, 10**6) for n in (5, 6, 7, 20) for _ in range(40)]
    own, always = fingerprint.anchors(F.col("text")), fingerprint.anchors(F.col("text"), never_none=True)
    rows = documents(spark, texts).select("text", own.alias("own"), always.alias("always")).collect()
    lone = [r for r in rows if not r["own"]]
    assert lone and all(r["own"] == r["always"] for r in rows if r["own"])
    for row in lone:
        words = row["text"].split()
        windows = [" ".join(words[i:i + fingerprint.K]).split() for i in range(len(words) - fingerprint.K + 1)]
        hashes = spark.createDataFrame([(i, w) for i, w in enumerate(windows)], "i int, w array<string>").select(
            F.xxhash64(*[F.col("w")[j] for j in range(fingerprint.K)]).alias("h"), "i"
        ).collect()
        least = min(hashes, key=lambda r: r["h"])
        assert [(a["position"], a["hash"]) for a in row["always"]] == [(least["i"], least["h"])]
