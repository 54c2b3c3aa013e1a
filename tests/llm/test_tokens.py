"""Token counts against the library on the whole text."""

from __future__ import annotations

import random

import pytest

from ontime.llm import tokens
from tests.llm.helpers import ODD_TEXTS, clashing, documents

ALPHABET = "abcXYZ ' 's 123 _-²½Ⅷ漢字。!?\n\tßİ한€" + "́각\x1c "
PIECES = ["the ", "it's ", " <|endoftext|>", "''s", "<|startoftext|>", "we'll_ve've ", "z" * 40]


@pytest.mark.parametrize("chunk", [90, 150, 10_000])
def test_counts_equal_the_library(chunk):
    counter = tokens.counter("word_bpe_49k.json")
    assert counter.proven
    source = random.Random(chunk)
    for _ in range(300):
        text = "".join(source.choice([source.choice(ALPHABET), source.choice(PIECES)]) for _ in range(source.randint(0, 500)))
        assert counter.count([text], chunk, 45) == counter.whole([text])


def test_unbroken_text_is_encoded_in_one(spark):
    counter = tokens.counter("word_bpe_49k.json")
    for text in ("ab" * 2000, "é" * 3000, "漢" * 500):
        assert counter.count([text], 200, 64) == counter.whole([text])


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_other_vocabularies_are_not_cut(vocabulary):
    counter = tokens.counter(vocabulary)
    assert not counter.proven
    assert counter.count(["hello  world " * 50], 64, 16) == counter.whole(["hello  world " * 50])


def test_table(spark):
    found = tokens.token_counts(clashing(documents(spark, ODD_TEXTS))).orderBy("doc_id").collect()
    counter = tokens.counter("word_bpe_49k.json")
    for row, text in zip(found, ODD_TEXTS, strict=True):
        assert row["n_tokens"] == counter.whole([text or ""])[0]
        assert row["n_bytes"] == len((text or "").encode())
        assert row["over_limit"] == (row["n_tokens"] > 2048)
    assert tokens.token_counts(documents(spark, [])).count() == 0
