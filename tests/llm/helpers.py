"""Small tables and plain-Python counterparts for the operator tests."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators add or use inside; input tables may have them already.
CLASHING = (
    "score", "slot", "shard", "label", "key", "n_tokens", "epoch", "taken_tokens", "held_out", "lang_pred",
    "virtual_slot", "size", "cut", "node", "_id", "anchors", "home", "item_id", "set_id", "payload",
)


def documents(spark, texts, first=0, lang="en", source="src0"):
    rows = [(first + i, t, lang, source, len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


def clashing(frame):
    from pyspark.sql import functions as F

    return frame.withColumns({name: F.lit("other") for name in CLASHING if name not in frame.columns})


def sentence(random_source: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{random_source.randrange(vocabulary)}" for _ in range(words))


ODD_TEXTS = [None, "", "   \n\t", "one", "Émile été 漢字かな!?", "a" * 5000, "word " * 20_000, "x\r\n\r\ny", "same words here today ok", "same words here today ok"]
