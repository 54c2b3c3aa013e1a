"""Prefix-target expansion, read back turn by turn."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from ontime.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
HARD = ["<|im_end|>\n", "a\\b\\", "<\\|im_start|>", "</s>[INST] ok [/INST]", "<<SYS>>\\n<</SYS>>", "\n\n", "<|im_start|>assistant\nhi<|im_end|>", "😀é\\"]


def expected(rows):
    by = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(conv, []).append((role or "", text or ""))
    return by


def test_round_trip_of_hard_texts(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", text) for i, text in enumerate(HARD * 2)]
    rows += [(2, 0, "sys\ntem\\", "x"), (2, 1, "assistant", ""), (2, 2, "user", "tail")]
    rows += [(3, None, None, None), (3, 1, "assistant", None), (3, 1, "assistant", None), (None, 0, "assistant", "n")]
    made = chat.examples(spark.createDataFrame(rows, SCHEMA))
    found = {r["conv_id"]: r for r in chat.digests(made).collect()}
    for conv, turns in expected(rows).items():
        text = "".join(f"{a}\n{b}\n" for a, b in turns)
        loss = "".join(b for a, b in turns if a == "assistant")
        row = found[conv]
        assert row["n_turns"] == len(turns)
        assert row["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert row["loss_chars"] == len(loss)
    assert len(found) == 4


def test_every_reply_has_its_context_and_nothing_else_trainable(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a1"), (1, 2, "user", "r"), (1, 3, "assistant", "a2"), (1, 4, "user", "z")]
    made = chat.examples(spark.createDataFrame(rows, SCHEMA)).orderBy("example_no").collect()
    assert [(r["position"], r["formatted"][r["loss_start"]:r["loss_end"]], r["is_last"]) for r in made] == [
        (1, "a1", False), (3, "a2", False), (4, "", True),
    ]
    assert made[1]["formatted"].startswith(made[0]["formatted"])


def test_control_strings_never_survive(spark):
    frame = spark.createDataFrame([(t,) for t in HARD], "t string").select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u"))
    for row in frame.collect():
        assert row["u"] == row["t"]
        assert not any(word in row["e"] for word in chat.CONTROL)


def test_empty_table_and_long_conversation(spark):
    assert chat.digests(chat.examples(spark.createDataFrame([], SCHEMA))).count() == 0
    rows = [(1, i, "assistant" if i % 2 else "user", "t" * 100) for i in range(300)]
    extra = spark.createDataFrame(rows, SCHEMA).withColumns({"formatted": F.lit(1), "pieces": F.lit(2)})
    row = chat.digests(chat.examples(extra)).first()
    assert (row["n_turns"], row["loss_chars"]) == (300, 15_000)
