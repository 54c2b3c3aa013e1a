"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: the formatted conversation up to and including
that turn, of which only that reply is trainable. Built from DataFrame functions alone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
# Strings a chat tokenizer may read as control; the markers of the template come first.
CONTROL = (
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]",
    "<<SYS>>", "<</SYS>>",
)
TARGET_ROLE = "assistant"


def escape(text: Column, control: tuple[str, ...] = CONTROL) -> Column:
    """Double every backslash and put one after the first character of each control string."""
    if any("\\" in word or len(word) < 2 for word in control):
        raise ValueError("a control string has two characters or more and no backslash")
    first = "(?s)(?=" + "|".join(re.escape(word) for word in control) + ")(.)"
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), first, r"$1\\")


def unescape(text: Column) -> Column:
    """Undo ``escape``: a backslash stands for nothing but protects the character after it."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def examples(conversations: DataFrame, control: tuple[str, ...] = CONTROL) -> DataFrame:
    """One row per trainable reply, and one for turns after the last reply, if there are any.

    Columns: conv_id; example_no from 0; position, that of the last turn in the example; n_turns of
    the conversation; formatted; loss_start and loss_end, code points of ``formatted`` between
    which text is trainable (equal where nothing is); is_last, true for the example that holds the
    whole conversation.

    Turns are ordered by turn (null first), then role and text, so ties and repeated rows have one
    order. Null roles and texts are empty, a null conv_id is a conversation like any other, other
    input columns are ignored. Only the role ``assistant``, written so, is a target. A conversation
    is one text, so its turns meet in one row; the prefixes are cut row by row after that.
    """
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    grouped = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )

    def piece(turn: Column) -> Column:
        role = F.regexp_replace(escape(turn["role"], control), "\n", "\\\\\\\n")
        return F.struct(
            F.concat(F.lit(START), role, F.lit("\n")).alias("head"),
            escape(turn["text"], control).alias("body"),
            (turn["role"] == TARGET_ROLE).alias("target"),
        )

    pieces = grouped.select(
        "conv_id", F.size("turns").alias("n_turns"), F.transform("turns", piece).alias("pieces")
    )
    wanted = F.filter(
        F.sequence(F.lit(0), F.col("n_turns") - 1),
        lambda i: F.element_at("pieces", i + 1)["target"] | (i == F.col("n_turns") - 1),
    )
    rendered = pieces.withColumn(
        "texts",
        F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))),
    ).select(
        "conv_id", "n_turns", "texts",
        F.transform("pieces", lambda p: F.when(p["target"], F.length(p["body"])).otherwise(0)).alias("loss"),
        F.posexplode(wanted).alias("example_no", "position"),
    )
    cut = rendered.select(
        "conv_id", "example_no", "position", "n_turns",
        F.array_join(F.slice("texts", 1, F.col("position") + 1), "").alias("formatted"),
        F.element_at("loss", F.col("position") + 1).alias("loss_chars"),
    )
    loss_end = F.length("formatted") - len(END)
    return cut.select(
        "conv_id", "example_no", "position", "n_turns", "formatted",
        (loss_end - F.col("loss_chars")).alias("loss_start"), loss_end.alias("loss_end"),
        (F.col("position") == F.col("n_turns") - 1).alias("is_last"),
    )


def trainable(example: str = "formatted") -> Column:
    """The text under the loss mask, as it was written."""
    start, end = F.col("loss_start"), F.col("loss_end")
    return unescape(F.substring(F.col(example), start + 1, end - start))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text as an array of (role, text)."""
    shape = r"(?s)\A" + re.escape(START) + r"((?:[^\\\n]|\\.)*+)\n(.*)\z"
    parts = F.split(formatted, re.escape(END.rstrip("\n")) + "\n")
    return F.transform(
        F.filter(parts, lambda part: part != ""),
        lambda part: F.struct(
            unescape(F.regexp_extract(part, shape, 1)).alias("role"),
            unescape(F.regexp_extract(part, shape, 2)).alias("text"),
        ),
    )


def digests(made: DataFrame) -> DataFrame:
    """Per conversation, what the examples contain, read back from their texts."""
    read = made.select(
        "conv_id", "example_no", trainable().alias("reply"),
        F.length("formatted").cast("long").alias("chars"),
        F.when(F.col("is_last"), F.col("formatted")).alias("whole"),
    )
    joined = read.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("example_no", "reply"))).alias("replies"),
        F.max("whole").alias("whole"), F.sum("chars").alias("formatted_chars"),
    ).select(
        "conv_id", read_turns(F.col("whole")).alias("turns"), "formatted_chars",
        F.array_join(F.transform("replies", lambda r: r["reply"]), "").alias("loss"),
    )
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return joined.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"), "formatted_chars",
    )
