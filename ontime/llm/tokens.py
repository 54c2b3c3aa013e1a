"""Exact token counts of whole texts, huge ones by overlapping chunks.

A text longer than one chunk is cut into chunks that overlap. The overlap is encoded from either
side with offsets, and the splice is put at a boundary that both encodings have and that is proven
stable: what precedes it cannot change the tokens that follow. Where there is none, the overlap is
widened.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

CHUNK = 16_384  # code points per chunk
OVERLAP = 256  # code points that neighbours share at first
MARGIN = 32  # distance from the ends of a chunk; longer than any special string
BATCH = 256  # texts handled at once
MEMORY = 500_000  # words whose counts are remembered
JOINED = 1000  # new words encoded at once
SPACES = " \t\n\r"
# Rules a pre-tokenizer must have for ``stable`` to be a proof.
PRE_TOKENS = (r"[\p{L}]+", r"|[\p{N}]|", r"[^\s\p{L}\p{N}]+")
# Symbols and the letters after them; the boundaries between such words are stable.
WORDS = re.compile(r"\S*?[^\W\d_]+|\S+")


def unsure(char: str) -> bool:
    """Whether a character may join its neighbour or become several, or is white space to some only."""
    odd_space = char.isspace() and char not in SPACES
    several = len(unicodedata.normalize("NFC", char).lower()) > 1
    return odd_space or several or unicodedata.category(char)[0] == "M"


UNSURE = frozenset(filter(unsure, map(chr, range(0x110000))))


def kind(char: str) -> str:
    """W for plain white space, L, N or O as pre-tokenizers class characters, ? where unsure."""
    if char in SPACES:
        return "W"
    major = unicodedata.category(char)[0]
    return "?" if char in UNSURE else major if major in "LN" else "O"


def stable(text: str, at: int) -> bool:
    """Whether pre-tokens end at ``at`` whatever surrounds it.

    True next to plain white space, next to a number, and between a letter and a following symbol;
    never next to a combining mark. Words are then encoded apart from each other on both sides.
    """
    left, right = kind(text[at - 1]), kind(text[at])
    if "?" in (left, right):
        return False
    return "W" in (left, right) or "N" in (left, right) or (left, right) == ("L", "O")


def splice(text: str, left: list[tuple[int, int]], right: list[tuple[int, int]], start: int, end: int) -> int | None:
    """A proven boundary in [start, end] where a token ends on the left and begins on the right."""
    ends = {b for _, b in left}
    for begin, _ in right:
        if begin > end:
            break
        if begin < start:
            continue
        # White space belongs to no token, so the token before ends at the last other character.
        before = begin
        while before > start and text[before - 1] in SPACES:
            before -= 1
        if before in ends and stable(text, begin):
            return begin
    return None


def cuts(text: str, encode, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Places, 0 and the length included, where the tokens of a text can be cut.

    Around the end of a chunk its tail and the head of the next one are encoded with offsets. Both
    cover the overlap; the cut is a proven boundary that both have there, and the overlap is
    widened until there is one. Where the chunk has none, it grows into the next.
    """

    def tokens(a: int, b: int) -> list[tuple[int, int]]:
        return [(a + s, a + e) for s, e in encode([text[a:b]])[0]]

    places = [0]
    for end in range(chunk, len(text), chunk):
        shared, at = overlap, None
        while at is None:
            tail, head = max(places[-1], end - 2 * shared), max(places[-1], end - shared)
            left, right = tokens(tail, end), tokens(head, min(len(text), end + shared))
            low = head + MARGIN if head > places[-1] else places[-1] + 1
            at = splice(text, left, right, low, end - MARGIN)
            if at is None and head == places[-1]:
                break
            shared *= 2
        if at is not None:
            places.append(at)
    return [*places, len(text)]


class Counter:
    """Counts of one vocabulary file. Words met before are counted from memory.

    Boundaries are proven for pre-tokenizers that keep runs of letters, single numbers and runs of
    symbols and drop white space. With any other (and with sentencepiece models, whose pieces cross
    white space) every text is encoded whole.
    """

    def __init__(self, name: str):
        import public_tokenizers

        path = name if os.path.isabs(name) else public_tokenizers.path(name)
        self.model, self.known, self.special = path.endswith(".model"), {}, ()
        if self.model:
            import sentencepiece

            self.library, self.proven = sentencepiece.SentencePieceProcessor(model_file=path), False
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        parts = json.loads(self.library.to_str()).get("pre_tokenizer") or {}
        splits = [p for p in parts.get("pretokenizers", [parts]) if p.get("type") == "Split"]
        self.proven = [(p["behavior"], p["invert"]) for p in splits] == [("Removed", True)] and all(
            rule in splits[0]["pattern"].get("Regex", "") for rule in PRE_TOKENS
        )
        self.special = tuple(t.content for t in self.library.get_added_tokens_decoder().values())

    def offsets(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        return [e.offsets for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def whole(self, texts: list[str]) -> list[int]:
        if self.model:
            return [len(ids) for ids in self.library.encode(texts, num_threads=1)] if texts else []
        return [
            len(e) for i in range(0, len(texts), BATCH)
            for e in self.library.encode_batch_fast(texts[i:i + BATCH], add_special_tokens=False)
        ]

    def by_words(self, texts: list[str]) -> list[int]:
        """Counts of texts without unsure characters and special strings, from their words."""
        found = [WORDS.findall(text) for text in texts]
        if len(self.known) > MEMORY:
            self.known.clear()
        new = list({word for words in found for word in words if word not in self.known})
        for first in range(0, len(new), JOINED):
            part = new[first:first + JOINED]
            starts = np.cumsum([0, *[len(word) + 1 for word in part]])
            begins = [begin for begin, _ in self.offsets([" ".join(part)])[0]]
            place = np.searchsorted(starts, begins, side="right") - 1
            self.known.update(zip(part, np.bincount(place, minlength=len(part)).tolist(), strict=True))
        return [sum(map(self.known.__getitem__, words)) for words in found]

    def count(self, texts: list[str], chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
        """Tokens per text, without begin, end or added special tokens."""
        if not self.proven:
            return self.whole(texts)
        parts, owner = [], []
        for i, text in enumerate(texts):
            places = cuts(text, self.offsets, chunk, overlap) if len(text) > chunk else [0, len(text)]
            parts += [text[a:b] for a, b in zip(places, places[1:])]
            owner += [i] * (len(places) - 1)
        plain = [UNSURE.isdisjoint(t) and not any(s in t for s in self.special) for t in parts]
        easy = iter(self.by_words([t for t, simple in zip(parts, plain, strict=True) if simple]))
        rest = iter(self.whole([t for t, simple in zip(parts, plain, strict=True) if not simple]))
        totals = [0] * len(texts)
        for i, simple in zip(owner, plain, strict=True):
            totals[i] += next(easy) if simple else next(rest)
        return totals


@lru_cache(maxsize=4)
def counter(name: str) -> Counter:
    """The counter of a vocabulary file, loaded once in each worker."""
    return Counter(name)


def token_counts(
    documents: DataFrame, vocabulary: str = "word_bpe_49k.json", limit: int = 2048,
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row, repeated rows included.

    Null and empty texts have 0 bytes and tokens; a null doc_id stays; other columns are ignored.
    A task holds one Arrow batch and the offsets of one chunk, or of one text where nothing in it
    is a proven boundary.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            numbers = [
                n for i in range(0, len(texts), BATCH)
                for n in counter(vocabulary).count(texts[i:i + BATCH], chunk, overlap)
            ]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"], "n_tokens": numbers,
            })

    text = F.coalesce("text", F.lit(""))
    rows = documents.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    schema = "doc_id long, n_bytes long, n_tokens long"
    return rows.mapInPandas(count, schema).withColumn("over_limit", F.col("n_tokens") > limit)
