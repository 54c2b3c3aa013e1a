"""Benchmark decontamination by greedy string tiling.

Windows of a few words that a document shares with a test item are the seeds. On the seeds of a pair
the longest common run of unmarked words is marked, again and again, until none of the least length
is left. The share of an item that its tiles cover says whether the document holds it, in whatever
order its parts stand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ontime.llm.words import WordHashes, shingles

MATCH = 5  # words of the shortest tile
COVER = 0.5  # share of an item from which a document counts as contaminated
BLOCK_WORDS = 1_000_000  # words of test items that a worker holds at once
FILTER_BITS = 22
# Han, Hiragana, Katakana and Thai are written without spaces: a word per character.
ALONE = (
    "\u0e01-\u0e3a\u0e40-\u0e5b\u2e80-\u2fd5\u3005\u3007\u3021-\u3029\u3038-\u303b\u3041-\u3096\u309d-\u309f\u30a1-\u30fa"
    "\u30fd-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufad9\uff66-\uff6f\uff71-\uff9d"
    "\U0001b000-\U0001b16f\U00020000-\U000323af"
)
WORD = re.compile(rf"[{ALONE}]|[^\W{ALONE}]+")


def word_hashes(text: str, hashes: WordHashes) -> np.ndarray:
    return hashes.of(WORD.findall(text.lower()))


def tiles(doc: np.ndarray, item: np.ndarray, at: np.ndarray, of: np.ndarray, match: int) -> list[tuple[int, int, int]]:
    """Tiles (place in doc, place in item, words), longest first, from the seeds (at, of).

    Seeds are the pairs of windows with equal Karp-Rabin hashes. A pass sees only windows without a
    marked word; runs of seeds along a diagonal are the maximal matches. Of equally long ones the
    first in the document, then in the item, is marked.
    """
    same = np.ones(len(at), bool)
    for k in range(match):
        same &= doc[at + k] == item[of + k]
    at, of = at[same], of[same]
    order = np.lexsort((at, at - of))
    at, of = at[order], of[order]
    marked_doc, marked_item = np.zeros(len(doc) + 1, bool), np.zeros(len(item) + 1, bool)
    found = []
    while len(at):
        new = np.r_[True, (at[1:] - at[:-1] != 1) | (of[1:] - of[:-1] != 1)]
        starts = np.flatnonzero(new)
        lengths = np.diff(np.r_[starts, len(at)])
        top = starts[lengths == lengths.max()]
        best = top[np.lexsort((of[top], at[top]))[0]]
        p, q, n = int(at[best]), int(of[best]), int(lengths.max()) + match - 1
        found.append((p, q, n))
        marked_doc[p:p + n] = True
        marked_item[q:q + n] = True
        in_doc, in_item = np.cumsum(np.r_[0, marked_doc]), np.cumsum(np.r_[0, marked_item])
        free = (in_doc[at + match] == in_doc[at]) & (in_item[of + match] == in_item[of])
        at, of = at[free], of[free]
    return found


class Windows:
    """The windows of one length of some test items, looked up by hash."""

    def __init__(self, items: list[np.ndarray], chosen: list[int], match: int):
        self.match = match
        windows = [shingles(items[i], match) for i in chosen]
        hashes = np.concatenate([np.zeros(0, np.uint64), *windows])
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.item = np.repeat(np.array(chosen, np.int64), [len(w) for w in windows])[order]
        self.place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(w)) for w in windows]])[order]
        self.filter = np.zeros(2 ** FILTER_BITS, bool)
        self.filter[(self.hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def seeds(self, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in the document, item and place in the item of all equal windows."""
        windows = shingles(doc, self.match)
        at = np.flatnonzero(self.filter[(windows >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        first = np.searchsorted(self.hashes, windows[at], "left")
        count = np.searchsorted(self.hashes, windows[at], "right") - first
        at, first, count = at[count > 0], first[count > 0], count[count > 0]
        row = np.repeat(first - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
        return np.repeat(at, count), self.item[row], self.place[row]


class Seeds:
    """The windows of a block of test items; an item shorter than ``match`` words is one window."""

    def __init__(self, items: list[tuple[int, bytes]], match: int):
        self.ids = [item_id for item_id, _ in items]
        self.items = [np.frombuffer(words, np.uint64) for _, words in items]
        by_length: dict[int, list[int]] = {}
        for i, words in enumerate(self.items):
            if len(words):
                by_length.setdefault(min(match, len(words)), []).append(i)
        self.windows = [Windows(self.items, chosen, length) for length, chosen in by_length.items()]

    def matches(self, doc: np.ndarray, cover: float) -> Iterator[tuple[int, int, int, list]]:
        """Items covered enough: id, words, covered words, tiles."""
        for windows in self.windows:
            match = windows.match
            if len(doc) < match:
                continue
            at, item, place = windows.seeds(doc)
            for i in np.unique(item):
                own, words = item == i, self.items[i]
                reach = np.unique(place[own])
                most = int(np.minimum(np.diff(np.r_[reach, reach[-1] + match]), match).sum())
                if most < cover * len(words):  # even if every seed became part of a tile
                    continue
                made = tiles(doc, words, at[own], place[own], match)
                covered = sum(n for _, _, n in made)
                if covered >= cover * len(words):
                    yield self.ids[i], len(words), covered, made


RESULT = (
    "doc_id long, item_id long, item_words int, covered_words int, coverage double, "
    "tiles array<struct<doc_place:int, item_place:int, words:int>>"
)


def contaminated(
    documents: DataFrame, benchmark: DataFrame, match: int = MATCH, cover: float = COVER,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row for every document and test item whose tiles cover ``cover`` of the item or more.

    Words are runs of letters, digits and underscores in lower case, and single characters of the
    scripts in ``ALONE``. An item of fewer than ``match`` words has to be held whole; texts without
    words match nothing; null ids stay; repeated rows give repeated results;
    other columns are ignored. Items are dealt into blocks of about ``block_words`` words, the most
    that is sent to every worker at once; documents are read once per block and never shuffled.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            words = [word_hashes(t, hashes) for t in batch["text"]]
            yield pd.DataFrame({
                "item_id": batch["item_id"], "words": [w.tobytes() for w in words],
                "n": [len(w) for w in words],
            })

    spark = documents.sparkSession
    text = F.coalesce("text", F.lit("")).alias("text")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text).mapInPandas(
        read, "item_id long, words binary, n long"
    ).filter("n > 0").distinct().persist()
    total = items.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    found = None
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block)
        sent = spark.sparkContext.broadcast([(r["item_id"], bytes(r["words"])) for r in part.select("item_id", "words").collect()])

        def search(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            seeds, hashes = Seeds(sent.value, match), WordHashes()
            for batch in batches:
                out = []
                for doc_id, body in zip(batch["doc_id"], batch["text"], strict=True):
                    for item_id, size, covered, made in seeds.matches(word_hashes(body, hashes), cover):
                        out.append((
                            None if pd.isna(doc_id) else int(doc_id), item_id, size, covered, covered / size,
                            [{"doc_place": p, "item_place": q, "words": n} for p, q, n in made],
                        ))
                made_rows = pd.DataFrame(out, columns=["doc_id", "item_id", "item_words", "covered_words", "coverage", "tiles"])
                yield made_rows.astype({"doc_id": "Int64", "item_id": "Int64"})

        one = rows.mapInPandas(search, RESULT)
        found = one if found is None else found.unionByName(one)
    items.unpersist()
    return found
