"""Greedy string tiling against a direct version, and contamination of planted texts."""

from __future__ import annotations

import random

import numpy as np
import pytest

from ontime.llm import tiling
from ontime.llm.words import WordHashes, shingles
from tests.llm.helpers import ODD_TEXTS, clashing, documents, sentence

ITEMS = "item_id long, text string"


def slow_tiles(doc, item, match):
    used_doc, used_item, out = set(), set(), []
    while True:
        best = None
        for p in range(len(doc)):
            for q in range(len(item)):
                n = 0
                while (
                    p + n < len(doc) and q + n < len(item) and doc[p + n] == item[q + n]
                    and p + n not in used_doc and q + n not in used_item
                ):
                    n += 1
                if n >= match and (best is None or n > best[2]):
                    best = (p, q, n)
        if best is None:
            return out
        out.append(best)
        used_doc.update(range(best[0], best[0] + best[2]))
        used_item.update(range(best[1], best[1] + best[2]))


@pytest.mark.parametrize("seed", range(25))
def test_tiles_equal_a_direct_version(seed):
    source = random.Random(seed)
    item = [f"w{source.randrange(4)}" for _ in range(source.randint(3, 25))]
    doc = [f"w{source.randrange(4)}" for _ in range(source.randint(0, 40))]
    for _ in range(2):
        a = source.randrange(len(item))
        at = source.randint(0, len(doc))
        doc[at:at] = item[a:a + 10]
    hashes = WordHashes()
    d, i = hashes.of(doc), hashes.of(item)
    seeds = [(p, q) for p, x in enumerate(shingles(d, 3)) for q, y in enumerate(shingles(i, 3)) if x == y and len(d) >= 3 and len(i) >= 3]
    at, of = (np.array(x, np.int64) for x in (zip(*seeds, strict=True) if seeds else ([], [])))
    assert tiling.tiles(d, i, at, of, 3) == slow_tiles(doc, item, 3)


def test_planted_items_are_found_and_clean_texts_are_not(spark):
    source = random.Random(1)
    items = [sentence(source, 40, 10**6) for _ in range(6)]
    halves = items[1].split()
    texts = ODD_TEXTS + [
        sentence(source, 100) + " " + items[0].upper().replace(" ", ", ") + " end",
        " ".join(halves[20:]) + " between " + " ".join(halves[:20]),
        " ".join(items[2].split()[:15]),  # less than half
        " ".join(items[3].split()[:25]) + " " + sentence(source, 50),
        items[4] + " " + items[5] + " " + items[4],
        sentence(source, 300),
    ]
    benchmark = spark.createDataFrame([*enumerate(items), (90, "too short"), (91, None), (92, "")], ITEMS)
    docs, first = clashing(documents(spark, texts)), len(ODD_TEXTS)
    wanted = {(first, 0), (first + 1, 1), (first + 3, 3), (first + 4, 4), (first + 4, 5)}
    for block in (tiling.BLOCK_WORDS, 50):
        found = tiling.contaminated(docs, benchmark, block_words=block).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == wanted
        assert len(found) == len(wanted)
    moved = next(r for r in found if r["item_id"] == 1)
    assert sorted(t["item_place"] for t in moved["tiles"]) == [0, 20] and moved["coverage"] == 1


def test_repeated_rows_null_ids_and_empty_tables(spark):
    item = "one two three four five six"
    docs = spark.createDataFrame([(None, item), (3, item), (3, item)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (1, item), (None, item)], ITEMS)
    found = sorted(tiling.contaminated(docs, items).collect(), key=str)
    assert len(found) == 6 and {r["covered_words"] for r in found} == {6}
    assert tiling.contaminated(docs, items.limit(0)).count() == 0
    assert tiling.contaminated(docs.limit(0), items).count() == 0


def test_items_of_few_words_are_held_whole(spark):
    texts = ["so Paris, is it", "paris", "it is so", "a b a b c d", "one two three", "", None, "nothing of it"]
    items = [(1, "Paris"), (2, "is it"), (3, "a b c"), (4, "One, two! three four"), (5, ""), (6, "?!"), (7, "x y")]
    found = tiling.contaminated(clashing(documents(spark, texts)), spark.createDataFrame(items, ITEMS)).collect()
    assert sorted((r["doc_id"], r["item_id"], r["item_words"], r["covered_words"]) for r in found) == [
        (0, 1, 1, 1), (0, 2, 2, 2), (1, 1, 1, 1), (3, 3, 3, 3),
    ]
    assert [[tuple(t) for t in r["tiles"]] for r in found if r["item_id"] == 3] == [[(2, 0, 3)]]


def test_scripts_without_spaces(spark):
    japanese, thai = "東京タワーはどこにありますか", "สวัสดีชาวโลก"
    texts = [f"質問{japanese}答え", f"ก{thai}ข", "東京は大きい", "สวัสดี", f"abc{japanese}def ghi"]
    items = spark.createDataFrame([(1, japanese), (2, thai), (3, "東京")], ITEMS)
    found = tiling.contaminated(documents(spark, texts), items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(0, 1), (0, 3), (1, 2), (2, 3), (3, 2), (4, 1), (4, 3)}
    assert tiling.WORD.findall("aあb漢字c") == ["a", "あ", "b", "漢", "字", "c"]
