"""Spelling variants against all pairs in plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np

from ontime.llm import queries, spelling
from tests.llm.helpers import ODD_TEXTS, clashing, documents

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def counted(rows, every=None):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words):
    rows, forms = {}, {}
    for w, n in words.items():
        others = [o for o in words if o != w and near(w, o)]
        best = min(others, key=lambda o: (-words[o], o), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * n else None
        rows[w] = len(others)
    out = {}
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (forms[w], root, n, rows[w], None if forms[w] is None else words[forms[w]])
    return out


def as_rows(frame):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in frame.collect()}


def vocabulary(source, count, letters="abcéÿÀ"):
    made = ["".join(source.choice(letters) for _ in range(source.randint(7, 10))) for _ in range(count)]
    for word in made[: count // 2]:
        at = source.randrange(len(word))
        made.append(word[:at] + word[at + 1:])
        made.append(word[:at] + source.choice(letters) + word[at:])
        made.append(word[:at] + source.choice(letters) + word[at + 1:])
    return {w: source.choice([2, 3, 20, 25, 300, 5000]) for w in made if len(w) >= 7}


def check(spark, words):
    frame = spark.createDataFrame(list(words.items()) or [], "word string, n long").repartition(3)
    assert as_rows(spelling.variants(clashing(frame))) == brute(words)


def test_variants_equal_brute_force(spark):
    check(spark, vocabulary(random.Random(1), 400))


def test_small_blocks_leaves_and_split_nodes(spark, monkeypatch):
    for name, value in (("BLOCK", 50), ("LEAF", 1), ("NODE", 20)):
        monkeypatch.setattr(spelling, name, value)
    check(spark, vocabulary(random.Random(2), 200, "aab"))


def test_letters_of_one_group_and_very_long_words(spark):
    # a, Á and á have the same last five bits: equal counts, a replacement all the same.
    words = {"aaaaaaa": 2, "aaaaaaá": 30, "Áaaaaaa": 400, "aaaaaaaa": 5, "x" * 5000: 50, "x" * 5001: 3, "x" * 4999 + "y": 2}
    check(spark, words)


def test_no_words(spark):
    check(spark, {})
    assert spelling.variants(spelling.word_counts(documents(spark, [None, "", "short words"]))).count() == 0


def test_words_of_odd_texts_and_null_ids(spark):
    source = random.Random(3)
    words = list(vocabulary(source, 40))
    texts = [*ODD_TEXTS, *(" ".join(source.choice(words).upper() for _ in range(60)) + ", Straße123naïveté" for _ in range(20))]
    frame = documents(spark, texts).unionByName(documents(spark, texts[-3:])).unionByName(
        spark.createDataFrame([(None, texts[-1], None, None, None)], "doc_id long, text string, lang string, source string, n_chars long"))
    rows = [*enumerate(texts), *enumerate(texts[-3:]), (None, texts[-1])]
    for every in (None, 5):
        found = {r["word"]: r["n"] for r in spelling.word_counts(clashing(frame), every).collect()}
        assert found == counted(rows, every)


def test_query_over_the_given_table(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    words = counted(rows, 31)
    found = as_rows(queries.op11_spelling_variants(spark, sf_dir))
    assert {w: r[2] for w, r in found.items()} == words
    neighbours = {w: Counter() for w in words}
    for w in words:
        others = {w[:i] + w[i + 1:] for i in range(len(w))}
        for o in others & words.keys():
            neighbours[w][o] = neighbours[o][w] = 1
    gaps = {}
    for w in words:
        for i in range(len(w)):
            gaps.setdefault((i, w[:i] + "\0" + w[i + 1:]), []).append(w)
    for same in gaps.values():
        for w in same:
            for o in same:
                if o != w:
                    neighbours[w][o] = 1
    assert {w: r[3] for w, r in found.items()} == {w: len(o) for w, o in neighbours.items()}
    for w, (form, _, n, _, form_n) in found.items():
        best = min(neighbours[w], key=lambda o: (-words[o], o), default=None)
        wanted = best if best is not None and words[best] >= 10 * n else None
        assert (form, form_n) == (wanted, words.get(wanted))


def test_group_counts_of_points():
    assert np.array_equal(spelling.group_counts(["ab", "á"])[:, [1, 2]], [[1, 1], [1, 0]])
