"""Periodic runs against every period at every place in plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from ontime.llm import periodic, queries
from tests.llm.helpers import ODD_TEXTS, clashing, documents


def brute(words, least=6, exponent=4):
    found = {}
    for period in range(1, len(words) // exponent + 1):
        i = 0
        while i + period < len(words):
            j = i
            while j + period < len(words) and words[j] == words[j + period]:
                j += 1
            length = j - i + period
            # A smaller period of the same stretch came first.
            if j > i and length >= max(least, exponent * period):
                found.setdefault((i, length), period)
            i = max(j, i + 1)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def reduced(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def made_words(source):
    words = [source.choice("abcdefgh"[:source.choice([1, 2, 3, 6])]) for _ in range(source.randint(0, 40))]
    block = [source.choice("xyzuvw") for _ in range(source.randint(1, 9))]
    repeated = block * source.randint(1, 9)
    return words + repeated[:source.randint(0, len(repeated))] + words[:source.randint(0, len(words))] + block * 5


def as_rows(frame):
    return sorted(
        ((r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in frame.collect()), key=str
    )


@pytest.mark.parametrize("least,exponent", [(6, 4), (3, 3), (12, 5)])
def test_runs_equal_brute_force(least, exponent):
    source = random.Random(least)
    finder = periodic.Finder(least, exponent)
    for _ in range(150):
        texts = [[w.encode() for w in made_words(source)] for _ in range(source.randint(0, 6))]
        assert finder.runs(texts) == [brute(words, least, exponent) for words in texts]


def test_operator_with_odd_texts_and_ids(spark):
    source = random.Random(1)
    texts = [*ODD_TEXTS, "A a A a A a A a", *(" ".join(made_words(source)) for _ in range(60))]
    frame = documents(spark, texts).unionByName(documents(spark, texts[-2:])).unionByName(
        spark.createDataFrame([(None, texts[-1], None, None, None)], "doc_id long, text string, lang string, source string, n_chars long"))
    wanted = []
    for doc_id, text in [*enumerate(texts), *enumerate(texts[-2:]), (None, texts[-1])]:
        words = (text or "").encode().split()
        words = [w.decode() for w in words]
        runs = [(0, len(words), 1)] if len(words) > 1000 else brute(words)
        wanted.append((doc_id, len(words), tuple(runs), reduced(words, runs)))
    assert as_rows(periodic.periodic_runs(clashing(frame))) == sorted(wanted, key=str)


def test_empty_table_and_few_periods(spark):
    assert periodic.periodic_runs(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        periodic.Finder(6, 2)


def test_long_repeats():
    source = random.Random(2)
    block = [b"%d" % source.randrange(10**6) for _ in range(60_000)]
    assert periodic.Finder().runs([block * 4, [b"w"] * 300_000]) == [[(0, 240_000, 60_000)], [(0, 300_000, 1)]]


def test_query_over_the_given_table(spark, sf_dir):
    wanted = {}
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        words = [w.decode() for w in (row["text"] or "").encode().split()]
        h, n = zlib.crc32(str(row["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words) if n < 3000 or h % 10 == 0 else None
        wanted[row["doc_id"]] = (words, runs)
    found = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, sf_dir).collect()}
    assert found.keys() == wanted.keys() and any(r for _, r in wanted.values())
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for doc_id, (words, runs) in wanted.items():
        if runs is None:
            continue
        row = found[doc_id]
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if runs else None
        assert (row["n_runs"], row["start"], row["length"], row["period"], row["exponent_milli"]) == (len(runs), *best, milli)
        assert row["runs_sha256"] == digest("".join(f"{s},{n},{p}\n" for s, n, p in runs))
        assert row["collapsed_sha256"] == digest(reduced(words, runs))
