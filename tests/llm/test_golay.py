"""Golay-code SimHash join against all pairs in plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from ontime.llm import golay, queries
from tests.llm.helpers import ODD_TEXTS, clashing, documents

CODE = golay.Golay()


def slow_simhash(text):
    words = (text or "").encode().lower().split()
    k = min(4, len(words))
    grams = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """Smallest id, null if there is none, of the rows reachable by links, per row."""
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if (a ^ rows[j][1]).bit_count() <= 4:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        known = [d for d in (least.get(root(i)), doc_id) if d is not None]
        least[root(i)] = min(known, default=None)
    return sorted(((d, p, least[root(i)]) for i, (d, p) in enumerate(rows)), key=str)


def as_rows(frame):
    return sorted(((r["doc_id"], r["fingerprint"] % 2 ** 64, r["component_id"]) for r in frame.collect()), key=str)


def signed(spark, rows):
    signed_rows = [(d, p - 2 ** 64 if p >= 2 ** 63 else p) for d, p in rows]
    return spark.createDataFrame(signed_rows, "doc_id long, fingerprint long").repartition(3)


def test_every_word_is_near_one_codeword():
    words = np.arange(2 ** 23)
    index = CODE.decode(words)
    codewords = (np.arange(4096) << 11) | CODE.upper
    assert np.bitwise_count(words ^ codewords[index]).max() == 3
    assert set(np.bincount(index)) == {2048}


def test_indices_of_words_one_and_two_bits_apart():
    source = np.random.default_rng(1)
    for words, bits in ((source.integers(0, 2 ** 22, 3000), 22), (source.integers(0, 2 ** 21, 3000), 21)):
        a, b = source.integers(0, bits, (2, 3000))
        own, one = CODE.indices(words, bits), CODE.indices(words ^ (1 << a), bits)
        two = CODE.indices(words ^ (1 << a) ^ (1 << b), bits)
        assert (own[:, :1] == one).any(1).all() and (one[:, :1] == own).any(1).all()
        assert (own[:, :, None] == two[:, None, :]).any((1, 2)).all()


def test_prints_four_bits_apart_share_a_key():
    source = random.Random(2)
    for _ in range(300):
        a = source.getrandbits(64)
        b = a
        for bit in source.sample(range(64), source.randint(1, 4)):
            b ^= 1 << bit
        places, keys = golay.segment_keys(CODE, np.array([a, b], np.uint64).view(np.int64))
        assert set(keys[places == 0]) & set(keys[places == 1])


def clustered(source, groups, size):
    rows = []
    for _ in range(groups):
        print_ = source.getrandbits(64)
        for _ in range(size):
            rows.append((source.choice([len(rows), len(rows), None, 5]), print_))
            for _ in range(source.randint(0, 6)):
                print_ ^= 1 << source.randrange(64)
    return rows


@pytest.mark.parametrize("group", [4096, 3])
def test_components_equal_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(golay, "GROUP", group)
    source = random.Random(3)
    rows = clustered(source, 30, 12) + [(7, 0), (8, 0), (9, 15), (10, 31), (None, 2 ** 64 - 1)]
    assert as_rows(golay.linked_components(clashing(signed(spark, rows)))) == brute(rows)


def test_dense_group_of_distinct_prints(spark, monkeypatch):
    monkeypatch.setattr(golay, "GROUP", 50)
    source = random.Random(4)
    centre = source.getrandbits(64)
    rows = [(0, centre)]
    for i in range(400):
        rows.append((i + 1, centre ^ sum(1 << b for b in source.sample(range(64), source.choice([1, 2, 3, 9])))))
    assert as_rows(golay.linked_components(signed(spark, rows))) == brute(rows)


def test_empty_table_and_lone_null_id(spark):
    assert golay.linked_components(golay.fingerprints(documents(spark, []))).count() == 0
    assert as_rows(golay.linked_components(signed(spark, [(None, 5)]))) == [(None, 5, None)]


def test_fingerprints_of_odd_texts(spark, monkeypatch):
    source = random.Random(5)
    texts = [*ODD_TEXTS, "A b C", "a B c", " ".join(f"w{source.randrange(30)}" for _ in range(2000))]
    for chunk in (32_768, 7):
        monkeypatch.setattr(golay, "CHUNK", chunk)
        found = {r["doc_id"]: r["fingerprint"] % 2 ** 64 for r in golay.fingerprints(clashing(documents(spark, texts))).collect()}
        assert found == {i: slow_simhash(t) for i, t in enumerate(texts)}


def test_query_over_the_given_table(spark, sf_dir):
    given = [(r["doc_id"], slow_simhash(r["text"])) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = sorted(((r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in queries.op12_simhash(spark, sf_dir).collect()), key=str)
    assert found == brute(given)
    assert all(len(r["fingerprint"]) == 16 for r in queries.op12_simhash(spark, sf_dir).collect())
