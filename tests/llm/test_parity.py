"""Parity-sketch join and components against all pairs in plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest

from ontime.llm import parity
from ontime.llm.components import components
from tests.llm.helpers import ODD_TEXTS, clashing, documents, sentence


def brute(texts, width, percent):
    sets = []
    for text in texts:
        words = (text or "").encode().lower().split()
        k = min(width, len(words))
        sets.append({tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set())
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if shared and 100 * shared >= percent * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: (len(s), root(i)) for i, s in enumerate(sets)}


def variants(source, count):
    """Texts near the limit: copies with a few words replaced, dropped or added."""
    base = [sentence(source, source.choice([3, 8, 30, 120, 400])).split() for _ in range(count)]
    out = []
    for words in base:
        out.append(" ".join(words))
        for _ in range(3):
            other = list(words)
            for _ in range(source.randint(0, max(1, len(words) // 60))):
                other[source.randrange(len(other))] = f"n{source.randrange(10**6)}"
            cut = source.randint(0, len(other) // 12)
            out.append(" ".join(other[cut:]))
    return out


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80)])
def test_components_equal_brute_force(spark, width, percent):
    source = random.Random(width)
    passage = sentence(source, 60)
    texts = ODD_TEXTS + variants(source, 25) + [passage + " " + sentence(source, 25) for _ in range(20)]
    found = parity.linked_components(clashing(documents(spark, texts)), width, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(texts, width, percent)


def test_small_tiles_and_no_spare_blocks(spark, monkeypatch):
    monkeypatch.setattr(parity, "TILE", 3)
    monkeypatch.setattr(parity, "GROUP", 2)
    monkeypatch.setattr(parity, "MARGIN", 0)
    source = random.Random(9)
    texts = variants(source, 12)
    found = parity.linked_components(documents(spark, texts), 4, 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(texts, 4, 85)


def test_a_batch_is_signed_in_pieces_of_bounded_size():
    """Rows handed over at once do not grow with the Arrow batch; copies in later pieces have no keys, all other texts have theirs."""
    source = random.Random(14)
    texts = [sentence(source, 200, 10**6) for _ in range(4000)]
    texts += texts[:100]
    made = list(parity.Signer(5, 80).batch([(i, i, t) for i, t in enumerate(texts)]))
    tags = np.concatenate([np.asarray(b["tag"]) for b in made]) % parity.KINDS
    keys = np.isin(tags, (parity.LONE, parity.HEAD, parity.MEMBER)).sum()
    assert keys > 2 * parity.PIECE
    assert max(b.num_rows for b in made) < 1.1 * parity.PIECE
    assert (tags == parity.TEXT).sum() == len(texts) and len({*tags.tolist()} - set(parity.KINDS_OF_ROWS)) == 0
    signer = parity.Signer(5, 80)
    assert keys == sum((np.asarray(b["tag"]) % parity.KINDS >= parity.LONE).sum() for t in texts[:4000] for b in signer.batch([(0, 0, t)]))


def test_pieces_of_single_texts_link_alike(spark, monkeypatch):
    monkeypatch.setattr(parity, "PIECE", 1)
    monkeypatch.setattr(parity, "READ", 1)
    texts = ODD_TEXTS + variants(random.Random(15), 12)
    found = parity.linked_components(documents(spark, texts), 5, 80).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(texts, 5, 80)


@pytest.mark.parametrize("kept", [1, 8])
def test_pairs_of_many_blocks_are_told_once(spark, monkeypatch, kept):
    """30 nodes of one sketch in 5 to 20 blocks each; with few named blocks some pairs come again, none is lost."""
    monkeypatch.setattr(parity, "FIRST", kept)
    source = random.Random(13)
    sketch = [source.randrange(2**62) for _ in range(2)]
    blocks = {node: set(source.sample(range(-10, 10), source.randint(5, 20))) for node in range(30)}
    rows = [(key, 30, 0, node, node, 100, sketch) for node, keys in blocks.items() for key in keys]
    given = spark.createDataFrame(rows, "key long, nodes long, main long, node long, label long, size long, sketch array<long>")
    given = given.join(parity.first_blocks(given), "node")
    told = sorted((r["a"], r["b"]) for r in parity.close_pairs(given, 85, False).collect())
    wanted = [(x, y) for x in range(30) for y in range(x + 1, 30) if blocks[x] & blocks[y]]
    assert sorted(set(told)) == wanted
    every = sum(len(blocks[x] & blocks[y]) for x, y in wanted)
    assert len(told) < every / 2 if kept == 8 else len(told) < every
    nearest = {(r["a"], r["b"]) for r in parity.close_pairs(given, 85, True).collect()}
    assert nearest == set(wanted)


def test_near_misses_of_one_template(spark):
    source = random.Random(10)
    words = sentence(source, 200, 10**6).split()
    texts = []
    for i in range(80):
        other = list(words)
        for at in source.sample(range(200), source.choice([3, 6, 8, 12])):
            other[at] = f"n{i}-{at}"
        texts.append(" ".join(other))
    found = parity.linked_components(documents(spark, texts), 4, 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(texts, 4, 85)


def test_null_ids_repeated_ids_and_empty_table(spark):
    source = random.Random(11)
    a, b, c = (sentence(source, 60, 10**6) for _ in range(3))
    rows = [(None, a), (3, a), (3, a + " more"), (4, None), (None, b), (None, c), (5, c), (3, b), (9, a), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r["doc_id"], r["component_id"]) for r in parity.linked_components(frame).collect()), key=str)
    wanted = [(None, 3), (3, 3), (3, 3), (4, 4), (None, 3), (None, 5), (5, 5), (3, 3), (9, 3), (None, None)]
    assert found == sorted(wanted, key=str)
    assert parity.linked_components(documents(spark, [])).count() == 0


def test_sets_with_one_number_are_signed_anew(spark, monkeypatch):
    real = parity.class_node
    monkeypatch.setattr(parity, "class_node", lambda elements, seed=0: 7 if seed == 0 else real(elements, seed))
    texts = ["a b c d e f g", "h i j k l m n", "a b c d e f g"]
    found = parity.linked_components(documents(spark, texts)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {0: 0, 1: 1, 2: 0}


def test_nothing_stays_but_the_result(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("ontime.session.shared_folder", lambda spark: str(tmp_path))
    made = parity.linked_components(documents(spark, variants(random.Random(12), 5)))
    assert [str(p) for p in tmp_path.iterdir()] == [made.stored_path]


def test_similar_sets_share_enough_blocks_and_bits():
    source = np.random.default_rng(1)
    for size in (7, 20, 90, 500, 3000):
        for percent in (80, 85):
            own = np.unique(source.integers(0, 2**63, size, dtype=np.uint64))
            for gone in range(0, size * (100 - percent) // 100 + 1, max(1, size // 40)):
                other = own[gone:]
                if 100 * len(other) < percent * len(own):
                    continue
                layout = parity.Layout(parity.band_of(len(own)), percent)
                if not layout.differences:
                    assert not gone
                    continue
                due, keys = layout.keys(own)
                due_other, keys_other = layout.keys(other)
                assert len(np.intersect1d(keys, keys_other)) >= max(due, due_other)
                bits = np.bitwise_count((layout.sketch(own) ^ layout.sketch(other)).view(np.uint64)).sum()
                assert bits <= gone


def test_long_chains_are_joined(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    found = {r["node"]: r["label"] for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
