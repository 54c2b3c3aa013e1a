"""Budgets and prefixes against plain Python."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ontime.llm import mixing
from tests.llm.helpers import clashing

SCHEMA = "doc_id long, domain string, lang string, source string, text string"


def fill(budget, nodes):
    """nodes: {name: (weight, supply)}; the level is found by handing out again and again."""
    share, open_nodes, left = {}, dict(nodes), budget
    while open_nodes:
        total = sum(w for w, _ in open_nodes.values())
        full = {n for n, (w, s) in open_nodes.items() if s <= left * w / total + 1e-9}
        if not full:
            return share | {n: left * w / total for n, (w, _) in open_nodes.items()}
        for n in full:
            share[n] = open_nodes.pop(n)[1]
        left = budget - sum(share.values())
    return share


def plan(rows, budget, weights, max_epochs, seed):
    tokens = {r[0]: len((r[4] or "").split()) for r in rows}
    path = {r[0]: tuple(x if x is not None else mixing.NONE for x in r[1:4]) for r in rows}
    supply = {}
    for doc, p in path.items():
        for d in range(4):
            supply[p[:d]] = supply.get(p[:d], 0) + tokens[doc] * max_epochs
    budgets = {(): min(budget, supply[()])}
    for depth in range(1, 4):
        for parent in [p for p in budgets if len(p) == depth - 1]:
            nodes = {p: (weights.get(p, 1.0), s) for p, s in supply.items() if len(p) == depth and p[:-1] == parent and s and weights.get(p, 1.0)}
            budgets |= fill(budgets[parent], nodes)
    out = {}
    for leaf in [p for p in budgets if len(p) == 3]:
        docs = [d for d in path if path[d] == leaf]
        whole = sum(tokens[d] for d in docs)
        left = int(budgets[leaf] + 1e-6)
        for epoch in range(max_epochs + 1):
            part = left >= whole
            for doc in sorted(docs, key=lambda d: hashlib.md5(f"{seed}:{epoch}:{d}".encode()).hexdigest()):
                if left > 0 or part:
                    taken = min(tokens[doc], left)
                    out[doc, epoch] = taken
                    left -= taken
            if left <= 0:
                break
    return out, budgets


@pytest.mark.parametrize("budget,max_epochs", [(500, 1), (3000, 1), (3000, 3), (10**6, 2), (0, 1)])
def test_mix_equals_plain_python(spark, budget, max_epochs):
    source = random.Random(budget + max_epochs)
    rows = [
        (i, source.choice("ABC"), source.choice(["en", "de", None]), source.choice(["s1", "s2"]), "w " * source.choice([0, 1, 7, 40]))
        for i in range(200)
    ]
    weights = {("A",): 3.0, ("B",): 0.5, ("A", "en"): 2.0, ("C", "de"): 0.0, ("A", "en", "s1"): 5.0}
    found = mixing.mix_plan(
        clashing(spark.createDataFrame(rows, SCHEMA)), mixing.word_count(), budget=budget, weights=weights, max_epochs=max_epochs, seed=3
    ).collect()
    expected, _ = plan(rows, budget, weights, max_epochs, 3)
    nonzero = {k: v for k, v in expected.items() if v}
    assert {(r["doc_id"], r["epoch"]): r["taken_tokens"] for r in found if r["taken_tokens"]} == nonzero
    assert len({(r["doc_id"], r["epoch"]) for r in found}) == len(found)


def test_shortage_goes_to_siblings_first(spark):
    rows = [(0, "A", "en", "s", "w " * 10), (1, "A", "de", "s", "w " * 500), (2, "B", "en", "s", "w " * 500)]
    made = mixing.mix_plan(spark.createDataFrame(rows, SCHEMA), mixing.word_count(), budget=400)
    assert {r["doc_id"]: r["taken_tokens"] for r in made.collect()} == {0: 10, 1: 190, 2: 200}


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "A", "en", "s", "w w w w")] * 3 + [(None, None, None, None, None), (5, None, None, None, "w w")]
    frame = spark.createDataFrame(rows, SCHEMA)
    whole = mixing.mix_plan(frame, mixing.word_count(), share=1.0).collect()
    assert sum(r["taken_tokens"] for r in whole) == 14
    assert mixing.mix_plan(frame.limit(0), mixing.word_count(), share=0.5).count() == 0
    assert mixing.mix_plan(frame, F.lit(0), share=0.5).count() == 0


@pytest.mark.parametrize("share,max_epochs", [(1.0, 1), (0.3, 1), (1.0, 3)])
def test_leaves_without_tokens_are_taken_once(spark, share, max_epochs):
    rows = [
        (0, "A", "en", "s", "w " * 10), (1, "A", "en", "t", ""), (2, "A", "en", "t", None), (2, "A", "en", "t", None),
        (3, "B", None, None, " "), (4, "C", "en", "s", ""), (5, "A", "de", "s", ""), (6, "A", "fr", "u", ""), (7, "A", "fr", "v", ""),
    ]
    weights = {("C",): 0.0, ("A", "de"): 0.0, ("A", "fr", "u"): 0.0, ("B",): 2.0}
    made = mixing.mix_plan(
        clashing(spark.createDataFrame(rows, SCHEMA)), mixing.word_count(), share=share, weights=weights, max_epochs=max_epochs
    ).collect()
    empty = sorted((r["doc_id"], r["epoch"], r["taken_tokens"]) for r in made if r["doc_id"])
    assert empty == [(1, 0, 0), (2, 0, 0), (2, 0, 0), (3, 0, 0), (7, 0, 0)]
    assert sum(r["taken_tokens"] for r in made) == int(10 * share)
