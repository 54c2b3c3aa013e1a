"""Spelling variants: words one code point apart, found in a trie of letter-group counts.

A word is filed by how often it has the letters of each group. One letter more adds one to one
count; one letter replaced adds one somewhere and takes one elsewhere, or changes no count. So a
search that may spend one surplus and one deficit on its way down the trie meets every near word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ontime.llm.words import mix
from ontime.session import materialize

LETTERS = "[A-Za-zÀ-ÿ]+"
LENGTH, TIMES, RATIO = 7, 2, 10  # least code points and occurrences of a word, and a form's multiple of its variant
GROUPS = 32  # letter groups: code points by their last five bits
ROUTE = 3  # levels below the length that are dealt out by Spark
NODE = 20_000  # words of a dealt node that a task holds at once
LEAF = 8  # words at which a node is a leaf
BLOCK = 100_000  # states of the search held at once, per level


def lower(column):
    """A-Z in lower case, all else as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_counts(documents: DataFrame, delete_every: int | None = None) -> DataFrame:
    """word and n of the distinct runs of letters of whole texts, A-Z in lower case, of ``LENGTH`` code points and ``TIMES`` occurrences.

    With ``delete_every`` a run loses a code point where the checksum of doc_id and run is a
    multiple of it: planted misspellings. Null texts have no words; a null id counts as an empty
    one in the checksum. Counts merge before they move, so a frequent word is one row per task.
    """
    words = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.explode(F.expr(f"regexp_extract_all(text, r'{LETTERS}', 0)")).alias("word"),
    ).select("doc_id", lower(F.col("word")).alias("word"))
    if delete_every:
        sums = words.withColumn("h", F.crc32(F.concat("doc_id", F.lit(":"), "word").cast("binary")))
        at = F.pmod("h", F.length("word")).cast("int")
        shorter = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        words = sums.select(F.when(F.pmod("h", F.lit(delete_every)) == 0, shorter).otherwise(F.col("word")).alias("word"))
    long_enough = words.filter(F.length("word") >= LENGTH)
    return long_enough.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= TIMES)


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words one after the other, and their number per word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), lengths


def group_counts(words: list[str]) -> np.ndarray:
    """Row per word, column per letter group."""
    points, lengths = letters(words)
    place = np.repeat(np.arange(len(words)), lengths) * GROUPS + points % GROUPS
    return np.bincount(place, minlength=len(words) * GROUPS).reshape(-1, GROUPS).astype(np.int32)


def group_order(words: DataFrame) -> list[int]:
    """Letter groups, the most frequent first: they part the words best. A sum of ``GROUPS`` numbers per task."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(GROUPS, np.int64)
        for batch in batches:
            sums += group_counts(batch["word"].to_pylist()).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(GROUPS)), pa.array(sums)], names=["letters", "total"])

    rows = words.select("word").mapInArrow(total, "letters long, total long").groupBy("letters").agg(F.sum("total").alias("total"))
    totals = {r["letters"]: r["total"] for r in rows.collect()}
    return sorted(range(GROUPS), key=lambda g: (-totals.get(g, 0), g))


# What a row says beside the word, in the low bits of one number: it is filed here, or it searches
# with a surplus or a deficit to spend, for words one longer or as long. The rest of the number is n.
HOME, SURPLUS, DEFICIT, LONGER = 1, 2, 4, 8
BITS = 4
ROUTED = pa.schema([("node", pa.int64()), ("about", pa.int64()), ("word", pa.string())])
ROUTED_SQL = "node long, about long, word string"


def node_number(length: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Number of the node below a length and the first counts; lengths are told apart again where it is used."""
    number = length.astype(np.uint64)
    for column in counts.T:
        number = mix(number * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64))
    return number.view(np.int64)


def routes(words: list[str], n: np.ndarray, order: list[int]) -> Iterator[pa.RecordBatch]:
    """Every word at its own node, and as a search at each node it can reach; what is left to spend goes along.

    A search looks for words one longer (a surplus) or as long (a surplus, then a deficit, or
    neither): of two near words exactly one finds the other, but for equal counts, where both do.
    """
    counts = group_counts(words)[:, order[:ROUTE]]
    length = np.fromiter(map(len, words), np.int64, len(words))
    column = pa.array(words)

    def rows(kind: int, up: int | None = None, down: int | None = None) -> pa.RecordBatch:
        moved = counts.copy()
        if up is not None:
            moved[:, up] += 1
        if down is not None:
            moved[:, down] -= 1
        fits = np.flatnonzero((moved >= 0).all(1))
        nodes = node_number(length[fits] + bool(kind & LONGER), moved[fits])
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes), pa.array((n[fits] << BITS) + kind), column.take(pa.array(fits))], schema=ROUTED
        )

    yield rows(HOME)
    yield rows(SURPLUS | DEFICIT)
    yield rows(SURPLUS | LONGER)
    for up in range(ROUTE):
        yield rows(DEFICIT, up)
        yield rows(LONGER, up)
        for down in range(up + 1, ROUTE):
            yield rows(0, up, down)


class Trie:
    """Words of one length and node, filed by their letter-group counts, level by level from that node down.

    A node is a stretch of the sorted rows; ``starts`` of a level are those of its nodes.
    """

    def __init__(self, words: list[str], n: np.ndarray, order: list[int]):
        counts = group_counts(words)[:, order]
        sort = np.lexsort(counts.T[::-1])
        self.words = [words[i] for i in sort.tolist()]
        self.n, self.counts = n[sort], counts[sort]
        self.points = letters(self.words)[0].reshape(len(words), -1)
        self.order = order
        self.levels = {}
        nodes = np.zeros(len(words), np.int64)
        for level in range(ROUTE, GROUPS):
            child = nodes * self.base + self.counts[:, level]
            keys, starts = np.unique(child, return_index=True)
            self.levels[level] = keys, np.r_[starts, len(words)]
            nodes = np.searchsorted(keys, child)

    @property
    def base(self) -> int:
        """More than any count."""
        return self.points.shape[1] + 2

    def search(self, words: list[str], surplus: np.ndarray, deficit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Indices of the words asked for and of the near words here, as verified.

        Depth first over blocks of states (word, node, what may still be spent): the deepest block
        goes on, so at most ``BLOCK`` states and their children wait per level. A surplus
        comes before its deficit.
        """
        points, lengths = letters(words)
        points = points.reshape(len(words), -1)
        shorter = points.shape[1] < self.points.shape[1]
        asked = group_counts(words)[:, self.order]
        everyone = np.arange(len(words))
        waiting = [(ROUTE, everyone, np.zeros(len(words), np.int64), surplus, deficit)]
        while waiting:
            level, who, node, may_add, may_take = waiting.pop()
            if len(who) > BLOCK:
                for k in range(0, len(who), BLOCK):
                    part = slice(k, k + BLOCK)
                    waiting.append((level, who[part], node[part], may_add[part], may_take[part]))
                continue
            keys, starts = self.levels[level]
            found = []
            # Same count; one more here, if no surplus is spent; one less, if the surplus is spent and no deficit.
            for step, allowed in ((0, None), (1, may_add), (-1, ~may_add & may_take)):
                take = slice(None) if allowed is None else np.flatnonzero(allowed)
                w, k = who[take], node[take]
                wanted = asked[w, level] + step
                key = k * self.base + wanted
                at = np.searchsorted(keys, key)
                hit = np.flatnonzero((wanted >= 0) & (wanted < self.base) & (keys[np.minimum(at, len(keys) - 1)] == key))
                add, take_ = may_add[take][hit] & (step != 1), may_take[take][hit] & (step != -1)
                found.append((w[hit], at[hit], add, take_))
            who, node, may_add, may_take = (np.concatenate(c) for c in zip(*found, strict=True))
            first, size = starts[node], starts[node + 1] - starts[node]
            leaf = (size <= LEAF) | (level == GROUPS - 1)
            if leaf.any():
                yield from self.verified(points, asked, who[leaf], first[leaf], size[leaf], shorter)
            if not leaf.all():
                rest = ~leaf
                waiting.append((level + 1, who[rest], node[rest], may_add[rest], may_take[rest]))

    def verified(self, points, asked, who, first, size, shorter: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of the words at leaves those that differ by exactly one code point, in blocks."""
        ends = np.cumsum(size)
        for low in range(0, int(ends[-1]), BLOCK):
            number = np.arange(low, min(low + BLOCK, int(ends[-1])))
            leaf = np.searchsorted(ends, number, side="right")
            a, b = who[leaf], first[leaf] + number - (ends[leaf] - size[leaf])
            change = self.counts[b] - asked[a]
            off = np.abs(change).sum(1)
            # One more; or one more, then one less (the other order is found from the other side); or none.
            early = change[np.arange(len(a)), (change != 0).argmax(1)]
            fits = np.flatnonzero((off == 1) if shorter else (off == 0) | (off == 2) & (early == 1))
            a, b = a[fits], b[fits]
            x, y = points[a], self.points[b]
            if shorter:
                before, after = x != y[:, :-1], x != y[:, 1:]
                width = x.shape[1]
                first_off = np.where(before.any(1), before.argmax(1), width)
                last_off = np.where(after.any(1), width - 1 - after[:, ::-1].argmax(1), -1)
                near = last_off < first_off
            else:
                # Equal counts are found from both sides: the smaller word keeps the pair.
                near = ((x != y).sum(1) == 1) & ((off[fits] > 0) | (x.sum(1) < y.sum(1)))
            if near.any():
                yield a[near], b[near]


def near_pairs(words: DataFrame) -> DataFrame:
    """word, other and other_n for every two of the given words (word, n) exactly one code point apart, both ways.

    Spark deals the words to the nodes ``ROUTE`` levels below their length; a node of more than
    ``NODE`` words is split by a hash and its searches go to each part. A task builds the trie
    below a node from its words, then runs the searches through it batch by batch.
    """
    order = group_order(words)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from routes(batch["word"].to_pylist(), np.asarray(batch["n"]), order)

    routed = words.select("word", "n").mapInArrow(route, ROUTED_SQL)
    home = F.col("about").bitwiseAND(HOME) == HOME
    sizes = materialize(routed.filter(home).groupBy("node").agg(F.ceil(F.count(F.lit(1)) / NODE).cast("int").alias("parts")))
    part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    parts = F.when(home, F.array(part)).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = routed.join(sizes, "node").select("node", F.explode(parts).alias("part"), "about", "word")
    dealt = dealt.repartition("node", "part").sortWithinPartitions("node", "part", home.desc())

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, tries = None, [], {}
        for batch in batches:
            node, part, about = (np.asarray(batch[c]) for c in ("node", "part", "about"))
            if not len(node):
                continue
            filed = about & HOME
            cut = np.flatnonzero((node[1:] != node[:-1]) | (part[1:] != part[:-1]) | (filed[1:] != filed[:-1])) + 1
            for start, stop in zip([0, *cut.tolist()], [*cut.tolist(), len(node)], strict=True):
                rows, about_rows = batch["word"].slice(start, stop - start).to_pylist(), about[start:stop]
                if (node[start], part[start]) != key:
                    key, members, tries = (node[start], part[start]), [], {}
                if filed[start]:
                    members.append((rows, about_rows >> BITS))
                elif members:
                    if not tries:
                        tries = planted(members)
                    yield from answers(tries, rows, about_rows)

    def planted(members) -> dict[int, Trie]:
        words, n = [w for m in members for w in m[0]], np.concatenate([m[1] for m in members])
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        by_length = ((int(k), np.flatnonzero(lengths == k)) for k in np.unique(lengths))
        return {k: Trie([words[i] for i in here.tolist()], n[here], order) for k, here in by_length}

    def answers(tries: dict[int, Trie], words: list[str], about: np.ndarray) -> Iterator[pa.RecordBatch]:
        lengths = np.fromiter(map(len, words), np.int64, len(words)) * 2 + (about & LONGER > 0)
        for length in np.unique(lengths):
            trie = tries.get(int(length // 2 + length % 2))
            if trie is None:
                continue
            here = np.flatnonzero(lengths == length)
            asked, spend = [words[i] for i in here.tolist()], about[here]
            for a, b in trie.search(asked, spend & SURPLUS > 0, spend & DEFICIT > 0):
                own, other = [asked[i] for i in a.tolist()], [trie.words[i] for i in b.tolist()]
                yield pa.RecordBatch.from_arrays([
                    pa.array(own + other), pa.array(other + own), pa.array(np.r_[trie.n[b], spend[a] >> BITS]),
                ], names=["word", "other", "other_n"])

    return dealt.mapInArrow(find, "word string, other string, other_n long")


def variants(counted: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``counted`` (word and n, words distinct).

    form is the near word of largest n (ties: the smallest) if that is at least ``ratio`` times n,
    else null with form_n; root is where forms lead in the end, the word itself if it has none.
    Without words the result is empty. Forms grow by ``ratio`` a step, so few rounds end the search for roots.
    """
    words = materialize(counted.select("word", "n"))
    best = near_pairs(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    joined = words.join(best, "word", "left")
    is_form = -F.col("best.less") >= ratio * F.col("n")
    named = materialize(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"),
    ))
    steps = named.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(steps.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        ))
        steps = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return named.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
