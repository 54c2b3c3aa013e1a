"""Runs of words that repeat with a period, from the maximal pairs of an LCP-interval tree.

Two places i < j of a text are a maximal pair of length L if the L words from i and from j are the
same, and neither the word before nor the word after them is. Then the words from i to j + L repeat
with period j - i, and no neighbour continues that: a maximal pair that is long for its distance
is a run, with nothing to extend.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ontime.llm.words import mix, shingles

MIN_LENGTH, EXPONENT = 6, 4  # words of a run, and periods it must hold
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.binary())])
FOUND_SQL = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"


class Numbers(dict):
    """A number for every distinct word, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def dense(values: np.ndarray) -> np.ndarray:
    """Ranks of the values, equal where they are equal."""
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


class Finder:
    """Finds the runs of at least ``min_length`` words and ``exponent`` periods (3 or more).

    A pair at distance p is long enough from max(min_length - p, (exponent - 1) * p) words on, so
    all pairs share ``seed`` words at least: nodes of the tree nearer to its root are not built.
    """

    def __init__(self, min_length: int = MIN_LENGTH, exponent: int = EXPONENT):
        if exponent < 3:
            raise ValueError("runs of fewer than three periods are not found from neighbours alone")
        self.min_length, self.times = min_length, exponent - 1
        self.seed = min(max(min_length - p, self.times * p) for p in range(1, min_length + 1))

    def runs(self, texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
        """Per text its runs as (start, length, period), by start and period."""
        numbers = Numbers()
        lengths = np.array([len(words) for words in texts], np.int64)
        first = 1 + np.r_[0, np.cumsum(lengths + 1)].astype(np.int64)
        total = int(first[-1])
        # One word of its own before every text, and enough after the last.
        ids = np.arange(total + self.seed, dtype=np.int64)
        for begin, words in zip(first, texts, strict=False):
            ids[begin:begin + len(words)] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        edges = np.r_[0, first[1:-1] - 1, np.arange(total - 1, total + self.seed)].astype(np.int64)
        ids[edges] = len(numbers) + np.arange(len(edges))
        doc = np.repeat(np.arange(len(texts)), lengths + 1)
        doc = np.r_[-1, doc, np.full(len(ids) - 1 - len(doc), -1)].astype(np.int64)[:len(ids)]
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        leaves, lcps = self.leaves(ids, doc)
        for (begin, end), period in self.pairs(leaves.tolist(), lcps.tolist(), ids).items():
            home = int(doc[begin])
            out[home].append((begin - int(first[home]), end - begin, period))
        for found in out:
            found.sort(key=lambda r: (r[0], r[2]))
        return out

    def leaves(self, ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places that may be in a pair, as sorted by their suffixes, and the words each shares with the one before.

        Left out are places whose nearest equal seed is farther away than the words they can share
        allow; such a place is in no run, and never between the two of a pair.
        """
        none = np.empty(0, np.int64)
        count = len(ids) - self.seed
        key = shingles(ids.view(np.uint64), self.seed)[:count] ^ mix(doc[:count].astype(np.uint64))
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        if not same.any():
            return none, none
        far = np.iinfo(np.int64).max // 8
        step = np.where(same, np.diff(order), far)
        gap = np.full(count, far, np.int64)
        gap[order] = np.minimum(np.r_[far, step], np.r_[step, far])
        repeated = gap < far
        # Places from here on that all repeat, this one included: shared words are fewer than that plus a seed.
        stop = np.flatnonzero(np.r_[~repeated, True])
        ahead = stop[np.searchsorted(stop, np.arange(count))] - np.arange(count)
        kept = repeated & (self.times * gap <= ahead + self.seed - 1)
        if not kept.any():
            return none, none
        # Compare whole stretches that hold such a place, and one seed beyond each.
        group = np.cumsum(np.r_[True, repeated[1:] != repeated[:-1]])
        wanted = np.zeros(group[-1] + 1, bool)
        wanted[group[kept]] = True
        needed = np.zeros(len(ids) + 1, np.int64)
        inside = np.flatnonzero(wanted[group] & repeated)
        np.add.at(needed, inside, 1)
        np.add.at(needed, inside + self.seed + 1, -1)
        base = np.flatnonzero(np.cumsum(needed)[:count] > 0)
        at = np.full(len(ids) + 1, -1, np.int64)
        at[base] = np.arange(len(base))
        ranks = doc[base]
        for offset in range(self.seed):
            ranks = dense((ranks + 1) * (len(ids) + 1) + ids[base + offset])
        levels, width = [], self.seed
        while True:
            levels.append((width, ranks.astype(np.int32)))
            shared = np.bincount(ranks)[ranks] > 1
            if not shared.any():
                break
            beyond = np.where(shared, at[np.minimum(base + width, len(ids))], -1)
            # Places without a successor here are told apart already, or compared by their seed alone.
            following = np.where(beyond >= 0, ranks[beyond], len(base) + np.arange(len(base)))
            ranks = dense(ranks * (2 * len(base)) + following)
            width *= 2
        leaves = np.flatnonzero(kept)
        leaves = leaves[np.argsort(ranks[at[leaves]])]
        lcps = np.r_[0, self.common(ids, at, levels, leaves[:-1], leaves[1:])]
        # What a place shares with its neighbours in this order is the most it shares with any.
        most = np.maximum(lcps, np.r_[lcps[1:], 0])
        stay = np.flatnonzero(most >= np.maximum(self.seed, self.times * gap[leaves]))
        if not len(stay):
            return none, none
        between = np.minimum.reduceat(lcps[:stay[-1] + 1], stay[:-1] + 1) if len(stay) > 1 else none
        return leaves[stay], np.r_[0, between]

    def common(self, ids, at, levels, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes at a and b have in common."""
        shared = np.zeros(len(a), np.int64)
        for width, ranks in reversed(levels):
            x, y = at[np.minimum(a + shared, len(ids))], at[np.minimum(b + shared, len(ids))]
            shared += width * ((x >= 0) & (y >= 0) & (ranks[x] == ranks[y]))
        alive = shared > 0
        for _ in range(self.seed - 1):
            alive = alive & (ids[np.minimum(a + shared, len(ids) - 1)] == ids[np.minimum(b + shared, len(ids) - 1)])
            shared += alive
        return shared

    def pairs(self, leaves: list[int], lcps: list[int], ids: np.ndarray) -> dict[tuple[int, int], int]:
        """Begin and end of every run with its period, by a bottom-up walk over the LCP-interval tree.

        A finished child is merged into its node, the smaller list of places into the larger. The
        class of a place is the word to its left; a pair has two classes. Equal words at
        a distance of a third of their length or less lie a period apart in a row, and all but the
        first of the row have one class: so only neighbours in the order of the text can be the pair of a run.
        Two places with others of the same child between them have a multiple of its period.
        """
        found: dict[tuple[int, int], int] = {}
        if not leaves:
            return found
        left = dict(zip(leaves, ids[np.array(leaves, np.int64) - 1].tolist(), strict=True))
        times, least = self.times, self.min_length

        def merged(node: list[int], child: list[int], depth: int) -> list[int]:
            if len(node) < len(child):
                node, child = child, node
            reach = depth // times
            for place in child:
                k = bisect_left(node, place)
                for other in node[k - 1:k + 1] if k else node[:1]:
                    begin, end = (other, place) if other < place else (place, other)
                    period = end - begin
                    if period <= reach and period + depth >= least and left[begin] != left[end]:
                        span = (begin, end + depth)
                        found[span] = min(period, found.get(span, period))
            for place in child:
                insort(node, place)
            return node

        open_nodes: list[tuple[int, list[int]]] = []
        current = [leaves[0]]
        for place, depth in zip(leaves[1:], lcps[1:], strict=True):
            while open_nodes and open_nodes[-1][0] > depth:
                level, node = open_nodes.pop()
                current = merged(node, current, level)
            if depth < self.seed:
                current = []
            elif open_nodes and open_nodes[-1][0] == depth:
                current = merged(open_nodes.pop()[1], current, depth)
            if depth >= self.seed:
                open_nodes.append((depth, current))
            current = [place]
        while open_nodes:
            level, node = open_nodes.pop()
            current = merged(node, current, level)
        return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by blanks, less those that a run holds after its first period."""
    if runs:
        gone = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            gone[start + period] += 1
            gone[start + length] -= 1
        words = [w for w, dropped in zip(words, np.cumsum(gone).tolist(), strict=False) if not dropped]
    return b" ".join(words)


def periodic_runs(documents: DataFrame, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """doc_id, n_words, runs and collapsed (text without the repeats) of every row; one task reads a text whole.

    Words are what ASCII blanks part, cases told apart. A run is a stretch with a smallest period
    that no neighbouring word continues, of at least ``min_length`` words and ``exponent`` periods.
    Null and blank texts have no words, no runs and an empty collapsed text. Every row is taken by
    itself, so null and repeated ids change nothing; an empty table gives an empty one; other
    columns are left out. A text of n words takes memory in proportion to n, and up to four bytes
    more per word and doubling of the longest repeat where it is periodic.
    """
    finder = Finder(min_length, exponent)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(text or b"").split() for text in batch["text"].to_pylist()]
            runs = finder.runs(texts)
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"],
                pa.array([len(words) for words in texts], pa.int64()),
                pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in found] for found in runs], FOUND.field("runs").type),
                pa.array([collapsed(*both) for both in zip(texts, runs, strict=True)], pa.binary()),
            ], schema=FOUND)

    given = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return given.mapInArrow(find, FOUND_SQL).withColumn("collapsed", F.col("collapsed").cast("string"))
