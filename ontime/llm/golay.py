"""SimHash near-duplicates through the binary Golay code of length 23.

Every 23-bit word is at most 3 bits away from exactly one of 4 096 codewords. A segment of a
fingerprint gets the indices of its own codeword and of those that become nearest after one more
error. Two segments one bit apart: the own index of each is among the indices of the other. Two
bits apart: they share an index. Fingerprints with few errors share such keys in two segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ontime.llm.components import components
from ontime.session import materialize

WIDTH, SEED = 4, 42  # words of a shingle, seed of its hash
ERRORS = 4  # differing bits of a link; the keys below find up to 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and number of bits
PIECES = 5  # one more than errors: some piece of two linked fingerprints is equal
GROUP = 4_096  # fingerprints of one key that a task compares with each other
CHUNK = 32_768  # shingles whose bits are counted at once

LENGTH, DATA = 23, 12
GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def remainder(value: int) -> int:
    """Of a word of 23 bits, divided by the generator polynomial."""
    for bit in range(LENGTH - 1, DATA - 2, -1):
        if value >> bit & 1:
            value ^= GENERATOR << (bit - DATA + 1)
    return value


def nearest() -> np.ndarray:
    """Index of the nearest codeword, its upper 12 bits, of every pair of upper bits and remainder as an error to undo."""
    errors = np.zeros(2 ** (LENGTH - DATA), np.int64)
    bits = [1 << i for i in range(LENGTH)]
    for i, a in enumerate(bits):
        errors[remainder(a)] = a
        for j, b in enumerate(bits[i + 1:], i + 1):
            errors[remainder(a | b)] = a | b
            for c in bits[j + 1:]:
                errors[remainder(a | b | c)] = a | b | c
    return errors


class Golay:
    """Decodes arrays of 23-bit words to codeword indices."""

    def __init__(self):
        self.errors = nearest()
        self.upper = np.array([remainder(high << (LENGTH - DATA)) for high in range(2 ** DATA)], np.int64)

    def decode(self, words: np.ndarray) -> np.ndarray:
        high, low = words >> (LENGTH - DATA), words & (2 ** (LENGTH - DATA) - 1)
        return (words ^ self.errors[self.upper[high] ^ low]) >> (LENGTH - DATA)

    def indices(self, words: np.ndarray, bits: int) -> np.ndarray:
        """Per word a row: its own index, then those after flipping each of its ``bits`` low bits."""
        flips = np.r_[0, 1 << np.arange(bits)]
        return self.decode(words[:, None] ^ flips[None, :])


def simhash(words: list[bytes], width: int = WIDTH) -> int:
    """64 bits, each set if it is set in over half the hashes of the word shingles, repeats included."""
    count = max(len(words) - width + 1, 1 if words else 0)
    ones = np.zeros(64, np.int64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1][:count]
    ends = ends[min(width, len(words)) - 1:] if count else ends
    digest = xxhash.xxh64_intdigest
    for k in range(0, count, CHUNK):
        spans = zip(starts[k:k + CHUNK].tolist(), ends[k:k + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > count).tolist())


def fingerprints(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id and fingerprint (64 bits as a long) of every row, from whole texts.

    Words are what ASCII blanks part, A-Z in lower case; fewer than ``width`` are one shingle. Null
    and blank texts have fingerprint zero. Every row is taken by itself; other columns are left out.
    A text is held whole with the list of its words; the bits of its shingles are counted in chunks.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [simhash((text or b"").lower().split(), width) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(np.array(made, np.uint64).view(np.int64))], names=["doc_id", "fingerprint"]
            )

    given = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return given.mapInArrow(sign, "doc_id long, fingerprint long")


def hexadecimal(column: str):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def segment_keys(code: Golay, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the fingerprints, and their keys: a pair of segments and an index in each.

    Of at most 4 errors in three segments, two segments hold at most 2, either one in each or none
    in one of them. One index is the own one of its segment, the other any of its indices:
    with one error in each, the own index of either fingerprint meets the other's.
    """
    bits = prints.view(np.uint64)
    segments = [
        code.indices(((bits >> np.uint64(first)) & np.uint64(2 ** count - 1)).astype(np.int64), count)
        for first, count in SEGMENTS
    ]
    places, keys = [], []
    for number, (a, b) in enumerate(((0, 1), (1, 2), (2, 0))):
        x, y = segments[a], segments[b]
        made = (number << 2 * DATA) + np.hstack([(x[:, :1] << DATA) + y, (x << DATA) + y[:, :1]])
        made.sort(axis=1)
        new = np.hstack([np.ones((len(made), 1), bool), made[:, 1:] != made[:, :-1]])
        places.append(np.nonzero(new)[0])
        keys.append(made[new])
    return np.concatenate(places), np.concatenate(keys)


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64))


def forest(prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that join what the fingerprints of one key link, breadth first; each is reached once."""
    rest = np.sort(prints)
    while len(rest) > 1:
        waiting, rest = [rest[0]], rest[1:]
        while waiting and len(rest):
            own = waiting.pop()
            near = apart(rest, own) <= ERRORS
            if near.any():
                found = rest[near]
                yield np.full(len(found), own), found
                waiting.extend(found)
                rest = rest[~near]


def joined(batches: Iterator[pa.RecordBatch], split: bool) -> Iterator[pa.RecordBatch]:
    """Links between the fingerprints of equal keys, from rows sorted by key.

    A key with more than ``GROUP`` fingerprints is handed on, if ``split``: its rows come out with
    a link to nothing, and no more than a batch of them is held at a time.
    """
    key, group, over = None, [], False

    def finish() -> Iterator[pa.RecordBatch]:
        if over or not group:
            return
        for a, b in forest(np.unique(np.concatenate(group))):
            yield rows(np.zeros(len(a), np.int64), a, b)

    def rows(keys, a, b) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(a), pa.array(b)], names=["key", "a", "b"])

    for batch in batches:
        keys, prints = (np.asarray(batch[c]) for c in ("key", "fingerprint"))
        if not len(keys):
            continue
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        stops = np.r_[starts[1:], len(keys)]
        # Keys of two rows, within the batch, at once.
        twos = (stops - starts == 2) & (starts > 0) & (stops < len(keys))
        a, b = prints[starts[twos]], prints[starts[twos] + 1]
        near = (apart(a, b) <= ERRORS) & (a != b)
        if near.any():
            yield rows(np.zeros(near.sum(), np.int64), np.minimum(a, b)[near], np.maximum(a, b)[near])
        ones = (stops - starts == 1) & (starts > 0) & (stops < len(keys))
        for start, stop in zip(starts[~twos & ~ones].tolist(), stops[~twos & ~ones].tolist(), strict=True):
            if keys[start] != key:
                yield from finish()
                key, group, over = keys[start], [], False
            group.append(prints[start:stop])
            if split and (over or sum(map(len, group)) > GROUP):
                over = True
                for part in group:
                    yield rows(np.full(len(part), key), part, part)
                group = []
    yield from finish()


def links(prints: DataFrame) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that join all those at most ``ERRORS`` bits apart.

    ``prints`` has distinct fingerprints. Rows with equal keys meet in one task, which gives a tree
    of links for each component among them, never all pairs. The fingerprints of a key with very
    many are dealt once more, by key and each of five equal pieces, and so compared in smaller groups.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Golay()
        for batch in batches:
            values = np.asarray(batch["fingerprint"])
            if len(values):
                places, keys = segment_keys(code, values)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(values[places])], names=["key", "fingerprint"])

    def met(rows: DataFrame, split: bool) -> DataFrame:
        dealt = rows.repartition("key").sortWithinPartitions("key")
        return dealt.mapInArrow(lambda batches: joined(batches, split), "key long, a long, b long")

    first = materialize(met(prints.select("fingerprint").mapInArrow(keyed, "key long, fingerprint long"), True))
    crowded = first.filter("a = b").select("key", F.col("a").alias("fingerprint"))
    bits = -(-64 // PIECES)
    pieces = F.array(*[
        F.xxhash64("key", F.lit(i), F.shiftrightunsigned("fingerprint", i * bits).bitwiseAND(F.lit(2 ** bits - 1)))
        for i in range(PIECES)
    ])
    again = met(crowded.select(F.explode(pieces).alias("key"), "fingerprint"), False)
    return first.filter("a <> b").select("a", "b").unionByName(again.select("a", "b")).distinct()


def linked_components(signed: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id, the smallest doc_id reachable by links, of every row.

    ``signed`` has doc_id and fingerprint. Rows link when their fingerprints differ in ``ERRORS``
    bits at most; equal ones are one class and are never paired. Rows that share an id are told
    apart by their fingerprints. Null ids link like others and are never the smallest; where
    nothing else is reachable component_id is null. An empty table gives an empty one.
    """
    signed = materialize(signed.select("doc_id", "fingerprint"))
    classes = materialize(signed.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    found = materialize(components(links(classes)))
    named = classes.join(found, F.col("fingerprint") == F.col("node"), "left").withColumn("label", F.coalesce("label", "fingerprint"))
    roots = named.groupBy("label").agg(F.min("least").alias("component_id"))
    by_print = named.select("fingerprint", "label").join(roots, "label").drop("label")
    return signed.join(by_print, "fingerprint").select("doc_id", "fingerprint", "component_id")
