"""Set-similarity join with parity sketches.

The shingles of a text flip bits of a wide sketch, so the sketches of two texts differ in at most as
many bits as their sets differ in elements. Texts of a size band share one layout of blocks, with
more blocks than a similar pair can have differences: a known number of blocks is then equal.
Each text is joined on its rarest blocks only, as many as make sure that one of the equal ones is
among them; the Hamming distance of a narrower sketch drops pairs that differ in too much; the whole
sets decide.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from ontime.llm.components import components
from ontime.llm.words import WordHashes, mix, shingles
from ontime.session import discard, handed_on, materialize, scope

BAND = 1.5  # ratio of the sizes in a band
MARGIN = 0.25  # blocks beyond those needed, as a share of them
WIDTH = 2 ** 24  # bits of a block
SKETCH = 4  # bits of the stored sketch per difference that a similar pair may have
BROADCAST_ROWS = 500_000  # rows of a few numbers that a broadcast may hold
GROUP = 2_000  # nodes of a block that a task compares with each other
FIRST = 8  # blocks that a node names, so that a pair is told once
LAST = np.iinfo(np.int64).max  # above all keys
TILE = 500  # texts of a tile, whose sets a task holds
PIECE = 2 ** 17  # keys that a signing task holds, and rows it hands over at once; one text may have more
READ = 64  # texts taken from an Arrow batch at once


def word_list(text: str) -> list[bytes]:
    """Words between ASCII blanks, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    return np.unique(shingles(hashes, width))


class Layout:
    """Blocks of the sketches in one size band.

    A pair whose larger set is in the band differs in ``differences`` elements at most, so in at
    most as many blocks. ``spare`` blocks more than needed make sure that several are equal, and
    let a text leave out its blocks without elements, which say nothing.
    """

    def __init__(self, band: int, percent: int):
        self.low = BAND ** band
        largest = math.ceil(BAND ** (band + 1)) - 1
        # |A xor B| = a + b - 2 i with 100 i >= percent (a + b - i), and b <= largest.
        self.differences = (100 - percent) * 2 * largest // (100 + percent)
        blocks = self.differences + 1 + math.ceil(MARGIN * (self.differences + 1))
        empty = blocks * math.exp(-self.low / blocks)
        self.spare = blocks - self.differences - 1 + math.ceil(empty + 2 * math.sqrt(empty))
        self.blocks = self.differences + 1 + self.spare
        self.bits = 64 * math.ceil(SKETCH * self.differences / 64)
        self.seed = np.uint64(band * 0x9E3779B97F4A7C15 % 2 ** 64)

    def keys(self, elements: np.ndarray) -> tuple[int, np.ndarray]:
        """Least number of these keys that a similar text has too, and the keys of the blocks.

        The key of a block is the XOR of its set bits, scrambled; flipping a bit twice clears it.
        """
        bit = mix(elements ^ self.seed) % np.uint64(self.blocks * WIDTH)
        order = np.argsort(bit)
        bit = bit[order]
        block = (bit // np.uint64(WIDTH)).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        sketch = np.zeros(self.blocks, np.uint64)
        sketch[block[starts]] = np.bitwise_xor.reduceat(mix(bit + np.uint64(1)), starts)
        number = np.arange(self.blocks, dtype=np.uint64)
        keys = mix(sketch ^ mix(number + self.seed)).view(np.int64)
        # Equal blocks are empty in both texts or in neither: at most so many of the equal ones are left out.
        empty = self.blocks - len(starts)
        return (self.spare - empty + 1, keys[block[starts]]) if empty <= self.spare else (1, keys)

    def sketch(self, elements: np.ndarray) -> np.ndarray:
        """Parity of the elements at each of ``bits`` places, as 64-bit numbers."""
        place = mix(elements + self.seed + np.uint64(1)) % np.uint64(self.bits)
        odd = np.bincount(place.astype(np.int64), minlength=self.bits) & 1
        return np.packbits(odd.astype(np.uint8)).view(np.int64)


def band_of(size: int) -> int:
    band = int(math.log(size) / math.log(BAND))
    while BAND ** (band + 1) <= size:
        band += 1
    while BAND ** band > size:
        band -= 1
    return band


def class_node(elements: np.ndarray, seed: int = 0) -> int:
    """Number of a set of shingles."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(elements.tobytes(), seed)).view(np.int64))


TEXT, SKETCHED, LONE, HEAD, MEMBER = KINDS_OF_ROWS = range(5)
KINDS, BANDS = len(KINDS_OF_ROWS), 128
ABOUT = pa.struct([
    ("doc_id", pa.int64()), ("text_id", pa.int64()), ("size", pa.int64()), ("set_id", pa.binary()),
    ("sketch", pa.list_(pa.int64())),
])
SIGNED = pa.schema([
    ("place", pa.int64()), ("node", pa.int64()), ("tag", pa.int64()), ("key", pa.int64()), ("about", ABOUT),
])
SIGNED_SQL = (
    "place long, node long, tag long, key long, "
    "about struct<doc_id:long, text_id:long, size:long, set_id:binary, sketch:array<long>>"
)


class Signer:
    """Turns a batch of texts into rows of a few kinds, a piece of about ``PIECE`` keys after the other.

    TEXT: doc_id, text_id, size, set_id and node of a text; without set_id and node if it has no
    words. SKETCHED: size and sketch of a node in a band: that of its own size, and those in which
    a larger partner may be. LONE: a key (in ``place``) and the only node of the piece that has it.
    HEAD: the same where there are more, each of which is a MEMBER with that key. Of equal sets in
    a batch only the first has keys and sketches. ``place`` deals rows out evenly, since a key has one
    HEAD per piece however many texts share it. ``tag`` holds the kind, the band, and for a key how
    many keys of its text a similar one has at least.
    """

    def __init__(self, width: int, percent: int, seed: int = 0):
        self.width, self.percent, self.seed = width, percent, seed
        self.layouts: dict[int, Layout] = {}
        self.hashes = WordHashes()

    def layout(self, band: int) -> Layout:
        if band not in self.layouts:
            self.layouts[band] = Layout(band, self.percent)
        return self.layouts[band]

    def batch(self, rows: Iterable[tuple[int | None, int, str]]) -> Iterator[pa.RecordBatch]:
        texts, sketches, keys, marks, held, seen = [], [], [], [], 0, set()
        for doc_id, text_id, text in rows:
            elements = shingle_set(self.hashes.of(word_list(text)), self.width)
            size = len(elements)
            if not size:
                texts.append((None, doc_id, text_id, 0, None))
                continue
            node = class_node(elements, self.seed)
            texts.append((node, doc_id, text_id, size, xxhash.xxh3_128_digest(elements.tobytes())))
            if node in seen:
                continue
            seen.add(node)
            band = band_of(size)
            last = band_of(max(size, size * 100 // self.percent))
            for band in range(band, last + 1):
                layout = self.layout(band)
                if not layout.differences:
                    continue
                due, own = layout.keys(elements)
                sketches.append((node, band, size, layout.sketch(elements)))
                keys.append(own)
                marks.append(due * BANDS + band)
                held += len(own)
            if held >= PIECE:
                yield from self.piece(texts, sketches, keys, marks)
                texts, sketches, keys, marks, held = [], [], [], [], 0
        yield from self.piece(texts, sketches, keys, marks)

    def piece(self, texts: list[tuple], sketches: list[tuple], keys: list[np.ndarray], marks: list[int]) -> Iterator[pa.RecordBatch]:
        if texts:
            node, doc_id, text_id, size, set_id = zip(*texts, strict=True)
            yield signed_rows(np.full(len(node), TEXT), place=pa.array(text_id), node=pa.array(node, pa.int64()), about=about(
                len(node), doc_id=doc_id, text_id=text_id, size=size, set_id=set_id))
        if not keys:
            return
        node, band, size, sketch = zip(*sketches, strict=True)
        node, band = np.array(node, np.int64), np.array(band)
        yield signed_rows(band * KINDS + SKETCHED, place=spread(node + band), node=node, about=about(len(node), size=size, sketch=sketch))
        times = [len(own) for own in keys]
        key, owner, mark = np.concatenate(keys), np.repeat(node, times), np.repeat(np.array(marks, np.int64), times)
        order = np.argsort(key, kind="stable")
        key, owner, mark = key[order], owner[order], mark[order] * KINDS
        head = np.r_[True, key[1:] != key[:-1]]
        many = np.diff(np.r_[np.flatnonzero(head), len(key)]) > 1
        yield signed_rows(mark[head] + np.where(many, HEAD, LONE), place=key[head], node=owner[head])
        rest = ~head
        yield signed_rows(mark[rest] + MEMBER, place=spread(owner[rest] ^ key[rest]), node=owner[rest], key=pa.array(key[rest]))


def spread(values: np.ndarray) -> np.ndarray:
    return mix(values.view(np.uint64)).view(np.int64)


def about(rows: int, **columns) -> pa.StructArray:
    made = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in ABOUT]
    return pa.StructArray.from_arrays(made, fields=list(ABOUT))


def signed_rows(tags: np.ndarray, **columns) -> pa.RecordBatch:
    columns["tag"] = tags
    return pa.RecordBatch.from_arrays([
        columns.get(f.name) if isinstance(columns.get(f.name), pa.Array)
        else pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(tags), f.type) for f in SIGNED
    ], schema=SIGNED)


def signatures(documents: DataFrame, width: int, percent: int, seed: int) -> DataFrame:
    """The rows of ``Signer`` for all texts, less the keys that one node of one piece alone has.

    Columns: kind (HEAD stands for LONE too), key, node, band, due and about. Every key moves once.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(width, percent, seed)
        for batch in batches:
            yield from signer.batch(texts_of(batch))

    def texts_of(batch: pa.RecordBatch) -> Iterator[tuple[int | None, int, str]]:
        for start in range(0, batch.num_rows, READ):
            part = batch.slice(start, READ)
            yield from zip(*(part[c].to_pylist() for c in ("doc_id", "text_id", "text")), strict=True)

    made = documents.mapInArrow(sign, SIGNED_SQL)
    heads = F.count(F.lit(1)).over(Window.partitionBy("place"))
    kind = F.pmod("tag", F.lit(KINDS))
    mark = F.floor(F.col("tag") / KINDS)
    counted = made.withColumn("heads", heads).filter((kind != LONE) | (F.col("heads") > 1))
    return counted.select(
        F.when(kind == LONE, HEAD).otherwise(kind).alias("kind"), F.coalesce("key", "place").alias("key"), "node",
        F.pmod(mark, F.lit(BANDS)).cast("int").alias("band"), F.floor(mark / BANDS).cast("int").alias("due"), "about.*",
    )


def small(stored: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast if it has ``BROADCAST_ROWS`` rows at most."""
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def may_link(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (band, a, b) whose sketches differ in no more bits than similar sets may differ in elements."""
    side = lambda name: sketches.select("band", F.col("node").alias(name), F.col("size").alias(f"size_{name}"), F.col("sketch").alias(f"sketch_{name}"))
    both = pairs.join(side("a"), ["band", "a"]).join(side("b"), ["band", "b"])
    bits = F.aggregate(
        F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, n: total + n
    )
    allowed = F.floor((100 - percent) * (F.col("size_a") + F.col("size_b")) / (100 + percent))
    close = 100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b")
    return both.filter(close).filter(bits <= allowed).select("a", "b")


def first_blocks(rows: DataFrame) -> DataFrame:
    """node and first, the ``FIRST`` smallest keys of its rows; of fewer keys the last one is repeated."""
    keys = F.slice(F.sort_array(F.collect_set("key")), 1, FIRST)
    found = rows.groupBy("node").agg(keys.alias("first"))
    return found.select("node", F.concat("first", F.array_repeat(F.element_at("first", -1), F.lit(FIRST) - F.size("first"))).alias("first"))


def close_pairs(rows: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Pairs (a, b) of nodes with different labels that share a block and whose sketches allow a link.

    ``rows`` has key, nodes (of the key), main (its most frequent label), node, label, size,
    sketch and first (see ``first_blocks``). The nodes of a block meet in one task, those of a block of more than ``GROUP`` in one
    task for every two parts of it. Every pair of different labels has a node outside the
    largest label, so only those are compared with the others; pairs too far apart never leave the task.
    With ``nearest`` a node has one pair per block and other label, the one whose sketches differ least.
    Else a pair is told in the first block that both nodes name only; without one, in every block they
    share. The sketches of a linked pair allow it in any block, so none is lost.
    """
    parts = F.ceil(F.col("nodes") / GROUP).cast("int")
    own = F.pmod(F.xxhash64("node"), parts).cast("int")
    dealt = rows.select(
        "key", "node", "label", "size", "sketch", "first", (F.col("label") != F.col("main")).alias("outer"), own.alias("own"),
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"),
    ).select("*", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    dealt = dealt.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", F.desc("outer"))

    def near(key: int, columns: list[tuple]) -> list[tuple[np.ndarray, np.ndarray]]:
        node, label, size, outer, own, low, high, sketch, first = (np.concatenate(c) for c in zip(*columns, strict=True))
        found = []
        for x in range(int(outer.sum())):
            y = slice(x + 1, None)
            total, least = size[y] + size[x], np.minimum(size[y], size[x])
            bits = np.bitwise_count(sketch[y] ^ sketch[x]).sum(1, dtype=np.int64)
            good = (label[y] != label[x]) & ((own[y] != own[x]) | (low[x] == high[x]))
            good &= (bits <= (100 - percent) * total // (100 + percent)) & (100 * least >= percent * (total - least))
            chosen = np.flatnonzero(good)
            if nearest and len(chosen) > 1:
                chosen = chosen[np.lexsort((bits[chosen], label[y][chosen]))]
                named = label[y][chosen]
                chosen = chosen[np.r_[True, named[1:] != named[:-1]]]
            if not nearest:
                theirs = first[y][chosen]
                told = np.where(np.isin(theirs, first[x]), theirs, LAST).min(axis=1, initial=LAST)
                chosen = chosen[(told == key) | (told == LAST)]
            partner = node[y][chosen]
            if len(partner):
                found.append((np.minimum(partner, node[x]), np.maximum(partner, node[x])))
        return found

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        job, waiting = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            found = []
            key, low, high = (np.asarray(batch[c]) for c in ("key", "low", "high"))
            others = [batch[c].to_numpy(zero_copy_only=False) for c in ("node", "label", "size", "outer", "own", "low", "high")]
            offsets, bits = np.asarray(batch["sketch"].offsets), np.asarray(batch["sketch"].values).view(np.uint64)
            first = np.asarray(batch["first"].flatten()).reshape(-1, FIRST)
            starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
            for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(key)], strict=True):
                if (key[start], low[start], high[start]) != job:
                    found += near(job[0], waiting) if waiting else []
                    job, waiting = (key[start], low[start], high[start]), []
                sketch = bits[offsets[start]:offsets[stop]].reshape(stop - start, -1)
                waiting.append((*(c[start:stop] for c in others), sketch, first[start:stop]))
            if found:
                yield pairs(found)
        if waiting and (found := near(job[0], waiting)):
            yield pairs(found)

    def pairs(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        a, b = (np.concatenate(c) for c in zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return dealt.mapInArrow(compare, "a long, b long")


def verified(documents: DataFrame, pairs: DataFrame, classes: DataFrame, width: int, percent: int, seed: int) -> DataFrame:
    """The pairs (a, b) of nodes whose whole shingle sets are similar enough.

    Nodes are dealt to tiles of about ``TILE``; a task compares one tile with another. A text
    moves once per tile it has a partner in, never once per pair. Texts are looked up by a hash;
    one whose set is not that of its node is left out.
    """
    pairs = materialize(pairs.distinct())
    nodes = materialize(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct())
    tiles = nodes.count() // TILE + 1
    wanted = materialize(nodes.join(classes, "node").select("node", F.col("first.doc_id").alias("_doc"), F.col("first.text_id").alias("_text")))
    texts = materialize(documents.join(
        small(wanted), (F.col("text_id") == F.col("_text")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
    ).select("node", "text").distinct())
    tile = lambda name: F.pmod(F.xxhash64(name), F.lit(tiles)).cast("int")
    placed = materialize(pairs.select("a", "b", tile("a").alias("tile_a"), tile("b").alias("tile_b")))
    owners = placed.select("tile_a", "tile_b", F.col("a").alias("node")).distinct().withColumn("partners", F.array().cast("array<long>"))
    partners = placed.groupBy("tile_a", "tile_b", F.col("b").alias("node")).agg(F.collect_list("a").alias("partners"))
    sent = owners.unionByName(partners).join(texts, "node")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, job, owned = WordHashes(), None, {}
        for batch in batches:
            found = []
            rows = zip(batch["tile_a"], batch["tile_b"], batch["node"], batch["partners"], batch["text"], strict=True)
            for tile_a, tile_b, node, partners, text in rows:
                elements = shingle_set(hashes.of(word_list(text)), width)
                if class_node(elements, seed) != node:
                    continue
                if (tile_a, tile_b) != job:
                    job, owned = (tile_a, tile_b), {}
                if not len(partners):
                    owned[node] = elements
                for partner in partners:
                    other = owned.get(partner)
                    if other is None:
                        continue
                    shared = len(np.intersect1d(elements, other, assume_unique=True))
                    if 100 * shared >= percent * (len(elements) + len(other) - shared):
                        found.append((partner, node))
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])

    dealt = sent.repartition("tile_a", "tile_b").sortWithinPartitions("tile_a", "tile_b", F.size("partners") > 0)
    return dealt.mapInPandas(compare, "a long, b long")


def rare_blocks(signed: DataFrame) -> DataFrame:
    """key, band, node and docs of the blocks to join on.

    A similar pair has ``due`` keys in common at least. With all keys in one order, the rarest
    first, either text can leave out its last due - 1 keys: the first common key has that many
    after it in both. Keys that one node alone has went before; they would have been the rarest.
    """
    blocks = signed.filter(F.col("kind").isin(HEAD, MEMBER)).groupBy("key", "node").agg(
        F.first("band").alias("band"), F.first("due").alias("due")
    )
    blocks = materialize(blocks)
    shared = blocks.groupBy("key").agg(F.count(F.lit(1)).alias("docs")).filter("docs > 1")
    from_last = F.row_number().over(Window.partitionBy("node", "band").orderBy(F.desc("docs"), "key"))
    kept = blocks.join(shared, "key").withColumn("from_last", from_last).filter("from_last >= due")
    return kept.select("key", "band", "node", "docs")


def linked_components(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id reachable by links, of every row.

    Two texts link when their sets of distinct word shingles have at least ``percent`` hundredths
    of their union in common. Texts without words (null, empty, blank) link with nothing and are
    their own component. Equal sets are one class, so copies are never paired. Every row
    counts by its text: rows that share an id, null ids too, are linked by their own texts only. A null
    id is never the smallest; component_id is null where nothing else is reachable. An empty
    table gives an empty one; other columns are left out. A text is held whole, with its words.

    Steps: sign every text; keep the rare blocks of each class; compare every class with the
    pivot it shares most blocks with; join what that has linked; then, of classes that share a block
    and are not in one component yet, compare each with the nearest of another one, and at last every pair. Should two sets get one number, all is
    signed anew with another seed. What is stored on the way is deleted.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    given = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_id"), text.alias("text"))
    spark, seed = documents.sparkSession, 0
    while True:
        with scope(spark):
            signed = materialize(signatures(given, width, percent, seed))
            texts = materialize(signed.filter(F.col("kind") == TEXT).select("doc_id", "text_id", "size", "set_id", "node"))
            classes = materialize(texts.filter("node IS NOT NULL").groupBy("node").agg(
                F.min(F.struct("doc_id", "text_id")).alias("first"), F.min("doc_id").alias("least"),
                (F.min("set_id") != F.max("set_id")).alias("met"),
            ))
            if classes.filter("met").isEmpty():
                labels = all_labels(given, signed, classes, width, percent, seed)
                named = classes.join(labels, "node", "left").select("node", "least", F.coalesce("label", "node").alias("label"))
                named = materialize(named)
                roots = named.groupBy("label").agg(F.min("least").alias("component_id"))
                by_node = named.join(roots, "label").select("node", "component_id")
                return handed_on(texts.join(by_node, "node", "left").select(
                    "doc_id", F.col("size").alias("n_shingles"),
                    F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                ))
        seed += 1


def all_labels(documents: DataFrame, signed: DataFrame, classes: DataFrame, width: int, percent: int, seed: int) -> DataFrame:
    """node and label of every class that is linked with another; takes the signed rows and deletes them."""
    buckets = materialize(rare_blocks(signed))
    sketches = materialize(
        signed.filter(F.col("kind") == SKETCHED).join(small(materialize(buckets.select("node").distinct())), "node", "left_semi")
        .groupBy("node", "band").agg(F.first("size").alias("size"), F.first("sketch").alias("sketch"))
    )
    discard(signed)

    # The text whose blocks are shared most is nearest to the middle of its group: it is the pivot
    # of a block, and a text is compared with the pivot it has most blocks in common with.
    scores = materialize(buckets.groupBy("node").agg(F.sum("docs").alias("score")))
    ranked = buckets.join(small(scores), "node")
    pivots = ranked.groupBy("key").agg(F.max(F.struct("score", "node")).alias("pivot"))
    stars = ranked.join(pivots, "key").filter("node <> pivot.node").groupBy(
        "band", F.col("pivot.node").alias("a"), F.col("node").alias("b")
    ).agg(F.count(F.lit(1)).alias("times"))
    most = F.min(F.struct((-F.col("times")).alias("less"), "a", "band"))
    checked = materialize(stars.groupBy("b").agg(most.alias("most")).select("most.band", "most.a", "b"))
    links = materialize(verified(documents, may_link(checked, sketches, percent), classes, width, percent, seed).distinct())

    # First the nearest pair of a node and another component, which joins most of them; then every pair left.
    for nearest in (True, False):
        labels = materialize(components(links))
        labelled = materialize(buckets.join(small(labels), "node", "left").select("key", "band", "node", F.coalesce("label", "node").alias("label")))
        groups = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("members"))
        split = groups.groupBy("key").agg(
            F.count(F.lit(1)).alias("labels"), F.max(F.struct("members", "label")).alias("largest"), F.sum("members").alias("nodes")
        ).filter("labels > 1").select("key", F.col("largest.label").alias("main"), "nodes")
        open_rows = materialize(labelled.join(split, "key"))
        open_rows = open_rows.join(sketches, ["node", "band"]).join(small(materialize(first_blocks(open_rows))), "node")
        more = verified(documents, close_pairs(open_rows, percent, nearest), classes, width, percent, seed)
        links = materialize(links.unionByName(more))
    return materialize(components(links))
