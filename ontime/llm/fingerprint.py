"""Document fingerprints from closed syncmers over words.

A window of K words is chosen when the smallest hash of its inner groups of S words lies at the
first or the last of them. Whether a window is chosen depends on its own words only, so equal
passages give equal anchors wherever they stand. Built from DataFrame functions alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

K, S = 5, 2
# Runs of letters, marks and digits; scripts written without spaces give a word per character.
WORD = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]|[\p{L}\p{M}\p{N}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]]+"
HEX = 8  # digits of an anchor in the fingerprint
FAN = 64  # slices are looked up in two steps of this width


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Words in lower case; a text without any is one word, so that equal texts only are equal."""
    found = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return let(found, lambda w: F.when(F.size(w) > 0, w).otherwise(F.array(text)))


def anchors(text: Column, k: int = K, s: int = S, never_none: bool = False) -> Column:
    """Chosen windows in order, as an array of (position of the first word, hash).

    A null or empty text has none. A text of fewer than K words is one window. With ``never_none``
    the window of the smallest hash stands for a text in which none is chosen; without, whether a
    window is an anchor depends on its own words in short texts too.
    """
    if not 1 <= s < k:
        raise ValueError("inner groups are shorter than the window")
    inner = k - s + 1

    def chosen(w: Column) -> Column:
        groups = F.transform(
            F.sequence(F.lit(1), F.size(w) - s + 1),
            lambda i: F.xxhash64(*[F.get(w, i + (j - 1)) for j in range(s)]),
        )

        def closed(g: Column) -> Column:
            def at_edge(i: Column) -> Column:
                parts = [F.get(g, i + j) for j in range(inner)]
                least = F.least(*parts)
                return (parts[0] == least) | (parts[-1] == least)
            every = F.sequence(F.lit(0), F.size(w) - k)
            edges = windows(F.filter(every, at_edge))
            if not never_none:
                return edges
            first = lambda a, b: (
                F.when(a["hash"] < b["hash"], -1).when(a["hash"] > b["hash"], 1).otherwise(a["position"] - b["position"])
            )
            return let(edges, lambda e: F.when(F.size(e) > 0, e).otherwise(F.slice(F.array_sort(windows(every), first), 1, 1)))

        def windows(starts: Column) -> Column:
            return F.transform(starts, lambda i: F.struct(
                i.alias("position"),
                F.xxhash64(*[F.get(w, i + j) for j in range(k)]).alias("hash"),
            ))
        return let(groups, closed)

    whole = lambda w: F.array(F.struct(F.lit(0).alias("position"), F.xxhash64(w).alias("hash")))
    none = F.array().cast("array<struct<position:int,hash:bigint>>")
    taken = let(words(text), lambda w: F.when(F.size(w) < k, whole(w)).otherwise(chosen(w)))
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, none).otherwise(taken)


def fingerprint(found: Column) -> Column:
    """The low bits of every anchor hash, in order of position, as fixed-width hex digits."""
    part = lambda a: F.lower(F.right(F.lpad(F.hex(a["hash"]), 16, "0"), F.lit(HEX)))
    return F.array_join(F.transform(found, part), "")


def anchor_set(found: Column) -> Column:
    return F.array_distinct(F.transform(found, lambda a: a["hash"]))


def likeness(left: Column, right: Column) -> Column:
    """Shared over all distinct anchors of two ``anchor_set`` arrays; 1 where both are empty."""
    shared = F.size(F.array_intersect(left, right))
    union = F.size(left) + F.size(right) - shared
    return F.when(union == 0, 1.0).otherwise(shared / union)


def matches(left: DataFrame, right: DataFrame, key: str = "doc_id") -> DataFrame:
    """Pairs of places with the same anchor, one row each: left and right key and position.

    Both sides have ``key`` and ``anchors``. Made for a stated set on one side.
    """
    side = lambda d, name: d.select(
        F.col(key).alias(f"{name}_{key}"), F.explode("anchors").alias("_a")
    ).select(f"{name}_{key}", F.col("_a.position").alias(f"{name}_position"), F.col("_a.hash").alias("_hash"))
    return side(left, "left").join(side(right, "right"), "_hash").drop("_hash")


def slice_bounds(keys: DataFrame, key: str, slices: int) -> list[int]:
    """Keys that split the table into even slices; ``slices`` numbers at most reach the driver."""
    shares = [i / slices for i in range(1, slices)]
    row = keys.agg(
        F.min(key).alias("first"),
        F.percentile_approx(key, shares, max(10_000, 10 * slices)).alias("inner"),
    ).first()
    return sorted({row["first"], *(row["inner"] or [])} - {None})


def slice_of(key: Column, bounds: list[int]) -> Column:
    """Number of the last bound not above the key, found in two steps of ``FAN`` comparisons."""
    step = max(1, -(-len(bounds) // FAN))
    blocks = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    tops = F.array(*[F.lit(b[0]).cast("long") for b in blocks])
    inner = F.array(*[F.array(*[F.lit(x).cast("long") for x in b]) for b in blocks])
    below = lambda a: F.size(F.filter(a, lambda x: x <= key))
    return let(below(tops), lambda block: (block - 1) * step + below(F.get(inner, block - 1)) - 1)


def with_next(documents: DataFrame, slices: int) -> DataFrame:
    """Texts with their anchors and those of the next document; only empty texts have none.

    Columns: doc_id, text, anchors, next_text, next_anchors. The next document has the next greater
    doc_id; after the last comes the first. Rows of one doc_id all have the same next, of which the
    text smallest in byte order counts; null ids come before all others; null texts are empty.
    Rows move once: to the slice of their key, and the first key of each slice also to the slice
    before, as a guest that ends it.
    """
    key = F.coalesce("doc_id", F.lit(-(2 ** 63)))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        key.cast("long").alias("key"),
    )
    bounds = slice_bounds(rows, "key", min(slices, FAN * FAN)) or [0]
    firsts = F.array(*[F.lit(b).cast("long") for b in bounds])

    def homes(own: Column) -> Column:
        resident = F.struct(own.alias("home"), F.lit(0).alias("guest"))
        before = F.when(own > 0, own - 1).otherwise(len(bounds) - 1)
        guest = F.struct(before.alias("home"), F.lit(1).alias("guest"))
        return F.when(F.get(firsts, own) == F.col("key"), F.array(resident, guest)).otherwise(F.array(resident))

    dealt = rows.select("*", F.inline(let(slice_of(F.col("key"), bounds), homes)))
    marked = dealt.repartition("home").withColumn("anchors", anchors(F.col("text"), never_none=True))
    # Going down, what stands before the first row of a key is the next document.
    down = Window.partitionBy("home").orderBy(F.desc("guest"), F.desc("key"), F.desc("text"))
    above = marked.withColumns({
        "above": F.lag(F.struct("text", "anchors")).over(down),
        "above_key": F.lag(F.struct("guest", "key")).over(down),
    })
    own_key = F.struct("guest", "key")
    fresh = F.when(~F.col("above_key").eqNullSafe(own_key), F.col("above"))
    carried = F.last(fresh, ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, 0))
    found = above.withColumn("next", carried).filter("guest = 0")
    return found.select(
        "doc_id", "text", "anchors", F.col("next.text").alias("next_text"),
        F.col("next.anchors").alias("next_anchors"),
    )


def edited_likeness(documents: DataFrame, slices: int) -> DataFrame:
    """Fingerprints of every text and of the text whose last quarter the next one replaces.

    The last floor(n_chars / 4) code points give way to as many of the first of the next document,
    or to all of them. Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.
    """
    quarter = F.floor(F.length("text") / 4).cast("int")
    kept = F.length("text") - quarter
    both = with_next(documents, slices).withColumn(
        "edited", F.concat(F.substring("text", 1, kept), F.substring("next_text", 1, quarter))
    )
    read = both.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("anchors")).alias("fingerprint"),
        anchors(F.col("edited"), never_none=True).alias("edited_anchors"), anchor_set(F.col("anchors")).alias("own"),
        anchor_set(F.col("next_anchors")).alias("other"),
    )
    return read.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint",
        fingerprint(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("own"), anchor_set(F.col("edited_anchors"))).alias("near_edited"),
        likeness(F.col("own"), F.col("other")).alias("near_next"),
    )
