"""Reproducible samples and the chronological split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ontime import schema
from ontime.operators.ranks import running_totals

# Bits of a position that one histogram of the sample looks at.
LEVEL_BITS = 12


def congruence(key: Column, seed: int) -> Column:
    """Pseudo-random value in [0, modulus) of an integer key."""
    modulus = F.lit(schema.SAMPLE_MODULUS).cast("bigint")
    scrambled = F.pmod(key.cast("bigint"), modulus) * schema.SAMPLE_MULTIPLIER + seed
    return F.pmod(scrambled, modulus)


def sample_fraction(data: DataFrame, fraction: float, seed: int = 42, key: str = "flight_key") -> DataFrame:
    """Keep about ``fraction`` of the rows, always the same ones whatever the partitioning."""
    if not 0 < fraction <= 1:
        raise ValueError("the sample fraction must be in ]0, 1]")
    if fraction == 1:
        return data
    threshold = max(1, int(fraction * schema.SAMPLE_MODULUS))
    return data.filter(congruence(F.col(key), seed) < threshold)


def sample_rows(data: DataFrame, size: int, seed: int = 42, key: str | None = None) -> DataFrame:
    """Exactly ``size`` rows (or all, if fewer), whole and the same ones whatever the partitioning.

    Rows are taken along a hash of the whole row or, with ``key``, along the congruence of an
    integer column (null first), then along the key and the other columns. Two histograms of the
    position, of a bounded number of rows each, find the slice in which the last row lies; all
    slices before it are filtered, and that slice alone is ranked.
    """
    if size <= 0:
        raise ValueError("the sample size must be positive")
    position, ties = F.xxhash64(*data.columns, F.lit(seed)), list(data.columns)
    if key is not None:
        position = F.shiftleft(F.coalesce(congruence(F.col(key), seed), F.lit(-1)), 63 - 20)
        ties = [key, *[name for name in data.columns if name != key]]
    first = F.shiftright(position, 64 - LEVEL_BITS)
    second = F.shiftright(position, 64 - 2 * LEVEL_BITS).bitwiseAND((1 << LEVEL_BITS) - 1)
    placed = data.withColumns({"_first": first, "_second": second})
    outer = _last_slice(placed, "_first", size)
    if outer is None:
        return data
    edge = placed.filter(F.col("_first") == outer.slice)
    inner = _last_slice(edge, "_second", outer.room)
    before = (F.col("_first") < outer.slice) | (
        (F.col("_first") == outer.slice) & (F.col("_second") < inner.slice)
    )
    last = edge.filter(F.col("_second") == inner.slice).withColumn("_position", position)
    chosen = _first_copies(last.drop("_first", "_second"), ["_position", *ties], inner.room)
    return placed.filter(before).select(*data.columns).unionByName(chosen.select(*data.columns))


def _last_slice(rows: DataFrame, name: str, size: int):
    """The slice in which row number ``size`` lies, and how many rows it has to give."""
    counts = rows.groupBy(F.col(name).alias("slice")).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(F.lit(0)).orderBy("slice")
    before = F.sum("n").over(order) - F.col("n")
    return counts.withColumn("before", before).filter(
        (F.col("before") < size) & (F.col("before") + F.col("n") >= size)
    ).select("slice", (F.lit(size) - F.col("before")).alias("room")).first()


def _first_copies(rows: DataFrame, order: list[str], room: int) -> DataFrame:
    """The first ``room`` rows: equal rows are counted, ranked once and written out again."""
    copies = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies"))
    ranked = running_totals(copies, ["_copies"], [F.col(name) for name in order])
    free = F.lit(room) - (F.col("running__copies") - F.col("_copies"))
    taken = ranked.withColumn("_take", F.least(F.col("_copies"), free)).filter("_take > 0")
    batch = 10_000
    batches = taken.select(
        *rows.columns, "_take",
        F.explode(F.sequence(F.lit(0), F.col("_take") - 1, F.lit(batch))).alias("_start"),
    )
    last = F.least(F.col("_take"), F.col("_start") + batch) - 1
    return batches.select(*rows.columns, F.explode(F.sequence(F.col("_start"), last)).alias("_copy")).drop("_copy")


SPLITS = ("train", "tuning", "validation", "test")


def split_name(month: Column) -> Column:
    """Months 1-7 train, 8 tunes, 9-10 validate, 11-12 test."""
    return (
        F.when(month <= 7, "train").when(month == 8, "tuning")
        .when(month <= 10, "validation").when(month >= 11, "test")
    )


def with_split(data: DataFrame) -> DataFrame:
    """Tag each row with its part; one column instead of four copies."""
    return data.withColumn("split", split_name(F.col("month")))


def split_summary(data: DataFrame) -> DataFrame:
    """Rows, delayed rows, share and months of each part and of the whole."""
    label = F.col(schema.TARGET_LABEL)
    summary = with_split(data).rollup("split").agg(
        F.grouping_id().alias("_all"),
        F.count(F.lit(1)).alias("row_count"), F.sum(label.cast("bigint")).alias("delayed_count"),
        (F.avg(label) * 100).alias("delayed_percentage"),
        F.min("month").alias("month_min"), F.max("month").alias("month_max"),
    )
    name = F.when(F.col("_all") == 1, F.lit("all")).otherwise(F.col("split"))
    return summary.withColumn("split", name).drop("_all")


def check_split(data: DataFrame) -> None:
    """Refuse a split with an empty part; reads one row of counts."""
    counts = with_split(data).agg(
        *[F.count_if(F.col("split") == part).alias(part) for part in SPLITS]
    ).first()
    empty = [part for part in SPLITS if not counts[part]]
    if empty:
        raise ValueError(f"the chronological split left empty parts: {', '.join(empty)}")
