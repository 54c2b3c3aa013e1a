"""Attach several feature tables to a fact table with as few shuffles of the fact as possible."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

# A table is broadcast only if its proven row bound keeps it below the first size, and only as many
# as stay below the second one together: all of them are held by every executor at once.
BROADCAST_BYTES = 32 * 1024 * 1024
BROADCAST_TOTAL = 96 * 1024 * 1024
BYTES_PER_FIELD = 16


@dataclass(frozen=True)
class FeatureTable:
    """Features keyed by ``keys``, at most ``row_bound`` rows (``None`` if nothing is known)."""

    rows: DataFrame
    keys: tuple[str, ...]
    row_bound: int | None = None

    @property
    def byte_bound(self) -> float:
        if self.row_bound is None:
            return float("inf")
        return self.row_bound * len(self.rows.columns) * BYTES_PER_FIELD

    @property
    def is_small(self) -> bool:
        return self.byte_bound <= BROADCAST_BYTES


def key_counts(data: DataFrame, columns: list[str]) -> dict[str, int]:
    """Exact number of distinct values (null included) of each key column; one row comes back."""
    counted = data.agg(*[
        (F.count_distinct(name) + F.max(F.col(name).isNull().cast("int"))).alias(name)
        for name in columns
    ]).first()
    return {name: int(counted[name] or 0) for name in columns}


def row_bound(counts: dict[str, int], keys: tuple[str, ...]) -> int:
    """A table with one row per key cannot have more rows than there are combinations."""
    return reduce(lambda a, b: a * b, [counts[name] for name in keys], 1)


def join_by_key(facts: DataFrame, features: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on possibly null keys; ``features`` has one row per key, null keys included."""
    renamed = features.withColumnsRenamed({name: f"_key_{name}" for name in keys})
    same = reduce(
        lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_key_{name}")) for name in keys]
    )
    return facts.join(renamed, same, "left").drop(*[f"_key_{name}" for name in keys])


def broadcastable(tables: list[FeatureTable]) -> set[int]:
    """Places of the tables to broadcast: the smallest first, until their sum reaches its bound."""
    chosen, total = set(), 0.0
    for place in sorted(range(len(tables)), key=lambda i: tables[i].byte_bound):
        total += tables[place].byte_bound
        if not tables[place].is_small or total > BROADCAST_TOTAL:
            break
        chosen.add(place)
    return chosen


def join_table(data: DataFrame, table: FeatureTable) -> DataFrame:
    """Left join of one table."""
    return data.join(table.rows, list(table.keys), "left")


def join_small(data: DataFrame, table: FeatureTable) -> DataFrame:
    """Left join of one table that is proven small, broadcast."""
    return data.join(F.broadcast(table.rows), list(table.keys), "left")


def join_wide(facts: DataFrame, features: DataFrame, keys: list[str]) -> DataFrame:
    """``join_by_key`` for many features: neither side is sorted, rows get their features at once.

    A partition of ``features`` is hashed in memory; it has one row per key, so that a hot key is one row.
    """
    return join_by_key(facts, features.hint("shuffle_hash"), keys)


def attach(facts: DataFrame, tables: list[FeatureTable], grain: DataFrame | None = None) -> DataFrame:
    """Left-join every table to the facts; a fact with a null key gets null features.

    Tables proven small are broadcast and cost no shuffle, as long as their sum is bounded too. A single large one is joined as it is.
    Several large ones are first joined to each other at the grain of their combined keys, so that
    the facts are shuffled once and not once per table.

    ``grain`` names keys that many facts share: one row per combination, none of the facts missing.
    All tables over its columns are then joined to it first. Every join copies the rows it has by
    then, so that otherwise each fact is copied once per table, wider each time.
    """
    columns = [*facts.columns, *[
        name for table in tables for name in table.rows.columns if name not in table.keys
    ]]
    shared = [grain is not None and set(table.keys) <= set(grain.columns) for table in tables]
    if sum(shared) > 1:
        features = attach(grain, [table for table, is_shared in zip(tables, shared) if is_shared])
        slim = attach(facts, [table for table, is_shared in zip(tables, shared) if not is_shared])
        return join_wide(slim, features, grain.columns).select(*columns)
    chosen = broadcastable(tables)
    small = [table for i, table in enumerate(tables) if i in chosen]
    large = [table for i, table in enumerate(tables) if i not in chosen]
    if len(large) > 1:
        keys = sorted({name for table in large for name in table.keys})
        facts = join_by_key(facts, reduce(join_table, large, facts.select(*keys).distinct()), keys)
    else:
        facts = reduce(join_table, large, facts)
    return reduce(join_small, small, facts).select(*columns)
