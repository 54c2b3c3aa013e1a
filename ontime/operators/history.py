"""Delay history: daily counts and rolling rates over the previous calendar days."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ontime import schema
from ontime.functions import outcome
from ontime.functions.ratios import ratio
from ontime.operators.attach import FeatureTable, attach, key_counts, row_bound
from ontime.session import materialize

# Finest daily grain: every history level is a roll-up of it.
LEG_DAY = ["fl_date", "op_unique_carrier", "origin", "dest"]
MEASURES = ["flights", "completed", "delayed", "disrupted"]


def count_outcomes() -> list:
    """The four counts of a group of flights."""
    return [
        F.count(F.lit(1)).alias("flights"),
        F.count_if(outcome.is_completed()).alias("completed"),
        F.count_if(outcome.is_delayed()).alias("delayed"),
        F.count_if(outcome.is_disrupted()).alias("disrupted"),
    ]


def leg_days(flights: DataFrame) -> DataFrame:
    """Counts per day, carrier and route: the only aggregation that reads the fact table."""
    return flights.groupBy(*LEG_DAY).agg(*count_outcomes())


def daily_counts(legs: DataFrame, level: str) -> DataFrame:
    """Counts per day and per key of a history level."""
    keys, _ = schema.HISTORY_LEVELS[level]
    return legs.groupBy("fl_date", *keys).agg(*[F.sum(m).alias(m) for m in MEASURES])


def rolling_history(legs: DataFrame, level: str) -> DataFrame:
    """Delay rate, disruption rate and volume over the N days before each observed day.

    The day itself is excluded. A day with no earlier observation has null features, and so has a
    rate whose denominator is zero. Windows run over daily counts: a key never has more rows than
    the calendar has days.
    """
    keys, lengths = schema.HISTORY_LEVELS[level]
    by_key = Window.partitionBy(*keys).orderBy(F.unix_date("fl_date"))
    sums = {
        f"{measure}_{days}": F.sum(measure).over(by_key.rangeBetween(-days, -1))
        for days in lengths for measure in MEASURES
    }
    features = []
    for days in lengths:
        flights, completed, delayed, disrupted = [F.col(f"{m}_{days}") for m in MEASURES]
        features += [
            ratio(delayed, completed).alias(f"{level}_delay_rate_{days}d"),
            ratio(disrupted, flights).alias(f"{level}_disruption_rate_{days}d"),
            flights.cast("double").alias(f"{level}_flight_count_{days}d"),
        ]
    known = daily_counts(legs, level).filter(F.col("fl_date").isNotNull())
    return known.withColumns(sums).select("fl_date", *keys, *features)


def history_tables(legs: DataFrame, counts: dict[str, int] | None = None) -> list[FeatureTable]:
    """The five histories, bounded by the distinct days and keys of the stored ``legs``."""
    counts = counts or key_counts(legs, LEG_DAY)
    tables = []
    for level, (keys, _) in schema.HISTORY_LEVELS.items():
        names = ("fl_date", *keys)
        tables.append(FeatureTable(rolling_history(legs, level), names, row_bound(counts, names)))
    return tables


def add_history(flights: DataFrame, history_of: DataFrame | None = None) -> DataFrame:
    """Flights with their 51 history features, one row each.

    The history comes from ``history_of`` (all flights), by default the flights themselves.
    """
    legs = materialize(leg_days(history_of if history_of is not None else flights))
    return attach(flights, history_tables(legs))
