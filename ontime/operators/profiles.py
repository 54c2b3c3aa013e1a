"""Profiles a future flight is completed with: latest history, typical schedule, defaults."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ontime import schema
from ontime.operators.attach import FeatureTable, attach
from ontime.operators.congestion import GRAINS, VOLUMES, volume_table
from ontime.operators.history import rolling_history
from ontime.operators.ranks import exact_quantiles
from ontime.session import materialize, materialize_all

# Columns of the model rows that profiles read, by grain: its keys and what typical schedules add.
FRAME_GRAINS = {
    "legs": [*GRAINS["legs"], "month", "day_of_week"],
    "departures": ["fl_date", *GRAINS["departures"], "month", "day_of_week", "departure_hour"],
    "arrivals": ["fl_date", *GRAINS["arrivals"], "month", "day_of_week", "arrival_hour"],
}


def frame_weights(base: DataFrame, grains: tuple[str, ...] = tuple(FRAME_GRAINS)) -> dict[str, DataFrame]:
    """How many model rows each key of a grain holds, stored; profiles are weighted by it.

    ``base`` carries the slot columns, month, weekday and both hours of every model row.
    """
    return materialize_all({
        grain: base.groupBy(*FRAME_GRAINS[grain]).agg(F.count(F.lit(1)).alias("weight")) for grain in grains
    })


def grains_of(names: tuple[str, ...]) -> tuple[str, ...]:
    """The grains that some schedule profiles need."""
    return tuple(dict.fromkeys(VOLUMES[name][1] for name in names))


def history_states(weights: DataFrame, legs: DataFrame, levels: tuple[str, ...] = tuple(schema.HISTORY_LEVELS)) -> dict[str, DataFrame]:
    """By level, the history of every key on every day with model rows, and how many carry it.

    One row per day and key, stored: defaults and latest values both read it, so that each level
    rolls once.
    """
    rolled = {}
    for level in levels:
        keys, _ = schema.HISTORY_LEVELS[level]
        days = weights.groupBy("fl_date", *keys).agg(F.sum("weight").alias("weight"))
        rolled[level] = days.join(rolling_history(legs, level), ["fl_date", *keys], "left")
    return materialize_all(rolled)


def _medians(long: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Weighted exact median per feature as one wide row; 0 where nothing is known."""
    counts = (
        long.filter(F.col("value").isNotNull()).groupBy("feature", "value")
        .agg(F.sum("weight").alias("n"))
    )
    medians = exact_quantiles(counts, {"median": 0.5}, by=["feature"], interpolate=True)
    return medians.agg(*[
        F.coalesce(F.max(F.when(F.col("feature") == name, F.col("median"))), F.lit(0.0)).alias(name)
        for name in names
    ])


def history_defaults(states: dict[str, DataFrame]) -> DataFrame:
    """Median of each history feature of the given levels over the model rows, in one row.

    Features repeat for all rows of a day and key, so the medians are weighted medians over the
    daily states and the fact table is not touched.
    """
    parts = [
        state.unpivot(["weight"], schema.history_features(level), "feature", "value")
        for level, state in states.items()
    ]
    names = tuple(name for level in states for name in schema.history_features(level))
    return _medians(reduce(DataFrame.unionByName, parts), names)


def history_profile(state: DataFrame, level: str, defaults: DataFrame) -> DataFrame:
    """Latest known features per key of a level, the default where one is unknown.

    The features of the latest day are kept while aggregating; partial results merge before the
    shuffle and nothing is joined.
    """
    keys, _ = schema.HISTORY_LEVELS[level]
    names = schema.history_features(level)
    latest = state.groupBy(*keys).agg(
        F.max("fl_date").alias("profile_date"), F.max_by(F.struct(*names), "fl_date").alias("_latest")
    )
    fallback = _as_scalar(defaults)
    return latest.select(
        *keys, "profile_date",
        *[_or_default(F.col("_latest").getField(name), fallback, name) for name in names],
    )


def weighted_volumes(weights: dict[str, DataFrame], counts: dict[str, DataFrame], name: str) -> DataFrame:
    """The volumes a schedule profile summarises, by day and key, and how many model rows carry them."""
    keys = list(dict.fromkeys(["fl_date", *VOLUMES[name][2], *schema.SCHEDULE_PROFILES[name][0]]))
    held = weights[VOLUMES[name][1]].groupBy(*keys).agg(F.sum("weight").alias("weight"))
    return attach(held, [volume_table(counts, name)])


def schedule_states(
    weights: dict[str, DataFrame], counts: dict[str, DataFrame], names: tuple[str, ...] = tuple(VOLUMES)
) -> dict[str, DataFrame]:
    """The weighted volumes of the profiles, stored: defaults and typical values both read them."""
    return materialize_all({name: weighted_volumes(weights, counts, name) for name in names})


def schedule_defaults(states: dict[str, DataFrame]) -> DataFrame:
    """Median of each planned volume of the given profiles over the model rows, in one row."""
    features = {name: schema.SCHEDULE_PROFILES[name][1] for name in states}
    parts = [
        state.unpivot(["weight"], list(features[name]), "feature", "value") for name, state in states.items()
    ]
    return _medians(reduce(DataFrame.unionByName, parts), tuple(f for own in features.values() for f in own))


def schedule_profile(volumes: DataFrame, name: str, defaults: DataFrame) -> DataFrame:
    """Typical volume per key: median over distinct days and values, each counting once.

    A key combines a month and a weekday (and an hour), so it only ever meets a few days a year
    and the median of a group stays small.
    """
    keys, features = schema.SCHEDULE_PROFILES[name]
    distinct = volumes.select("fl_date", *keys, *features).distinct()
    medians = distinct.groupBy(*keys).agg(*[F.median(f).alias(f) for f in features])
    fallback = _as_scalar(defaults)
    return medians.select(*keys, *[_or_default(F.col(f), fallback, f) for f in features])


def history_profiles(
    weights: dict[str, DataFrame], counts: dict[str, DataFrame], levels: tuple[str, ...] = tuple(schema.HISTORY_LEVELS)
) -> dict[str, DataFrame]:
    """Defaults and latest history of the levels, by table name; defaults cover those levels."""
    states = history_states(weights["legs"], counts["legs"], levels)
    defaults = materialize(history_defaults(states))
    tables = {f"history_{n}": history_profile(state, n, defaults) for n, state in states.items()}
    return {"history_defaults": defaults, **tables}


def schedule_profiles(
    weights: dict[str, DataFrame], counts: dict[str, DataFrame], names: tuple[str, ...] = tuple(schema.SCHEDULE_PROFILES)
) -> dict[str, DataFrame]:
    """Defaults and typical volumes of the profiles, by table name; defaults cover those profiles."""
    states = schedule_states(weights, counts, names)
    defaults = materialize(schedule_defaults(states))
    tables = {f"schedule_{n}": schedule_profile(state, n, defaults) for n, state in states.items()}
    return {"schedule_defaults": defaults, **tables}


def history_cutoff(weights: DataFrame) -> DataFrame:
    """Last day the profiles know about."""
    return weights.agg(F.max("fl_date").alias("history_cutoff_date"))


def _as_scalar(one_row: DataFrame) -> Column:
    return one_row.select(F.struct("*")).scalar()


def _or_default(value: Column, defaults: Column, name: str) -> Column:
    return F.coalesce(value, defaults.getField(name)).alias(name)


class Profiles:
    """All profile tables of a training run, by name; stored, so that they can be counted."""

    def __init__(self, tables: dict[str, DataFrame]):
        self.tables = tables

    @classmethod
    def build(cls, base: DataFrame, counts: dict[str, DataFrame]) -> "Profiles":
        """Profiles of the model rows ``base``, from the stored counts of all flights."""
        weights = frame_weights(base)
        tables = {
            **history_profiles(weights, counts), **schedule_profiles(weights, counts),
            "history_cutoff": history_cutoff(weights["legs"]),
        }
        return cls(materialize_all(tables))

    def _feature_table(self, name: str, keys: tuple[str, ...]) -> FeatureTable:
        table = self.tables[name].drop("profile_date")
        return FeatureTable(table, keys, table.count())

    def complete(self, requests: DataFrame) -> DataFrame:
        """Fill in the volumes (given, else typical, else default) and the latest history.

        ``requests`` carries the six volume columns, possibly null, and both hours. Profiles are
        attached by their keys, those counted small enough being broadcast.
        """
        given = {name: f"_given_{name}" for name in schema.SCHEDULE_FEATURES}
        keyed = [
            (f"schedule_{name}", keys) for name, (keys, _) in schema.SCHEDULE_PROFILES.items()
        ] + [
            (f"history_{level}", keys) for level, (keys, _) in schema.HISTORY_LEVELS.items() if keys
        ]
        data = attach(
            requests.withColumnsRenamed(given),
            [self._feature_table(name, keys) for name, keys in keyed],
        )
        typical = _as_scalar(self.tables["schedule_defaults"])
        usual = _as_scalar(self.tables["history_defaults"])
        latest = _as_scalar(self.tables["history_global"])
        filled = {
            name: F.coalesce(F.col(column), F.col(name), typical.getField(name))
            for name, column in given.items()
        }
        for level, (keys, _) in schema.HISTORY_LEVELS.items():
            for name in schema.history_features(level):
                known = F.col(name) if keys else latest.getField(name)
                filled[name] = F.coalesce(known, usual.getField(name))
        return data.withColumns(filled).drop(*given.values())
