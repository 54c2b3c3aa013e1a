"""Planned congestion: volumes per airport and hour, per route and day, per carrier and origin."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ontime.functions import clock, outcome
from ontime.operators.attach import FeatureTable, attach, key_counts, row_bound
from ontime.operators.history import LEG_DAY, count_outcomes
from ontime.session import materialize_all

# Columns that place a flight in the schedule: its leg, its day and its scheduled hours.
SLOT = [*LEG_DAY, "departure_slot", "arrival_slot"]
# The grains that volumes and histories are summed from. No two hours meet in one of them: a table
# of legs with both hours has nearly as many rows as there are flights.
GRAINS = {
    "legs": LEG_DAY,
    "departures": ["origin", "departure_slot"],
    "arrivals": ["dest", "arrival_slot"],
}


def with_slots(flights: DataFrame) -> DataFrame:
    """Add the scheduled hours as indexes on one hourly axis, the arrival one on its local day."""
    departure = clock.minute_of_day(F.col("crs_dep_time"))
    arrival = clock.minute_of_day(F.col("crs_arr_time"))
    offset = clock.arrival_day_offset(departure, arrival, F.col("crs_elapsed_time"))
    return flights.withColumns({
        "departure_slot": clock.hour_index(F.col("fl_date"), departure),
        "arrival_slot": clock.hour_index(F.col("fl_date"), arrival, offset),
    })


def grain_counts(flights: DataFrame, grain: str) -> DataFrame:
    """Planned flights at a grain; legs carry the outcome counts too.

    The keys are bounded by days, hours and airports and not by the number of fact rows, so counts
    merge before the shuffle.
    """
    measures = count_outcomes() if grain == "legs" else []
    return with_slots(flights).groupBy(*GRAINS[grain]).agg(
        *measures, F.count_if(outcome.is_planned()).alias("planned")
    )


def stored_counts(flights: DataFrame, grains: tuple[str, ...] = tuple(GRAINS)) -> dict[str, DataFrame]:
    """Counts by grain, stored; each grain reads its own columns of the facts once."""
    return materialize_all({grain: grain_counts(flights, grain) for grain in grains})


def _volume(counts: DataFrame, keys: list[str], name: str) -> DataFrame:
    planned = counts.filter(F.col("planned") > 0)
    return planned.groupBy(*keys).agg(F.sum("planned").cast("double").alias(name))


def hourly_volume(counts: DataFrame, airport: str, slot: str, hour_name: str, near_name: str) -> DataFrame:
    """Planned flights per airport and hour, and over that hour and its two neighbours.

    Hours are consecutive integers, so the neighbourhood is a range frame that crosses midnight
    by itself; an airport has at most one row per hour of the calendar.
    """
    around = Window.partitionBy(airport).orderBy(slot).rangeBetween(-1, 1)
    volume = _volume(counts, [airport, slot], hour_name)
    return volume.withColumn(near_name, F.sum(hour_name).over(around))


def departures_per_hour(departures: DataFrame) -> DataFrame:
    return hourly_volume(
        departures, "origin", "departure_slot",
        "origin_scheduled_departures_hour", "origin_scheduled_departures_3h",
    )


def arrivals_per_hour(arrivals: DataFrame) -> DataFrame:
    return hourly_volume(
        arrivals, "dest", "arrival_slot",
        "dest_scheduled_arrivals_hour", "dest_scheduled_arrivals_3h",
    )


def route_per_day(legs: DataFrame) -> DataFrame:
    return _volume(legs, ["fl_date", "origin", "dest"], "route_scheduled_flights_day")


def carrier_origin_per_day(legs: DataFrame) -> DataFrame:
    return _volume(
        legs, ["fl_date", "op_unique_carrier", "origin"], "carrier_origin_scheduled_flights_day"
    )


# Per schedule table: what builds it, from which grain, and its keys.
VOLUMES = {
    "origin": (departures_per_hour, "departures", ("origin", "departure_slot")),
    "dest": (arrivals_per_hour, "arrivals", ("dest", "arrival_slot")),
    "route": (route_per_day, "legs", ("fl_date", "origin", "dest")),
    "carrier_origin": (carrier_origin_per_day, "legs", ("fl_date", "op_unique_carrier", "origin")),
}


def volume_table(counts: dict[str, DataFrame], name: str, distinct: dict[str, int] | None = None) -> FeatureTable:
    """A volume table; bounded by the rows of its grain, or tighter by the distinct keys given."""
    build, grain, keys = VOLUMES[name]
    bound = counts[grain].count()
    if distinct is not None and distinct.keys() >= set(keys):
        bound = min(bound, row_bound(distinct, keys))
    return FeatureTable(build(counts[grain]), keys, bound)


def schedule_tables(counts: dict[str, DataFrame], distinct: dict[str, int] | None = None) -> list[FeatureTable]:
    """The four volume tables of stored counts."""
    distinct = distinct or key_counts(counts["legs"], LEG_DAY)
    return [volume_table(counts, name, distinct) for name in VOLUMES]


def add_schedule(flights: DataFrame, schedule_of: DataFrame | None = None) -> DataFrame:
    """Flights with their six planned volumes, one row each.

    Volumes come from ``schedule_of`` (all flights), by default the flights themselves.
    """
    counts = stored_counts(schedule_of if schedule_of is not None else flights)
    return attach(with_slots(flights), schedule_tables(counts)).drop(
        "departure_slot", "arrival_slot"
    )
