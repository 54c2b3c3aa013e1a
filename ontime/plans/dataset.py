"""The model frame: calendar, schedule and history features of the completed flights."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ontime import schema
from ontime.functions import clock, outcome, text
from ontime.operators.attach import attach, key_counts
from ontime.operators.congestion import SLOT, schedule_tables, stored_counts, with_slots
from ontime.operators.history import LEG_DAY, history_tables
from ontime.operators.sampling import sample_fraction


def calendar_columns(date: str = "fl_date") -> dict:
    """Calendar, clock and category features, for observed flights and for requests alike."""
    col = F.col
    day = col(date)
    departure = clock.minute_of_day(col("crs_dep_time"))
    arrival = clock.minute_of_day(col("crs_arr_time"))
    departure_hour, arrival_hour = clock.hour_of_day(departure), clock.hour_of_day(arrival)
    month_sin, month_cos = clock.cyclic(col("month") - 1, 12)
    weekday_sin, weekday_cos = clock.cyclic(col("day_of_week") - 1, 7)
    departure_sin, departure_cos = clock.cyclic(departure, 1440)
    arrival_sin, arrival_cos = clock.cyclic(arrival, 1440)
    categories = {
        "op_unique_carrier": col("op_unique_carrier"),
        "flight_number": col("op_carrier_fl_num").cast("bigint"),
        "origin": col("origin"), "origin_state_nm": col("origin_state_nm"),
        "dest": col("dest"), "dest_state_nm": col("dest_state_nm"),
        "route": text.joined_key(col("origin"), col("dest")),
        "carrier_route": text.joined_key(col("op_unique_carrier"), col("origin"), col("dest")),
        "departure_hour": departure_hour, "arrival_hour": arrival_hour,
        "origin_hour": text.joined_key(col("origin"), departure_hour.cast("string")),
        "dest_hour": text.joined_key(col("dest"), arrival_hour.cast("string")),
        "month_category": col("month"), "day_of_week_category": col("day_of_week"),
    }
    return {
        "day_of_month": col("day_of_month"), "day_of_year": F.dayofyear(day),
        "week_of_year": F.weekofyear(day), "is_weekend": (col("day_of_week") >= 6).cast("int"),
        "month_sin": month_sin, "month_cos": month_cos,
        "day_of_week_sin": weekday_sin, "day_of_week_cos": weekday_cos,
        "scheduled_departure_minutes": departure, "scheduled_arrival_minutes": arrival,
        "departure_time_sin": departure_sin, "departure_time_cos": departure_cos,
        "arrival_time_sin": arrival_sin, "arrival_time_cos": arrival_cos,
        "crs_elapsed_time": col("crs_elapsed_time"), "distance": col("distance"),
        **{name: text.category(value) for name, value in categories.items()},
    }


def with_calendar(flights: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The calendar features next to the columns named in ``keep``."""
    features = {k: v for k, v in calendar_columns().items() if k not in keep}
    return flights.select(*keep, *[value.alias(name) for name, value in features.items()])


def model_frame(
    flights: DataFrame, fraction: float = 1.0, seed: int = 42, key: str = "flight_key",
    counts: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Completed flights (a fraction of them if asked) with 87 features and the target.

    Volumes and histories always come from all the flights, cancelled ones included; ``counts``
    may pass their stored counts.
    """
    schema.assert_no_leakage(schema.FEATURES)
    if counts is None:
        counts = stored_counts(flights)
    completed = sample_fraction(flights.filter(outcome.is_completed()), fraction, seed, key)
    base = with_slots(completed).withColumn(schema.TARGET_LABEL, outcome.is_delayed().cast("int"))
    slim = base.select(
        key, *SLOT, schema.TARGET_LABEL, "month", "day_of_month", "day_of_week",
        "op_carrier_fl_num", "origin_state_nm", "dest_state_nm", "crs_dep_time", "crs_arr_time",
        "crs_elapsed_time", "distance",
    )
    distinct = key_counts(counts["legs"], LEG_DAY)
    joined = attach(
        slim, schedule_tables(counts, distinct) + history_tables(counts["legs"], distinct),
        grain=counts["legs"].select(*LEG_DAY),
    )
    return joined.select(
        key, F.col("fl_date").alias("flight_date"), "month",
        *[value.alias(name) for name, value in calendar_columns().items()
          if name in schema.CALENDAR_FEATURES],
        *schema.SCHEDULE_FEATURES, *schema.HISTORY_FEATURES,
        *[value.alias(name) for name, value in calendar_columns().items()
          if name in schema.CATEGORY_FEATURES],
        schema.TARGET_LABEL,
    )
