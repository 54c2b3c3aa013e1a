"""Future flights: normalisation, validation, features and the publication decision."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ontime import schema
from ontime.functions import clock, text
from ontime.operators.profiles import Profiles
from ontime.operators.quality import Rule, failed_rules, where_flag
from ontime.plans.dataset import calendar_columns


def from_form(form: DataFrame) -> DataFrame:
    """Requests from typed form fields: a date, two clock times, codes in any case.

    Expects ``flight_date`` (date), ``departure_hour``, ``departure_minute``, ``arrival_hour``,
    ``arrival_minute`` and the remaining request fields.
    """
    day = F.col("flight_date")
    parts = ("departure_hour", "departure_minute", "arrival_hour", "arrival_minute")
    return form.withColumns({
        "month": F.month(day), "day_of_month": F.dayofmonth(day),
        "day_of_week": F.weekday(day) + 1,
        "flight_date": day.cast("string"),
        "crs_dep_time": clock.clock_time(F.col("departure_hour"), F.col("departure_minute")),
        "crs_arr_time": clock.clock_time(F.col("arrival_hour"), F.col("arrival_minute")),
    }).drop(*parts)


STATES_ROWS = 100_000  # airports that a broadcast may hold


def with_states(requests: DataFrame, airport_states: DataFrame) -> DataFrame:
    """Requests with the states of their airports, from ``(airport, state)`` rows.

    An airport that is not listed leaves the state null and is named, as the field of its state, in
    ``unknown_airports``. The list is broadcast where it is small.
    """
    listed = F.broadcast(airport_states) if airport_states.count() <= STATES_ROWS else airport_states
    fields = {"origin": "origin_state_nm", "dest": "dest_state_nm"}
    data = requests.drop(*fields.values())
    for end, field in fields.items():
        states = listed.select(F.col("airport").alias("_airport"), F.col("state").alias(field))
        data = data.join(states, text.code(F.col(end)) == F.col("_airport"), "left").drop("_airport")
    unknown = [F.when(F.col(end).isNotNull() & F.col(field).isNull(), F.lit(field)) for end, field in fields.items()]
    return data.withColumn("unknown_airports", F.array_compact(F.array(*unknown)))


def normalise(requests: DataFrame) -> DataFrame:
    """Upper-case trimmed codes, a parsed date and every optional volume as a column."""
    codes = {n: text.code(F.col(n)) for n in ("op_unique_carrier", "origin", "dest")}
    absent = {
        name: F.lit(None).cast("double")
        for name in schema.SCHEDULE_FEATURES if name not in requests.columns
    }
    day = text.to_date(text.clean_text(F.col("flight_date")))
    return requests.withColumns({**codes, **absent, "request_date": day})


def request_rules() -> list[Rule]:
    """Everything that makes a request unusable; each failure is reported, none raises."""
    col, day = F.col, F.col("request_date")
    rules: list[Rule] = [
        (f"missing_field:{name}", col(name).isNull()) for name in schema.REQUEST_FIELDS
    ]
    rules += [
        (f"empty_code:{name}", col(name) == "") for name in ("op_unique_carrier", "origin", "dest")
    ]
    rules += [
        ("invalid_date", col("flight_date").isNotNull() & day.isNull()),
        (
            "date_month_or_day_mismatch",
            (F.month(day) != col("month")) | (F.dayofmonth(day) != col("day_of_month")),
        ),
        ("date_weekday_mismatch", F.weekday(day) + 1 != col("day_of_week")),
        ("invalid_clock:crs_dep_time", ~clock.is_clock_time(col("crs_dep_time"))),
        ("invalid_clock:crs_arr_time", ~clock.is_clock_time(col("crs_arr_time"))),
        ("non_positive_duration", col("crs_elapsed_time") <= 0),
        ("negative_distance", col("distance") < 0),
        ("invalid_flight_number", col("op_carrier_fl_num") <= 0),
        ("same_airports", col("origin") == col("dest")),
    ]
    rules += [
        (
            f"invalid_volume:{name}",
            F.isnan(name) | (col(name) == float("inf")) | (col(name) < 0),
        )
        for name in schema.SCHEDULE_FEATURES
    ]
    return rules


def validate_requests(requests: DataFrame) -> DataFrame:
    """Normalised requests with ``request_errors`` and ``is_valid_request``."""
    checked = normalise(requests).withColumn("request_errors", failed_rules(request_rules()))
    for column, code, replaced in (
        ("invalid_numbers", "invalid_number", "missing_field"), ("unknown_airports", "unknown_airport", "missing_field"),
    ):
        if column in requests.columns:
            named = lambda prefix, c=column: F.transform(c, lambda n: F.concat(F.lit(f"{prefix}:"), n))
            errors = F.col("request_errors")
            told = F.concat(F.array_except(errors, named(replaced)), named(code))
            checked = checked.withColumn("request_errors", F.when(F.size(column) > 0, told).otherwise(errors))
    return checked.withColumn("is_valid_request", F.size("request_errors") == 0)


def request_features(requests: DataFrame, profiles: Profiles | None) -> DataFrame:
    """Valid requests with the 87 features, by the same expressions as the model frame.

    The columns of the request stay next to the features, except the volumes, which are replaced
    by their completed form. Without profiles, history is missing and so are volumes not given.
    """
    usable = where_flag(validate_requests(requests), "is_valid_request")
    provided = provided_volumes()
    with_hours = usable.withColumns({
        "provided_volumes": provided,
        "departure_hour": clock.hour_of_day(clock.minute_of_day(F.col("crs_dep_time"))),
        "arrival_hour": clock.hour_of_day(clock.minute_of_day(F.col("crs_arr_time"))),
    })
    if profiles is None:
        empty = F.lit(None).cast("double")
        completed = with_hours.withColumns({name: empty for name in schema.HISTORY_FEATURES})
    else:
        completed = profiles.complete(with_hours)
    return completed.withColumns(calendar_columns("request_date")).drop(
        "request_errors", "is_valid_request"
    )


def provided_volumes() -> Column:
    """How many of the six volumes the caller gave."""
    return reduce(
        lambda a, b: a + b, [F.col(n).isNotNull().cast("int") for n in schema.SCHEDULE_FEATURES]
    )


def schedule_context(provided: Column, has_profiles: bool = True) -> Column:
    """Where the volumes of a request come from."""
    source = F.when(provided == len(schema.SCHEDULE_FEATURES), "provided_daily_schedule")
    if has_profiles:
        source = source.when(provided > 0, "typical_schedule_profile_with_overrides")
        return source.otherwise("typical_schedule_profile")
    return source.otherwise("missing")


def publication_decision(
    scored: DataFrame, threshold: Column, ready: Column, violations: Column,
    has_profiles: bool = True, extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Decide per request whether the alert may be published, and say what prevents it.

    ``scored`` carries ``delay_probability`` and ``provided_volumes``; ``threshold``, ``ready``
    and ``violations`` come from the model. An alert is only published when the model is ready
    and the exact schedule was given.
    """
    exact = F.col("provided_volumes") == len(schema.SCHEDULE_FEATURES)
    violations = F.coalesce(violations, F.array(F.lit(schema.NO_BUSINESS_VALIDATION)))
    decided = scored.withColumns({
        "model_business_ready": F.coalesce(ready, F.lit(False)),
        "business_gate_violations": violations,
        "classification_threshold": threshold,
        "schedule_context_source": schedule_context(F.col("provided_volumes"), has_profiles),
        **(extra or {}),
    })
    publishable = F.col("model_business_ready") & exact
    late = F.col("delay_probability") >= F.col("classification_threshold")
    no_schedule = F.when(exact, F.array().cast("array<string>")).otherwise(
        F.array(F.lit(schema.MISSING_SCHEDULE))
    )
    return decided.withColumns({
        "model_business_status": F.when(F.col("model_business_ready"), "ready").otherwise("not_ready"),
        "prediction_publishable": publishable,
        "publication_blockers": F.concat(F.col("business_gate_violations"), no_schedule),
        "prediction_status": F.when(publishable, "publishable")
        .when(~F.col("model_business_ready"), "experimental_model_not_ready")
        .otherwise("experimental_missing_daily_schedule"),
        "published_delay_alert": F.when(publishable, late),
        "diagnostic_is_delayed_prediction": late,
    })


def presentation(decisions: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """What a reader may see: the alert only when publishable, the diagnostic kept apart."""
    shown = F.coalesce(F.col("prediction_publishable"), F.lit(False))
    no_text = F.array().cast("array<string>")
    return decisions.select(
        *keep,
        shown.alias("publishable"),
        F.when(shown, F.col("published_delay_alert")).alias("published_alert"),
        F.coalesce("delay_probability", F.lit(0.0)).alias("diagnostic_probability"),
        F.coalesce("classification_threshold", F.lit(0.5)).alias("diagnostic_threshold"),
        F.coalesce("diagnostic_is_delayed_prediction", F.lit(False)).alias("diagnostic_class"),
        F.coalesce("publication_blockers", no_text).alias("blockers"),
        "historical_context_date",
        F.coalesce("schedule_context_source", F.lit("missing")).alias("schedule_context_source"),
    )
