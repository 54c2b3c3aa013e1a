"""Column roles, schemas and constants shared by the whole package."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column names and roles of the source file.
# ---------------------------------------------------------------------------

CAUSE_COLUMNS = (
    "carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay",
)

# Columns kept after validation, in file order, with the role that decides their conversion.
COLUMN_ROLES = {
    "year": "integer", "month": "integer", "day_of_month": "integer", "day_of_week": "integer",
    "fl_date": "date",
    "op_unique_carrier": "text", "op_carrier_fl_num": "integer",
    "origin": "text", "origin_city_name": "text", "origin_state_nm": "text",
    "dest": "text", "dest_city_name": "text", "dest_state_nm": "text",
    "crs_dep_time": "integer", "dep_time": "integer", "dep_delay": "float",
    "taxi_out": "float", "wheels_off": "integer", "wheels_on": "integer", "taxi_in": "float",
    "crs_arr_time": "integer", "arr_time": "integer", "arr_delay": "float",
    "cancelled": "integer", "cancellation_code": "text", "diverted": "integer",
    "crs_elapsed_time": "float", "actual_elapsed_time": "float", "air_time": "float",
    "distance": "float",
}

CLOCK_COLUMNS = ("crs_dep_time", "dep_time", "wheels_off", "wheels_on", "crs_arr_time", "arr_time")

# Columns that may legitimately be empty (the flight did not run, or nothing was cancelled).
OPTIONAL_COLUMNS = (
    "dep_time", "dep_delay", "taxi_out", "wheels_off", "wheels_on", "taxi_in", "arr_time",
    "arr_delay", "cancellation_code", "actual_elapsed_time", "air_time",
)

CORRUPT_COLUMN = "_corrupt_record"

# Variables of the correlation study, and those of them known before departure.
PLANNED_VARIABLES = (
    "month", "day_of_month", "day_of_week", "scheduled_departure_minutes",
    "scheduled_arrival_minutes", "crs_elapsed_time", "distance",
)
STUDY_VARIABLES = PLANNED_VARIABLES + (
    "dep_delay", "taxi_out", "taxi_in", "actual_elapsed_time", "air_time", "arr_delay",
)

# Values observed during or after the flight: a feature built on one of them would leak.
OUTCOME_COLUMNS = frozenset(
    {
        "dep_time", "dep_delay", "taxi_out", "wheels_off", "wheels_on", "taxi_in", "arr_time",
        "arr_delay", "actual_elapsed_time", "air_time", *CAUSE_COLUMNS,
    }
)

# History levels: key columns and look-back lengths in calendar days.
HISTORY_LEVELS = {
    "global": ((), (1, 3, 7, 28)),
    "carrier": (("op_unique_carrier",), (1, 7, 28)),
    "origin": (("origin",), (1, 3, 14, 28)),
    "dest": (("dest",), (1, 3, 14, 28)),
    "route": (("origin", "dest"), (7, 28)),
}

CALENDAR_FEATURES = (
    "day_of_month", "day_of_year", "week_of_year", "is_weekend", "month_sin", "month_cos",
    "day_of_week_sin", "day_of_week_cos", "scheduled_departure_minutes",
    "scheduled_arrival_minutes", "departure_time_sin", "departure_time_cos",
    "arrival_time_sin", "arrival_time_cos", "crs_elapsed_time", "distance",
)
SCHEDULE_FEATURES = (
    "origin_scheduled_departures_hour", "origin_scheduled_departures_3h",
    "dest_scheduled_arrivals_hour", "dest_scheduled_arrivals_3h",
    "route_scheduled_flights_day", "carrier_origin_scheduled_flights_day",
)
CATEGORY_FEATURES = (
    "op_unique_carrier", "flight_number", "origin", "origin_state_nm", "dest", "dest_state_nm",
    "route", "carrier_route", "departure_hour", "arrival_hour", "origin_hour", "dest_hour",
    "month_category", "day_of_week_category",
)
MISSING_CATEGORY = "__missing__"

# Typical-schedule profiles: key columns and the volumes each of them summarises.
SCHEDULE_PROFILES = {
    "origin": (
        ("origin", "month", "day_of_week", "departure_hour"),
        ("origin_scheduled_departures_hour", "origin_scheduled_departures_3h"),
    ),
    "dest": (
        ("dest", "month", "day_of_week", "arrival_hour"),
        ("dest_scheduled_arrivals_hour", "dest_scheduled_arrivals_3h"),
    ),
    "route": (("origin", "dest", "month", "day_of_week"), ("route_scheduled_flights_day",)),
    "carrier_origin": (
        ("op_unique_carrier", "origin", "month", "day_of_week"),
        ("carrier_origin_scheduled_flights_day",),
    ),
}

# Acceptance rules of the delay alert.
MIN_PRECISION = 0.50
MIN_RECALL = 0.20
MIN_COVERAGE = 0.05
MAX_COVERAGE = 0.20
MIN_ALERTS = 500
WILSON_Z = 1.959963984540054
ARTIFACT_VERSION = 6
TARGET_LABEL = "is_delayed"
TARGET_DEFINITION = "completed and arr_delay > 0"

# Deterministic sampling: multiplicative congruence over a key column.
SAMPLE_MODULUS = 1_000_003
SAMPLE_MULTIPLIER = 48_271
DEFAULT_SAMPLE_ROWS = 10_000

# Texts shown to readers of the explorer and of the scoring output.
MONTH_LABELS = (
    "Janvier", "Février", "Mars", "Avril", "Mai", "Juin", "Juillet", "Août", "Septembre",
    "Octobre", "Novembre", "Décembre",
)
STATUS_CANCELLED = "Annulé"
STATUS_DIVERTED = "Dérouté"
STATUS_LATE = "Arrivé en retard"
STATUS_ON_TIME = "À l'heure ou en avance"

# Messages of the gates and of the threshold choice.
GATE_MESSAGES = {
    "minimum_precision_lower_bound_95":
        "La borne basse à 95 % de la précision est inférieure à 50 %.",
    "minimum_recall_lower_bound_95":
        "La borne basse à 95 % du rappel est inférieure à 20 %.",
    "minimum_alert_coverage":
        "Moins de 5 % des vols déclenchent une alerte.",
    "maximum_alert_coverage":
        "Plus de 20% des vols déclenchent une alerte.",
    "minimum_alert_count":
        "Moins de 500 alertes sont disponibles pour valider la fiabilité.",
}
VALIDATION_INFEASIBLE = "Aucun seuil ne respecte toutes les contraintes sur la validation."
TEST_GATE_FAILED = (
    "Les performances hors échantillon ne respectent pas toutes les contraintes métier."
)
MONTHLY_GATE_FAILED = (
    "Les contraintes métier ne sont pas respectées pour chaque mois de test."
)
NO_BUSINESS_VALIDATION = "L'artefact ne contient pas de validation métier exploitable."
MISSING_SCHEDULE = "Les six volumes du planning journalier exact ne sont pas fournis."

FALLBACK_REASONS = {
    "fallback_single_class":
        "La validation ne contient pas les deux classes nécessaires.",
    "fallback_no_threshold":
        "Aucun seuil candidat n'a pu être calculé.",
    "fallback_target_alert_coverage":
        "Aucun seuil ne satisfait simultanément la précision, le rappel et la couverture "
        "attendus. Le seuil de repli cible le centre de la plage métier, soit 12.5% d'alertes "
        "sur la validation.",
    "fallback_closest_target_coverage":
        "La taille de la validation ne permet aucun seuil dans la plage de couverture "
        "attendue. Le seuil de repli s'en approche au mieux.",
}

# ---------------------------------------------------------------------------
# Derived names and schemas.
# ---------------------------------------------------------------------------

PARSED_COLUMNS = tuple(COLUMN_ROLES)
SOURCE_COLUMNS = PARSED_COLUMNS + CAUSE_COLUMNS
TYPED_COLUMNS = tuple(
    name for role in ("integer", "float", "date")
    for name, declared in COLUMN_ROLES.items() if declared == role
)
REQUIRED_COLUMNS = tuple(name for name in PARSED_COLUMNS if name not in OPTIONAL_COLUMNS)


def history_features(level: str) -> list[str]:
    """Names of the three features each look-back of a history level yields."""
    measures = ("delay_rate", "disruption_rate", "flight_count")
    return [f"{level}_{m}_{days}d" for days in HISTORY_LEVELS[level][1] for m in measures]


HISTORY_FEATURES = tuple(name for level in HISTORY_LEVELS for name in history_features(level))
NUMERIC_FEATURES = CALENDAR_FEATURES + SCHEDULE_FEATURES + HISTORY_FEATURES
FEATURES = NUMERIC_FEATURES + CATEGORY_FEATURES


def assert_no_leakage(columns) -> None:
    """Refuse a feature list that names anything observed during or after the flight."""
    leaked = sorted(OUTCOME_COLUMNS.intersection(columns))
    if leaked:
        raise ValueError(f"outcome columns used as features: {', '.join(leaked)}")


def raw_schema() -> T.StructType:
    """All-text schema of the source file, with the column that keeps malformed records."""
    return T.StructType(
        [T.StructField(name, T.StringType()) for name in (*SOURCE_COLUMNS, CORRUPT_COLUMN)]
    )


def request_schema() -> T.StructType:
    """Schema of a future flight to score: fourteen required fields, six optional volumes."""
    text, whole, real = T.StringType(), T.IntegerType(), T.DoubleType()
    fields = {
        "flight_date": text, "month": whole, "day_of_month": whole, "day_of_week": whole,
        "op_unique_carrier": text, "op_carrier_fl_num": whole, "origin": text,
        "origin_state_nm": text, "dest": text, "dest_state_nm": text, "crs_dep_time": whole,
        "crs_arr_time": whole, "crs_elapsed_time": real, "distance": real,
    }
    fields.update({name: real for name in SCHEDULE_FEATURES})
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


REQUEST_FIELDS = tuple(
    name for name in request_schema().names if name not in SCHEDULE_FEATURES
)
