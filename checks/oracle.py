"""The SQL each registered query is compared with, written as plainly as SQL allows.

Windows are single ones, three-hour sums are self-joins and joins go from each flight to each
feature table: none of the tricks of the Spark side are used here.
"""

from __future__ import annotations

from checks import binding
from checks.registry import EXACT_SAMPLE, EXPLORED, LARGE_SAMPLE, SAMPLE
from ontime import schema
from ontime.sources import snapshot

MINUTES = "(({0} // 100) * 60 + {0} % 100) % 1440"
DEP, ARR = MINUTES.format("crs_dep_time"), MINUTES.format("crs_arr_time")

FLIGHTS = f"flights AS ({binding.FLIGHTS_SQL})"
FLAGS = """facts AS (
  SELECT *, (cancelled = 0 AND diverted = 0 AND arr_delay IS NOT NULL) AS completed,
         COALESCE(cancelled = 0 AND diverted = 0 AND arr_delay > 0, FALSE) AS delayed,
         (cancelled = 1 OR diverted = 1 OR COALESCE(arr_delay > 0, FALSE)) AS disrupted
  FROM flights)"""
BASE = [FLIGHTS, FLAGS]


def sql(*parts: str) -> str:
    """CTEs followed by the final select."""
    return f"WITH {', '.join(parts[:-1])} {parts[-1]}"


def r6(expression: str, digits: int = 6) -> str:
    return f"ROUND({expression}, {digits}) + 0.0"


def pct(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / NULLIF({whole}, 0) * 100"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


# --- descriptive -----------------------------------------------------------

N_DONE, N_LATE = "COUNT(*) FILTER (completed)", "COUNT(*) FILTER (delayed)"
N_CANCELLED = "COUNT(*) FILTER (cancelled = 1)"
MEAN_ARR, MEAN_DEP = "AVG(arr_delay) FILTER (completed)", "AVG(dep_delay)"


def overview() -> str:
    q = "quantile_disc(arr_delay, {}) FILTER (completed)"
    return sql(*BASE, f"""
      SELECT COUNT(*) AS flight_count, {N_DONE} AS completed_flight_count,
        {N_LATE} AS delayed_flight_count, {N_CANCELLED} AS cancelled_flight_count,
        COUNT(*) FILTER (diverted = 1) AS diverted_flight_count,
        {MEAN_ARR} AS average_arrival_delay_minutes,
        {q.format(0.5)} AS median_arrival_delay_minutes, {q.format(0.9)} AS p90_arrival_delay_minutes,
        MAX(arr_delay) FILTER (completed) AS maximum_arrival_delay_minutes,
        {MEAN_DEP} AS average_departure_delay_minutes,
        {pct(N_LATE, N_DONE)} AS delayed_flight_percentage,
        {pct(N_CANCELLED, 'COUNT(*)')} AS cancelled_flight_percentage,
        {pct('COUNT(*) FILTER (diverted = 1)', 'COUNT(*)')} AS diverted_flight_percentage
      FROM facts""")


def punctuality(dimension: str) -> str:
    return sql(*BASE, f"""
      SELECT {dimension}, COUNT(*) AS flight_count, {N_DONE} AS completed_flight_count,
        {N_LATE} AS delayed_flight_count, {N_CANCELLED} AS cancelled_flight_count,
        {MEAN_ARR} AS average_arrival_delay_minutes, {MEAN_DEP} AS average_departure_delay_minutes,
        {pct(N_LATE, N_DONE)} AS delayed_flight_percentage,
        {pct(N_CANCELLED, 'COUNT(*)')} AS cancelled_flight_percentage
      FROM facts GROUP BY {dimension}""")


def status_distribution() -> str:
    return sql(*BASE, f"""
      SELECT CASE WHEN cancelled = 1 THEN 'cancelled' WHEN diverted = 1 THEN 'diverted'
                  WHEN arr_delay IS NULL THEN 'unknown' WHEN arr_delay > 0 THEN 'delayed'
                  ELSE 'on_time' END AS flight_status,
             COUNT(*) AS flight_count,
             {pct('COUNT(*)', '(SELECT COUNT(*) FROM facts)')} AS flight_percentage
      FROM facts GROUP BY 1""")


FLIGHT_COLUMNS = (
    "flight_key year month day_of_month day_of_week fl_date op_unique_carrier op_carrier_fl_num "
    "origin origin_state_nm dest dest_state_nm crs_dep_time crs_arr_time crs_elapsed_time distance "
    "dep_delay taxi_out taxi_in actual_elapsed_time air_time arr_delay cancelled "
    "cancellation_code diverted score"
).split()


def missing_values() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", COUNT(*) FILTER ({name} IS NULL) AS missing_count, "
        f"{pct(f'COUNT(*) FILTER ({name} IS NULL)', 'COUNT(*)')} AS missing_percentage FROM flights"
        for name in FLIGHT_COLUMNS
    )
    return sql(FLIGHTS, rows)


def study(completed: bool) -> str:
    columns = ", ".join(
        f"CAST({ {'scheduled_departure_minutes': DEP, 'scheduled_arrival_minutes': ARR}.get(n, n)} AS DOUBLE) AS {n}"
        for n in schema.STUDY_VARIABLES
    )
    where = ""
    if completed:
        where = "WHERE completed AND " + " AND ".join(
            f"{n} IS NOT NULL" for n in schema.STUDY_VARIABLES if "scheduled_" not in n
        ) + " AND crs_dep_time IS NOT NULL AND crs_arr_time IS NOT NULL"
    return f"study AS (SELECT {columns} FROM facts {where})"


def numeric_summary() -> str:
    rows = " UNION ALL ".join(
        f"""SELECT '{n}' AS variable, COUNT({n}) AS count, {r6(f'AVG({n})')} AS mean,
        {r6(f'STDDEV_SAMP({n})')} AS stddev, MIN({n}) AS min, quantile_disc({n}, 0.25) AS q25,
        quantile_disc({n}, 0.5) AS q50, quantile_disc({n}, 0.75) AS q75, MAX({n}) AS max FROM study"""
        for n in schema.STUDY_VARIABLES
    )
    return sql(*BASE, study(False), rows)


def _corr(x: str, y: str) -> str:
    return (
        f"CASE WHEN MIN({x}) < MAX({x}) AND MIN({y}) < MAX({y}) THEN {r6(f'CORR({x}, {y})')} END"
    )


def correlation_matrix() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{x}' AS variable_x, '{y}' AS variable_y, {_corr(x, y)} AS correlation FROM study"
        for x in schema.STUDY_VARIABLES for y in schema.STUDY_VARIABLES
    )
    return sql(*BASE, study(True), rows)


def correlation_with_delay(limit: int | None = None) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{x}' AS variable, {_corr(x, 'arr_delay')} AS correlation, "
        f"ABS({_corr(x, 'arr_delay')}) AS absolute_correlation, "
        f"{x in schema.PLANNED_VARIABLES} AS available_before_departure FROM study"
        for x in schema.STUDY_VARIABLES if x != "arr_delay"
    )
    top = f"ORDER BY absolute_correlation DESC NULLS LAST, variable LIMIT {limit}" if limit else ""
    return sql(*BASE, study(True), f"SELECT * FROM ({rows}) {top}")


# --- validation ------------------------------------------------------------

RAW = [FLIGHTS, f"raw_flights AS ({binding.RAW_SQL})"]


def _typed(name: str) -> str:
    text = f"NULLIF(TRIM({name}), '')"
    role = schema.COLUMN_ROLES[name]
    if role == "integer":
        return (f"CASE WHEN regexp_full_match({text}, '[+-]?[0-9]+(\\.0+)?') "
                f"THEN TRY_CAST(TRY_CAST({text} AS DOUBLE) AS INTEGER) END")
    if role == "float":
        return (f"CASE WHEN regexp_full_match({text}, '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
                f"THEN TRY_CAST({text} AS DOUBLE) END")
    if role == "date":
        return (f"CASE WHEN regexp_full_match({text}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
                f"THEN TRY_CAST({text} AS DATE) END")
    return text


def _rules() -> list[tuple[str, str]]:
    rules = [(f"invalid_format:{n}", f"NULLIF(TRIM(r_{n}), '') IS NOT NULL AND {n} IS NULL")
             for n in schema.TYPED_COLUMNS]
    rules += [(f"missing_required_value:{n}", f"{n} IS NULL") for n in schema.REQUIRED_COLUMNS]
    rules += [
        ("invalid_range:month", "month NOT BETWEEN 1 AND 12"),
        ("invalid_range:day_of_week", "day_of_week NOT BETWEEN 1 AND 7"),
        ("inconsistent_date", "year <> year(fl_date) OR month <> month(fl_date) OR day_of_month <> day(fl_date)"),
        ("invalid_flight_number", "op_carrier_fl_num <= 0"),
        ("negative_distance", "distance < 0"),
        ("non_positive_scheduled_duration", "crs_elapsed_time <= 0"),
        ("invalid_flag:cancelled", "cancelled NOT IN (0, 1)"),
        ("invalid_flag:diverted", "diverted NOT IN (0, 1)"),
        ("missing_cancellation_code", "cancelled = 1 AND cancellation_code IS NULL"),
        ("invalid_cancellation_code", "cancellation_code NOT IN ('A', 'B', 'C', 'D')"),
    ]
    rules += [(f"invalid_range:{n}", f"NOT ({n} = 2400 OR ({n} BETWEEN 0 AND 2359 AND {n} % 100 < 60))")
              for n in schema.CLOCK_COLUMNS]
    return rules


def validated() -> list[str]:
    typed = ", ".join(f"{_typed(n)} AS {n}, {n} AS r_{n}" for n in schema.PARSED_COLUMNS)
    codes = ", ".join(f"CASE WHEN {condition} THEN '{code}' END" for code, condition in _rules())
    return RAW + [
        f"typed AS (SELECT flight_key, {typed} FROM raw_flights)",
        f"""validated AS (SELECT flight_key, {', '.join(schema.PARSED_COLUMNS)},
          list_filter([{codes}], lambda x: x IS NOT NULL) AS errors,
          CAST({DEP} AS INTEGER) AS scheduled_departure_minutes,
          CAST({ARR} AS INTEGER) AS scheduled_arrival_minutes FROM typed)""",
    ]


CLEAN_COLUMNS = ", ".join(
    ["flight_key", *schema.PARSED_COLUMNS, "scheduled_departure_minutes", "scheduled_arrival_minutes"]
)


def csv_corrupt_rows() -> str:
    damaged = "(flight_key % 211 = 0 OR flight_key % 223 = 0 OR flight_key % 227 = 0)"
    return sql(*validated(), f"""
      SELECT {damaged} AS is_corrupt, COUNT(*) AS rows,
             COUNT(*) FILTER (len(errors) = 0 AND NOT {damaged}) AS valid_rows
      FROM validated GROUP BY 1""")


# --- features --------------------------------------------------------------

PI2 = "(2 * pi())"
CALENDAR = {
    "day_of_month": "day_of_month", "day_of_year": "CAST(dayofyear(fl_date) AS INTEGER)",
    "week_of_year": "CAST(weekofyear(fl_date) AS INTEGER)",
    "is_weekend": "CAST(day_of_week >= 6 AS INTEGER)",
    "month_sin": r6(f"sin({PI2} * (month - 1) / 12)"), "month_cos": r6(f"cos({PI2} * (month - 1) / 12)"),
    "day_of_week_sin": r6(f"sin({PI2} * (day_of_week - 1) / 7)"),
    "day_of_week_cos": r6(f"cos({PI2} * (day_of_week - 1) / 7)"),
    "scheduled_departure_minutes": f"CAST({DEP} AS INTEGER)",
    "scheduled_arrival_minutes": f"CAST({ARR} AS INTEGER)",
    "departure_time_sin": r6(f"sin({PI2} * ({DEP}) / 1440)"), "departure_time_cos": r6(f"cos({PI2} * ({DEP}) / 1440)"),
    "arrival_time_sin": r6(f"sin({PI2} * ({ARR}) / 1440)"), "arrival_time_cos": r6(f"cos({PI2} * ({ARR}) / 1440)"),
    "crs_elapsed_time": "crs_elapsed_time", "distance": "distance",
}
H_DEP, H_ARR = f"CAST(({DEP}) // 60 AS VARCHAR)", f"CAST(({ARR}) // 60 AS VARCHAR)"
CATEGORIES = {
    "op_unique_carrier": "op_unique_carrier", "flight_number": "CAST(op_carrier_fl_num AS VARCHAR)",
    "origin": "origin", "origin_state_nm": "origin_state_nm", "dest": "dest",
    "dest_state_nm": "dest_state_nm", "route": "origin || '-' || dest",
    "carrier_route": "op_unique_carrier || '-' || origin || '-' || dest",
    "departure_hour": H_DEP, "arrival_hour": H_ARR, "origin_hour": f"origin || '-' || {H_DEP}",
    "dest_hour": f"dest || '-' || {H_ARR}", "month_category": "CAST(month AS VARCHAR)",
    "day_of_week_category": "CAST(day_of_week AS VARCHAR)",
}
CATEGORIES = {k: f"COALESCE({v}, '{schema.MISSING_CATEGORY}')" for k, v in CATEGORIES.items()}


def listed(columns: dict[str, str], skip=()) -> str:
    return ", ".join(f"{value} AS {name}" for name, value in columns.items() if name not in skip)


SHIFT = f"(CAST({ARR} AS DOUBLE) - {DEP} - crs_elapsed_time)"
OFFSET = f"CASE WHEN {SHIFT} < -720 THEN 1 WHEN {SHIFT} > 720 THEN -1 ELSE 0 END"
DAYS = "(fl_date - DATE '1970-01-01')"
SLOTS = {
    "departure_slot": f"CAST({DAYS} * 24 + ({DEP}) // 60 AS BIGINT)",
    "arrival_slot": f"CAST(({DAYS} + {OFFSET}) * 24 + ({ARR}) // 60 AS BIGINT)",
}
SLOTTED = f"""slotted AS (SELECT *, {listed(SLOTS)}, CAST(({DEP}) // 60 AS INTEGER) AS departure_hour,
  CAST(({ARR}) // 60 AS INTEGER) AS arrival_hour FROM facts)"""
PLANNED = """planned AS (SELECT * FROM slotted WHERE fl_date IS NOT NULL AND op_unique_carrier IS NOT NULL
  AND origin IS NOT NULL AND dest IS NOT NULL AND crs_dep_time IS NOT NULL
  AND crs_arr_time IS NOT NULL AND crs_elapsed_time > 0)"""


def hourly(airport: str, slot: str, hour_name: str, near_name: str) -> list[str]:
    return [
        f"h_{airport} AS (SELECT {airport}, {slot}, CAST(COUNT(*) AS DOUBLE) AS n FROM planned GROUP BY ALL)",
        f"""v_{airport} AS (SELECT a.{airport}, a.{slot}, ANY_VALUE(a.n) AS {hour_name}, SUM(b.n) AS {near_name}
          FROM h_{airport} a JOIN h_{airport} b
            ON a.{airport} = b.{airport} AND b.{slot} BETWEEN a.{slot} - 1 AND a.{slot} + 1
          GROUP BY a.{airport}, a.{slot})""",
    ]


SCHEDULE = [
    SLOTTED, PLANNED,
    *hourly("origin", "departure_slot", *schema.SCHEDULE_FEATURES[:2]),
    *hourly("dest", "arrival_slot", *schema.SCHEDULE_FEATURES[2:4]),
    "v_route AS (SELECT fl_date, origin, dest, CAST(COUNT(*) AS DOUBLE) AS route_scheduled_flights_day FROM planned GROUP BY ALL)",
    "v_carrier AS (SELECT fl_date, op_unique_carrier, origin, CAST(COUNT(*) AS DOUBLE) AS carrier_origin_scheduled_flights_day FROM planned GROUP BY ALL)",
]
SCHEDULE_JOINS = """LEFT JOIN v_origin USING (origin, departure_slot)
  LEFT JOIN v_dest USING (dest, arrival_slot) LEFT JOIN v_route USING (fl_date, origin, dest)
  LEFT JOIN v_carrier USING (fl_date, op_unique_carrier, origin)"""


def daily(level: str) -> str:
    keys = "".join(f", {k}" for k in schema.HISTORY_LEVELS[level][0])
    return f"""d_{level} AS (SELECT fl_date{keys}, COUNT(*) AS flights, {N_DONE} AS completed,
      {N_LATE} AS delayed, COUNT(*) FILTER (disrupted) AS disrupted FROM facts GROUP BY fl_date{keys})"""


def rolled(level: str) -> list[str]:
    keys, lengths = schema.HISTORY_LEVELS[level]
    by = f"PARTITION BY {', '.join(keys)}" if keys else ""
    windows = ", ".join(
        f"w{n} AS ({by} ORDER BY fl_date RANGE BETWEEN INTERVAL {n} DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)"
        for n in lengths
    )
    features = ", ".join(
        f"""CAST(SUM(delayed) OVER w{n} AS DOUBLE) / NULLIF(SUM(completed) OVER w{n}, 0) AS {level}_delay_rate_{n}d,
        CAST(SUM(disrupted) OVER w{n} AS DOUBLE) / NULLIF(SUM(flights) OVER w{n}, 0) AS {level}_disruption_rate_{n}d,
        CAST(SUM(flights) OVER w{n} AS DOUBLE) AS {level}_flight_count_{n}d"""
        for n in lengths
    )
    named = "".join(f", {k}" for k in keys)
    return [daily(level), f"r_{level} AS (SELECT fl_date{named}, {features} FROM d_{level} WINDOW {windows})"]


HISTORY = [part for level in schema.HISTORY_LEVELS for part in rolled(level)]
HISTORY_JOINS = " ".join(
    f"LEFT JOIN r_{level} USING ({', '.join(('fl_date', *keys))})"
    for level, (keys, _) in schema.HISTORY_LEVELS.items()
)
LEG = "flight_key, fl_date, op_unique_carrier, origin, dest"
ALL_SCHEDULE, ALL_HISTORY = ", ".join(schema.SCHEDULE_FEATURES), ", ".join(schema.HISTORY_FEATURES)

FRAME = [
    *BASE, *SCHEDULE, *HISTORY,
    f"""frame AS (SELECT * FROM (SELECT * FROM slotted WHERE completed) {SCHEDULE_JOINS} {HISTORY_JOINS})""",
]


def model_frame() -> str:
    return sql(*FRAME, f"""
      SELECT flight_key, fl_date AS flight_date, month, {listed(CALENDAR)}, {ALL_SCHEDULE}, {ALL_HISTORY},
             {listed(CATEGORIES)}, CAST(delayed AS INTEGER) AS is_delayed FROM frame""")


def daily_history_counts() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{level}' AS level, fl_date, "
        + ", ".join(f"{k if k in keys else 'CAST(NULL AS VARCHAR)'} AS {k}" for k in ("op_unique_carrier", "origin", "dest"))
        + f", flights, completed, delayed, disrupted FROM d_{level}"
        for level, (keys, _) in schema.HISTORY_LEVELS.items()
    )
    return sql(*BASE, *[daily(level) for level in schema.HISTORY_LEVELS], rows)


def exact_sample(size: int) -> str:
    key = SAMPLE_KEY.replace("flight_key", "row_key")
    return sql(FLIGHTS, f"SELECT * FROM flights ORDER BY {key}, row_key LIMIT {size}")


SAMPLE_KEY = f"((flight_key % {schema.SAMPLE_MODULUS}) * {schema.SAMPLE_MULTIPLIER} + 42) % {schema.SAMPLE_MODULUS}"
SPLIT = """CASE WHEN month <= 7 THEN 'train' WHEN month = 8 THEN 'tuning'
  WHEN month <= 10 THEN 'validation' ELSE 'test' END"""


def split_summary() -> str:
    figures = """COUNT(*) AS row_count, COUNT(*) FILTER (delayed) AS delayed_count,
      CAST(COUNT(*) FILTER (delayed) AS DOUBLE) / COUNT(*) * 100 AS delayed_percentage,
      MIN(month) AS month_min, MAX(month) AS month_max FROM facts WHERE completed"""
    return sql(*BASE, f"""SELECT {SPLIT} AS split, {figures} GROUP BY 1
      UNION ALL SELECT 'all' AS split, {figures}""")


# --- profiles and requests -------------------------------------------------


def defaults(names, digits: int | None = 6) -> str:
    wrap = r6 if digits else (lambda e: e)
    return ", ".join(f"{wrap(f'COALESCE(median({n}), 0)')} AS {n}" for n in names)


DEFAULTS = [
    f"hdef AS (SELECT {', '.join(f'COALESCE(median({n}), 0) AS {n}' for n in schema.HISTORY_FEATURES)} FROM frame)",
    f"sdef AS (SELECT {', '.join(f'COALESCE(median({n}), 0) AS {n}' for n in schema.SCHEDULE_FEATURES)} FROM frame)",
]


def history_profile(level: str, rounding: bool = True) -> str:
    keys, _ = schema.HISTORY_LEVELS[level]
    named = "".join(f"f.{k}, " for k in keys)
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    same = " AND ".join(["f.fl_date = l.fl_date"] + [f"f.{k} IS NOT DISTINCT FROM l.{k}" for k in keys])
    wrap = r6 if rounding else (lambda e: e)
    values = ", ".join(
        f"{wrap(f'COALESCE(f.{n}, hdef.{n})')} AS {n}" for n in schema.history_features(level)
    )
    plain = "".join(f"{k}, " for k in keys)
    return f"""SELECT DISTINCT {named} f.fl_date AS profile_date, {values} FROM frame f
      JOIN (SELECT {plain} MAX(fl_date) AS fl_date FROM frame {group}) l ON {same}, hdef"""


def schedule_profile(name: str) -> str:
    keys, features = schema.SCHEDULE_PROFILES[name]
    joined = ", ".join(keys)
    values = ", ".join(f"COALESCE(median(u.{f}), ANY_VALUE(sdef.{f})) AS {f}" for f in features)
    return f"""SELECT {', '.join('u.' + k for k in keys)}, {values}
      FROM (SELECT DISTINCT fl_date, {joined}, {', '.join(features)} FROM frame) u, sdef
      GROUP BY {', '.join('u.' + k for k in keys)}"""


PROFILES = [
    *[f"hp_{level} AS ({history_profile(level, False)})" for level in schema.HISTORY_LEVELS],
    *[f"sp_{name} AS ({schedule_profile(name)})" for name in schema.SCHEDULE_PROFILES],
]

CODES = ("op_unique_carrier", "origin", "dest")
REQUESTS = f"""requests AS (SELECT * REPLACE (UPPER(TRIM(op_unique_carrier)) AS op_unique_carrier,
  UPPER(TRIM(origin)) AS origin, UPPER(TRIM(dest)) AS dest), CAST(flight_date AS DATE) AS fl_date,
  {' + '.join(f'CASE WHEN {n} IS NULL THEN 0 ELSE 1 END' for n in schema.SCHEDULE_FEATURES)} AS provided
  FROM ({binding.REQUESTS_SQL}))"""


# Numbers that cannot be read: 12.5 and text.
REQUESTS_SPELT = REQUESTS.replace("requests AS (", "given AS (", 1) + """, requests AS (
  SELECT * REPLACE (CASE WHEN flight_key % 10 IN (2, 3) THEN NULL ELSE op_carrier_fl_num END AS op_carrier_fl_num),
         flight_key % 10 IN (2, 3) AS unread FROM given)"""


def _request_rules() -> list[tuple[str, str]]:
    clock = "NOT ({0} = 2400 OR ({0} BETWEEN 0 AND 2359 AND {0} % 100 < 60))"
    rules = [(f"missing_field:{n}", f"{n} IS NULL") for n in schema.REQUEST_FIELDS]
    rules += [(f"empty_code:{n}", f"{n} = ''") for n in CODES]
    rules += [
        ("invalid_date", "flight_date IS NOT NULL AND TRY_CAST(flight_date AS DATE) IS NULL"),
        ("date_month_or_day_mismatch", "month(fl_date) <> month OR day(fl_date) <> day_of_month"),
        ("date_weekday_mismatch", "isodow(fl_date) <> day_of_week"),
        ("invalid_clock:crs_dep_time", clock.format("crs_dep_time")),
        ("invalid_clock:crs_arr_time", clock.format("crs_arr_time")),
        ("non_positive_duration", "crs_elapsed_time <= 0"),
        ("negative_distance", "distance < 0"),
        ("invalid_flight_number", "op_carrier_fl_num <= 0"),
        ("same_airports", "origin = dest"),
    ]
    return rules + [(f"invalid_volume:{n}", f"{n} < 0") for n in schema.SCHEDULE_FEATURES]


CHECKED = "checked AS (SELECT *, list_filter([{}], lambda x: x IS NOT NULL) AS errors FROM requests)".format(
    ", ".join(f"CASE WHEN {c} THEN '{code}' END" for code, c in _request_rules())
)


def request_features() -> str:
    volumes = ", ".join(
        f"COALESCE(q.{n}, p_{name}.{n}, sdef.{n}) AS {n}"
        for name, (_, features) in schema.SCHEDULE_PROFILES.items() for n in features
    )
    rates = ", ".join(
        f"{r6(f'COALESCE(h_{level}.{n}, hdef.{n})')} AS {n}"
        for level in schema.HISTORY_LEVELS for n in schema.history_features(level)
    )
    joins = "".join(
        f" LEFT JOIN sp_{name} p_{name} ON " + " AND ".join(f"q.{k} = p_{name}.{k}" for k in keys)
        for name, (keys, _) in schema.SCHEDULE_PROFILES.items()
    ) + "".join(
        f" LEFT JOIN hp_{level} h_{level} ON " + (" AND ".join(f"q.{k} = h_{level}.{k}" for k in keys) or "TRUE")
        for level, (keys, _) in schema.HISTORY_LEVELS.items()
    )
    own = listed({f'"{k}"': f"q.{k}" for k in CALENDAR} | {f'"{k}"': f"q.c_{k}" for k in CATEGORIES})
    prepared = f"""prepared AS (SELECT * EXCLUDE ({', '.join(CALENDAR_ONLY)}), {listed(CALENDAR)},
      {', '.join(f'{v} AS c_{k}' for k, v in CATEGORIES.items())},
      CAST(({DEP}) // 60 AS INTEGER) AS departure_hour, CAST(({ARR}) // 60 AS INTEGER) AS arrival_hour
      FROM checked WHERE len(errors) = 0)"""
    return sql(*FRAME, *DEFAULTS, *PROFILES, REQUESTS, CHECKED, prepared,
               f"SELECT q.flight_key, q.flight_date, {own}, {volumes}, {rates} FROM prepared q{joins}, hdef, sdef")


CALENDAR_ONLY = ("day_of_month", "crs_elapsed_time", "distance")


# --- evaluation ------------------------------------------------------------

SCORED = f"""scored AS (SELECT flight_key, month, {SPLIT} AS split, CAST(delayed AS INTEGER) AS label,
  score FROM facts WHERE completed)"""
WEAK = SCORED.replace("score FROM", f"{binding.WEAK_SCORE_SQL} AS score FROM")
CURVE = """points AS (SELECT split, score AS threshold, COUNT(*) AS a, COUNT(*) FILTER (label = 1) AS p
    FROM scored GROUP BY ALL),
  summed AS (SELECT *, CAST(SUM(a) OVER down AS BIGINT) AS alert_count,
    CAST(SUM(p) OVER down AS BIGINT) AS true_positive_count,
    CAST(SUM(a) OVER (PARTITION BY split) AS BIGINT) AS sample_count,
    CAST(SUM(p) OVER (PARTITION BY split) AS BIGINT) AS positive_count
    FROM points WINDOW down AS (PARTITION BY split ORDER BY threshold DESC)),
  curve AS (SELECT *, CAST(true_positive_count AS DOUBLE) / alert_count AS precision,
    CAST(true_positive_count AS DOUBLE) / NULLIF(positive_count, 0) AS recall,
    CAST(alert_count AS DOUBLE) / sample_count AS alert_coverage FROM summed)"""
Z = "1.959963984540054e0"


def wilson(successes: str, total: str) -> tuple[str, str]:
    n = f"CAST({total} AS DOUBLE)"
    share = f"(CAST({successes} AS DOUBLE) / NULLIF({total}, 0))"
    spread = f"{Z} * sqrt({share} * (1 - {share}) / {n} + {Z} * {Z} / (4 * {n} * {n}))"
    middle, scale = f"({share} + {Z} * {Z} / (2 * {n}))", f"(1 + {Z} * {Z} / {n})"
    return (
        f"CASE WHEN {total} > 0 THEN GREATEST(({middle} - {spread}) / {scale}, 0e0) ELSE 0e0 END",
        f"CASE WHEN {total} > 0 THEN LEAST(({middle} + {spread}) / {scale}, 1e0) ELSE 1e0 END",
    )


F1_OF_CURVE = "CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END"
CHOICE = [
    f"""best_f1 AS (SELECT LEAST(GREATEST(threshold, 1e-3), 999e-3) AS f1_threshold, {F1_OF_CURVE} AS best_f1
      FROM curve WHERE split = 'validation' ORDER BY {F1_OF_CURVE} DESC, threshold LIMIT 1)""",
    f"""bounded AS (SELECT *, {wilson('true_positive_count', 'alert_count')[0]} AS pl,
      {wilson('true_positive_count', 'positive_count')[0]} AS rl, ABS(alert_coverage - 125e-3) AS distance
      FROM curve WHERE split = 'validation')""",
    """tiered AS (SELECT *, CASE WHEN pl >= 5e-1 AND rl >= 2e-1 AND alert_coverage BETWEEN 5e-2 AND 2e-1
        AND alert_count >= 500 THEN 1 WHEN alert_coverage BETWEEN 5e-2 AND 2e-1 THEN 2 ELSE 3 END AS tier FROM bounded)""",
    """chosen AS (SELECT *, LEAST(GREATEST(threshold, 1e-3), 999e-3) AS picked FROM tiered
      ORDER BY tier, CASE WHEN tier = 1 THEN -recall ELSE distance END, precision DESC,
        CASE WHEN tier = 1 THEN distance ELSE -recall END, threshold DESC LIMIT 1)""",
]


def _reason() -> str:
    cases = " ".join(
        f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in schema.FALLBACK_REASONS.items()
    )
    return f"CASE strategy {cases} END"


def business_threshold(scores: str = SCORED) -> str:
    return sql(*BASE, scores, CURVE, *CHOICE, f"""
      SELECT *, {_reason()} AS fallback_reason FROM (
      SELECT picked AS threshold, CASE tier WHEN 1 THEN 'business_constraints'
          WHEN 2 THEN 'fallback_target_alert_coverage' ELSE 'fallback_closest_target_coverage' END AS strategy,
        tier = 1 AS feasible_on_validation, f1_threshold,
        precision AS candidate_validation_precision, recall AS candidate_validation_recall,
        alert_coverage AS candidate_validation_alert_coverage,
        alert_count AS candidate_validation_alert_count,
        {r6('pl')} AS candidate_validation_precision_lower_bound_95,
        {r6('rl')} AS candidate_validation_recall_lower_bound_95
      FROM chosen, best_f1)""")


EVAL = [*BASE, SCORED, CURVE, *CHOICE]


def measured(name: str, source: str, by: str, threshold: str) -> list[str]:
    p = "GREATEST(LEAST(score, 1 - 1e-7), 1e-7)"
    counted = f"""c_{name} AS (SELECT {by}, COUNT(*) AS n, COUNT(*) FILTER (label = 1) AS pos,
        COUNT(*) FILTER (score >= {threshold}) AS al, COUNT(*) FILTER (label = 1 AND score >= {threshold}) AS tp,
        MAX({threshold}) AS threshold, AVG(-CASE WHEN label = 1 THEN ln({p}) ELSE ln(1 - {p}) END) AS ll,
        AVG(({p} - label) * ({p} - label)) AS bs FROM {source} GROUP BY ALL)"""
    pl, pu = wilson("tp", "al")
    rl, ru = wilson("tp", "pos")
    rated = f"""{name} AS (SELECT {by}, n AS sample_count, pos AS positive_count, {pct('pos', 'n')} AS positive_percentage,
        al AS predicted_positive_count, {pct('al', 'n')} AS predicted_positive_percentage,
        al AS alert_count, CAST(al AS DOUBLE) / n AS alert_coverage, {pct('al', 'n')} AS alert_coverage_percentage,
        threshold, CAST(n - al - pos + 2 * tp AS DOUBLE) / n AS accuracy,
        (CAST(tp AS DOUBLE) / NULLIF(pos, 0) + CAST(n - al - pos + tp AS DOUBLE) / NULLIF(n - pos, 0)) / 2 AS balanced_accuracy,
        COALESCE(CAST(tp AS DOUBLE) / NULLIF(al, 0), 0) AS precision,
        COALESCE(CAST(tp AS DOUBLE) / NULLIF(pos, 0), 0) AS recall,
        COALESCE(CAST(2 * tp AS DOUBLE) / NULLIF(al + pos, 0), 0) AS f1,
        n - al - pos + tp AS true_negative, al - tp AS false_positive, pos - tp AS false_negative,
        tp AS true_positive, {pl} AS precision_lower_95, {pu} AS precision_upper_95,
        {rl} AS recall_lower_95, {ru} AS recall_upper_95, ll AS log_loss, bs AS brier_score FROM c_{name})"""
    return [counted, rated]


EVALUATED = "(SELECT * FROM scored, chosen_one WHERE split IN ('validation', 'test'))"
ONE = "chosen_one AS (SELECT picked, tier = 1 AS feasible FROM chosen)"
METRICS = [*EVAL, ONE, *measured("m", EVALUATED, "split", "picked")]
MONTHLY = measured("mm", "(SELECT * FROM scored, chosen_one WHERE split = 'test')", "month", "picked")
ROUNDED = ("precision_lower_95", "precision_upper_95", "recall_lower_95", "recall_upper_95", "log_loss", "brier_score")


def gated(name: str, source: str, by: str) -> str:
    checks = {
        "minimum_precision_lower_bound_95": "precision_lower_95 >= 5e-1",
        "minimum_recall_lower_bound_95": "recall_lower_95 >= 2e-1",
        "minimum_alert_coverage": "alert_coverage >= 5e-2",
        "maximum_alert_coverage": "alert_coverage <= 2e-1",
        "minimum_alert_count": "alert_count >= 500",
    }
    messages = ", ".join(
        f"CASE WHEN NOT ({c}) THEN '{schema.GATE_MESSAGES[k]}' END" for k, c in checks.items()
    )
    return f"""{name} AS (SELECT {by}, {listed(checks)}, {' AND '.join(checks.values())} AS passed,
      array_to_string(list_filter([{messages}], lambda x: x IS NOT NULL), '|') AS violations,
      precision, {', '.join(f'{r6(n)} AS {n}' for n in ROUNDED[:2])}, recall,
      {', '.join(f'{r6(n)} AS {n}' for n in ROUNDED[2:4])}, alert_coverage, alert_count, sample_count
      FROM {source})"""


GATES = [*METRICS, *MONTHLY, gated("g", "m", "split"), gated("gm", "mm", "month")]
VERDICT = """verdict AS (SELECT *, array_to_string(list_filter([
    CASE WHEN NOT feasible_on_validation THEN '{}' END, CASE WHEN NOT test_passed THEN '{}' END,
    CASE WHEN NOT monthly_stability_passed THEN '{}' END], lambda x: x IS NOT NULL), '|') AS violations,
    feasible_on_validation AND validation_passed AND test_passed AND monthly_stability_passed AS passed
  FROM (SELECT (SELECT feasible FROM chosen_one) AS feasible_on_validation,
    (SELECT passed FROM g WHERE split = 'validation') AS validation_passed,
    (SELECT passed FROM g WHERE split = 'test') AS test_passed,
    (SELECT bool_and(passed) FROM gm) AS monthly_stability_passed))""".format(
    schema.VALIDATION_INFEASIBLE, schema.TEST_GATE_FAILED, schema.MONTHLY_GATE_FAILED
)


def long(source: str, ids: str, names: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {ids}, '{n}' AS metric, CAST({n} AS DOUBLE) AS value FROM {source}" for n in names
    )


def threshold_comparison() -> str:
    both = """(SELECT scored.*, 'business' AS threshold_name, picked AS t FROM scored, chosen_one WHERE split IN ('validation', 'test')
      UNION ALL SELECT scored.*, 'f1', f1_threshold FROM scored, best_f1 WHERE split IN ('validation', 'test'))"""
    return sql(*EVAL, ONE, *measured("tc", both, "split, threshold_name", "t"),
               long("tc", "split, threshold_name", ["precision", "recall", "alert_coverage", "f1"]))


def ranking_metrics() -> str:
    return sql(*BASE, SCORED, CURVE, f"""
      SELECT split, MAX(sample_count) AS sample_count, MAX(positive_count) AS positive_count,
        {r6('''SUM(CAST(p AS DOUBLE) * (CAST(sample_count - positive_count - (alert_count - true_positive_count) AS DOUBLE)
          + (a - p) / 2)) / (CAST(MAX(positive_count) AS DOUBLE) * (MAX(sample_count) - MAX(positive_count)))''')} AS roc_auc,
        {r6('SUM(p * precision) / MAX(positive_count)')} AS average_precision
      FROM curve GROUP BY split""")


CANDIDATES = f"""candidates AS (SELECT flight_key, flight_date, provided AS provided_volumes,
  {binding.WEAK_SCORE_SQL} AS delay_probability FROM checked WHERE len(errors) = 0)"""
DECISIONS = f"""decisions AS (SELECT c.*, v.passed AS model_business_ready, v.violations AS business_gate_violations,
    o.picked AS classification_threshold,
    CASE WHEN provided_volumes = 6 THEN 'provided_daily_schedule'
         WHEN provided_volumes > 0 THEN 'typical_schedule_profile_with_overrides'
         ELSE 'typical_schedule_profile' END AS schedule_context_source,
    (SELECT CAST(MAX(fl_date) AS VARCHAR) FROM facts WHERE completed) AS historical_context_date,
    CASE WHEN v.passed THEN 'ready' ELSE 'not_ready' END AS model_business_status,
    v.passed AND provided_volumes = 6 AS prediction_publishable,
    array_to_string(list_filter([NULLIF(v.violations, ''), CASE WHEN provided_volumes <> 6 THEN '{schema.MISSING_SCHEDULE}' END],
      lambda x: x IS NOT NULL), '|') AS publication_blockers,
    CASE WHEN v.passed AND provided_volumes = 6 THEN 'publishable' WHEN NOT v.passed THEN 'experimental_model_not_ready'
         ELSE 'experimental_missing_daily_schedule' END AS prediction_status,
    CASE WHEN v.passed AND provided_volumes = 6 THEN delay_probability >= o.picked END AS published_delay_alert,
    delay_probability >= o.picked AS diagnostic_is_delayed_prediction
  FROM candidates c, verdict v, chosen_one o)"""

# --- explorer --------------------------------------------------------------

LABELS = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(schema.MONTH_LABELS, 1))
VIEW = f"""explored AS (SELECT *, CASE month {LABELS} END AS month_label,
  CASE WHEN cancelled = 1 THEN '{schema.STATUS_CANCELLED}' WHEN diverted = 1 THEN '{schema.STATUS_DIVERTED}'
       WHEN delayed THEN '{schema.STATUS_LATE}' ELSE '{schema.STATUS_ON_TIME.replace("'", "''")}' END AS flight_status
  FROM facts)"""
CHOSEN = (
    f"month IN ({', '.join(map(str, EXPLORED['months']))}) AND op_unique_carrier IN "
    f"({', '.join(repr(c) for c in EXPLORED['carriers'])})"
)
RATE = "COUNT(*) AS flights, AVG(CAST(delayed AS INTEGER)) AS delay_rate FROM explored WHERE completed"


def category_encodings() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS category, {value} AS level, delayed FROM train" for name, value in CATEGORIES.items()
    )
    return sql(*BASE, "train AS (SELECT * FROM facts WHERE completed AND month <= 7)",
               "overall AS (SELECT CAST(COUNT(*) FILTER (delayed) AS DOUBLE) / COUNT(*) AS o FROM train)",
               f"""SELECT category, level, COUNT(*) AS rows,
                 {r6('(COUNT(*) FILTER (delayed) + 20 * ANY_VALUE(o)) / (COUNT(*) + 20)', 9)} AS rate
                 FROM ({rows}), overall GROUP BY category, level""")


def oof_encodings() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS category, {value} AS level, flight_key % 5 AS fold, delayed FROM train" for name, value in CATEGORIES.items()
    )
    others = "(delayed AND t.fold <> f.fold)", "(t.fold <> f.fold)"
    return sql(*BASE, "train AS (SELECT * FROM facts WHERE completed AND month <= 7)",
               "overall AS (SELECT CAST(COUNT(*) FILTER (delayed) AS DOUBLE) / COUNT(*) AS o FROM train)",
               f"""SELECT category, level, CAST(f.fold AS INTEGER) AS fold,
                 {r6(f"(COUNT(*) FILTER {others[0]} + 20 * ANY_VALUE(o)) / (COUNT(*) FILTER {others[1]} + 20)", 9)} AS rate
                 FROM ({rows}) AS t, overall, range(5) AS f(fold) GROUP BY category, level, f.fold""")


def prepared_modes() -> str:
    """Once, twice by appending, once after overwriting, and the same after a refused write."""
    steps = "(0, 'errorifexists', TRUE, 1), (1, 'append', TRUE, 2), (2, 'overwrite', TRUE, 1), (3, 'errorifexists', FALSE, 1)"
    return sql(*validated(), f"""SELECT CAST(s.step AS INTEGER) AS step, s.mode, s.written,
        CASE WHEN len(v.errors) = 0 THEN 'clean' ELSE 'rejected' END AS part, CAST(COUNT(*) * ANY_VALUE(s.times) AS BIGINT) AS rows
      FROM validated v, (VALUES {steps}) AS s(step, mode, written, times) GROUP BY ALL""")


def importance_documents() -> str:
    published = ", ".join(f"('{name}', {value!r}::DOUBLE)" for name, value in snapshot.IMPORTANCES)
    return f"""SELECT 'local' AS document, variable AS feature, {r6('absolute_correlation')} AS importance, 'local' AS source
        FROM ({correlation_with_delay()})
      UNION ALL SELECT d, feature, {r6('value')}, 'snapshot' FROM (VALUES ('old'), ('broken'), ('missing')) AS v(d),
        (VALUES {published}) AS p(feature, value)"""


def staged_auc() -> str:
    """The rank-sum form of the AUC, ties sharing their mean rank; precision by running sums."""
    return sql(*BASE, SCORED, """staged AS (SELECT CAST(i AS INTEGER) AS trees, label,
        CAST(ROUND(score * 10000) * i + (flight_key * (31 + i)) % 20000 AS DOUBLE) AS margin FROM scored, range(1, 13) AS r(i))""",
      "points AS (SELECT trees, margin, COUNT(*) AS a, SUM(label) AS p FROM staged GROUP BY trees, margin)",
      """placed AS (SELECT *, SUM(a) OVER up AS upto, SUM(a) OVER down AS alerts, SUM(p) OVER down AS hits FROM points
        WINDOW up AS (PARTITION BY trees ORDER BY margin), down AS (PARTITION BY trees ORDER BY margin DESC))""",
      f"""SELECT trees, CAST(SUM(a) AS BIGINT) AS sample_count, CAST(SUM(p) AS BIGINT) AS positive_count,
        {r6("(SUM(p * (upto - (a - 1) / 2.0::DOUBLE)) - SUM(p) * (SUM(p) + 1) / 2.0::DOUBLE) / (CAST(SUM(p) AS DOUBLE) * (SUM(a) - SUM(p)))")} AS roc_auc,
        {r6("SUM(p * CAST(hits AS DOUBLE) / alerts) / SUM(p)")} AS average_precision
        FROM placed GROUP BY trees""")


REPORTS = {
    "overview": ("overview", []), "flight_status": ("status_distribution", ["flight_status"]),
    "missing_values": ("missing_values", ["column"]), "monthly_metrics": ("punctuality_by_month", ["month"]),
    "carrier_metrics": ("punctuality_by_carrier", ["op_unique_carrier"]),
    "origin_metrics": ("punctuality_by_origin", ["origin"]), "numeric_summary": ("numeric_summary", ["variable"]),
    "correlations/matrix": ("correlation_matrix", ["variable_x", "variable_y"]),
    "correlations/with_arrival_delay": ("correlation_with_delay", ["variable"]),
}


def report_sinks(texts: dict[str, str]) -> str:
    parts = []
    for name, (query, keys) in REPORTS.items():
        key = "concat_ws('~', " + ", ".join(f'CAST("{k}" AS VARCHAR)' for k in keys) + ")" if keys else "''"
        kept = "* EXCLUDE (" + ", ".join(f'"{k}"' for k in keys) + ")" if keys else "*"
        parts.append(f"""SELECT '{name}' AS report, _key AS key, metric, value FROM (UNPIVOT (
          SELECT {key} AS _key, ROUND(CAST(COLUMNS({kept}) AS DOUBLE), 4) + 0.0 FROM ({texts[query]}))
          ON COLUMNS(* EXCLUDE (_key)) INTO NAME metric VALUE value)""")
    return " UNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    slot_base = [*BASE, *SCHEDULE]
    metric_names = [
        "sample_count", "positive_count", "positive_percentage", "predicted_positive_count",
        "predicted_positive_percentage", "alert_count", "alert_coverage",
        "alert_coverage_percentage", "threshold", "accuracy", "balanced_accuracy", "precision",
        "recall", "f1", "true_negative", "false_positive", "false_negative", "true_positive",
    ]
    texts = {
        "overview": overview(),
        "status_distribution": status_distribution(),
        "missing_values": missing_values(),
        "punctuality_by_month": punctuality("month"),
        "punctuality_by_carrier": punctuality("op_unique_carrier"),
        "punctuality_by_origin": punctuality("origin"),
        "numeric_summary": numeric_summary(),
        "correlation_matrix": correlation_matrix(),
        "correlation_row_count": sql(*BASE, study(True), "SELECT COUNT(*) AS row_count FROM study"),
        "correlation_with_delay": correlation_with_delay(),
        "correlation_top5": correlation_with_delay(5),
        "validated_rows": sql(*validated(), f"""SELECT {CLEAN_COLUMNS}, array_to_string(errors, '|') AS validation_errors,
          len(errors) = 0 AS is_valid_row FROM validated"""),
        "valid_rows": sql(*validated(), f"SELECT {CLEAN_COLUMNS} FROM validated WHERE len(errors) = 0"),
        "rejected_rows": sql(*validated(), """SELECT flight_key, fl_date, op_unique_carrier,
          array_to_string(errors, '|') AS validation_errors FROM validated WHERE len(errors) > 0"""),
        "quality_global": sql(*validated(), """SELECT COUNT(*) AS row_count, COUNT(*) FILTER (len(errors) = 0) AS valid_row_count,
          COUNT(*) FILTER (len(errors) > 0) AS rejected_row_count FROM validated"""),
        "quality_by_error": sql(*validated(), """SELECT error, COUNT(*) AS count
          FROM (SELECT unnest(errors) AS error FROM validated) GROUP BY error"""),
        "csv_corrupt_rows": csv_corrupt_rows(),
        "parquet_roundtrip": sql(*validated(), """SELECT year, month, 'clean' AS part, COUNT(*) AS rows FROM validated
          WHERE len(errors) = 0 GROUP BY year, month UNION ALL
          SELECT NULL, NULL, 'rejected', COUNT(*) FROM validated WHERE len(errors) > 0"""),
        "request_json": sql(FLIGHTS, REQUESTS_SPELT, CHECKED, """SELECT flight_date, op_unique_carrier, op_carrier_fl_num, origin, dest,
          crs_dep_time, crs_elapsed_time, distance, route_scheduled_flights_day,
          array_to_string(list_concat(list_filter(errors, lambda e: NOT (unread AND e = 'missing_field:op_carrier_fl_num')),
            CASE WHEN unread THEN ['invalid_number:op_carrier_fl_num'] ELSE [] END), '|') AS request_errors FROM checked"""),
        "feature_importance": "SELECT feature, TRUE AS matches_nodes, TRUE AS sums_to_100 FROM (VALUES "
          + ", ".join(f"('{name}')" for name in schema.FEATURES) + ") AS f(feature)",
        "trained_scores": sql(*BASE, """SELECT flight_key, CASE WHEN month <= 10 THEN 'validation' ELSE 'test' END AS split,
          CAST(delayed AS INTEGER) AS is_delayed, TRUE AS is_probability, TRUE AS matches_nodes FROM facts WHERE completed AND month >= 9"""),
        "model_contract": sql(*BASE, """SELECT 'rows:' || CASE WHEN month <= 7 THEN 'train' WHEN month = 8 THEN 'tuning'
            WHEN month <= 10 THEN 'validation' ELSE 'test' END AS figure, CAST(COUNT(*) AS DOUBLE) AS value
          FROM facts WHERE completed GROUP BY 1 UNION ALL SELECT 'features', 87.0::DOUBLE UNION ALL
          SELECT 'importance', 100.0::DOUBLE UNION ALL SELECT 'better_than_chance', 1.0::DOUBLE"""),
        "oof_encodings": oof_encodings(),
        "staged_auc": staged_auc(),
        "prepared_modes": prepared_modes(),
        "importance_documents": importance_documents(),
        "scored_requests": sql(FLIGHTS, REQUESTS, CHECKED, """SELECT flight_key, flight_date, provided AS provided_volumes,
            CASE WHEN provided = 6 THEN 'provided_daily_schedule' WHEN provided > 0 THEN 'typical_schedule_profile_with_overrides'
              ELSE 'typical_schedule_profile' END AS schedule_context_source,
            TRUE AS matches_nodes, TRUE AS is_probability FROM checked WHERE len(errors) = 0"""),
        "form_requests": sql(FLIGHTS, """SELECT row_key, CAST(fl_date AS VARCHAR) AS flight_date, CAST(month(fl_date) AS INTEGER) AS month,
          CAST(day(fl_date) AS INTEGER) AS day_of_month, CAST(isodow(fl_date) AS INTEGER) AS day_of_week,
          crs_dep_time, crs_arr_time FROM flights WHERE crs_dep_time IS NOT NULL"""),
        "request_states": sql(FLIGHTS, REQUESTS, """s AS (SELECT airport, MIN(state) AS state FROM (
            SELECT origin AS airport, origin_state_nm AS state FROM flights UNION ALL SELECT dest, dest_state_nm FROM flights)
            WHERE airport IS NOT NULL AND state IS NOT NULL GROUP BY airport)""",
          "r AS (SELECT * REPLACE (CASE WHEN flight_key % 37 = 0 THEN 'NOWHERE' ELSE dest END AS dest) FROM requests)",
          """SELECT r.flight_key, r.flight_date, r.origin, r.dest, a.state AS origin_state_nm, b.state AS dest_state_nm,
            concat_ws('|', CASE WHEN r.origin IS NOT NULL AND a.state IS NULL THEN 'origin_state_nm' END,
              CASE WHEN r.dest IS NOT NULL AND b.state IS NULL THEN 'dest_state_nm' END) AS unknown_airports
          FROM r LEFT JOIN s a ON a.airport = r.origin LEFT JOIN s b ON b.airport = r.dest"""),
        "metrics_documents": sql(*BASE, """SELECT 'local' AS document, 'local' AS source, CAST(COUNT(*) FILTER (delayed) AS DOUBLE) AS value
          FROM facts UNION ALL SELECT d, 'snapshot', 252517.0::DOUBLE FROM (VALUES ('stale'), ('foreign'), ('missing')) AS v(d)"""),
        "calendar_features": sql(*BASE, f"""SELECT flight_key, fl_date, month, day_of_week, {listed(CALENDAR)},
          {listed(CATEGORIES)} FROM facts"""),
        "arrival_day_offset": sql(*BASE, SLOTTED, f"""SELECT flight_key, fl_date, CAST({DEP} AS INTEGER) AS departure_minutes,
          CAST({ARR} AS INTEGER) AS arrival_minutes, {OFFSET} AS day_offset, departure_slot, arrival_slot FROM slotted"""),
        "daily_history_counts": daily_history_counts(),
        "history_features_joined": sql(*BASE, *HISTORY, f"""SELECT {LEG}, cancelled, diverted, arr_delay, {ALL_HISTORY}
          FROM facts {HISTORY_JOINS}"""),
        "hourly_departures_3h": sql(*slot_base, "SELECT * FROM v_origin"),
        "hourly_arrivals_3h": sql(*slot_base, "SELECT * FROM v_dest"),
        "route_daily_load": sql(*slot_base, "SELECT * FROM v_route"),
        "carrier_origin_daily_load": sql(*slot_base, "SELECT * FROM v_carrier"),
        "schedule_features_joined": sql(*slot_base, f"""SELECT {LEG}, crs_dep_time, crs_arr_time, crs_elapsed_time,
          cancelled, diverted, arr_delay, {ALL_SCHEDULE} FROM slotted {SCHEDULE_JOINS}"""),
        "model_frame": model_frame(),
        "deterministic_sample": sql(*BASE, f"""SELECT flight_key, fl_date, origin, dest, CAST(delayed AS INTEGER) AS is_delayed
          FROM facts WHERE completed AND {SAMPLE_KEY} < {int(SAMPLE * schema.SAMPLE_MODULUS)}"""),
        "exact_sample": exact_sample(EXACT_SAMPLE),
        "exact_sample_large": exact_sample(LARGE_SAMPLE),
        "temporal_split_summary": split_summary(),
        "history_defaults": sql(*FRAME, f"SELECT {defaults(schema.HISTORY_FEATURES)} FROM frame"),
        "schedule_defaults": sql(*FRAME, f"""SELECT {defaults(schema.SCHEDULE_FEATURES, None)},
          MAX(fl_date) AS history_cutoff_date FROM frame"""),
        "explorer_filtered": sql(*BASE, VIEW, f"""SELECT flight_key, fl_date, month, month_label, op_unique_carrier,
          op_carrier_fl_num, origin, dest, crs_dep_time, crs_arr_time, arr_delay, completed AS is_completed,
          delayed AS is_delayed, flight_status FROM explored WHERE {CHOSEN}"""),
        "explorer_kpis": sql(*BASE, VIEW, f"""SELECT COUNT(*) AS flight_count, {N_DONE} AS completed_count,
          {N_LATE} AS delayed_count, {N_CANCELLED} AS cancelled_count, COUNT(*) FILTER (diverted = 1) AS diverted_count,
          COALESCE(CAST({N_LATE} AS DOUBLE) / NULLIF({N_DONE}, 0), 0) AS delay_rate FROM explored WHERE {CHOSEN}"""),
        "explorer_monthly": sql(*BASE, VIEW, f"SELECT month, month_label, {RATE} GROUP BY month, month_label"),
        "explorer_top_carriers": sql(*BASE, VIEW, f"""SELECT op_unique_carrier, {RATE} GROUP BY op_unique_carrier
          ORDER BY flights DESC, delay_rate DESC, op_unique_carrier LIMIT 10"""),
        "explorer_status_counts": sql(*BASE, VIEW, "SELECT flight_status, COUNT(*) AS flights FROM explored GROUP BY flight_status"),
        "filter_options": sql(FLIGHTS, """SELECT DISTINCT 'op_unique_carrier' AS option, op_unique_carrier AS value FROM flights
          WHERE op_unique_carrier IS NOT NULL UNION SELECT DISTINCT 'origin', origin FROM flights WHERE origin IS NOT NULL"""),
        "delay_histogram": sql(*BASE, """SELECT CAST(LEAST(FLOOR((LEAST(GREATEST(arr_delay, -30), 180) + 30) / 5), 41) AS INTEGER) AS bin,
          CAST(LEAST(FLOOR((LEAST(GREATEST(arr_delay, -30), 180) + 30) / 5), 41) AS INTEGER) * 5 - 30 AS bin_start,
          COUNT(*) AS flights FROM facts WHERE completed GROUP BY 1, 2"""),
        "airport_state": sql(FLIGHTS, """SELECT airport, MIN(state) AS state FROM (
          SELECT origin AS airport, origin_state_nm AS state FROM flights UNION ALL
          SELECT dest, dest_state_nm FROM flights) WHERE airport IS NOT NULL AND state IS NOT NULL GROUP BY airport"""),
        "request_features": request_features(),
        "request_validation": sql(FLIGHTS, REQUESTS, CHECKED, """SELECT flight_key, flight_date, op_unique_carrier, origin, dest,
          array_to_string(errors, '|') AS request_errors, len(errors) = 0 AS is_valid_request FROM checked"""),
        "schedule_context": sql(FLIGHTS, REQUESTS, """SELECT flight_key, flight_date, provided,
          CASE WHEN provided = 6 THEN 'provided_daily_schedule' WHEN provided > 0 THEN 'typical_schedule_profile_with_overrides'
               ELSE 'typical_schedule_profile' END AS with_profiles,
          CASE WHEN provided = 6 THEN 'provided_daily_schedule' ELSE 'missing' END AS without_profiles FROM requests"""),
        "publication_decision": sql(*GATES, VERDICT, REQUESTS, CHECKED, CANDIDATES, DECISIONS, "SELECT * FROM decisions"),
        "presentation": sql(*GATES, VERDICT, REQUESTS, CHECKED, CANDIDATES, DECISIONS, """SELECT flight_key, flight_date,
          prediction_publishable AS publishable, published_delay_alert AS published_alert,
          delay_probability AS diagnostic_probability, classification_threshold AS diagnostic_threshold,
          diagnostic_is_delayed_prediction AS diagnostic_class, publication_blockers AS blockers,
          historical_context_date, schedule_context_source FROM decisions"""),
        "pr_curve": sql(*BASE, SCORED, CURVE, """SELECT split, threshold, alert_count, true_positive_count, sample_count,
          positive_count, precision, recall, alert_coverage FROM curve"""),
        "f1_threshold": sql(*EVAL, f"SELECT f1_threshold, {r6('best_f1')} AS best_f1 FROM best_f1"),
        "business_threshold": business_threshold(),
        "business_threshold_fallback": business_threshold(WEAK),
        "classification_metrics": sql(*METRICS, f"""SELECT split, {', '.join(metric_names)},
          {', '.join(f'{r6(n)} AS {n}' for n in ROUNDED)} FROM m"""),
        "ranking_metrics": ranking_metrics(),
        "business_gate": sql(*METRICS, gated("g", "m", "split"), "SELECT * FROM g"),
        "monthly_gate": sql(*GATES, "SELECT * FROM gm"),
        "monthly_performance": sql(*GATES, long("mm", "month", ["precision", "recall", "alert_coverage"])),
        "overall_gate": sql(*GATES, VERDICT, "SELECT * FROM verdict"),
        "baselines": sql(*BASE, SCORED, """SELECT 'always_negative' AS baseline,
          CAST(COUNT(*) FILTER (label = 0) AS DOUBLE) / COUNT(*) AS accuracy, CAST(0 AS DOUBLE) AS f1
          FROM scored WHERE split = 'test' UNION ALL SELECT 'always_positive',
          CAST(COUNT(*) FILTER (label = 1) AS DOUBLE) / COUNT(*),
          CAST(2 * COUNT(*) FILTER (label = 1) AS DOUBLE) / (COUNT(*) + COUNT(*) FILTER (label = 1))
          FROM scored WHERE split = 'test'"""),
        "threshold_comparison": threshold_comparison(),
        "confusion_long": sql(*METRICS, """SELECT split, 0 AS actual, 0 AS predicted, true_negative AS flights FROM m
          UNION ALL SELECT split, 0, 1, false_positive FROM m UNION ALL SELECT split, 1, 0, false_negative FROM m
          UNION ALL SELECT split, 1, 1, true_positive FROM m"""),
        "category_encodings": category_encodings(),
    }
    texts["report_sinks"] = report_sinks(texts)
    texts["prepared_rows"], texts["bundle_encodings"] = texts["valid_rows"], texts["category_encodings"]
    for level in schema.HISTORY_LEVELS:
        texts[f"rolling_{level}"] = sql(*BASE, *rolled(level), f"SELECT * FROM r_{level}")
        texts[f"history_profile_{level}"] = sql(*FRAME, *DEFAULTS, history_profile(level))
    texts["bundle_profile"] = texts["history_profile_route"]
    for name in schema.SCHEDULE_PROFILES:
        texts[f"schedule_profile_{name}"] = sql(*FRAME, *DEFAULTS, schedule_profile(name))
    return texts
