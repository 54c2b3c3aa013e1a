"""Views of the given tables in the shape of the flight data.

The same SQL text defines a table for Spark and for DuckDB. ``lineitem`` plays the flights file;
requests are next year's flights, some with volumes given and some with errors seeded. On the
Spark side flights are written once per application to the shared folder, as the prepare job would
leave them, so that operators read columns and not the text of a view. Raw flights are read once by
every query that takes them and stay a view. Only queries that read ``row_key`` pay for numbering the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ontime.session import TASKS_PER_CORE, scratch_path, with_settings

FLIGHTS_SQL = """
WITH k AS (
  SELECT CAST(l_orderkey*31 + l_partkey*17 + l_suppkey*13 + l_linenumber*7 + CAST(l_quantity AS BIGINT) AS BIGINT) AS flight_key,
         CAST(dayofyear(CAST(l_shipdate AS DATE)) - 1 AS INT) AS doy0,
         l_orderkey, l_suppkey, l_partkey, l_linenumber, l_quantity, l_shipdate
  FROM lineitem),
u AS (
  SELECT flight_key, doy0, l_suppkey, l_partkey,
         flight_key * 1000 + row_number() OVER (PARTITION BY flight_key
           ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_shipdate) AS row_key
  FROM k),
h AS (
  SELECT *, (flight_key * 48271) % 1000003 AS h1, (flight_key * 16807) % 1000003 AS h2,
         (flight_key * 7) % 1440 AS dep_min, 45 + flight_key % 300 AS elapsed,
         (l_partkey % 7 - 3) * 60 AS tz, l_suppkey % 30 AS o, (l_partkey + 1) % 30 AS d,
         CASE WHEN flight_key % 82 = 0 THEN 1 ELSE 0 END AS cancelled,
         CASE WHEN flight_key % 82 <> 0 AND flight_key % 239 = 1 THEN 1 ELSE 0 END AS diverted
  FROM u),
m AS (
  SELECT *, CAST(FLOOR(dep_min / 60) AS BIGINT) AS dep_hr,
         (dep_min + elapsed + tz + 1440) % 1440 AS arr_min,
         CASE WHEN cancelled = 1 OR diverted = 1 OR h2 % 233 = 13 THEN NULL
              ELSE h1 % 110 - 82 + CAST(FLOOR(dep_min / 60) AS BIGINT) + l_suppkey % 12
                   + CASE WHEN h1 % 97 = 0 THEN 300 ELSE 0 END END AS dly
  FROM h)
SELECT flight_key, row_key,
       2024 AS year, CAST(EXTRACT(MONTH FROM DATE '2024-01-01' + doy0) AS INT) AS month,
       CAST(EXTRACT(DAY FROM DATE '2024-01-01' + doy0) AS INT) AS day_of_month,
       doy0 % 7 + 1 AS day_of_week, DATE '2024-01-01' + doy0 AS fl_date,
       CASE WHEN h2 % 211 <> 3 THEN 'C' || CAST(l_suppkey % 12 AS STRING) END AS op_unique_carrier,
       CAST(flight_key % 6000 + 1 AS INT) AS op_carrier_fl_num,
       'A' || CAST(o AS STRING) AS origin, 'S' || CAST(o % 10 AS STRING) AS origin_state_nm,
       CASE WHEN h2 % 223 <> 5 THEN 'A' || CAST(d AS STRING) END AS dest, 'S' || CAST(d % 10 AS STRING) AS dest_state_nm,
       CAST(CASE WHEN h2 % 227 = 7 THEN NULL WHEN dep_min = 0 AND h1 % 2 = 0 THEN 2400 ELSE dep_hr * 100 + dep_min % 60 END AS INT) AS crs_dep_time,
       CAST(CAST(FLOOR(arr_min / 60) AS BIGINT) * 100 + arr_min % 60 AS INT) AS crs_arr_time,
       CAST(CASE WHEN h2 % 229 = 11 THEN NULL WHEN h2 % 229 = 12 THEN 0 ELSE elapsed END AS DOUBLE) AS crs_elapsed_time, CAST(elapsed * 8 AS DOUBLE) AS distance,
       CAST(CASE WHEN cancelled = 1 THEN NULL ELSE COALESCE(dly, 0) + flight_key % 15 - 7 END AS DOUBLE) AS dep_delay,
       CAST(CASE WHEN cancelled = 1 THEN NULL ELSE 8 + h2 % 25 END AS DOUBLE) AS taxi_out,
       CAST(CASE WHEN cancelled = 1 THEN NULL ELSE 3 + h2 % 11 END AS DOUBLE) AS taxi_in,
       CAST(CASE WHEN dly IS NULL THEN NULL ELSE elapsed + h2 % 31 - 15 END AS DOUBLE) AS actual_elapsed_time,
       CAST(CASE WHEN dly IS NULL THEN NULL ELSE elapsed + h2 % 31 - 15 - (11 + h2 % 25 + h2 % 11) END AS DOUBLE) AS air_time,
       CAST(dly AS DOUBLE) AS arr_delay,
       cancelled, CASE WHEN cancelled = 1 THEN CASE CAST(h1 % 4 AS INT) WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'D' END END AS cancellation_code,
       diverted,
       LEAST(9999, dep_hr * 150 + h2 % 4000 + CASE WHEN dly > 0 THEN 2500 ELSE 0 END) / CAST(10000 AS DOUBLE) AS score
FROM m
"""

RAW_SQL = """
SELECT flight_key, CAST(year AS STRING) AS year,
       CASE WHEN flight_key % 101 = 0 THEN 'january' WHEN flight_key % 149 = 0 THEN '13' ELSE CAST(month AS STRING) END AS month,
       CAST(day_of_month AS STRING) AS day_of_month,
       CASE WHEN flight_key % 151 = 0 THEN '8' ELSE CAST(day_of_week AS STRING) END AS day_of_week,
       CASE WHEN flight_key % 127 = 0 THEN '2024-02-30' ELSE CAST(fl_date AS STRING) END AS fl_date,
       CASE WHEN flight_key % 107 = 0 THEN '   ' ELSE ' ' || op_unique_carrier || ' ' END AS op_unique_carrier,
       CASE WHEN flight_key % 109 = 0 THEN '12.5' WHEN flight_key % 157 = 0 THEN '0' ELSE CAST(op_carrier_fl_num AS STRING) || '.0' END AS op_carrier_fl_num,
       origin, 'City ' || origin AS origin_city_name, origin_state_nm,
       dest, 'City ' || dest AS dest_city_name, dest_state_nm,
       CASE WHEN flight_key % 103 = 0 THEN '1260' ELSE CAST(crs_dep_time AS STRING) END AS crs_dep_time,
       CASE WHEN cancelled = 1 THEN '' ELSE CAST(crs_dep_time AS STRING) || '.0' END AS dep_time,
       COALESCE(CAST(CAST(dep_delay AS BIGINT) AS STRING) || '.0', '') AS dep_delay,
       COALESCE(CAST(CAST(taxi_out AS BIGINT) AS STRING) || '.0', '') AS taxi_out,
       CASE WHEN cancelled = 1 THEN '' ELSE CAST(crs_dep_time AS STRING) || '.0' END AS wheels_off,
       CASE WHEN cancelled = 1 THEN '' ELSE CAST(crs_arr_time AS STRING) || '.0' END AS wheels_on,
       COALESCE(CAST(CAST(taxi_in AS BIGINT) AS STRING) || '.0', '') AS taxi_in,
       CAST(crs_arr_time AS STRING) AS crs_arr_time,
       CASE WHEN cancelled = 1 THEN '' ELSE CAST(crs_arr_time AS STRING) || '.0' END AS arr_time,
       COALESCE(CAST(CAST(arr_delay AS BIGINT) AS STRING) || '.0', '') AS arr_delay,
       CASE WHEN flight_key % 137 = 0 THEN '2' ELSE CAST(cancelled AS STRING) END AS cancelled,
       CASE WHEN flight_key % 113 = 0 THEN 'Z' WHEN flight_key % 163 = 0 THEN '' ELSE COALESCE(cancellation_code, '') END AS cancellation_code,
       CAST(diverted AS STRING) AS diverted,
       CASE WHEN flight_key % 139 = 0 THEN '0' ELSE CAST(CAST(crs_elapsed_time AS BIGINT) AS STRING) || '.0' END AS crs_elapsed_time,
       COALESCE(CAST(CAST(actual_elapsed_time AS BIGINT) AS STRING) || '.0', '') AS actual_elapsed_time,
       COALESCE(CAST(CAST(air_time AS BIGINT) AS STRING) || '.0', '') AS air_time,
       CASE WHEN flight_key % 131 = 0 THEN '-5.0' ELSE CAST(CAST(distance AS BIGINT) AS STRING) || '.0' END AS distance
FROM flights
"""

REQUESTS_SQL = """
SELECT flight_key, CAST(fl_date + 366 AS STRING) AS flight_date,
       CAST(EXTRACT(MONTH FROM fl_date + 366) AS INT) AS month,
       CAST(EXTRACT(DAY FROM fl_date + 366) AS INT) AS day_of_month,
       CASE WHEN flight_key % 60 = 7 THEN 9 ELSE (day_of_week + 1) % 7 + 1 END AS day_of_week,
       CASE WHEN flight_key % 83 = 0 THEN ' ' ELSE LOWER(op_unique_carrier) || ' ' END AS op_unique_carrier,
       CASE WHEN flight_key % 140 = 9 THEN 0 ELSE op_carrier_fl_num END AS op_carrier_fl_num,
       origin, origin_state_nm, dest, dest_state_nm,
       CASE WHEN flight_key % 100 = 11 THEN 1260 ELSE crs_dep_time END AS crs_dep_time, crs_arr_time,
       CASE WHEN flight_key % 160 = 13 THEN CAST(0 AS DOUBLE) ELSE crs_elapsed_time END AS crs_elapsed_time,
       CASE WHEN flight_key % 180 = 17 THEN CAST(-1 AS DOUBLE) ELSE distance END AS distance,
       CAST(CASE WHEN flight_key % 40 = 5 THEN 12 END AS DOUBLE) AS origin_scheduled_departures_hour,
       CAST(CASE WHEN flight_key % 40 = 5 THEN 30 END AS DOUBLE) AS origin_scheduled_departures_3h,
       CAST(CASE WHEN flight_key % 40 = 5 THEN 10 END AS DOUBLE) AS dest_scheduled_arrivals_hour,
       CAST(CASE WHEN flight_key % 40 = 5 THEN 28 END AS DOUBLE) AS dest_scheduled_arrivals_3h,
       CAST(CASE WHEN flight_key % 20 = 5 THEN 4 WHEN flight_key % 200 = 19 THEN -4 END AS DOUBLE) AS route_scheduled_flights_day,
       CAST(CASE WHEN flight_key % 40 = 5 THEN 40 END AS DOUBLE) AS carrier_origin_scheduled_flights_day
FROM flights
"""

# A score unrelated to the outcome: no threshold on it can satisfy the acceptance rules.
WEAK_SCORE_SQL = "((flight_key * 16807) % 1000003 % 10000) / CAST(10000 AS DOUBLE)"

_stored: dict[tuple[str, str, str], str] = {}


def _stored_table(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Write a derived table once per application and folder, then read it back."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = scratch_path(spark, name)
        build().write.parquet(path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])


def _flights_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a flight, dealt by its order so that a file of one row group is spread."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    with_settings(spark)
    source = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"
    )
    sql = FLIGHTS_SQL.replace("FROM lineitem", "FROM {lineitem}")
    tasks = spark.sparkContext.defaultParallelism * TASKS_PER_CORE
    return spark.sql(sql, lineitem=source.repartition(tasks, "l_orderkey"))


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean flights dataset; without ``row_key``, whose numbering would sort all rows."""
    return _stored_table(spark, sf_dir, "flights", lambda: _flights_view(spark, sf_dir).drop("row_key"))


def keyed_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with ``row_key``, a unique number per row."""
    return _stored_table(spark, sf_dir, "keyed_flights", lambda: _flights_view(spark, sf_dir))


def raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same flights as text, with seeded defects."""
    sql = RAW_SQL.replace("FROM flights", "FROM {flights}")
    return spark.sql(sql, flights=_flights_view(spark, sf_dir).drop("row_key"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = REQUESTS_SQL.replace("FROM flights", "FROM {flights}")
    return spark.sql(sql, flights=flights(spark, sf_dir))


def weak_scores(data: DataFrame) -> DataFrame:
    return data.withColumn("score", F.expr(WEAK_SCORE_SQL))
