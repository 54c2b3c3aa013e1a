"""Cases with known answers: conversions, rules, offsets, thresholds, gates, artefacts."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ontime import schema
from ontime.functions import clock
from ontime.functions.ratios import wilson_interval
from ontime.operators import attach, congestion, evaluate, history, metrics, quality, requests, sampling
from ontime.operators.curve import business_threshold
from ontime.plans import analyze, prepare
from ontime.session import create_session, scratch_path
from ontime.sources import artifacts, tables

GOOD = {
    "year": "2024", "month": "1", "day_of_month": "2", "day_of_week": "2", "fl_date": "2024-01-02",
    "op_unique_carrier": "AA", "op_carrier_fl_num": "100.0", "origin": "JFK",
    "origin_city_name": "New York, NY", "origin_state_nm": "New York", "dest": "LAX",
    "dest_city_name": "Los Angeles, CA", "dest_state_nm": "California", "crs_dep_time": "830",
    "dep_time": "835.0", "dep_delay": "5.0", "taxi_out": "20.0", "wheels_off": "855.0",
    "wheels_on": "1130.0", "taxi_in": "8.0", "crs_arr_time": "1145", "arr_time": "1138.0",
    "arr_delay": "-7.0", "cancelled": "0", "cancellation_code": "", "diverted": "0",
    "crs_elapsed_time": "375.0", "actual_elapsed_time": "363.0", "air_time": "335.0",
    "distance": "2475.0", **{name: "0" for name in schema.CAUSE_COLUMNS},
}


def checked(spark, **changes):
    row = {**GOOD, **changes}
    raw = spark.createDataFrame([tuple(row.values())], ", ".join(f"{n} string" for n in row))
    return quality.validate(raw).first()


def test_session_is_utc(spark):
    assert create_session().conf.get("spark.sql.session.timeZone") == "UTC"


def test_good_row_is_typed(spark):
    row = checked(spark)
    assert row.is_valid_row and row.validation_errors == []
    assert row.fl_date == dt.date(2024, 1, 2) and row.op_carrier_fl_num == 100
    assert (row.scheduled_departure_minutes, row.scheduled_arrival_minutes) == (510, 705)
    assert row.cancellation_code is None


@pytest.mark.parametrize("changes, errors", [
    ({"crs_dep_time": "1260"}, ["invalid_range:crs_dep_time"]),
    ({"month": "january"}, ["invalid_format:month", "missing_required_value:month"]),
    ({"op_carrier_fl_num": "12.5"},
     ["invalid_format:op_carrier_fl_num", "missing_required_value:op_carrier_fl_num"]),
    ({"arr_delay": "NaN"}, ["invalid_format:arr_delay"]),
    ({"distance": "12d"}, ["invalid_format:distance", "missing_required_value:distance"]),
    ({"fl_date": "2024-1-2"}, ["invalid_format:fl_date", "missing_required_value:fl_date"]),
    ({"day_of_month": "3"}, ["inconsistent_date"]),
    ({"cancelled": "1"}, ["missing_cancellation_code"]),
    ({"cancellation_code": "Z"}, ["invalid_cancellation_code"]),
    ({"cancelled": "2", "diverted": "3"}, ["invalid_flag:cancelled", "invalid_flag:diverted"]),
    ({"op_unique_carrier": "   "}, ["missing_required_value:op_unique_carrier"]),
    ({"crs_elapsed_time": "0", "distance": "-1"}, ["negative_distance", "non_positive_scheduled_duration"]),
    ({"dep_delay": "99999999999", "crs_arr_time": "2400"}, []),
    ({"year": "99999999999"}, ["invalid_format:year", "missing_required_value:year"]),
])
def test_rules(spark, changes, errors):
    row = checked(spark, **changes)
    assert row.validation_errors == errors
    assert row.is_valid_row is (not errors)


def test_rule_count(spark):
    assert len(quality.flight_rules()) == 58


@pytest.mark.parametrize("departure, arrival, elapsed, offset", [
    (600, 590, 60.0, 0), (1320, 360, 330.0, 1), (10, 1430, 60.0, -1), (600, 700, None, 0),
])
def test_arrival_day(spark, departure, arrival, elapsed, offset):
    row = spark.createDataFrame([(departure, arrival, elapsed)], "d int, a int, e double")
    assert row.select(clock.arrival_day_offset(F.col("d"), F.col("a"), F.col("e"))).first()[0] == offset


def test_constant_column_has_no_correlation(spark):
    rows = [tuple([7.0] + [float(i * k % 11) for k in range(1, 13)]) for i in range(40)]
    names = list(schema.STUDY_VARIABLES)
    data = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    data = data.withColumns({"cancelled": F.lit(0), "diverted": F.lit(0)})
    matrix = {(r.variable_x, r.variable_y): r.correlation for r in metrics.correlation_matrix(data).collect()}
    assert len(matrix) == 169
    assert all(matrix[names[0], other] is None for other in names)
    assert matrix[names[1], names[1]] == 1.0


FLIGHT = "fl_date date, op_unique_carrier string, origin string, dest string, crs_dep_time int, " \
         "crs_arr_time int, crs_elapsed_time double, cancelled int, diverted int, arr_delay double"


def days(spark):
    rows = []
    for day in range(1, 12):
        for n in range(day % 4 + 1):
            late = float((day * 7 + n * 5) % 3 - 1)
            rows.append((dt.date(2024, 3, day), f"C{n % 2}", f"A{n}", f"A{(n + 1) % 3}",
                         (2300 + n) if n else 15, 130, 90.0, int(n == 3), 0, None if n == 3 else late))
    rows.append((dt.date(2024, 3, 20), None, "A0", None, None, 130, None, 0, 0, 4.0))
    return spark.createDataFrame(rows, FLIGHT), rows


def test_previous_day_rate_is_recomputed(spark):
    flights, rows = days(spark)
    result = history.add_history(flights)
    assert result.count() == len(rows)
    for row in result.select("fl_date", "global_delay_rate_1d", "global_flight_count_1d").distinct().collect():
        before = [r for r in rows if r[0] == row.fl_date - dt.timedelta(days=1)]
        known = [r for r in before if not r[7] and r[9] is not None]
        assert row.global_flight_count_1d == (len(before) or None)
        expected = sum(r[9] > 0 for r in known) / len(known) if known else None
        assert row.global_delay_rate_1d == expected


@pytest.mark.parametrize("limit", [0, 10**12])
def test_features_do_not_depend_on_the_join_strategy(spark, monkeypatch, limit):
    flights, rows = days(spark)
    expected = sorted(map(str, history.add_history(flights).collect()))
    volumes = sorted(map(str, congestion.add_schedule(flights).collect()))
    monkeypatch.setattr(attach, "BROADCAST_BYTES", limit)
    assert sorted(map(str, history.add_history(flights).collect())) == expected
    assert sorted(map(str, congestion.add_schedule(flights).collect())) == volumes
    assert len(volumes) == len(rows)


def test_neighbouring_hours_cross_midnight(spark):
    flights, _ = days(spark)
    result = congestion.add_schedule(flights.filter("origin IN ('A0', 'A1')").withColumn("origin", F.lit("X")))
    row = result.filter("fl_date = '2024-03-02' AND crs_dep_time = 15").first()
    assert row.origin_scheduled_departures_hour == 1.0
    assert row.origin_scheduled_departures_3h == 2.0


def scores(spark, ones, zeros):
    parts = [spark.range(n).select(F.lit(y).alias("label"), F.lit(s).alias("score"))
             for y, groups in ((1, ones), (0, zeros)) for n, s in groups]
    data = parts[0]
    for part in parts[1:]:
        data = data.unionByName(part)
    return data


def judged(data, threshold):
    measured = evaluate.classification_metrics(data.withColumn("threshold", F.lit(threshold)))
    return measured.first(), evaluate.business_gate(measured).first()


def test_threshold_at_the_edges_of_the_coverage(spark):
    """A tier that ends exactly on an allowed coverage counts, one row more does not."""
    for alerts, inside in ((1000, True), (4000, True), (4001, False), (999, False)):
        hits = alerts * 3 // 4
        data = scores(spark, [(hits, 0.7), (3500 - hits, 0.1)], [(alerts - hits, 0.7)])
        missing = 20_000 - data.count()
        data = data.unionByName(scores(spark, [], [(missing, 0.1)]))
        choice = business_threshold(data).first()
        measured, _ = judged(data, 0.7)
        assert (measured.alert_count, round(measured.alert_coverage * 20_000)) == (alerts, alerts)
        assert (choice.threshold == 0.7 and choice.feasible_on_validation) == inside


def test_equal_recalls_take_the_better_precision(spark):
    """Lowering the threshold adds false alerts only, so the higher one is kept."""
    data = scores(spark, [(1200, 0.8), (1800, 0.1)], [(200, 0.8), (600, 0.6), (6200, 0.05)])
    choice = business_threshold(data).first()
    measured, gate = judged(data, choice.threshold)
    assert choice.threshold == 0.8 and gate.passed
    assert measured.recall == pytest.approx(0.4)


def test_no_tier_is_good_enough(spark):
    """Late flights have the low scores: nothing is feasible, and the gate says so."""
    data = scores(spark, [(1500, 0.15)], [(n, s) for n, s in ((700, 0.9), (700, 0.7), (7100, 0.3))])
    choice = business_threshold(data).first()
    measured, gate = judged(data, choice.threshold)
    assert not choice.feasible_on_validation and choice.strategy.startswith("fallback_")
    assert not gate.passed and measured.precision == 0 and gate.violations


def test_few_alerts_are_refused_however_good(spark):
    data = scores(spark, [(480, 0.9), (520, 0.1)], [(19, 0.9), (8000, 0.1)])
    measured, gate = judged(data, 0.9)
    assert measured.alert_count == 499 and measured.precision > 0.9
    assert not gate.minimum_alert_count and gate.minimum_precision_lower_bound_95
    assert gate.violations == [schema.GATE_MESSAGES["minimum_alert_count"]]


def test_wilson_without_observations(spark):
    low, high = wilson_interval(F.lit(0), F.lit(0))
    assert tuple(spark.range(1).select(low, high).first()) == (0.0, 1.0)


def test_feature_lists():
    assert (len(schema.NUMERIC_FEATURES), len(schema.FEATURES), len(schema.HISTORY_FEATURES)) == (73, 87, 51)
    schema.assert_no_leakage(schema.FEATURES)
    with pytest.raises(ValueError):
        schema.assert_no_leakage(["distance", "arr_delay"])


def test_bad_fraction_and_empty_split(spark):
    data = spark.range(4).withColumnRenamed("id", "flight_key")
    for fraction in (0, 1.5):
        with pytest.raises(ValueError):
            sampling.sample_fraction(data, fraction)
    with pytest.raises(ValueError):
        sampling.check_split(data.withColumn("month", F.lit(3)))


REQUEST = {
    "flight_date": "2025-01-05", "month": 1, "day_of_month": 5, "day_of_week": 7,
    "op_unique_carrier": " aa ", "op_carrier_fl_num": 100, "origin": "JFK",
    "origin_state_nm": "New York", "dest": "LAX", "dest_state_nm": "California",
    "crs_dep_time": 830, "crs_arr_time": 1145, "crs_elapsed_time": 375.0, "distance": 2475.0,
}


def errors_of(spark, **changes):
    row = {**REQUEST, **changes}
    data = spark.createDataFrame(
        [tuple(row.get(n) for n in schema.request_schema().names)], schema.request_schema()
    )
    return requests.validate_requests(data).first().request_errors


@pytest.mark.parametrize("changes, expected", [
    ({}, []), ({"dest": "jfk"}, ["same_airports"]), ({"crs_dep_time": 1260}, ["invalid_clock:crs_dep_time"]),
    ({"flight_date": "05/01/2025"}, ["invalid_date"]), ({"day_of_week": 1}, ["date_weekday_mismatch"]),
    ({"month": 2}, ["date_month_or_day_mismatch"]), ({"origin": None}, ["missing_field:origin"]),
    ({"op_unique_carrier": " "}, ["empty_code:op_unique_carrier"]),
    ({"route_scheduled_flights_day": -1.0}, ["invalid_volume:route_scheduled_flights_day"]),
    ({"route_scheduled_flights_day": float("inf")}, ["invalid_volume:route_scheduled_flights_day"]),
    ({"distance": -2.0, "crs_elapsed_time": 0.0, "op_carrier_fl_num": 0},
     ["non_positive_duration", "negative_distance", "invalid_flight_number"]),
])
def test_request_errors(spark, changes, expected):
    assert errors_of(spark, **changes) == expected


def test_form_becomes_request(spark):
    form = spark.createDataFrame(
        [(dt.date(2025, 1, 5), 8, 30, 11, 45)],
        "flight_date date, departure_hour int, departure_minute int, arrival_hour int, arrival_minute int",
    )
    row = requests.from_form(form).first()
    assert (row.flight_date, row.day_of_week, row.crs_dep_time, row.crs_arr_time) == ("2025-01-05", 7, 830, 1145)


def test_request_from_json(spark, tmp_path):
    path = tmp_path / "flight.json"
    path.write_text(json.dumps(REQUEST))
    row = tables.read_requests(spark, str(path)).first()
    assert row.origin == "JFK" and row.distance == 2475.0 and row.origin_scheduled_departures_3h is None


def test_unready_model_never_publishes(spark):
    scored = spark.createDataFrame([(0.9, 6), (0.9, 0)], "delay_probability double, provided_volumes int")
    for ready in (True, False):
        decided = requests.publication_decision(
            scored, F.lit(0.5), F.lit(ready), F.array().cast("array<string>"),
            extra={"historical_context_date": F.lit("2024-12-31")},
        )
        rows = {r.provided_volumes: r for r in decided.collect()}
        assert rows[6].published_delay_alert == (True if ready else None)
        assert rows[0].published_delay_alert is None
        assert schema.MISSING_SCHEDULE in rows[0].publication_blockers
        assert all(r.publishable == (ready and bool(r.diagnostic_class) and not r.blockers)
                   for r in requests.presentation(decided).collect())


def csv_file(path, rows):
    names = list(schema.SOURCE_COLUMNS)
    lines = [",".join(names)] + [",".join(f'"{row[n]}"' for n in names) for row in rows]
    path.write_text("\n".join(lines) + '\n2024,1,2\n"open,1\n')


def test_prepare_then_analyze(spark, tmp_path):
    source, output = tmp_path / "flights.csv", scratch_path(spark, "job")
    later = {**GOOD, "month": "2", "fl_date": "2024-02-02", "arr_delay": "12.0"}
    csv_file(source, [GOOD, later, {**GOOD, "crs_dep_time": "1260"}])
    totals = prepare.prepare(spark, str(source), output)
    assert (totals.row_count, totals.valid_row_count, totals.rejected_row_count) == (5, 2, 3)
    errors = {r.error: r["count"] for r in spark.read.json(f"{output}/quality_report/by_error").collect()}
    assert errors["corrupt_csv_row"] == 2 and errors["invalid_range:crs_dep_time"] == 1
    flights = tables.read_flights(spark, f"{output}/flights")
    assert flights.count() == 2 and flights.filter("month = 2").count() == 1
    with pytest.raises(Exception):
        prepare.prepare(spark, str(source), output)
    prepare.prepare(spark, str(source), output, "append", sample_size=5)
    flights = tables.read_flights(spark, f"{output}/flights")
    assert flights.count() == 4
    analyze.analyze(flights, f"{output}/analysis")
    head = spark.read.json(f"{output}/analysis/overview").first()
    assert (head.flight_count, head.delayed_flight_count) == (4, 2)
    with pytest.raises(ValueError):
        analyze.analyze(flights, f"{output}/again", "append")


def test_metrics_snapshot_replaces_missing_or_stale_documents(spark):
    assert {r.source for r in artifacts.load_metrics(spark, None).collect()} == {"snapshot"}
    assert {r.source for r in artifacts.load_importances(spark, "/nowhere/at/all").collect()} == {"snapshot"}
    path = scratch_path(spark, "metrics")
    rows = [("document", "artifact_version", 5.0, None), ("document", "label", None, "is_delayed")]
    spark.createDataFrame(rows, artifacts.METRIC_SCHEMA).write.json(path)
    assert {r.source for r in artifacts.load_metrics(spark, path).collect()} == {"snapshot"}
    path = scratch_path(spark, "importances")
    spark.createDataFrame([("route", "1.5"), ("average_delay_minutes_7d", "2")], "feature string, importance string") \
        .write.option("header", True).csv(path)
    assert {r.source for r in artifacts.load_importances(spark, path).collect()} == {"snapshot"}
    assert artifacts.top_importances(artifacts.load_importances(spark, None)).count() == 15


def test_the_sum_of_broadcasts_is_bounded(spark, monkeypatch):
    """The smallest tables are broadcast until their sum reaches the bound; results stay the same."""
    facts = spark.range(50).selectExpr("id", "id % 5 AS a", "id % 7 AS b", "id % 3 AS c")
    tables = [
        attach.FeatureTable(spark.range(n).selectExpr(f"id AS {key}", f"id * {n} AS of_{key}"), (key,), n)
        for key, n in (("a", 5), ("b", 7), ("c", 3))
    ]
    everything = sorted(attach.attach(facts, tables).collect())
    assert attach.broadcastable(tables) == {0, 1, 2}
    row = 2 * attach.BYTES_PER_FIELD
    for total, chosen in ((14 * row, {0, 2}), (8 * row, {0, 2}), (7 * row, {2}), (0, set())):
        monkeypatch.setattr(attach, "BROADCAST_TOTAL", total)
        assert attach.broadcastable(tables) == chosen
        assert sorted(attach.attach(facts, tables).collect()) == everything
    assert attach.broadcastable([attach.FeatureTable(facts, ("a",), None)]) == set()
