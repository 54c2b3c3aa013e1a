"""What keeps the work of a query in proportion to its rows."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import binding
from checks.registry import validated
from ontime import schema
from ontime.operators import quality, requests
from ontime.session import materialize, scratch_path, with_settings
from ontime.sources import sinks


def plan(data) -> str:
    return data._jdf.queryExecution().optimizedPlan().toString()


def whole_plan(data) -> str:
    """The plan with all its columns, however many."""
    conf, name = data.sparkSession.conf, "spark.sql.debug.maxToStringFields"
    before = conf.get(name)
    conf.set(name, "10000")
    try:
        return plan(data)
    finally:
        conf.set(name, before)


def test_flights_are_not_sorted_unless_their_number_is_read(spark, sf_dir):
    assert "Window" in plan(binding._flights_view(spark, sf_dir))
    assert "Window" not in plan(binding._flights_view(spark, sf_dir).drop("row_key"))
    flights, keyed = binding.flights(spark, sf_dir), binding.keyed_flights(spark, sf_dir)
    assert set(keyed.columns) - set(flights.columns) == {"row_key"}
    assert keyed.drop("row_key").exceptAll(flights).isEmpty() and flights.count() == keyed.count()


def test_raw_flights_are_read_without_storing_them(spark, sf_dir):
    assert "lineitem" in "".join(binding.raw_flights(spark, sf_dir).inputFiles())


@pytest.mark.parametrize("keep_valid", [True, False])
def test_the_rules_run_once_for_chosen_rows(spark, sf_dir, keep_valid):
    rows = quality.chosen_rows(validated(spark, sf_dir), keep_valid)
    filters = [line for line in plan(rows).splitlines() if "Filter" in line]
    assert filters and not any("RLIKE" in line or "cancelled" in line for line in filters)


def test_the_rules_run_once_for_usable_requests(spark, sf_dir):
    checked = requests.validate_requests(binding.requests(spark, sf_dir))
    usable = requests.request_features(binding.requests(spark, sf_dir), None)
    filters = [line for line in plan(usable).splitlines() if "Filter" in line]
    assert filters and not any("invalid_clock" in line for line in filters)
    assert usable.count() == checked.filter("is_valid_request").count()


def test_stored_rows_are_written_by_month_without_storing_them_again(spark, sf_dir, monkeypatch):
    checked = materialize(validated(spark, sf_dir))
    monkeypatch.setattr(sinks, "materialize", lambda data: pytest.fail("stored again"))
    folder = scratch_path(spark, "prepared")
    totals = sinks.write_prepared(checked, folder)
    written = spark.read.parquet(f"{folder}/flights")
    assert written.count() == totals.valid_row_count == checked.filter("is_valid_row").count()
    months = {r["month"] for r in checked.filter("is_valid_row").select("month").distinct().collect()}
    held = {p.name for p in Path(f"{folder.removeprefix('file:')}/flights").glob("year=2024/month=*")}
    assert held == {f"month={m}" for m in months}
    tasks = checked.rdd.getNumPartitions()
    assert len(list(Path(folder.removeprefix("file:")).glob("flights/*/*/*.parquet"))) <= tasks * len(months)


def test_profiles_are_summed_from_tables_without_both_hours(spark, sf_dir):
    """A table with the hours of both ends has nearly one row per flight and grows with the facts."""
    from checks import registry
    from ontime.functions import outcome
    from ontime.operators import congestion, profiles

    flights = binding.flights(spark, sf_dir)
    counts, weights = congestion.stored_counts(flights), profiles.frame_weights(registry.model_rows(flights))
    for table in (*counts.values(), *weights.values()):
        assert not {"departure_slot", "arrival_slot"} <= set(table.columns)
    planned = flights.filter(outcome.is_planned()).count()
    assert {t.agg(F.sum("planned").alias("n")).first().n for t in counts.values()} == {planned}
    completed = flights.filter(outcome.is_completed()).count()
    assert {t.agg(F.sum("weight").alias("n")).first().n for t in weights.values()} == {completed}
    assert profiles.grains_of(("origin",)) == ("departures",) and profiles.grains_of(("route", "carrier_origin")) == ("legs",)


def test_the_model_frame_counts_no_pair_of_hours(spark, sf_dir, monkeypatch):
    from ontime.operators import congestion
    from ontime.plans import dataset

    stored, store = {}, congestion.materialize_all
    monkeypatch.setattr(congestion, "materialize_all", lambda frames: stored.update(frames) or store(frames))
    dataset.model_frame(binding.flights(spark, sf_dir))
    assert set(stored) == set(congestion.GRAINS)
    assert not any({"departure_slot", "arrival_slot"} <= set(frame.columns) for frame in stored.values())


def joins_of_the_facts(data) -> int:
    """Joins that the rows of the leftmost table pass through."""
    node, joins = data._jdf.queryExecution().optimizedPlan(), 0
    while node.children().nonEmpty():
        joins += node.nodeName() == "Join"
        node = node.children().head()
    return joins


def test_rows_of_the_model_frame_pass_one_join_for_all_features_of_a_leg(spark, sf_dir):
    """The others are the hours of departure and arrival; each join copies the row as wide as it is by then."""
    from ontime.plans import dataset

    assert joins_of_the_facts(dataset.model_frame(binding.flights(spark, sf_dir))) == 3


def test_features_joined_at_a_shared_grain_are_those_joined_one_by_one(spark):
    from ontime.operators.attach import FeatureTable, attach

    keys = [(1, "a", None), (1, "a", "x"), (None, "a", "x"), (2, None, "y"), (2, "b", "y"), (None, None, None)]
    facts = spark.createDataFrame([(i, *key, i % 5) for i, key in enumerate(keys * 4)], "n int, day int, origin string, dest string, hour int")
    tables = [
        FeatureTable(spark.createDataFrame([(1, 1.0), (2, 2.0)], "day int, of_day double"), ("day",), 2),
        FeatureTable(spark.createDataFrame([(1, "a", 3.0), (2, None, 9.0)], "day int, origin string, of_origin double"), ("day", "origin"), 2),
        FeatureTable(spark.createDataFrame([(2, "y", 4.0), (1, None, 9.0)], "day int, dest string, of_dest double"), ("day", "dest")),
        FeatureTable(spark.createDataFrame([("a", 3, 5.0)], "origin string, hour int, of_hour double"), ("origin", "hour"), 1),
    ]
    one_by_one, shared = attach(facts, tables), attach(facts, tables, facts.select("day", "origin", "dest").distinct())
    assert shared.columns == one_by_one.columns and joins_of_the_facts(shared) < joins_of_the_facts(one_by_one)
    assert shared.count() == facts.count() and shared.exceptAll(one_by_one).isEmpty()


def test_sines_are_rounded_as_round_does(spark):
    from checks import registry
    from ontime.functions import clock

    data = spark.range(1440).select(*[value.alias(name) for name, value in zip(registry.TRIGONOMETRY, [
        angle for period in (12, 7, 1440, 1440) for angle in clock.cyclic(F.col("id"), period)])])
    assert registry.rounded_trigonometry(data).collect() == registry.rounded(data, *registry.TRIGONOMETRY).collect()
    assert "round(" not in whole_plan(registry.rounded_trigonometry(data))


def test_wide_projections_are_compiled(spark):
    with_settings(spark)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 12


def test_walking_the_nodes_moves_no_rows(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    from ontime.operators import forest

    rows = spark.range(400).selectExpr("id % 40 AS key", "CAST(id % 7 AS DOUBLE) AS a", "CAST(id % 7 > 3 AS DOUBLE) AS y")
    vectors = VectorAssembler(inputCols=["a"], outputCol="features").transform(rows)
    fitted, folder = GBTClassifier(labelCol="y", maxIter=2, maxDepth=2).fit(vectors), scratch_path(spark, "trees")
    fitted.write().save(folder)
    walked = forest.walked_scores(vectors, forest.forest_nodes(spark, folder), ["key"], 2, 2)
    assert walked.count() == 400
    executed = walked._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in executed and "Generate" not in executed


def test_a_row_carries_one_rate_per_category(spark):
    from ontime.operators import model

    rates = spark.createDataFrame([("c", "a", 9, 0.5, [0.1, 0.2, 0.3, 0.4, 0.6])], "category string, level string, rows long, rate double, fold_rates array<double>")
    rows = spark.createDataFrame([(1, "a", 1), (2, "a", None), (3, "b", 4), (4, "a", 4)], "key int, c string, f int")
    encoded = model.encode(rows, rates, 0.7, ("c",), F.col("f"))
    assert {r["key"]: r["c_rate"] for r in encoded.collect()} == {1: 0.2, 2: 0.5, 3: 0.7, 4: 0.6}
    assert {r["c_rate"] for r in model.encode(rows, rates, 0.7, ("c",)).collect()} == {0.5, 0.7}
    joins = [line for line in plan(encoded).splitlines() if line.lstrip(" :+-").startswith("Join")]
    assert joins and all("_fold" in line for line in joins)


def feature_rows(spark, rows: int):
    """Rows with every feature, the numbers missing in some, and rates of the levels of the first category."""
    numbers = [F.when(F.col("id") % 5 != i % 5, F.col("id") * 1.5 + i).alias(n) for i, n in enumerate(schema.NUMERIC_FEATURES)]
    levels = [F.concat(F.lit("l"), F.col("id") % 3).alias(n) for n in schema.CATEGORY_FEATURES]
    frame = spark.range(rows).select(
        F.col("id").alias("flight_key"), *numbers, *levels, (F.col("id") % 2).cast("int").alias(schema.TARGET_LABEL)
    )
    rates = spark.createDataFrame(
        [(c, f"l{i}", 9, 0.1 * i + place, [0.5] * 5) for place, c in enumerate(schema.CATEGORY_FEATURES) for i in range(2)],
        "category string, level string, rows long, rate double, fold_rates array<double>",
    )
    return frame, rates


def test_joins_of_rates_pass_the_numbers_as_one_value(spark, monkeypatch):
    """Each of the fourteen joins copied some ninety columns, in a method too long to be compiled."""
    from ontime.operators import model

    def joined(node) -> list[int]:
        own = [node.output().size()] if node.nodeName() == "Join" else []
        return own + [n for i in range(node.children().size()) for n in joined(node.children().apply(i))]

    with_settings(spark)
    assert int(spark.conf.get("spark.sql.codegen.maxFields")) < len(schema.NUMERIC_FEATURES)
    frame, rates = feature_rows(spark, 30)
    stored = materialize(frame)
    monkeypatch.setattr(model, "materialize", lambda data: data)
    for fold in (None, model.fold_of("flight_key")):
        widths = joined(model._vectors(stored, rates, 0.7, fold)._jdf.queryExecution().optimizedPlan())
        assert len(widths) == len(schema.CATEGORY_FEATURES) and max(widths) < 40


def test_packed_rows_give_the_vectors_of_their_columns(spark):
    from pyspark.errors import PySparkException
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from ontime.operators import model

    frame, rates = feature_rows(spark, 30)
    vectors = model.assemble(model.encode(model.packed(frame), rates, 0.7))
    assert set(vectors.columns) == {*frame.columns, *map(model.encoded_name, schema.CATEGORY_FEATURES), "features"}
    filled = model.encode(frame, rates, 0.7).withColumns({
        n: F.coalesce(F.col(n).cast("double"), F.lit(model.MISSING_NUMBER)) for n in schema.NUMERIC_FEATURES
    })
    wanted = VectorAssembler(inputCols=model.INPUTS, outputCol="features").transform(filled)
    both = [{r[0]: r[1] for r in v.select("flight_key", vector_to_array("features")).collect()} for v in (vectors, wanted)]
    assert both[0] == both[1] and len(both[0]) == 30
    broken = frame.withColumn("distance", F.when(F.col("flight_key") == 7, float("nan")).otherwise(F.col("distance")))
    with pytest.raises(PySparkException, match="NaN"):
        model.assemble(model.encode(model.packed(broken), rates, 0.7)).select("features").collect()


def test_requests_read_each_number_once(spark, sf_dir, tmp_path):
    """What is null is told from the number that was read, not from reading it a second time."""
    from ontime.sources import tables

    path = f"file:{tmp_path}/requests"
    spark.createDataFrame([('{"crs_dep_time": "12.5", "distance": "1e3"}',), ('{"crs_dep_time": "12.0", "distance": "1d"}',)], "value string") \
        .write.text(path)
    read = tables.read_requests(spark, path)
    assert sorted((r.crs_dep_time, r.distance, tuple(r.invalid_numbers)) for r in read.filter("crs_dep_time is not null").collect()) == [
        (12, None, ("distance",))]
    assert [r.distance for r in read.filter("crs_dep_time is null").collect()] == [1000.0]
    assert whole_plan(read).count("RLIKE") == len([f for f in read.schema if f.dataType.typeName() in ("integer", "double")])


def test_written_requests_take_a_fraction_of_their_text(spark, tmp_path, monkeypatch):
    """The lines repeat every field name; as plain text they took ten times the disk of the flights."""
    from checks import registry

    rows = spark.range(1, 2001).selectExpr(
        "id AS l_orderkey", "id * 7 % 200 AS l_partkey", "id * 3 % 10 AS l_suppkey", "1 AS l_linenumber",
        "CAST(id % 50 AS DOUBLE) AS l_quantity", "DATE_ADD(DATE '1995-01-01', CAST(id % 365 AS INT)) AS l_shipdate",
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(registry, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    checked = registry.request_json(spark, str(tmp_path))
    written = list((tmp_path / "requests").glob("part-*"))
    lines = binding.requests(spark, str(tmp_path)).drop("flight_key").select(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0]
    assert checked.count() == 2000 and spark.read.text(f"{tmp_path}/requests").count() == 2000
    assert sum(p.stat().st_size for p in written) < lines / 3


def test_corrupt_rows_are_counted_without_storing_the_typed_rows(spark, sf_dir, monkeypatch):
    from checks import registry
    from ontime import schema

    monkeypatch.setattr(registry, "materialize", lambda data: pytest.fail("stored"))
    counted = registry.csv_corrupt_rows(spark, sf_dir)
    assert whole_plan(counted).count("RLIKE") == len(schema.TYPED_COLUMNS) and {r.is_corrupt for r in counted.collect()} == {True, False}


def test_rules_make_no_array_of_all_rules(spark, sf_dir):
    assert "lambda" not in whole_plan(validated(spark, sf_dir))


def test_numbers_and_dates_are_read_as_before(spark):
    from ontime.functions import text

    old_float = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
    odd = ["", "12", "12.0", "12.", "12.5", "+5", "-", ".0", "0.00", "2147483648", "\t12", "12\n", "12\n\n", "12d", "0x1", "1e3", "1.e-3",
           ".5E+7", "1e", "1e3.", "NaN", "--1", "1-", "2024-02-29", "2023-02-29", "2024-2-9", "0000-01-01", "12024-01-01", "2024-01-1T",
           "2024-01-01\n", "2024-01-01T00", "2024", "٢٠٢٤-01-01", "2024-00-10", "-2024-01-01", "1000-01-01"]
    value = F.col("t")
    read = spark.createDataFrame([(t,) for t in odd], "t string").select(
        text.to_integer(value).alias("i"), F.when(value.rlike(r"^[+-]?\d+(?:\.0+)?$"), value.try_cast("double").try_cast("int")).alias("old_i"),
        text.to_float(value).alias("f"), F.when(value.rlike(old_float), value.try_cast("double")).alias("old_f"),
        text.to_date(value).cast("string").alias("d"), F.when(value != "", F.try_to_date(value, text.DATE_FORMAT)).cast("string").alias("old_d"),
    )
    rows = read.collect()
    assert all(r.i == r.old_i and r.f == r.old_f and r.d == r.old_d for r in rows) and len({r.d for r in rows}) > 2
