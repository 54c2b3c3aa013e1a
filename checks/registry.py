"""One query per operator, over the whole given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from checks import binding
from ontime import schema
from ontime.functions import clock, outcome
from ontime.operators import (
    congestion, curve, evaluate, explorer, forest, history, metrics, model, profiles, quality, requests,
    sampling, stages,
)
from ontime.plans import analyze, dataset, evaluation, score, train
from ontime.session import materialize, scratch_path
from ontime.sources import artifacts, sinks, tables

EXPLORED = {"months": [6, 7, 8], "carriers": ["C1", "C2", "C3", "C5"], "origins": []}
SAMPLE = 0.1
EXACT_SAMPLE = 2000
LARGE_SAMPLE = 40_000
REQUESTS_IN_FILE = 1_000_000  # compressed lines are read by one task per file


def rounded(data: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Round what depends on the order of summation or on the maths library."""
    return data.withColumns({name: F.round(name, digits) + 0.0 for name in names})


def rounded_trigonometry(data: DataFrame) -> DataFrame:
    """Sines and cosines to six digits, without the decimal text that ``round`` makes of each."""
    return data.withColumns({name: F.rint(F.col(name) * 1e6) / 1e6 + 0.0 for name in TRIGONOMETRY})


def joined(data: DataFrame, *names: str) -> DataFrame:
    """Arrays as text."""
    return data.withColumns({name: F.array_join(name, "|") for name in names})


def over_flights(build):
    return lambda spark, sf_dir: build(binding.flights(spark, sf_dir))


def over_keyed_flights(build):
    return lambda spark, sf_dir: build(binding.keyed_flights(spark, sf_dir))


# --- quality ---------------------------------------------------------------


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validate(binding.raw_flights(spark, sf_dir), keep=("flight_key",))


def validated_rows(spark, sf_dir):
    return joined(validated(spark, sf_dir), "validation_errors").drop(schema.CORRUPT_COLUMN)


def valid_rows(spark, sf_dir):
    return quality.chosen_rows(validated(spark, sf_dir), True)


def rejected_rows(spark, sf_dir):
    rejected = quality.chosen_rows(validated(spark, sf_dir), False)
    return joined(rejected, "validation_errors").select(
        "flight_key", "fl_date", "op_unique_carrier", "validation_errors"
    )


def csv_corrupt_rows(spark, sf_dir):
    """Write the raw flights as CSV with some lines cut, lengthened or left open; read them back."""
    raw = binding.raw_flights(spark, sf_dir)
    columns = [
        F.col(name) if name in raw.columns else F.lit("0").alias(name)
        for name in schema.SOURCE_COLUMNS
    ]
    line = F.to_csv(F.struct(*columns), {"quote": '"', "escape": '"'})
    key = F.col("flight_key")
    damaged = (
        F.when(key % 211 == 0, F.substring_index(line, ",", 20))
        .when(key % 223 == 0, F.concat(line, F.lit(",surplus,fields")))
        .when(key % 227 == 0, F.concat(F.lit('"'), line))
        .otherwise(line)
    )
    path = scratch_path(spark, "csv")
    raw.select(damaged.alias("value")).write.option("lineSep", "\n").text(path)
    read = tables.read_flights_csv(spark, path, header=False)
    checked = quality.validate(read).select("validation_errors", "is_valid_row")
    corrupt = F.array_contains("validation_errors", "corrupt_csv_row")
    return checked.groupBy(corrupt.alias("is_corrupt")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("is_valid_row").alias("valid_rows")
    )


# --- features --------------------------------------------------------------

TRIGONOMETRY = [
    f"{name}_{f}" for name in ("month", "day_of_week", "departure_time", "arrival_time")
    for f in ("sin", "cos")
]


def calendar_features(flights: DataFrame) -> DataFrame:
    kept = ("flight_key", "fl_date", "month", "day_of_week")
    return rounded_trigonometry(dataset.with_calendar(flights, kept))


def arrival_day_offset(flights: DataFrame) -> DataFrame:
    departure = clock.minute_of_day(F.col("crs_dep_time"))
    arrival = clock.minute_of_day(F.col("crs_arr_time"))
    offset = clock.arrival_day_offset(departure, arrival, F.col("crs_elapsed_time"))
    return congestion.with_slots(flights).select(
        "flight_key", "fl_date", departure.alias("departure_minutes"),
        arrival.alias("arrival_minutes"), offset.alias("day_offset"), "departure_slot",
        "arrival_slot",
    )


def daily_history_counts(flights: DataFrame) -> DataFrame:
    legs = materialize(history.leg_days(flights))
    parts = None
    for level, (keys, _) in schema.HISTORY_LEVELS.items():
        values = [
            (F.col(name) if name in keys else F.lit(None).cast("string")).alias(name)
            for name in ("op_unique_carrier", "origin", "dest")
        ]
        part = history.daily_counts(legs, level).select(
            F.lit(level).alias("level"), "fl_date", *values, *history.MEASURES
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def rolling(level: str):
    return over_flights(lambda f: history.rolling_history(history.leg_days(f), level))


def history_joined(flights: DataFrame) -> DataFrame:
    slim = flights.select("flight_key", *history.LEG_DAY, "cancelled", "diverted", "arr_delay")
    return history.add_history(slim)


def schedule_joined(flights: DataFrame) -> DataFrame:
    slim = flights.select(
        "flight_key", *history.LEG_DAY, "crs_dep_time", "crs_arr_time", "crs_elapsed_time",
        "cancelled", "diverted", "arr_delay",
    )
    return congestion.add_schedule(slim)


def volumes(name: str):
    build, grain, _ = congestion.VOLUMES[name]
    return over_flights(lambda f: build(congestion.grain_counts(f, grain)))


def model_frame(flights: DataFrame) -> DataFrame:
    return rounded_trigonometry(dataset.model_frame(flights))


# --- samples and split -----------------------------------------------------


def labelled(flights: DataFrame) -> DataFrame:
    return flights.filter(outcome.is_completed()).withColumn(
        schema.TARGET_LABEL, outcome.is_delayed().cast("int")
    )


def deterministic_sample(flights: DataFrame) -> DataFrame:
    completed = labelled(flights)
    return sampling.sample_fraction(completed, SAMPLE).select(
        "flight_key", "fl_date", "origin", "dest", schema.TARGET_LABEL
    )


def exact_sample(size: int):
    """Whole rows, along the congruence of the unique key."""
    return over_keyed_flights(lambda flights: sampling.sample_rows(flights, size, key="row_key"))


# --- profiles and requests -------------------------------------------------


def model_rows(flights: DataFrame) -> DataFrame:
    """The completed flights with their slots and hours."""
    return congestion.with_slots(flights.filter(outcome.is_completed())).withColumns({
        "departure_hour": clock.hour_of_day(clock.minute_of_day(F.col("crs_dep_time"))),
        "arrival_hour": clock.hour_of_day(clock.minute_of_day(F.col("crs_arr_time"))),
    })


def build_profiles(flights: DataFrame) -> profiles.Profiles:
    return profiles.Profiles.build(model_rows(flights), congestion.stored_counts(flights))


def profile_inputs(flights: DataFrame, grains: tuple[str, ...]):
    """Weights of the model rows and counts of all flights at some grains."""
    return profiles.frame_weights(model_rows(flights), grains), congestion.stored_counts(flights, grains)


def history_defaults(flights: DataFrame) -> DataFrame:
    weights, counts = profile_inputs(flights, ("legs",))
    states = profiles.history_states(weights["legs"], counts["legs"])
    return rounded(profiles.history_defaults(states), *schema.HISTORY_FEATURES)


def schedule_defaults(flights: DataFrame) -> DataFrame:
    weights, counts = profile_inputs(flights, tuple(congestion.GRAINS))
    cutoff = profiles.history_cutoff(weights["legs"]).scalar()
    states = profiles.schedule_states(weights, counts)
    return profiles.schedule_defaults(states).withColumn("history_cutoff_date", cutoff)


def profile(kind: str, name: str):
    def build(flights: DataFrame) -> DataFrame:
        if kind == "schedule":
            weights, counts = profile_inputs(flights, profiles.grains_of((name,)))
            return profiles.schedule_profiles(weights, counts, (name,))[f"schedule_{name}"]
        weights, counts = profile_inputs(flights, ("legs",))
        table = profiles.history_profiles(weights, counts, (name,))[f"history_{name}"]
        return rounded(table, *schema.history_features(name))
    return over_flights(build)


REQUEST_KEYS = ("flight_key", "flight_date")


def request_features(spark, sf_dir):
    built = build_profiles(binding.flights(spark, sf_dir))
    featured = requests.request_features(binding.requests(spark, sf_dir), built)
    chosen = [*schema.SCHEDULE_FEATURES, *schema.HISTORY_FEATURES]
    others = [n for n in schema.FEATURES if n not in chosen]
    selected = featured.select(*REQUEST_KEYS, *others, *chosen)
    return rounded(selected, *TRIGONOMETRY, *schema.HISTORY_FEATURES)


def request_validation(spark, sf_dir):
    checked = requests.validate_requests(binding.requests(spark, sf_dir))
    return joined(checked, "request_errors").select(
        *REQUEST_KEYS, "op_unique_carrier", "origin", "dest", "request_errors", "is_valid_request"
    )


def schedule_context(spark, sf_dir):
    data = binding.requests(spark, sf_dir).withColumn("provided", requests.provided_volumes())
    return data.select(
        *REQUEST_KEYS, "provided",
        requests.schedule_context(F.col("provided")).alias("with_profiles"),
        requests.schedule_context(F.col("provided"), False).alias("without_profiles"),
    )


def decisions(spark, sf_dir) -> DataFrame:
    flights = binding.flights(spark, sf_dir)
    scored = flight_scores(flights)
    selection = evaluation.select_threshold(scored)
    gate = evaluation.verdict(scored, selection)
    usable = quality.where_flag(requests.validate_requests(binding.requests(spark, sf_dir)), "is_valid_request")
    candidates = usable.select(
        *REQUEST_KEYS, requests.provided_volumes().alias("provided_volumes"),
        F.expr(binding.WEAK_SCORE_SQL).alias("delay_probability"),
    )
    verdict = materialize(gate)
    cutoff = flights.filter(outcome.is_completed()).agg(F.max("fl_date").cast("string")).scalar()
    return requests.publication_decision(
        candidates, selection.select("threshold").scalar(), verdict.select("passed").scalar(),
        verdict.select("violations").scalar(), extra={"historical_context_date": cutoff},
    )


def publication_decision(spark, sf_dir):
    return joined(decisions(spark, sf_dir), "business_gate_violations", "publication_blockers")


def presentation(spark, sf_dir):
    return joined(requests.presentation(decisions(spark, sf_dir), REQUEST_KEYS), "blockers")


# --- evaluation ------------------------------------------------------------


def flight_scores(flights: DataFrame) -> DataFrame:
    return evaluation.scored_rows(labelled(flights), schema.TARGET_LABEL, "score", ("flight_key",))


def validation_scores(flights: DataFrame) -> DataFrame:
    return flight_scores(flights).filter(F.col("split") == "validation")


CURVE_COLUMNS = (
    "threshold", "alert_count", "true_positive_count", "sample_count", "positive_count",
    "precision", "recall", "alert_coverage",
)
METRIC_ROUNDED = (
    "precision_lower_95", "precision_upper_95", "recall_lower_95", "recall_upper_95",
    "log_loss", "brier_score",
)
SELECTION_ROUNDED = (
    "candidate_validation_precision_lower_bound_95", "candidate_validation_recall_lower_bound_95",
)


def pr_curve(flights: DataFrame) -> DataFrame:
    return curve.score_curve(flight_scores(flights), ["split"]).select("split", *CURVE_COLUMNS)


def f1_threshold(flights: DataFrame) -> DataFrame:
    return rounded(curve.f1_threshold(validation_scores(flights)), "best_f1")


def business_threshold(flights: DataFrame) -> DataFrame:
    return rounded(curve.business_threshold(validation_scores(flights)), *SELECTION_ROUNDED)


def business_threshold_fallback(flights: DataFrame) -> DataFrame:
    weak = validation_scores(binding.weak_scores(flights))
    return rounded(curve.business_threshold(weak), *SELECTION_ROUNDED)


def classification_metrics(flights: DataFrame) -> DataFrame:
    scored = flight_scores(flights)
    threshold = evaluation.select_threshold(scored).select("threshold").scalar()
    return rounded(
        evaluation.metrics_at(evaluation.evaluated(scored), threshold, ["split"]), *METRIC_ROUNDED
    )


def ranking_metrics(flights: DataFrame) -> DataFrame:
    scored = curve.score_curve(flight_scores(flights), ["split"])
    return rounded(curve.ranking_metrics(scored, ["split"]), "roc_auc", "average_precision")


def business_gate(flights: DataFrame) -> DataFrame:
    scored = flight_scores(flights)
    threshold = evaluation.select_threshold(scored).select("threshold").scalar()
    measured = evaluation.metrics_at(evaluation.evaluated(scored), threshold, ["split"])
    return joined(rounded(evaluate.business_gate(measured, ["split"]), *METRIC_ROUNDED[:4]), "violations")


def monthly_gate(flights: DataFrame) -> DataFrame:
    scored = flight_scores(flights)
    threshold = evaluation.select_threshold(scored).select("threshold").scalar()
    monthly = evaluation.monthly_metrics(scored, threshold)
    return joined(rounded(evaluate.business_gate(monthly, ["month"]), *METRIC_ROUNDED[:4]), "violations")


def monthly_performance(flights: DataFrame) -> DataFrame:
    scored = flight_scores(flights)
    threshold = evaluation.select_threshold(scored).select("threshold").scalar()
    monthly = evaluation.monthly_metrics(scored, threshold)
    return evaluate.long_metrics(monthly, ["month"], ["precision", "recall", "alert_coverage"])


def overall_gate(flights: DataFrame) -> DataFrame:
    scored = flight_scores(flights)
    return joined(evaluation.verdict(scored, evaluation.select_threshold(scored)), "violations")


def test_baselines(flights: DataFrame) -> DataFrame:
    return evaluate.baselines(flight_scores(flights).filter(F.col("split") == "test"))


def threshold_comparison(flights: DataFrame) -> DataFrame:
    scored = flight_scores(flights)
    compared = evaluation.compare_thresholds(scored, evaluation.select_threshold(scored))
    return evaluate.long_metrics(
        compared, ["split", "threshold_name"], ["precision", "recall", "alert_coverage", "f1"]
    )


def confusion_long(flights: DataFrame) -> DataFrame:
    scored = flight_scores(flights)
    threshold = evaluation.select_threshold(scored).select("threshold").scalar()
    measured = evaluation.metrics_at(evaluation.evaluated(scored), threshold, ["split"])
    return evaluate.confusion_rows(measured, ["split"])


# --- model -----------------------------------------------------------------

# Fewer and smaller trees than the train job has by default, to keep the comparison short.
CHECK_TREES = model.TreeSettings(iterations=40, depth=5, learning_rate=0.1, patience=15, min_rows=200)


def train_rows(flights: DataFrame) -> DataFrame:
    return dataset.with_calendar(
        sampling.with_split(labelled(flights)), ("flight_key", schema.TARGET_LABEL, "split")
    ).filter(F.col("split") == "train")


def category_encodings(flights: DataFrame) -> DataFrame:
    return rounded(model.category_encodings(train_rows(flights)), "rate", digits=9).drop("fold_rates")


def trained(flights: DataFrame):
    frame = materialize(sampling.with_split(dataset.model_frame(flights)))
    return frame, model.fit(frame, CHECK_TREES)


def saved_nodes(spark, fitted) -> DataFrame:
    folder = scratch_path(spark, "trees")
    fitted.trees.write().save(folder)
    return forest.forest_nodes(spark, folder)


def with_walk(scored: DataFrame, rows: DataFrame, fitted, key: str) -> DataFrame:
    """``scored`` with matches_nodes: whether walking the saved nodes gives the same probability."""
    vectors = materialize(
        model.assemble(model.encode(model.packed(rows), fitted.encodings, fitted.prior)).select(key, "features")
    )
    walked = forest.walked_scores(
        vectors, saved_nodes(rows.sparkSession, fitted), [key], fitted.trees.getNumTrees, CHECK_TREES.depth
    )
    same = F.abs(F.col("delay_probability") - F.col("walked_probability")) < 1e-9
    return scored.join(walked, key, "left").withColumn("matches_nodes", F.coalesce(same, F.lit(False)))


def trained_scores(flights: DataFrame) -> DataFrame:
    """Every validation and test flight once, with a probability that walking the saved nodes gives too."""
    frame, fitted = trained(flights)
    rows = materialize(frame.filter(F.col("split").isin(*evaluation.EVALUATED)).withColumn("_row", F.monotonically_increasing_id()))
    scored = with_walk(fitted.score(rows), rows, fitted, "_row")
    usable = F.col("delay_probability").isNotNull() & F.col("delay_probability").between(0, 1)
    return scored.select(
        "flight_key", "split", schema.TARGET_LABEL, usable.alias("is_probability"), "matches_nodes",
    )


def scored_requests(spark, sf_dir):
    """Decisions on requests from a saved and loaded bundle; probabilities compared with its nodes."""
    folder = scratch_path(spark, "bundle")
    train.save(spark, train.train(binding.flights(spark, sf_dir), settings=CHECK_TREES), folder)
    wanted = materialize(binding.requests(spark, sf_dir).withColumn("_row", F.monotonically_increasing_id()))
    decisions = score.score(spark, folder, wanted, keep=("_row", "flight_key"))
    fitted, built, _ = artifacts.load_bundle(spark, folder)
    rows = requests.request_features(wanted, built)
    return with_walk(decisions, rows, fitted, "_row").select(
        "flight_key", "flight_date", "provided_volumes", "schedule_context_source", "matches_nodes",
        F.col("delay_probability").between(0, 1).alias("is_probability"),
    )


def staged_auc(flights: DataFrame) -> DataFrame:
    """AUC of twelve prefixes, each adding another part of the key to the score."""
    margins = F.array(*[
        (F.round(F.col("score") * 10_000) * i + F.pmod(F.col("flight_key") * (31 + i), F.lit(20_000))).cast("double")
        for i in range(1, 13)
    ])
    rows = labelled(flights).select(F.col(schema.TARGET_LABEL).alias("label"), margins.alias("margins"))
    return rounded(stages.staged_auc(rows, 1, 12), "roc_auc", "average_precision")


def model_contract(spark, sf_dir):
    """Rows per part, what the importances add up to, and whether the model beats chance on the test."""
    frame, fitted = trained(binding.flights(spark, sf_dir))
    parts = frame.groupBy(F.concat(F.lit("rows:"), "split").alias("figure")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    weights = fitted.importances(spark).agg(
        F.count(F.lit(1)).cast("double").alias("features"), F.round(F.sum("importance"), 6).alias("importance"),
    ).unpivot([], ["features", "importance"], "figure", "value")
    tested = evaluation.scored_rows(
        fitted.score(frame.filter("split = 'test'")), schema.TARGET_LABEL, "delay_probability"
    )
    ranked = curve.ranking_metrics(curve.score_curve(tested, ["split"]), ["split"])
    better = ranked.select(F.lit("better_than_chance").alias("figure"), (F.col("roc_auc") > 0.5).cast("double").alias("value"))
    return parts.unionByName(weights).unionByName(better)


def oof_encodings(flights: DataFrame) -> DataFrame:
    """Rates of all levels of all categories without each fold, the fold being the key modulo the folds."""
    rates = model.category_encodings(train_rows(flights), fold=F.pmod("flight_key", F.lit(model.FOLDS)).cast("int"))
    return rounded(
        rates.select("category", "level", F.posexplode("fold_rates").alias("fold", "rate")), "rate", digits=9
    )


def feature_importance(spark, sf_dir):
    """All features; whether each importance is what the saved nodes sum up to, and whether all make 100."""
    _, fitted = trained(binding.flights(spark, sf_dir))
    summed = forest.summed_importances(saved_nodes(spark, fitted)).withColumnRenamed("importance", "summed")
    both = fitted.importances(spark).join(summed, "feature")
    return both.select(
        "feature", (F.abs(F.col("importance") - F.col("summed")) < 1e-9).alias("matches_nodes"),
        (F.abs(F.sum("summed").over(Window.partitionBy(F.lit(1))) - 100) < 1e-6).alias("sums_to_100"),
    )


# --- sources and sinks -----------------------------------------------------


def parquet_roundtrip(spark, sf_dir):
    """Prepare into fresh folders, then count the clean rows by month and the quarantine."""
    folder = scratch_path(spark, "prepared")
    sinks.write_prepared(quality.validate(binding.raw_flights(spark, sf_dir)), folder)
    clean = tables.read_flights(spark, f"{folder}/flights").groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("rows")
    )
    rejects = tables.read_flights(spark, f"{folder}/rejects").agg(F.count(F.lit(1)).alias("rows"))
    return clean.select("year", "month", F.lit("clean").alias("part"), "rows").unionByName(
        rejects.select(
            F.lit(None).cast("int").alias("year"), F.lit(None).cast("int").alias("month"),
            F.lit("rejected").alias("part"), "rows",
        )
    )


def prepared_rows(spark, sf_dir):
    """Every value of the clean rows as written by month and read back."""
    folder = scratch_path(spark, "prepared")
    sinks.write_prepared(validated(spark, sf_dir), folder)
    return tables.read_flights(spark, f"{folder}/flights")


def prepared_modes(spark, sf_dir):
    """Rows that are there after writing once, again by appending, again by overwriting, and after a refused write."""
    checked, folder = materialize(validated(spark, sf_dir)), scratch_path(spark, "prepared")
    found = []
    for step, mode in enumerate(("errorifexists", "append", "overwrite", "errorifexists")):
        try:
            sinks.write_prepared(checked, folder, mode)
            written = True
        except AnalysisException:
            written = False
        both = tables.read_flights(spark, f"{folder}/flights").select(F.lit("clean").alias("part")).unionByName(
            tables.read_flights(spark, f"{folder}/rejects").select(F.lit("rejected").alias("part"))
        )
        found.append(materialize(both.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))).select(
            F.lit(step).alias("step"), F.lit(mode).alias("mode"), F.lit(written).alias("written"), "part", "rows"
        ))
    return reduce(DataFrame.unionByName, found)


def importance_documents(spark, sf_dir):
    """Importances by document: one of this table, one with a feature of old name, one with a broken number, none."""
    strength = materialize(metrics.correlation_with_delay(binding.flights(spark, sf_dir)).select(
        F.col("variable").alias("feature"), F.round("absolute_correlation", 6).alias("importance")
    ))
    old = strength.withColumn("feature", F.when(F.col("feature") == "distance", "origin_average_delay_minutes").otherwise(F.col("feature")))
    broken = strength.withColumn("importance", F.when(F.col("feature") == "distance", "n/a").otherwise(F.col("importance").cast("string")))
    folder = scratch_path(spark, "importances")
    for name, data in (("local", strength), ("old", old), ("broken", broken)):
        sinks.write_report(data, f"{folder}/{name}")
    cases = [
        rounded(artifacts.load_importances(spark, f"{folder}/{name}"), "importance").select(F.lit(name).alias("document"), "*")
        for name in ("local", "old", "broken", "missing")
    ]
    return reduce(DataFrame.unionByName, cases)


def loaded_bundle(spark, sf_dir):
    """A bundle without trees, saved and loaded: its encodings and its profiles come from the flights."""
    flights, folder = binding.flights(spark, sf_dir), scratch_path(spark, "bundle")
    rates = model.category_encodings(train_rows(flights))
    untrained = model.DelayModel(rates, 0.5, None, 0.5)
    artifacts.save_bundle(spark, folder, untrained, build_profiles(flights), {})
    return artifacts.load_bundle(spark, folder)


def bundle_encodings(spark, sf_dir):
    loaded, _, _ = loaded_bundle(spark, sf_dir)
    return rounded(loaded.encodings, "rate", digits=9).drop("fold_rates")


def bundle_profile(spark, sf_dir):
    _, built, _ = loaded_bundle(spark, sf_dir)
    return rounded(built.tables["history_route"], *schema.history_features("route"))


def report_sinks(spark, sf_dir):
    """Write all nine reports, read them back, and give their cells as (report, key, metric, value)."""
    flights, folder = binding.flights(spark, sf_dir), scratch_path(spark, "reports")
    made = analyze.reports(flights)
    sinks.write_reports(made, folder, "errorifexists")
    cells = None
    for name, table, kind in made:
        reader = spark.read.schema(table.schema)
        read = reader.json(f"{folder}/{name}") if kind == "json" else reader.option("header", True).csv(f"{folder}/{name}")
        keys = REPORT_KEYS[name]
        values = [n for n in table.columns if n not in keys]
        key = F.concat_ws("~", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("")
        doubles = read.select(key.alias("key"), *[(F.round(F.col(n).cast("double"), 4) + 0.0).alias(n) for n in values])
        part = doubles.unpivot(["key"], values, "metric", "value").filter("value is not null").select(
            F.lit(name).alias("report"), "key", "metric", "value"
        )
        cells = part if cells is None else cells.unionByName(part)
    return cells


# Columns that name the rows of each report.
REPORT_KEYS = {
    "overview": [], "flight_status": ["flight_status"], "missing_values": ["column"], "monthly_metrics": ["month"],
    "carrier_metrics": ["op_unique_carrier"], "origin_metrics": ["origin"], "numeric_summary": ["variable"],
    "correlations/matrix": ["variable_x", "variable_y"], "correlations/with_arrival_delay": ["variable"],
}


def request_json(spark, sf_dir):
    """Requests with numbers in several spellings, written as JSON lines, read back and checked."""
    path = scratch_path(spark, "requests")
    given = binding.requests(spark, sf_dir)
    odd = F.col("flight_key") % 10
    number = F.col("op_carrier_fl_num").cast("string")
    spelt = F.when(odd == 1, F.concat(number, F.lit(".0"))).when(odd == 2, "12.5").when(odd == 3, "many").otherwise(number)
    given.withColumns({"op_carrier_fl_num": spelt, "distance": F.col("distance").cast("string")}).drop("flight_key").write.option(
        "maxRecordsPerFile", REQUESTS_IN_FILE
    ).json(path, compression="gzip")
    checked = requests.validate_requests(tables.read_requests(spark, path))
    return joined(checked, "request_errors").select(
        "flight_date", "op_unique_carrier", "op_carrier_fl_num", "origin", "dest", "crs_dep_time",
        "crs_elapsed_time", "distance", "route_scheduled_flights_day", "request_errors",
    )


def form_requests(flights: DataFrame) -> DataFrame:
    """Requests built from form fields."""
    form = flights.filter("crs_dep_time is not null").select(
        "row_key", F.col("fl_date").alias("flight_date"), *[
            F.expr(f"CAST({name} {sign} 100 AS INT)").alias(alias)
            for name, sign, alias in (
                ("crs_dep_time", "DIV", "departure_hour"), ("crs_dep_time", "%", "departure_minute"),
                ("crs_arr_time", "DIV", "arrival_hour"), ("crs_arr_time", "%", "arrival_minute"),
            )
        ],
    )
    return requests.from_form(form)


def request_states(spark, sf_dir):
    """States by airport, for requests some of which name an unknown one."""
    given = binding.requests(spark, sf_dir).withColumn(
        "dest", F.when(F.col("flight_key") % 37 == 0, "NOWHERE").otherwise(F.col("dest"))
    )
    found = requests.with_states(given, explorer.airport_states(binding.flights(spark, sf_dir)))
    return joined(found, "unknown_airports").select(
        *REQUEST_KEYS, "origin", "dest", "origin_state_nm", "dest_state_nm", "unknown_airports"
    )


def metrics_documents(spark, sf_dir):
    """Delayed flights by document: one of this table, the same as another version, and none at all."""
    flights = labelled(binding.flights(spark, sf_dir))
    tested = evaluation.evaluate_scores(materialize(flight_scores(binding.flights(spark, sf_dir))))
    document, folder = materialize(train.metrics_document(flights, tested)), scratch_path(spark, "metrics")
    version = F.when(F.col("metric") == "artifact_version", F.col("value") + 1).otherwise(F.col("value"))
    target = F.when(F.col("metric") == "label", "another").otherwise(F.col("text"))
    for name, data in (
        ("local", document), ("stale", document.withColumn("value", version)), ("foreign", document.withColumn("text", target)),
    ):
        sinks.write_report(data, f"{folder}/{name}", kind="json")
    cases = [
        artifacts.load_metrics(spark, f"{folder}/{name}").filter("section = 'data.all' and metric = 'delayed_count'")
        .select(F.lit(name).alias("document"), "source", "value") for name in ("local", "stale", "foreign", "missing")
    ]
    return reduce(DataFrame.unionByName, cases)


def explored(flights: DataFrame) -> DataFrame:
    return explorer.filter_flights(explorer.explorer_view(flights), **EXPLORED)


EXPLORER_COLUMNS = (
    "flight_key", "fl_date", "month", "month_label", "op_unique_carrier", "op_carrier_fl_num",
    "origin", "dest", "crs_dep_time", "crs_arr_time", "arr_delay", "is_completed", "is_delayed",
    "flight_status",
)


def queries() -> dict:
    view = explorer.explorer_view
    registered = {
        "overview": over_flights(metrics.overview),
        "status_distribution": over_flights(metrics.status_distribution),
        "missing_values": over_flights(metrics.missing_values),
        "punctuality_by_month": over_flights(lambda f: metrics.punctuality(f, "month")),
        "punctuality_by_carrier": over_flights(lambda f: metrics.punctuality(f, "op_unique_carrier")),
        "punctuality_by_origin": over_flights(lambda f: metrics.punctuality(f, "origin")),
        "numeric_summary": over_flights(
            lambda f: rounded(metrics.numeric_summary(f), "mean", "stddev")
        ),
        "correlation_matrix": over_flights(
            lambda f: rounded(metrics.correlation_matrix(f), "correlation")
        ),
        "correlation_row_count": over_flights(metrics.correlation_row_count),
        "correlation_with_delay": over_flights(
            lambda f: rounded(metrics.correlation_with_delay(f), "correlation", "absolute_correlation")
        ),
        "correlation_top5": over_flights(
            lambda f: rounded(metrics.correlation_with_delay(f).limit(5), "correlation", "absolute_correlation")
        ),
        "validated_rows": validated_rows,
        "valid_rows": valid_rows,
        "rejected_rows": rejected_rows,
        "quality_global": lambda s, d: quality.quality_totals(validated(s, d)),
        "quality_by_error": lambda s, d: quality.error_histogram(validated(s, d)),
        "csv_corrupt_rows": csv_corrupt_rows,
        "calendar_features": over_flights(calendar_features),
        "arrival_day_offset": over_flights(arrival_day_offset),
        "daily_history_counts": over_flights(daily_history_counts),
        "history_features_joined": over_flights(history_joined),
        "hourly_departures_3h": volumes("origin"),
        "hourly_arrivals_3h": volumes("dest"),
        "route_daily_load": volumes("route"),
        "carrier_origin_daily_load": volumes("carrier_origin"),
        "schedule_features_joined": over_flights(schedule_joined),
        "model_frame": over_flights(model_frame),
        "deterministic_sample": over_flights(deterministic_sample),
        "exact_sample": exact_sample(EXACT_SAMPLE),
        "exact_sample_large": exact_sample(LARGE_SAMPLE),
        "temporal_split_summary": over_flights(lambda f: sampling.split_summary(labelled(f))),
        "history_defaults": over_flights(history_defaults),
        "schedule_defaults": over_flights(schedule_defaults),
        "explorer_filtered": over_flights(lambda f: explored(f).select(*EXPLORER_COLUMNS)),
        "explorer_kpis": over_flights(lambda f: explorer.indicators(explored(f))),
        "explorer_monthly": over_flights(lambda f: explorer.monthly_rates(view(f))),
        "explorer_top_carriers": over_flights(lambda f: explorer.top_groups(view(f), "op_unique_carrier")),
        "explorer_status_counts": over_flights(lambda f: explorer.status_counts(view(f))),
        "filter_options": over_flights(explorer.filter_options),
        "delay_histogram": over_flights(lambda f: explorer.delay_histogram(view(f))),
        "airport_state": over_flights(explorer.airport_states),
        "request_features": request_features,
        "request_validation": request_validation,
        "request_json": request_json,
        "schedule_context": schedule_context,
        "publication_decision": publication_decision,
        "presentation": presentation,
        "pr_curve": over_flights(pr_curve),
        "f1_threshold": over_flights(f1_threshold),
        "business_threshold": over_flights(business_threshold),
        "business_threshold_fallback": over_flights(business_threshold_fallback),
        "classification_metrics": over_flights(classification_metrics),
        "ranking_metrics": over_flights(ranking_metrics),
        "business_gate": over_flights(business_gate),
        "monthly_gate": over_flights(monthly_gate),
        "monthly_performance": over_flights(monthly_performance),
        "overall_gate": over_flights(overall_gate),
        "baselines": over_flights(test_baselines),
        "threshold_comparison": over_flights(threshold_comparison),
        "confusion_long": over_flights(confusion_long),
        "category_encodings": over_flights(category_encodings),
        "trained_scores": over_flights(trained_scores),
        "scored_requests": scored_requests,
        "staged_auc": over_flights(staged_auc),
        "feature_importance": feature_importance,
        "model_contract": model_contract,
        "oof_encodings": over_flights(oof_encodings),
        "form_requests": over_keyed_flights(form_requests),
        "request_states": request_states,
        "metrics_documents": metrics_documents,
        "parquet_roundtrip": parquet_roundtrip,
        "prepared_rows": prepared_rows,
        "prepared_modes": prepared_modes,
        "importance_documents": importance_documents,
        "bundle_encodings": bundle_encodings,
        "bundle_profile": bundle_profile,
        "report_sinks": report_sinks,
    }
    for level in schema.HISTORY_LEVELS:
        registered[f"rolling_{level}"] = rolling(level)
        registered[f"history_profile_{level}"] = profile("history", level)
    for name in schema.SCHEDULE_PROFILES:
        registered[f"schedule_profile_{name}"] = profile("schedule", name)
    return registered
