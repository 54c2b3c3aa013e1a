"""Descriptive tables: overview, statuses, missing values, punctuality, summary, correlations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ontime import schema
from ontime.functions import clock, outcome
from ontime.functions.ratios import percentage
from ontime.operators.ranks import exact_quantiles, value_counts
from ontime.session import materialize


def overview(flights: DataFrame) -> DataFrame:
    """One row of headline figures.

    Flights are first reduced to one row per distinct arrival delay; the totals and the exact
    percentiles both come from that small table, which is stored: the flights are read once.
    """
    flown = outcome.is_completed()
    by_delay = materialize(flights.groupBy(F.when(flown, F.col("arr_delay")).alias("delay")).agg(
        F.count(F.lit(1)).alias("flights"),
        F.count_if(flown).alias("completed"),
        F.count_if(outcome.is_delayed()).alias("delayed"),
        F.count_if(F.col("cancelled") == 1).alias("cancelled"),
        F.count_if(F.col("diverted") == 1).alias("diverted"),
        F.sum("dep_delay").alias("departure_delay"),
        F.count("dep_delay").alias("departures"),
    ))
    totals = by_delay.agg(
        F.coalesce(F.sum("flights"), F.lit(0)).alias("flight_count"),
        F.sum("completed").alias("completed_flight_count"),
        F.sum("delayed").alias("delayed_flight_count"),
        F.sum("cancelled").alias("cancelled_flight_count"),
        F.sum("diverted").alias("diverted_flight_count"),
        F.try_divide(F.sum(F.col("delay") * F.col("completed")), F.sum("completed"))
        .alias("average_arrival_delay_minutes"),
        F.max("delay").alias("maximum_arrival_delay_minutes"),
        F.try_divide(F.sum("departure_delay"), F.sum("departures"))
        .alias("average_departure_delay_minutes"),
    )
    quantiles = exact_quantiles(
        by_delay.filter(F.col("delay").isNotNull()).select("delay", "completed"),
        {"median": 0.5, "p90": 0.9}, value="delay", weight="completed",
    ).select(F.struct("median", "p90")).scalar()
    return totals.select(
        "flight_count", "completed_flight_count", "delayed_flight_count",
        "cancelled_flight_count", "diverted_flight_count", "average_arrival_delay_minutes",
        quantiles.getField("median").alias("median_arrival_delay_minutes"),
        quantiles.getField("p90").alias("p90_arrival_delay_minutes"),
        "maximum_arrival_delay_minutes", "average_departure_delay_minutes",
        percentage(F.col("delayed_flight_count"), F.col("completed_flight_count"))
        .alias("delayed_flight_percentage"),
        percentage(F.col("cancelled_flight_count"), F.col("flight_count"))
        .alias("cancelled_flight_percentage"),
        percentage(F.col("diverted_flight_count"), F.col("flight_count"))
        .alias("diverted_flight_percentage"),
    )


def status_distribution(flights: DataFrame) -> DataFrame:
    """Flights per status with their share; the total is the sum of at most five rows."""
    counts = flights.groupBy(outcome.status().alias("flight_status")).agg(
        F.count(F.lit(1)).alias("flight_count")
    )
    total = F.sum("flight_count").over(Window.partitionBy())
    return counts.select(
        "flight_status", "flight_count",
        percentage(F.col("flight_count"), total).alias("flight_percentage"),
    ).orderBy(F.desc("flight_count"), "flight_status")


def missing_values(data: DataFrame) -> DataFrame:
    """Missing values per column: one aggregate row, turned into one row per column."""
    rows = F.count(F.lit(1))
    wide = data.agg(
        rows.alias("_rows"), *[(rows - F.count(F.col(name))).alias(name) for name in data.columns]
    )
    long = wide.unpivot(["_rows"], list(data.columns), "column", "missing_count")
    share = F.coalesce(percentage(F.col("missing_count"), F.col("_rows")), F.lit(0.0))
    return long.select("column", "missing_count", share.alias("missing_percentage")).orderBy(
        F.desc("missing_count"), "column"
    )


def punctuality(flights: DataFrame, dimension: str) -> DataFrame:
    """Volumes, mean delays and rates for each value of a dimension, busiest first."""
    flown = outcome.is_completed()
    counts = flights.groupBy(dimension).agg(
        F.count(F.lit(1)).alias("flight_count"),
        F.count_if(flown).alias("completed_flight_count"),
        F.count_if(outcome.is_delayed()).alias("delayed_flight_count"),
        F.count_if(F.col("cancelled") == 1).alias("cancelled_flight_count"),
        F.avg(F.when(flown, F.col("arr_delay"))).alias("average_arrival_delay_minutes"),
        F.avg("dep_delay").alias("average_departure_delay_minutes"),
    )
    return counts.select(
        "*",
        percentage(F.col("delayed_flight_count"), F.col("completed_flight_count"))
        .alias("delayed_flight_percentage"),
        percentage(F.col("cancelled_flight_count"), F.col("flight_count"))
        .alias("cancelled_flight_percentage"),
    ).orderBy(F.desc("flight_count"), dimension)


def study_frame(flights: DataFrame) -> DataFrame:
    """Flights with the scheduled minutes the numeric studies need."""
    wanted = {
        "scheduled_departure_minutes": "crs_dep_time", "scheduled_arrival_minutes": "crs_arr_time",
    }
    return flights.withColumns({
        name: clock.minute_of_day(F.col(source))
        for name, source in wanted.items() if name not in flights.columns
    })


def numeric_summary(
    flights: DataFrame, variables: tuple[str, ...] = schema.STUDY_VARIABLES
) -> DataFrame:
    """Count, mean, standard deviation, extremes and quartiles of each variable.

    Everything is computed from the stored table of distinct values, so the fact table is read once
    and never sorted.
    """
    counts = materialize(value_counts(study_frame(flights), list(variables)))
    value, n = F.col("value"), F.col("n")
    means = counts.groupBy("variable").agg(
        F.sum("n").alias("count"), (F.sum(value * n) / F.sum("n")).alias("mean"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    spread = counts.join(means.select("variable", "mean", "count"), "variable").groupBy(
        "variable"
    ).agg(
        F.sqrt(F.try_divide(
            F.sum(n * (value - F.col("mean")) * (value - F.col("mean"))), F.max("count") - 1
        )).alias("stddev")
    )
    quartiles = exact_quantiles(counts, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, by=["variable"])
    return means.join(spread, "variable").join(quartiles, "variable").select(
        "variable", "count", "mean", "stddev", "min", "q25", "q50", "q75", "max"
    )


def complete_cases(
    flights: DataFrame, variables: tuple[str, ...] = schema.STUDY_VARIABLES
) -> DataFrame:
    """Completed flights with none of the studied variables missing."""
    flown = study_frame(flights).filter(outcome.is_completed())
    return flown.select(
        *[F.col(name).cast("double").alias(name) for name in variables]
    ).na.drop(subset=list(variables))


def _pearson(cases: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Pearson coefficients of column pairs as ``(variable_x, variable_y, correlation)``.

    One scan: co-moments are kept centred while they grow and merge, so large values lose no digits
    and no pass for the means is needed. A constant variable has a null coefficient, itself included.
    """
    names = sorted({name for pair in pairs for name in pair})
    products = sorted({tuple(sorted(pair)) for pair in pairs} | {(name, name) for name in names})
    place = {pair: i for i, pair in enumerate(products)}
    sums = cases.agg(
        F.array(*[F.covar_pop(x, y) for x, y in products]).alias("sums"),
        F.array(*[F.min(name) < F.max(name) for name in names]).alias("varies"),
    )
    wanted = F.array(*[
        F.struct(
            F.lit(x).alias("x"), F.lit(y).alias("y"),
            F.lit(place[tuple(sorted((x, y)))]).alias("xy"),
            F.lit(place[x, x]).alias("xx"), F.lit(place[y, y]).alias("yy"),
            F.lit(names.index(x)).alias("ix"), F.lit(names.index(y)).alias("iy"),
        )
        for x, y in pairs
    ])

    def cell(pair: Column) -> Column:
        def total(place_name: str) -> Column:
            return F.get("sums", pair.getField(place_name))

        defined = F.get("varies", pair.getField("ix")) & F.get("varies", pair.getField("iy"))
        value = F.when(pair.getField("ix") == pair.getField("iy"), F.lit(1.0)).otherwise(
            F.try_divide(total("xy"), F.sqrt(total("xx")) * F.sqrt(total("yy")))
        )
        return F.struct(
            pair.getField("x").alias("variable_x"), pair.getField("y").alias("variable_y"),
            F.when(defined, value).alias("correlation"),
        )

    return sums.select(F.inline(F.transform(wanted, cell)))


def correlation_matrix(
    flights: DataFrame, variables: tuple[str, ...] = schema.STUDY_VARIABLES
) -> DataFrame:
    """Pearson matrix of the complete cases in long form."""
    return _pearson(complete_cases(flights, variables), [(x, y) for x in variables for y in variables])


def correlation_row_count(flights: DataFrame) -> DataFrame:
    """How many complete cases the matrix rests on."""
    return complete_cases(flights).agg(F.count(F.lit(1)).alias("row_count"))


def correlation_with_delay(
    flights: DataFrame, variables: tuple[str, ...] = schema.STUDY_VARIABLES,
    target: str = "arr_delay",
) -> DataFrame:
    """Coefficients with the arrival delay, strongest first, only those pairs being computed."""
    pairs = [(name, target) for name in variables if name != target]
    return (
        _pearson(complete_cases(flights, variables), pairs)
        .select(
            F.col("variable_x").alias("variable"),
            "correlation",
            F.abs("correlation").alias("absolute_correlation"),
            F.col("variable_x").isin(*schema.PLANNED_VARIABLES).alias("available_before_departure"),
        )
        .orderBy(F.desc_nulls_last("absolute_correlation"), "variable")
    )
