"""Interactive exploration tables: optional filters, indicators, groups, histogram, choices."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from ontime import schema
from ontime.functions import outcome
from ontime.functions.ratios import ratio_or_zero

# Bounds and bin width of the displayed delay.
DELAY_FLOOR, DELAY_CEILING, DELAY_BIN = -30, 180, 5

FILLED_COLUMNS = ("month", "day_of_month", "day_of_week", "cancelled", "diverted")


def month_label(month: Column) -> Column:
    """Month name; null outside 1 to 12."""
    names = F.array(*[F.lit(name) for name in schema.MONTH_LABELS])
    return F.when(month.between(1, 12), F.get(names, month - 1))


def explorer_view(flights: DataFrame) -> DataFrame:
    """Flights with unreadable numbers counted as zero, flags, a four-state status and labels."""
    filled = flights.withColumns({
        name: F.coalesce(F.col(name).try_cast("int"), F.lit(0)) for name in FILLED_COLUMNS
    })
    return filled.withColumns({
        "is_completed": outcome.is_completed(),
        "is_delayed": outcome.is_delayed(),
        "flight_status": outcome.display_status(),
        "month_label": month_label(F.col("month")),
    })


def filter_flights(
    view: DataFrame, months: Iterable[int] | None = None,
    carriers: Iterable[str] | None = None, origins: Iterable[str] | None = None,
) -> DataFrame:
    """Keep the selected months, carriers and origins; an empty choice filters nothing."""
    choices = {"month": months, "op_unique_carrier": carriers, "origin": origins}
    for name, chosen in choices.items():
        values = list(chosen or [])
        if values:
            view = view.filter(F.col(name).isin(*values))
    return view


def indicators(view: DataFrame) -> DataFrame:
    """Counts and delay rate of a selection; the rate of an empty one is zero."""
    counts = view.agg(
        F.count(F.lit(1)).alias("flight_count"),
        F.count_if("is_completed").alias("completed_count"),
        F.count_if("is_delayed").alias("delayed_count"),
        F.count_if(F.col("cancelled") == 1).alias("cancelled_count"),
        F.count_if(F.col("diverted") == 1).alias("diverted_count"),
    )
    rate = ratio_or_zero(F.col("delayed_count"), F.col("completed_count"))
    return counts.withColumn("delay_rate", rate)


def delay_rate_by(view: DataFrame, dimension: str) -> DataFrame:
    """Completed flights and delay rate per value of a dimension, a missing value excluded."""
    known = view.filter(F.col("is_completed") & F.col(dimension).isNotNull())
    return known.groupBy(dimension).agg(
        F.count(F.lit(1)).alias("flights"),
        F.avg(F.col("is_delayed").cast("int")).alias("delay_rate"),
    )


def monthly_rates(view: DataFrame) -> DataFrame:
    """Delay rate per month with its label, in calendar order."""
    rates = delay_rate_by(view, "month")
    return rates.withColumn("month_label", month_label(F.col("month"))).orderBy("month")


def top_groups(view: DataFrame, dimension: str, limit: int = 10) -> DataFrame:
    """The busiest values of a dimension; rate, then name, settle equal volumes."""
    rates = delay_rate_by(view, dimension)
    return rates.orderBy(F.desc("flights"), F.desc("delay_rate"), dimension).limit(limit)


def status_counts(view: DataFrame) -> DataFrame:
    return view.groupBy("flight_status").agg(F.count(F.lit(1)).alias("flights")).orderBy("flights")


def delay_histogram(view: DataFrame) -> DataFrame:
    """Completed flights per five-minute bin of the delay clipped to [-30, 180]; 42 bins."""
    bins = (DELAY_CEILING - DELAY_FLOOR) // DELAY_BIN
    shown = F.least(F.greatest(F.col("arr_delay"), F.lit(float(DELAY_FLOOR))), F.lit(float(DELAY_CEILING)))
    slot = F.least(F.floor((shown - DELAY_FLOOR) / DELAY_BIN), F.lit(bins - 1)).cast("int")
    return (
        view.filter("is_completed").groupBy(slot.alias("bin"))
        .agg(F.count(F.lit(1)).alias("flights"))
        .select("bin", (F.col("bin") * DELAY_BIN + DELAY_FLOOR).alias("bin_start"), "flights")
    )


def filter_options(view: DataFrame) -> DataFrame:
    """Distinct carriers and origins offered as filters, from one scan."""
    offered = ["op_unique_carrier", "origin"]
    return (
        view.select(*offered).unpivot([], offered, "option", "value")
        .filter(F.col("value").isNotNull()).distinct().orderBy("option", "value")
    )


def airport_states(flights: DataFrame) -> DataFrame:
    """State of every airport seen at either end of a flight; the smallest name settles doubts."""
    ends = F.array(
        F.struct(F.col("origin").alias("airport"), F.col("origin_state_nm").alias("state")),
        F.struct(F.col("dest").alias("airport"), F.col("dest_state_nm").alias("state")),
    )
    return (
        flights.select(F.inline(ends)).na.drop().groupBy("airport")
        .agg(F.min("state").alias("state")).orderBy("airport")
    )
