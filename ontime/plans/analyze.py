"""Clean flights to the nine descriptive reports.

    python -m ontime.plans.analyze --input prepared/flights --output analysis
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from ontime.operators import metrics
from ontime.session import create_session
from ontime.sources import sinks, tables


def reports(flights: DataFrame) -> list[tuple[str, DataFrame, str]]:
    """Name, table and format of every report; all are bounded by their keys."""
    return [
        ("overview", metrics.overview(flights), "json"),
        ("flight_status", metrics.status_distribution(flights), "csv"),
        ("missing_values", metrics.missing_values(flights), "csv"),
        ("monthly_metrics", metrics.punctuality(flights, "month").orderBy("month"), "csv"),
        ("carrier_metrics", metrics.punctuality(flights, "op_unique_carrier"), "csv"),
        ("origin_metrics", metrics.punctuality(flights, "origin"), "csv"),
        ("numeric_summary", metrics.numeric_summary(flights), "csv"),
        ("correlations/matrix", metrics.correlation_matrix(flights), "csv"),
        ("correlations/with_arrival_delay", metrics.correlation_with_delay(flights), "csv"),
    ]


def analyze(flights: DataFrame, output: str, mode: str = "errorifexists") -> None:
    """Write every report. Each one scans only the columns it needs of the Parquet dataset."""
    if mode not in sinks.ANALYZE_MODES:
        raise ValueError(f"unknown mode {mode!r}")
    sinks.write_reports(reports(flights), output, mode)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="clean flights dataset")
    parser.add_argument("--output", required=True)
    parser.add_argument("--mode", choices=sinks.ANALYZE_MODES, default="errorifexists")
    parser.add_argument("--master")
    options = parser.parse_args(argv)
    spark = create_session("ontime-analyze", options.master)
    flights = tables.read_flights(spark, options.input)
    analyze(flights, options.output, options.mode)
    head = spark.read.json(f"{options.output}/overview").first()
    print(f"{head.flight_count:,} flights, {head.delayed_flight_count:,} delayed "
          f"({head.delayed_flight_percentage:.1f} % of completed)")
    top = spark.read.option("header", True).csv(f"{options.output}/correlations/with_arrival_delay")
    for row in top.limit(5).collect():
        print(f"- {row.variable}: {float(row.correlation):.3f}")


if __name__ == "__main__":
    main()
