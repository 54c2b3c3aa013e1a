"""Raw CSV to a clean partitioned dataset, a quarantine and a quality report.

    python -m ontime.plans.prepare --input 'flights/*.csv' --output prepared
"""

from __future__ import annotations

import argparse

from pyspark.sql import Row, SparkSession

from ontime import schema
from ontime.operators import quality, sampling
from ontime.session import create_session
from ontime.sources import sinks, tables


def prepare(
    spark: SparkSession, source: str, output: str, mode: str = "errorifexists",
    sample_size: int | None = None, seed: int = 42,
) -> Row:
    """Validate every source row, or a sample of fixed size, and write the outcome."""
    raw = tables.read_flights_csv(spark, source)
    if sample_size is not None:
        raw = sampling.sample_rows(raw, sample_size, seed)
    return sinks.write_prepared(quality.validate(raw), output, mode)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="path or pattern of the source CSV files")
    parser.add_argument("--output", required=True)
    parser.add_argument(
        "--sample-size", type=int, help=f"rows to draw first, e.g. {schema.DEFAULT_SAMPLE_ROWS}; all if absent"
    )
    parser.add_argument("--sample-seed", type=int, default=42)
    parser.add_argument("--mode", choices=sinks.PREPARE_MODES, default="errorifexists")
    parser.add_argument("--master")
    options = parser.parse_args(argv)
    spark = create_session("ontime-prepare", options.master)
    totals = prepare(
        spark, options.input, options.output, options.mode, options.sample_size, options.sample_seed
    )
    print(f"{totals.valid_row_count:,} valid rows, {totals.rejected_row_count:,} rejected rows")


if __name__ == "__main__":
    main()
