"""Readers of flights and requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ontime import schema
from ontime.functions import text
from ontime.operators.quality import failed_rules


def read_flights_csv(
    spark: SparkSession, path: str | list[str], header: bool = True
) -> DataFrame:
    """Raw flights as text, malformed records kept in ``_corrupt_record``.

    Column pruning is turned off for this scan: a pruned parser does not notice missing or
    surplus fields, so malformed lines would pass as valid ones.
    """
    return (
        spark.read.schema(schema.raw_schema())
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schema.CORRUPT_COLUMN)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("columnPruning", False)
        .csv(path)
    )


def read_flights(spark: SparkSession, path: str) -> DataFrame:
    """The clean flights dataset; a filter on ``year`` or ``month`` prunes its folders."""
    return spark.read.parquet(path)


def read_requests(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Requests as JSON lines, or with ``multi_line`` one object or array per file.

    Numbers may be written as ``100``, ``100.0`` or ``"100"``. What cannot be read as the number
    its field asks for is null and named in ``invalid_numbers``.
    """
    wanted = schema.request_schema()
    numbers = {f.name: f.dataType for f in wanted if f.dataType != T.StringType()}
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted])
    raw = spark.read.schema(as_text).option("multiLine", multi_line).json(path)
    readers = {T.IntegerType(): text.to_integer, T.DoubleType(): text.to_float}
    written = {name: f"_text_{name}" for name in numbers}
    kept = raw.withColumns({column: text.clean_text(F.col(name)) for name, column in written.items()})
    read = kept.withColumns({name: readers[kind](F.col(written[name])) for name, kind in numbers.items()})
    unread = [(name, F.isnotnull(column) & F.isnull(name)) for name, column in written.items()]
    return read.withColumn("invalid_numbers", failed_rules(unread)).drop(*written.values())
