"""Flags outside 0 and 1, unknown ones and odd clock times, against plain conditions."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from ontime import schema
from ontime.functions import clock, outcome

FLAGS = (0, 1, 2, -1, None)
DELAYS = (-5.0, 0.0, 0.5, 30.0, None)


def plain(cancelled, diverted, delay):
    late = delay is not None and delay > 0
    completed = cancelled == 0 and diverted == 0 and delay is not None
    if cancelled == 1:
        five, four = "cancelled", schema.STATUS_CANCELLED
    elif diverted == 1:
        five, four = "diverted", schema.STATUS_DIVERTED
    else:
        five = "unknown" if delay is None else "delayed" if late else "on_time"
        four = schema.STATUS_LATE if completed and late else schema.STATUS_ON_TIME
    return completed, completed and late, cancelled == 1 or diverted == 1 or late, five, four


def test_every_mixture_of_flags_and_delays(spark):
    cases = list(product(FLAGS, FLAGS, DELAYS))
    frame = spark.createDataFrame(cases, "cancelled int, diverted int, arr_delay double")
    rows = frame.select(
        "*", outcome.is_completed().alias("c"), outcome.is_delayed().alias("d"), outcome.is_disrupted().alias("x"),
        outcome.status().alias("five"), outcome.display_status().alias("four"),
    ).collect()
    assert len(rows) == len(cases)
    for r in rows:
        assert (r["c"], r["d"], r["x"], r["five"], r["four"]) == plain(r["cancelled"], r["diverted"], r["arr_delay"]), r


def test_clock_times(spark):
    rows = spark.range(-120, 2600).select("id", clock.is_clock_time(F.col("id").cast("int")).alias("ok")).collect()
    assert {r["id"] for r in rows if r["ok"]} == {h * 100 + m for h in range(24) for m in range(60)} | {2400}
    assert spark.range(1).select(clock.is_clock_time(F.lit(None).cast("int"))).first()[0] is None
