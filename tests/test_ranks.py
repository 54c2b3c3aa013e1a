"""Distributed running totals and quantiles against plain Python."""

from __future__ import annotations

from collections import Counter
import random

import pytest
from pyspark.sql import functions as F

from ontime.operators.curve import business_threshold, f1_threshold, ranking_metrics, score_curve
from ontime.operators.ranks import exact_quantiles, running_totals
from ontime.operators.sampling import sample_rows


@pytest.fixture(autouse=True)
def many_slices(spark):
    """Keep several slices: adaptive execution would merge such small ones."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_running_totals_cross_slices(spark):
    random.seed(5)
    rows = [(g, v, random.randint(1, 9)) for g in "ab" for v in random.sample(range(10_000), 700)]
    table = spark.createDataFrame(rows, "g string, v int, n int")
    result = running_totals(table, ["n"], [F.desc("v")], ["g"], slices=7).collect()
    for group in "ab":
        total = 0
        for _, value, n in sorted((r for r in rows if r[0] == group), key=lambda r: -r[1]):
            total += n
            (row,) = [r for r in result if r.g == group and r.v == value]
            assert row.running_n == total
    assert {r.total_n for r in result if r.g == "a"} == {sum(n for g, _, n in rows if g == "a")}


def test_one_value_holding_most_rows(spark):
    table = spark.createDataFrame([(float(v), 1) for v in range(100)] + [(1000.0, 900)], "value double, n int")
    row = exact_quantiles(table, {"p05": 0.05, "p50": 0.5}).first()
    assert (row.p05, row.p50) == (49.0, 1000.0)


@pytest.mark.parametrize("values, expected", [([1, 2, 3, 4], 2.5), ([3, 1, 2], 2.0), ([7], 7.0)])
def test_interpolated_median(spark, values, expected):
    table = spark.createDataFrame([(float(v), 1) for v in values], "value double, n int")
    assert exact_quantiles(table, {"m": 0.5}, interpolate=True).first().m == expected


def test_curve_and_ranking_match_brute_force(spark):
    random.seed(11)
    pairs = [(int(random.random() < 0.4), round(random.random(), 2)) for _ in range(1500)]
    scored = spark.createDataFrame(pairs, "label int, score double")
    curve = score_curve(scored, slices=5)
    positives = sum(y for y, _ in pairs)
    for row in curve.collect():
        flagged = [y for y, s in pairs if s >= row.threshold]
        assert (row.alert_count, row.true_positive_count) == (len(flagged), sum(flagged))
    wins = sum(
        1.0 if sp > sn else 0.5 if sp == sn else 0.0
        for yp, sp in pairs if yp for yn, sn in pairs if not yn
    )
    ranking = ranking_metrics(curve).first()
    assert ranking.roc_auc == pytest.approx(wins / (positives * (len(pairs) - positives)))


@pytest.mark.parametrize("size", [1, 37, 250, 251, 400, 999, 5000])
def test_large_samples_are_exact(spark, size):
    rows = [(i % 7, "hot") for i in range(300)] + [(i, "cold") for i in range(700)]
    data = spark.createDataFrame(rows, "k int, kind string")
    taken = sorted(map(tuple, sample_rows(data, size, 3).collect()))
    other = sorted(map(tuple, sample_rows(data.repartition(5), size, 3).collect()))
    assert len(taken) == min(size, 1000)
    assert taken == other
    assert not Counter(taken) - Counter(rows)


@pytest.mark.parametrize("size", [1, 3, 50, 119, 120, 200])
def test_samples_along_a_key(spark, size):
    rows = [(None, i) for i in range(3)] + [(i % 50, i) for i in range(117)]
    data = spark.createDataFrame(rows, "k long, v int")
    place = lambda k: -1 if k is None else (k * 48_271 + 3) % 1_000_003
    expected = sorted(rows, key=lambda r: (place(r[0]), r[0] or 0, r[1]))[:size]
    found = sample_rows(data, size, 3, key="k").collect()
    assert Counter(map(tuple, found)) == Counter(expected)


def test_sample_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        sample_rows(spark.range(3), 0)


@pytest.mark.parametrize("label", [0, 1])
def test_single_class_falls_back(spark, label):
    scored = spark.createDataFrame([(label, 0.2), (label, 0.7)], "label int, score double")
    row = business_threshold(scored).first()
    assert (row.threshold, row.strategy, row.feasible_on_validation) == (0.5, "fallback_single_class", False)
    assert f1_threshold(scored).first().f1_threshold == 0.5


def test_no_rows_fall_back(spark):
    row = business_threshold(spark.createDataFrame([], "label int, score double")).first()
    assert (row.threshold, row.strategy) == (0.5, "fallback_single_class")
    assert row.fallback_reason
