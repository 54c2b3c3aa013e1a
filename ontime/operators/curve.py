"""The precision/recall curve of a scored table and what is read off it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ontime import schema
from ontime.functions.ratios import ratio, wilson_lower
from ontime.operators.ranks import running_totals

COVERAGE_CENTRE = (schema.MIN_COVERAGE + schema.MAX_COVERAGE) / 2
CLIP = (0.001, 0.999)


def score_curve(
    scored: DataFrame, by: list[str] | None = None, label: str = "label", score: str = "score",
    slices: int | None = None,
) -> DataFrame:
    """One row per distinct score: alerts and true positives when ``score >= threshold``.

    Rows with the same score merge before the shuffle; the distinct scores are then cumulated
    slice by slice from the highest down.
    """
    by = by or []
    points = scored.groupBy(*by, F.col(score).cast("double").alias("threshold")).agg(
        F.count(F.lit(1)).alias("alerts"), F.count_if(F.col(label) == 1).alias("positives")
    )
    curve = running_totals(points, ["alerts", "positives"], [F.desc("threshold")], by, slices)
    alerts, hits = F.col("running_alerts"), F.col("running_positives")
    return curve.select(
        *by, "threshold",
        F.col("alerts").alias("alerts_here"), F.col("positives").alias("positives_here"),
        alerts.alias("alert_count"), hits.alias("true_positive_count"),
        F.col("total_alerts").alias("sample_count"),
        F.col("total_positives").alias("positive_count"),
        ratio(hits, alerts).alias("precision"),
        ratio(hits, F.col("total_positives")).alias("recall"),
        ratio(alerts, F.col("total_alerts")).alias("alert_coverage"),
    )


def _clipped(threshold: Column) -> Column:
    return F.least(F.greatest(threshold, F.lit(CLIP[0])), F.lit(CLIP[1]))


def _harmonic(precision: Column, recall: Column) -> Column:
    return F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))


def best_f1(curve: DataFrame) -> DataFrame:
    """The curve row with the highest F1, the lowest threshold winning ties; no row if empty."""
    scored = curve.withColumn("f1", _harmonic(F.col("precision"), F.col("recall")))
    return scored.orderBy(F.desc("f1"), "threshold").limit(1)


def f1_threshold(scored: DataFrame, curve: DataFrame | None = None, label: str = "label") -> DataFrame:
    """One row: the F1-optimal threshold, or 0.5 when one class is missing."""
    curve = curve if curve is not None else score_curve(scored, label=label)
    best = best_f1(curve).select(F.struct("threshold", "f1")).scalar()
    return _class_counts(scored, label).select(
        F.when(_both_classes() & best.isNotNull(), _clipped(best.getField("threshold")))
        .otherwise(F.lit(0.5)).alias("f1_threshold"),
        F.when(_both_classes(), best.getField("f1")).alias("best_f1"),
    )


def _class_counts(scored: DataFrame, label: str) -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(F.col(label) == 1).alias("_positives")
    )


def _both_classes() -> Column:
    return (F.col("_positives") > 0) & (F.col("_positives") < F.col("_rows"))


def ranked_candidates(curve: DataFrame) -> DataFrame:
    """Curve rows with their confidence bounds and the tier they may be chosen from.

    Tier 1 meets every acceptance rule, tier 2 only the coverage range, tier 3 nothing.
    """
    hits, alerts = F.col("true_positive_count"), F.col("alert_count")
    coverage = F.col("alert_coverage")
    bounded = curve.withColumns({
        "precision_lower": wilson_lower(hits, alerts),
        "recall_lower": wilson_lower(hits, F.col("positive_count")),
    })
    in_range = coverage.between(schema.MIN_COVERAGE, schema.MAX_COVERAGE)
    feasible = (
        in_range & (alerts >= schema.MIN_ALERTS)
        & (F.col("precision_lower") >= schema.MIN_PRECISION)
        & (F.col("recall_lower") >= schema.MIN_RECALL)
    )
    return bounded.withColumns({
        "tier": F.when(feasible, 1).when(in_range, 2).otherwise(3),
        "centre_distance": F.abs(coverage - COVERAGE_CENTRE),
    })


def business_threshold(scored: DataFrame, curve: DataFrame | None = None, label: str = "label") -> DataFrame:
    """One row: the alert threshold, how it was obtained and what it achieves.

    Among thresholds meeting every rule, the highest recall wins, then precision, closeness to
    the middle of the coverage range and the highest threshold. Otherwise closeness comes first.
    """
    curve = curve if curve is not None else score_curve(scored, label=label)
    strict = F.col("tier") == 1
    distance = F.col("centre_distance")
    chosen = ranked_candidates(curve).orderBy(
        "tier",
        F.when(strict, -F.col("recall")).otherwise(distance),
        F.desc("precision"),
        F.when(strict, distance).otherwise(-F.col("recall")),
        F.desc("threshold"),
    ).limit(1)
    fields = [
        "threshold", "tier", "precision", "recall", "alert_coverage", "alert_count",
        "precision_lower", "recall_lower",
    ]
    best = chosen.select(F.struct(*fields)).scalar()
    found = _both_classes() & best.isNotNull()
    tier = best.getField("tier")
    strategy = (
        F.when(~_both_classes(), "fallback_single_class")
        .when(best.isNull(), "fallback_no_threshold")
        .when(tier == 1, "business_constraints")
        .when(tier == 2, "fallback_target_alert_coverage")
        .otherwise("fallback_closest_target_coverage")
    )
    f1 = f1_threshold(scored, curve, label).select("f1_threshold").scalar()
    picked = _class_counts(scored, label).select(
        F.when(found, _clipped(best.getField("threshold"))).otherwise(F.lit(0.5)).alias("threshold"),
        strategy.alias("strategy"),
        (found & (tier == 1)).alias("feasible_on_validation"),
        f1.alias("f1_threshold"),
        *[
            F.when(found, best.getField(source)).alias(f"candidate_validation_{name}")
            for name, source in {
                "precision": "precision", "recall": "recall", "alert_coverage": "alert_coverage",
                "alert_count": "alert_count", "precision_lower_bound_95": "precision_lower",
                "recall_lower_bound_95": "recall_lower",
            }.items()
        ],
    )
    reasons = F.create_map(*[F.lit(x) for pair in schema.FALLBACK_REASONS.items() for x in pair])
    return picked.withColumn("fallback_reason", F.try_element_at(reasons, F.col("strategy")))


def ranking_metrics(curve: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Exact ROC-AUC and average precision per group; null when a class is missing.

    Average precision is the step sum of recall gains times precision, not a trapezoid; tied
    scores share one step, and count for half in the AUC.
    """
    by = by or []
    hits, misses = F.col("positives_here"), F.col("alerts_here") - F.col("positives_here")
    misses_above = (F.col("alert_count") - F.col("true_positive_count")) - misses
    negatives = F.col("sample_count") - F.col("positive_count")
    misses_below = negatives - misses_above - misses
    wins = hits.cast("double") * (misses_below.cast("double") + misses.cast("double") / 2)
    sums = curve.groupBy(*by).agg(
        F.max("sample_count").alias("sample_count"), F.max("positive_count").alias("positive_count"),
        F.max(negatives).alias("_negatives"), F.sum(wins).alias("_wins"),
        F.sum(hits.cast("double") * F.col("precision")).alias("_steps"),
    )
    positives = F.col("positive_count").cast("double")
    both = (F.col("positive_count") > 0) & (F.col("_negatives") > 0)
    return sums.select(
        *by, "sample_count", "positive_count",
        F.when(both, F.try_divide(F.col("_wins"), positives * F.col("_negatives"))).alias("roc_auc"),
        F.when(both, F.try_divide(F.col("_steps"), positives)).alias("average_precision"),
    )

