"""Quality of a scored table at a threshold, acceptance gates, baselines, long reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ontime import schema
from ontime.functions.ratios import percentage, ratio, ratio_or_zero, wilson_interval
from ontime.operators.quality import failed_rules

# Fixed value: probabilities are kept this far from 0 and 1 in the log loss.
PROBABILITY_MARGIN = 1e-7


def requirements() -> dict[str, float]:
    """The acceptance rules as data."""
    return {
        "minimum_precision": schema.MIN_PRECISION,
        "minimum_recall": schema.MIN_RECALL,
        "minimum_alert_coverage": schema.MIN_COVERAGE,
        "maximum_alert_coverage": schema.MAX_COVERAGE,
        "minimum_alert_count": schema.MIN_ALERTS,
        "confidence_level": 0.95,
    }


def classification_metrics(
    scored: DataFrame, by: list[str] | None = None, label: str = "label", score: str = "score",
    threshold: str = "threshold",
) -> DataFrame:
    """Counts, rates, intervals, log loss and Brier score of ``score >= threshold``.

    ``threshold`` is a column, constant within each group of ``by``. One aggregate pass.
    """
    by = by or []
    actual, alert = F.col(label) == 1, F.col(score) >= F.col(threshold)
    margin = F.lit(PROBABILITY_MARGIN)
    p = F.greatest(F.least(F.col(score), 1 - margin), margin)
    truth = F.col(label).cast("double")
    counts = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.count_if(actual).alias("positive_count"),
        F.count_if(alert).alias("alert_count"),
        F.count_if(~actual & ~alert).alias("true_negative"),
        F.count_if(~actual & alert).alias("false_positive"),
        F.count_if(actual & ~alert).alias("false_negative"),
        F.count_if(actual & alert).alias("true_positive"),
        F.max(threshold).alias("threshold"),
        F.avg(-F.when(actual, F.log(p)).otherwise(F.log(1 - p))).alias("log_loss"),
        F.avg((p - truth) * (p - truth)).alias("brier_score"),
    )
    tp, tn, fp = F.col("true_positive"), F.col("true_negative"), F.col("false_positive")
    rows, positives, alerts = F.col("sample_count"), F.col("positive_count"), F.col("alert_count")
    negatives = rows - positives
    precision_low, precision_high = wilson_interval(tp, alerts)
    recall_low, recall_high = wilson_interval(tp, positives)
    return counts.select(
        *by, "sample_count", "positive_count",
        percentage(positives, rows).alias("positive_percentage"),
        alerts.alias("predicted_positive_count"),
        percentage(alerts, rows).alias("predicted_positive_percentage"),
        "alert_count",
        ratio(alerts, rows).alias("alert_coverage"),
        percentage(alerts, rows).alias("alert_coverage_percentage"),
        "threshold",
        ratio(tp + tn, rows).alias("accuracy"),
        ((ratio(tp, positives) + ratio(tn, negatives)) / 2).alias("balanced_accuracy"),
        ratio_or_zero(tp, alerts).alias("precision"),
        ratio_or_zero(tp, positives).alias("recall"),
        ratio_or_zero(2 * tp, alerts + positives).alias("f1"),
        "true_negative", "false_positive", "false_negative", "true_positive",
        precision_low.alias("precision_lower_95"), precision_high.alias("precision_upper_95"),
        recall_low.alias("recall_lower_95"), recall_high.alias("recall_upper_95"),
        "log_loss", "brier_score",
    )


def gate_checks() -> dict[str, Column]:
    """The five acceptance checks of a metrics row."""
    return {
        "minimum_precision_lower_bound_95": F.col("precision_lower_95") >= schema.MIN_PRECISION,
        "minimum_recall_lower_bound_95": F.col("recall_lower_95") >= schema.MIN_RECALL,
        "minimum_alert_coverage": F.col("alert_coverage") >= schema.MIN_COVERAGE,
        "maximum_alert_coverage": F.col("alert_coverage") <= schema.MAX_COVERAGE,
        "minimum_alert_count": F.col("alert_count") >= schema.MIN_ALERTS,
    }


def business_gate(metrics: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Checks, verdict, violations and the observed values they rest on, per metrics row."""
    checks = gate_checks()
    violations = failed_rules([(schema.GATE_MESSAGES[name], ~ok) for name, ok in checks.items()])
    return metrics.select(
        *(by or []),
        *[ok.alias(name) for name, ok in checks.items()],
        (F.size(violations) == 0).alias("passed"),
        violations.alias("violations"),
        "precision", "precision_lower_95", "precision_upper_95",
        "recall", "recall_lower_95", "recall_upper_95",
        "alert_coverage", "alert_count", "sample_count",
    )


def overall_gate(feasible: Column, split_gates: DataFrame, monthly_gates: DataFrame) -> DataFrame:
    """The verdict on a model: threshold feasible on validation, both splits and each test month.

    ``feasible`` is a boolean scalar; the gate tables hold a handful of rows each.
    """
    parts = split_gates.agg(
        F.coalesce(F.bool_or((F.col("split") == "validation") & F.col("passed")), F.lit(False))
        .alias("validation_passed"),
        F.coalesce(F.bool_or((F.col("split") == "test") & F.col("passed")), F.lit(False))
        .alias("test_passed"),
    )
    stable = monthly_gates.agg(F.coalesce(F.bool_and("passed"), F.lit(False))).scalar()
    verdict = parts.select(
        feasible.alias("feasible_on_validation"), "validation_passed", "test_passed",
        stable.alias("monthly_stability_passed"),
    )
    violations = failed_rules([
        (schema.VALIDATION_INFEASIBLE, ~F.col("feasible_on_validation")),
        (schema.TEST_GATE_FAILED, ~F.col("test_passed")),
        (schema.MONTHLY_GATE_FAILED, ~F.col("monthly_stability_passed")),
    ])
    passed = (
        F.col("feasible_on_validation") & F.col("validation_passed") & F.col("test_passed")
        & F.col("monthly_stability_passed")
    )
    return verdict.select("*", passed.alias("passed"), violations.alias("violations"))


def baselines(scored: DataFrame, label: str = "label") -> DataFrame:
    """Accuracy and F1 of always answering no and of always answering yes."""
    counts = scored.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("p")
    )
    n, p = F.col("n"), F.col("p")
    answers = F.array(
        F.struct(F.lit("always_negative").alias("baseline"), ratio(n - p, n).alias("accuracy"),
                 F.lit(0.0).alias("f1")),
        F.struct(F.lit("always_positive").alias("baseline"), ratio(p, n).alias("accuracy"),
                 ratio_or_zero(2 * p, n + p).alias("f1")),
    )
    return counts.select(F.inline(answers))


def with_thresholds(scored: DataFrame, thresholds: dict[str, Column]) -> DataFrame:
    """Repeat each row per named threshold, so that one scan evaluates them all."""
    named = F.array(*[
        F.struct(F.lit(name).alias("threshold_name"), value.alias("threshold"))
        for name, value in thresholds.items()
    ])
    return scored.select("*", F.inline(named))


def long_metrics(metrics: DataFrame, ids: list[str], names: list[str]) -> DataFrame:
    """Metrics as ``(ids, metric, value)`` rows."""
    doubles = metrics.select(*ids, *[F.col(name).cast("double").alias(name) for name in names])
    return doubles.unpivot(ids, names, "metric", "value")


def confusion_rows(metrics: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The four cells of the confusion matrix as rows, empty cells included."""
    cells = F.array(*[
        F.struct(F.lit(actual).alias("actual"), F.lit(predicted).alias("predicted"),
                 F.col(name).alias("flights"))
        for actual, predicted, name in (
            (0, 0, "true_negative"), (0, 1, "false_positive"),
            (1, 0, "false_negative"), (1, 1, "true_positive"),
        )
    ])
    return metrics.select(*(by or []), F.inline(cells))
