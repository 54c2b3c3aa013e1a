"""From scores to a verdict: threshold on validation, metrics and gates on validation and test."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ontime.operators import curve as curves, evaluate
from ontime.session import materialize

EVALUATED = ("validation", "test")


def scored_rows(frame: DataFrame, label: str, score: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns evaluation needs, from any table with a month, a 0/1 label and a score."""
    from ontime.operators.sampling import split_name

    return frame.select(
        *keep, "month", split_name(F.col("month")).alias("split"),
        F.col(label).cast("int").alias("label"), F.col(score).cast("double").alias("score"),
    )


@dataclass
class Evaluation:
    """Every evaluation table of a scored table; each one is a lazy plan."""

    scored: DataFrame
    selection: DataFrame
    metrics: DataFrame
    ranking: DataFrame
    gates: DataFrame
    monthly_metrics: DataFrame
    monthly_gates: DataFrame
    verdict: DataFrame
    baselines: DataFrame
    comparison: DataFrame

    @property
    def threshold(self) -> Column:
        return self.selection.select("threshold").scalar()


def select_threshold(scored: DataFrame) -> DataFrame:
    """The alert threshold, chosen on validation rows only and stored as one row."""
    validation = scored.filter(F.col("split") == "validation")
    return materialize(curves.business_threshold(validation, curves.score_curve(validation)))


def metrics_at(scored: DataFrame, threshold: Column, by: list[str]) -> DataFrame:
    return evaluate.classification_metrics(scored.withColumn("threshold", threshold), by)


def monthly_metrics(scored: DataFrame, threshold: Column) -> DataFrame:
    """Metrics of each test month at the one threshold."""
    return metrics_at(scored.filter(F.col("split") == "test"), threshold, ["month"])


def evaluated(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("split").isin(*EVALUATED))


def compare_thresholds(scored: DataFrame, selection: DataFrame) -> DataFrame:
    """Metrics of both splits at the business threshold and at the F1 one."""
    both = {
        "business": selection.select("threshold").scalar(),
        "f1": selection.select("f1_threshold").scalar(),
    }
    repeated = evaluate.with_thresholds(evaluated(scored), both)
    return evaluate.classification_metrics(repeated, ["split", "threshold_name"])


def verdict(scored: DataFrame, selection: DataFrame) -> DataFrame:
    """Feasible on validation, both splits passing, every test month passing."""
    threshold = selection.select("threshold").scalar()
    gates = evaluate.business_gate(metrics_at(evaluated(scored), threshold, ["split"]), ["split"])
    monthly = evaluate.business_gate(monthly_metrics(scored, threshold), ["month"])
    return evaluate.overall_gate(
        selection.select("feasible_on_validation").scalar(), gates, monthly
    )


def evaluate_scores(scored: DataFrame) -> Evaluation:
    """All evaluation tables; the test rows never influence the threshold."""
    selection = select_threshold(scored)
    threshold = selection.select("threshold").scalar()
    metrics = metrics_at(evaluated(scored), threshold, ["split"])
    monthly = monthly_metrics(scored, threshold)
    ranking = curves.ranking_metrics(curves.score_curve(evaluated(scored), ["split"]), ["split"])
    return Evaluation(
        scored=scored, selection=selection, metrics=metrics, ranking=ranking,
        gates=evaluate.business_gate(metrics, ["split"]), monthly_metrics=monthly,
        monthly_gates=evaluate.business_gate(monthly, ["month"]),
        verdict=verdict(scored, selection),
        baselines=evaluate.baselines(scored.filter(F.col("split") == "test")),
        comparison=compare_thresholds(scored, selection),
    )
