"""The trained bundle on shared storage: trees, encodings, profiles, metrics, importances."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ontime import schema
from ontime.operators.model import DelayModel
from ontime.operators.profiles import Profiles
from ontime.sources import snapshot

METRIC_SCHEMA = "section string, metric string, value double, text string"
IMPORTANCE_SCHEMA = "feature string, importance double"
METADATA_SCHEMA = T.StructType([
    T.StructField("artifact_version", T.IntegerType()),
    T.StructField("label", T.StringType()),
    T.StructField("single_class", T.BooleanType()),
    T.StructField("constant", T.DoubleType()),
    T.StructField("prior", T.DoubleType()),
    T.StructField("delay_threshold", T.DoubleType()),
    T.StructField("threshold_strategy", T.StringType()),
    T.StructField("ready", T.BooleanType()),
    T.StructField("violations", T.ArrayType(T.StringType())),
    T.StructField("history_cutoff_date", T.StringType()),
])


def save_bundle(
    spark: SparkSession, folder: str, model: DelayModel, profiles: Profiles, metadata: dict
) -> None:
    """Write a bundle; tables as Parquet, trees in Spark ML's own format, facts as JSON."""
    if model.trees is not None:
        model.trees.write().overwrite().save(f"{folder}/trees")
    model.encodings.write.mode("overwrite").parquet(f"{folder}/encodings")
    for name, table in profiles.tables.items():
        table.write.mode("overwrite").parquet(f"{folder}/profiles/{name}")
    facts = {
        "artifact_version": schema.ARTIFACT_VERSION, "label": schema.TARGET_LABEL,
        "single_class": model.trees is None, "constant": model.constant, "prior": model.prior,
        **metadata,
    }
    row = tuple(facts.get(name) for name in METADATA_SCHEMA.names)
    spark.createDataFrame([row], METADATA_SCHEMA).coalesce(1).write.mode("overwrite").json(
        f"{folder}/metadata"
    )


def load_bundle(spark: SparkSession, folder: str):
    """Read a bundle back as ``(model, profiles, metadata row)``; other versions are refused."""
    facts = spark.read.schema(METADATA_SCHEMA).json(f"{folder}/metadata").first()
    if facts is None or facts.artifact_version != schema.ARTIFACT_VERSION:
        found = None if facts is None else facts.artifact_version
        raise ValueError(
            f"bundle version {found!r} found, {schema.ARTIFACT_VERSION} expected: train again"
        )
    trees = None if facts.single_class else GBTClassificationModel.load(f"{folder}/trees")
    model = DelayModel(
        spark.read.parquet(f"{folder}/encodings"), facts.prior, trees, facts.constant
    )
    names = (
        ["history_defaults", "schedule_defaults", "history_cutoff"]
        + [f"history_{level}" for level in schema.HISTORY_LEVELS]
        + [f"schedule_{name}" for name in schema.SCHEDULE_PROFILES]
    )
    tables = {name: spark.read.parquet(f"{folder}/profiles/{name}") for name in names}
    return model, Profiles(tables), facts


def _read_or_none(reader) -> DataFrame | None:
    try:
        return reader()
    except AnalysisException:
        return None


def load_metrics(spark: SparkSession, path: str | None) -> DataFrame:
    """A metrics document as ``(section, metric, value, text, source)`` rows.

    A document of another version or target, or without the test section or the gate, is
    refused as a whole: the published snapshot takes its place. So does a missing path.
    """
    known = spark.createDataFrame(list(snapshot.METRICS), METRIC_SCHEMA).withColumn(
        "source", F.lit("snapshot")
    )
    document = _read_or_none(lambda: spark.read.schema(METRIC_SCHEMA).json(path)) if path else None
    if document is None:
        return known
    section, metric = F.col("section"), F.col("metric")
    accepted = document.agg(
        F.coalesce(
            F.bool_or((metric == "artifact_version") & (F.col("value") == schema.ARTIFACT_VERSION))
            & F.bool_or((metric == "label") & (F.col("text") == schema.TARGET_LABEL))
            & F.bool_or(section == "delay_classification.test")
            & F.bool_or(section == "delay_classification.business_gate"),
            F.lit(False),
        )
    ).scalar()
    local = document.withColumn("source", F.lit("local")).filter(accepted)
    return local.unionByName(known.filter(~accepted))


def load_importances(spark: SparkSession, path: str | None) -> DataFrame:
    """Feature importances, or the published selection when the file is missing or stale."""
    known = spark.createDataFrame(list(snapshot.IMPORTANCES), IMPORTANCE_SCHEMA).withColumn(
        "source", F.lit("snapshot")
    )
    table = (
        _read_or_none(lambda: spark.read.schema("feature string, importance string")
                      .option("header", True).csv(path)) if path else None
    )
    if table is None:
        return known
    typed = table.select("feature", F.col("importance").try_cast("double").alias("importance"))
    stale = typed.agg(
        F.coalesce(
            F.bool_or(F.col("feature").contains("average_delay_minutes") | F.col("importance").isNull()),
            F.lit(True),
        )
    ).scalar()
    local = typed.withColumn("source", F.lit("local")).filter(~stale)
    return local.unionByName(known.filter(stale))


def top_importances(importances: DataFrame, limit: int = 15) -> DataFrame:
    """The strongest features, shown in ascending order."""
    return importances.orderBy(F.desc("importance"), "feature").limit(limit).orderBy("importance")
