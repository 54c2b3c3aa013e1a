"""The delay classifier: category encodings, boosted trees, probabilities, importances."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ontime import schema
from ontime.operators.attach import FeatureTable, broadcastable, join_small, join_table
from ontime.operators.forest import forest_nodes
from ontime.operators.stages import best_by_auc, staged_margins
from ontime.session import materialize, scratch_path

# Missing numbers are placed below every observed value, as tree learners with a "minimum" rule do.
# Every feature that can be missing is a rate or a volume, hence never negative.
MISSING_NUMBER = -1.0
SMOOTHING = 20.0
FOLDS = 5


def encoded_name(category: str) -> str:
    return f"{category}_rate"


INPUTS = [*schema.NUMERIC_FEATURES, *[encoded_name(name) for name in schema.CATEGORY_FEATURES]]


def fold_of(key: str, folds: int = FOLDS) -> Column:
    """Fold of a training row, from a hash of its key."""
    return F.pmod(F.xxhash64(key), F.lit(folds)).cast("int")


def category_encodings(
    frame: DataFrame, label: str = schema.TARGET_LABEL, smoothing: float = SMOOTHING,
    categories: tuple[str, ...] = schema.CATEGORY_FEATURES, fold: Column | None = None,
    folds: int = FOLDS,
) -> DataFrame:
    """Smoothed delay rate of each level: ``(category, level, rows, rate, fold_rates)``.

    One scan and one shuffle serve all categories. Rare levels are drawn towards the overall
    rate, which is also what an unseen level receives. With ``fold``, ``fold_rates`` holds for each
    fold the rate over all the others: a training row is encoded without its own label.
    """
    fold = F.lit(0) if fold is None else fold
    counts = (
        frame.select(F.col(label).cast("bigint").alias("_label"), fold.alias("_fold"), *categories)
        .unpivot(["_label", "_fold"], list(categories), "category", "level")
        .groupBy("category", "level")
        .agg(
            F.count(F.lit(1)).alias("rows"), F.sum("_label").alias("delayed"),
            F.array(*[F.count_if(F.col("_fold") == i) for i in range(folds)]).alias("fold_rows"),
            F.array(*[F.sum(F.when(F.col("_fold") == i, F.col("_label")).otherwise(0)) for i in range(folds)]).alias("fold_delayed"),
        )
    )
    stored = materialize(counts)
    overall = stored.filter(F.col("category") == categories[0]).agg(
        F.sum("delayed").cast("double") / F.sum("rows")
    ).scalar()

    def rate(delayed: Column, rows: Column) -> Column:
        return (delayed + F.lit(smoothing) * F.col("_overall")) / (rows + F.lit(smoothing))

    others = F.transform(
        F.arrays_zip("fold_rows", "fold_delayed"),
        lambda own: rate(F.col("delayed") - own["fold_delayed"], F.col("rows") - own["fold_rows"]),
    )
    return stored.withColumn("_overall", overall).select(
        "category", "level", "rows", rate(F.col("delayed"), F.col("rows")).alias("rate"),
        others.alias("fold_rates"),
    )


def overall_rate(frame: DataFrame, label: str = schema.TARGET_LABEL) -> DataFrame:
    return frame.agg(F.avg(label).alias("rate"))


def encode(frame: DataFrame, encodings: DataFrame, prior: float | Column,
           categories: tuple[str, ...] = schema.CATEGORY_FEATURES, fold: Column | None = None) -> DataFrame:
    """Add the rate of each category; encodings with few enough levels are broadcast.

    ``fold`` is the fold of a training row and null for any other row, which gets the full rate. The
    fold is part of the join key, so that a row carries one number per category and no array.
    """
    sizes = {row.category: row["count"] for row in encodings.groupBy("category").count().collect()}
    keys, rates, copies, data = (), encodings.select("category", "level", "rate"), 1, frame
    if fold is not None:
        numbered = F.posexplode(F.concat(F.array("rate"), "fold_rates")).alias("_fold", "rate")
        keys, rates, copies = ("_fold",), encodings.select("category", "level", numbered), FOLDS + 1
        data = frame.withColumn("_fold", F.coalesce(fold + 1, F.lit(0)))
    tables = []
    for name in categories:
        levels = rates.filter(F.col("category") == name).select(
            F.col("level").alias(name), *keys, F.col("rate").alias(encoded_name(name))
        )
        tables.append(FeatureTable(levels, (name, *keys), sizes.get(name, 0) * copies))
    chosen = broadcastable(tables)
    for place, table in enumerate(tables):
        data = join_small(data, table) if place in chosen else join_table(data, table)
    prior = prior if isinstance(prior, Column) else F.lit(float(prior))
    return data.withColumns({
        name: F.coalesce(F.col(name), prior) for name in map(encoded_name, categories)
    }).drop(*keys)


def packed(frame: DataFrame) -> DataFrame:
    """Add ``_numbers``, the numeric features as one array, missing ones replaced.

    Joins then pass one value for all of them; a row of as many columns is copied by every join, in
    methods too long to be compiled.
    """
    numbers = [F.coalesce(F.col(name).cast("double"), F.lit(MISSING_NUMBER)) for name in schema.NUMERIC_FEATURES]
    return frame.withColumn("_numbers", F.array(*numbers))


def assemble(encoded: DataFrame) -> DataFrame:
    """The feature vector of rows that were ``packed`` and got their rates; NaN is refused."""
    values = F.concat("_numbers", F.array(*map(encoded_name, schema.CATEGORY_FEATURES)))
    refused = F.raise_error(F.lit("NaN among the features of a row"))
    checked = F.when(F.array_contains(values, float("nan")), refused).otherwise(values)
    about = {"ml_attr": {"num_attrs": len(INPUTS)}}
    return encoded.withColumn("features", array_to_vector(checked).alias("features", metadata=about)).drop("_numbers")


@dataclass(frozen=True)
class TreeSettings:
    """Size and speed of the boosting, and how many trees may pass without a better tuning AUC."""

    iterations: int = 600
    depth: int = 8
    learning_rate: float = 0.08
    patience: int = 80
    seed: int = 42
    min_rows: int = 20  # in a leaf
    subsample: float = 0.7  # of the rows, for each tree
    columns: str = "onethird"  # of the features, for each split


@dataclass
class DelayModel:
    """A fitted classifier with what it needs to read new rows.

    ``trees`` is ``None`` when the training rows held one class only; ``constant`` is then the
    probability of a delay.
    """

    encodings: DataFrame
    prior: float
    trees: GBTClassificationModel | None
    constant: float = 0.0

    def score(self, frame: DataFrame, output: str = "delay_probability") -> DataFrame:
        """Add the probability of a delay."""
        if self.trees is None:
            return frame.withColumn(output, F.lit(self.constant))
        vectors = assemble(encode(packed(frame), self.encodings, self.prior))
        positive = vector_to_array("probability").getItem(1)
        scored = self.trees.transform(vectors).withColumn(output, positive)
        return scored.select(*frame.columns, output)

    def importances(self, spark) -> DataFrame:
        """Importance of each model input, highest first; one row per feature."""
        weights = self.trees.featureImportances.toArray() if self.trees else [0.0] * len(INPUTS)
        rows = [(name, float(value) * 100.0) for name, value in zip(schema.FEATURES, weights)]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(
            F.desc("importance"), "feature"
        )


def _classifier(settings: TreeSettings, iterations: int) -> GBTClassifier:
    return GBTClassifier(
        labelCol=schema.TARGET_LABEL, featuresCol="features", maxIter=iterations,
        maxDepth=settings.depth, stepSize=settings.learning_rate, seed=settings.seed,
        minInstancesPerNode=settings.min_rows, subsamplingRate=settings.subsample,
        featureSubsetStrategy=settings.columns,
    )


def _vectors(rows: DataFrame, encodings: DataFrame, prior: float, fold: Column | None) -> DataFrame:
    vectors = assemble(encode(packed(rows), encodings, prior, fold=fold))
    return materialize(vectors.select("features", F.col(schema.TARGET_LABEL).cast("double").alias(schema.TARGET_LABEL)))


def fit(frame: DataFrame, settings: TreeSettings = TreeSettings(), key: str = "flight_key") -> DelayModel:
    """Fit on the training part, choose the number of trees on the tuning part, refit on both.

    ``frame`` carries a ``split`` column; only ``train`` and ``tuning`` rows are used. Rows that a
    model is fitted on get category rates of the other folds, all other rows the full rates. The
    refit takes encodings of both parts and as many trees as ranked the tuning part best, by its exact AUC.
    """
    known = frame.filter(F.col("split").isin("train", "tuning"))
    is_train, late = F.col("split") == "train", F.col(schema.TARGET_LABEL) == 1
    counts = known.agg(
        F.count_if(is_train).alias("train"), F.count_if(is_train & late).alias("train_late"),
        F.count_if(~is_train).alias("tuning"), F.count_if(~is_train & late).alias("tuning_late"),
    ).first()
    if not counts.train:
        raise ValueError("no training rows")
    fold = fold_of(key)
    rows, delayed = counts.train + counts.tuning, counts.train_late + counts.tuning_late
    encodings = materialize(category_encodings(known, fold=fold))
    if delayed in (0, rows):
        return DelayModel(encodings, delayed / rows, None, float(delayed > 0))
    trees = settings.iterations
    if 0 < counts.tuning_late < counts.tuning and 0 < counts.train_late < counts.train:
        train = known.filter(is_train)
        early, prior = materialize(category_encodings(train, fold=fold)), counts.train_late / counts.train
        first = _classifier(settings, trees).fit(_vectors(train, early, prior, fold))
        tuning = _vectors(known.filter(~is_train), early, prior, None)
        folder = scratch_path(frame.sparkSession, "first-trees")
        first.write().save(folder)
        staged = materialize(staged_margins(tuning, first, forest_nodes(frame.sparkSession, folder)).drop("features"))
        trees = best_by_auc(staged, trees, settings.patience, schema.TARGET_LABEL)
    prior = delayed / rows
    return DelayModel(encodings, prior, _classifier(settings, trees).fit(_vectors(known, encodings, prior, fold)))
