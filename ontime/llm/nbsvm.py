"""Quality classifier: a linear hinge-loss model over n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ontime.llm.words import WordHashes, mix, shingles
from ontime.session import materialize

SAMPLE = 16_000  # labelled rows that a model is fitted on at most
BUCKETS = 2 ** 18
ALPHA = 1.0  # added to the count of every n-gram
COST = 1.0  # of a violated margin; a class with few rows gets more in proportion
PASSES = 12
THRESHOLD = 0.3
TOKEN = re.compile(r"\w+|[^\w\s]+|\n+")


class Shapes(WordHashes):
    """Hash of the look of a token: its case or digits, or the symbols themselves."""

    def __missing__(self, token: str) -> int:
        if len(self) >= 500_000:
            self.clear()
        if token[0] == "\n":
            look = "\n"
        elif not (token[0].isalnum() or token[0] == "_"):
            look = token[:3]
        elif len(token) > 1 and token.isupper():
            look = "AA"
        elif token.isdigit():
            look = "00"
        elif token.islower():
            look = "aa"
        else:
            look = "Aa" if token[0].isupper() and token[1:] == token[1:].lower() else "aA0"
        value = self[token] = xxhash.xxh3_64_intdigest(look)
        return value


def features(text: str, words: WordHashes, shapes: Shapes) -> np.ndarray:
    """Buckets of the n-grams that occur: single words, and one to three looks in a row.

    Bucket 0 is in every text and carries the bias.
    """
    found = TOKEN.findall(text)
    looks = shapes.of(found)
    parts = [words.of(found)] if found else []
    parts += [np.unique(shingles(looks, n)) + np.uint64(n) for n in (1, 2, 3) if len(looks) >= n]
    hashed = np.concatenate([np.zeros(0, np.uint64), *parts])
    return np.unique(np.r_[np.int64(0), 1 + (mix(hashed) % np.uint64(BUCKETS - 1)).astype(np.int64)]).astype(np.int32)


@dataclass
class Model:
    """Weights per bucket, already scaled by the ratios, and the curve from margin to score."""

    weights: np.ndarray
    ratios: np.ndarray
    slope: float
    shift: float

    def margin(self, buckets: np.ndarray) -> float:
        return float(self.weights[buckets].sum()) / float(np.sqrt((self.ratios[buckets] ** 2).sum()))

    def score(self, buckets: np.ndarray) -> float:
        z = self.slope * self.margin(buckets) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def to_bytes(self) -> bytes:
        return np.concatenate([[self.slope, self.shift], self.weights, self.ratios]).astype(np.float32).tobytes()

    @staticmethod
    def from_bytes(data: bytes) -> Model:
        numbers = np.frombuffer(data, np.float32)
        return Model(numbers[2:2 + BUCKETS], numbers[2 + BUCKETS:], float(numbers[0]), float(numbers[1]))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """log of how much likelier each bucket is in texts of label 1 than in those of label 0."""
    logs = []
    for label in (1, 0):
        own = [r for r, y in zip(rows, labels, strict=True) if y == label]
        counts = ALPHA + np.bincount(np.concatenate(own), minlength=BUCKETS)
        logs.append(np.log(counts / counts.sum()))
    ratios = logs[0] - logs[1]
    ratios[0] = 1.0
    return ratios


def dual_coordinate_descent(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, seed: int) -> np.ndarray:
    """Weights of the linear hinge-loss model, by passes over the dual variables in random order."""
    sign = np.where(labels == 1, 1.0, -1.0)
    share = np.where(labels == 1, (labels == 1).mean(), (labels == 0).mean())
    cost = COST * 0.5 / share
    norms = [np.sqrt((ratios[r] ** 2).sum()) for r in rows]
    weights, dual = np.zeros(BUCKETS), np.zeros(len(rows))
    random = np.random.default_rng(seed)
    for _ in range(PASSES):
        most = 0.0
        for i in random.permutation(len(rows)):
            # Rows have unit length, so the diagonal of the dual problem is 1.
            values = ratios[rows[i]] / norms[i]
            gradient = sign[i] * (weights[rows[i]] @ values) - 1
            moved = min(max(dual[i] - gradient, 0.0), cost[i])
            step = moved - dual[i]
            if step:
                weights[rows[i]] += step * sign[i] * values
                dual[i] = moved
                most = max(most, abs(step))
        if most < 1e-3:
            break
    return weights


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps on smoothed targets."""
    good, bad = int((labels == 1).sum()), int((labels == 0).sum())
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([((p - target) * margins).sum(), (p - target).sum()])
        hessian = np.array([[(w * margins ** 2).sum(), (w * margins).sum()], [(w * margins).sum(), w.sum()]])
        step = np.linalg.solve(hessian + 1e-6 * np.eye(2), gradient)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(slope), float(shift)


def fit(rows: list[np.ndarray], labels: np.ndarray, seed: int = 0) -> Model:
    """Fit on four fifths of the rows and calibrate on the rest; constant where a class is missing."""
    order = np.random.default_rng(seed).permutation(len(rows))
    cut = len(order) - len(order) // 5
    train, rest = order[:cut], order[cut:]
    flat = Model(np.zeros(BUCKETS), np.ones(BUCKETS), 0.0, 0.0)
    if len(set(labels[train].tolist())) < 2:
        if len(labels):
            flat.shift = 30.0 if labels.mean() >= 0.5 else -30.0
        return flat
    chosen = [rows[i] for i in train]
    ratios = log_count_ratios(chosen, labels[train])
    weights = dual_coordinate_descent(chosen, labels[train], ratios, seed)
    model = Model(weights * ratios, ratios, 1.0, 0.0)
    check = rest if len(set(labels[rest].tolist())) == 2 else order
    margins = np.array([model.margin(rows[i]) for i in check])
    model.slope, model.shift = calibrate(margins, labels[check])
    return model


def held_out() -> Column:
    """Rows that no model learns from: crc32 of the id as text is a multiple of 5."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """Learn from ``sample`` labelled documents at most, the first in the order of a hash of the id.

    Labels are 0 or 1; null ones count as missing, of several for one id the largest holds. The
    bound makes the sample fit in one task and in a broadcast; if there are fewer labelled rows,
    all are used.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label"))
    known = known.filter("doc_id is not null and label in (0, 1)").filter(~held_out())
    picked = known.groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, shapes = WordHashes(), Shapes()
        for batch in batches:
            rows = [features(t, words, shapes).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "buckets": rows})

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        given = pd.concat(parts).sort_values(["doc_id", "buckets"]) if parts else pd.DataFrame({"label": [], "buckets": []})
        rows = [np.frombuffer(b, np.int32) for b in given["buckets"]]
        yield pd.DataFrame({"model": [fit(rows, given["label"].to_numpy()).to_bytes()]})

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(materialize(picked)), "doc_id")
    encoded = materialize(joined.mapInPandas(encode, "doc_id long, label int, buckets binary"))
    row = encoded.repartition(1).mapInPandas(learn, "model binary").first()
    return Model.from_bytes(bytes(row["model"])) if row else fit([], np.zeros(0))


def score(documents: DataFrame, model: Model, spark: SparkSession | None = None) -> DataFrame:
    """All columns of ``documents`` and score, the chance of label 1; a column score is replaced.

    Null and empty texts have the score of a text without words. Repeated rows score alike. Rows
    are not shuffled; the model is ``2 * BUCKETS`` numbers, whatever the input.
    """
    spark = spark or documents.sparkSession
    sent = spark.sparkContext.broadcast(model.to_bytes())

    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        loaded, words, shapes = Model.from_bytes(sent.value), WordHashes(), Shapes()
        for texts in batches:
            yield pd.Series([loaded.score(features(t, words, shapes)) for t in texts])

    scored = F.pandas_udf(apply, "double")
    return documents.withColumn("score", scored(F.coalesce("text", F.lit(""))))
