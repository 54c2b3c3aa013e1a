"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ontime.llm.nbsvm import held_out
from ontime.llm.words import mix
from ontime.session import materialize

BUCKETS = 2 ** 16
ORDERS = (1, 2, 3)
SAMPLE = 4000  # documents per language that a model is fitted on, about
ALPHA = 0.5
LANGUAGES = 128  # languages of the model that are held at once
TASKS = 12  # that count the sample, each giving a row per language
PIECE = 2_000_000  # characters handled at once
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Lower-case code point of every letter; 0 for all other characters."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def grams(text: str) -> np.ndarray:
    """Buckets of all n-grams over the letters of a text, a run of other characters being a blank.

    Empty where the text has no letter. n-grams of blanks alone are left out.
    """
    codes = letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not codes.any():
        return np.zeros(0, np.int32)
    kept = codes[(codes > 0) | (np.r_[np.uint32(1), codes[:-1]] > 0)]
    padded = np.r_[np.uint32(0), kept, np.uint32(0)].astype(np.uint64)
    parts = []
    for n in ORDERS:
        count = len(padded) - n + 1
        value = np.full(count, n, np.uint64)
        for k in range(n):
            value = value * np.uint64(2_097_143) + padded[k:k + count]
        if n == 1:
            value = value[padded > 0]
        parts.append((mix(value) % np.uint64(BUCKETS)).astype(np.int32))
    return np.concatenate(parts)


def model_blocks(documents: DataFrame, sample: int = SAMPLE) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """Languages, log-probabilities (BUCKETS x languages) and log-priors, ``LANGUAGES`` at a time.

    Learns from rows that are not held out and have a language and letters; about ``sample`` of
    each language, chosen by a hash of the id, all where there are fewer. Priors count all such
    rows. Counts are summed per task, then per language, so one row per language and task moves.
    A task holds one language at a time; the driver holds a name and a number of each language.
    """
    usable = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").filter(
        "lang is not null and text is not null"
    ).filter(~held_out())
    sizes = usable.groupBy("lang").count().collect()
    names = sorted(r["lang"] for r in sizes)
    if not names:
        return
    total = sum(r["count"] for r in sizes)
    prior = {r["lang"]: np.log(r["count"] / total) for r in sizes}
    spark = documents.sparkSession
    rates = spark.createDataFrame([(r["lang"], min(1.0, sample / r["count"])) for r in sizes], "lang string, rate double")
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < F.col("rate") * 1_000_000
    chosen = usable.join(F.broadcast(rates), "lang").filter(drawn)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, sums = None, np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                if lang != current:
                    if current is not None:
                        yield pd.DataFrame({"lang": [current], "counts": [sums.tobytes()]})
                    current, sums = lang, np.zeros(BUCKETS, np.int64)
                sums += np.bincount(grams(text), minlength=BUCKETS)
        if current is not None:
            yield pd.DataFrame({"lang": [current], "counts": [sums.tobytes()]})

    def add(key: tuple, part: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(BUCKETS, np.int64)
        for frame in part:
            for counts in frame["counts"]:
                sums += np.frombuffer(counts, np.int64)
        yield pd.DataFrame({"lang": [key[0]], "counts": [sums.tobytes()]})

    schema = "lang string, counts binary"
    partial = chosen.select("lang", "text").repartition(TASKS).sortWithinPartitions("lang").mapInPandas(count, schema)
    whole = materialize(partial.groupBy("lang").applyInPandas(add, schema))
    empty = np.zeros(BUCKETS, np.int64)
    for i in range(0, len(names), LANGUAGES):
        part = names[i:i + LANGUAGES]
        found = whole.filter(F.col("lang").between(part[0], part[-1])).collect()
        sums = {r["lang"]: np.frombuffer(bytes(r["counts"]), np.int64) for r in found}
        table = np.stack([sums.get(n, empty) for n in part], axis=1) + ALPHA
        yield part, np.log(table / table.sum(axis=0)).astype(np.float32), np.array([prior[n] for n in part], np.float32)


def train(documents: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The blocks of ``model_blocks`` in one, for models that fit into memory."""
    none = [], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32)
    names, tables, priors = zip(none, *model_blocks(documents, sample), strict=True)
    return sum(names, []), np.concatenate(tables, axis=1), np.concatenate(priors)


def predict(documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """All columns of ``documents`` and held_out, lang_pred, score; columns of these names go.

    ``lang_pred`` is a language seen in training, or ``und`` with score 0 where the text is null or
    has no letter, or nothing could be learnt. ``score`` is the share of the likeliest language
    when the log-probability per n-gram decides. Of equally likely languages the first by name is
    taken. Rows are not shuffled. All languages are scored; where there are more than LANGUAGES,
    workers read the model block by block for every piece of text and keep the running best.
    """
    context = documents.sparkSession.sparkContext
    sent = [context.broadcast(part) for part in model_blocks(documents, sample)]

    def load(part):
        """One block stays in the memory of a worker; several are read anew from its disk."""
        path = getattr(part, "_path", None)
        return part.load_from_path(path) if len(sent) > 1 and path else part.value

    def block(texts: list[str]) -> list[tuple[str, float]]:
        found = [grams(t) for t in texts]
        sizes = np.array([len(g) for g in found])
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        rows = np.flatnonzero(sizes)
        if not len(rows) or not sent:
            return out
        # One long list of buckets, cut where texts begin: a sparse matrix in compressed rows.
        starts = np.r_[0, np.cumsum(sizes[rows])[:-1]]
        buckets = np.concatenate([found[i] for i in rows])
        best, top, total = np.full(len(rows), -np.inf), np.full(len(rows), -np.inf), np.zeros(len(rows))
        likeliest = [UNKNOWN] * len(rows)
        for part in sent:
            names, table, prior = load(part)
            sums = prior + np.stack(
                [np.add.reduceat(table[:, k][buckets].astype(np.float64), starts) for k in range(len(names))], axis=1
            )
            own = sums.argmax(axis=1)
            value = sums[np.arange(len(rows)), own]
            for i in np.flatnonzero(value > best):
                likeliest[i] = names[own[i]]
            best = np.maximum(best, value)
            mean = sums / np.sqrt(sizes[rows])[:, None]
            higher = np.maximum(top, mean.max(axis=1))
            total = total * np.exp(top - higher) + np.exp(mean - higher[:, None]).sum(axis=1)
            top = higher
        for i, name, share in zip(rows, likeliest, 1 / total, strict=True):
            out[i] = (name, float(share))
        return out

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, texts, size = [], [], 0
            for text in batch.column("text").to_pylist():
                texts.append(text or "")
                size += len(texts[-1])
                if size > PIECE:
                    out += block(texts)
                    texts, size = [], 0
            out += block(texts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([n for n, _ in out], pa.string()), pa.array([s for _, s in out], pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    rows = documents.drop("held_out", "lang_pred", "score")
    fields = [*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return rows.mapInArrow(apply, T.StructType(fields)).withColumn("held_out", held_out())
