"""Quality classifier: hashed word n-gram logistic regression, trained by follow the regularised leader."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm import tokens
from tidegate.session import give_back, ship_package

BITS = 18
#: Labelled rows that training uses at most: those with the smallest hash of their id.
TRAINING_ROWS = 8192
EPOCHS = 3
#: Step size and regularisation of the per-coordinate updates.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.01, 1e-4
_BIAS = 0.3
_REPEAT = np.uint64(0x2545F4914F6CDD1D)


def _alphabet() -> tokens.Alphabet:
    """Words of letters and digits, and runs of other signs as words of their own; case counts."""
    classes = np.full(256, 2)
    classes[:0x21] = 0
    classes[0x7F] = 0
    for low, high in ((48, 58), (65, 91), (97, 123), (128, 256)):
        classes[low:high] = 1
    return tokens.Alphabet(classes, fold=False)


_ALPHABET = _alphabet()


@dataclass
class Model:
    """Weights by hash bucket, the last one for the bias."""

    weights: np.ndarray


def _features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and values of each text: words, pairs of words and words that follow themselves.

    Values are square roots of counts, scaled to length 1, and a constant for the bias.
    """
    data, offsets = tokens.string_bytes(texts)
    hashes, row, kind = tokens.words(data, offsets, _ALPHABET)
    bounds = np.searchsorted(row, np.arange(len(offsets)))
    for i in range(len(offsets) - 1):
        own = hashes[bounds[i] : bounds[i + 1]]
        plain = own[kind[bounds[i] : bounds[i + 1]] == 1]
        again = np.count_nonzero(plain[1:] == plain[:-1])
        grams = np.concatenate([own, tokens.ngrams(own, 2), np.full(again, _REPEAT)])
        bucket = np.sort((grams >> np.uint64(64 - BITS)).astype(np.int32))
        if not bucket.size:
            yield np.array([1 << BITS]), np.array([_BIAS])
            continue
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        value = np.sqrt(np.diff(first, append=bucket.size))
        value /= np.sqrt(bucket.size)
        yield np.append(bucket[first], 1 << BITS), np.append(value, _BIAS)


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights learned from one bounded sample, in the order of the rows."""
    examples = []
    for batch in _parts(batches):
        examples += zip(_features(batch.column(0)), batch.column(1).to_pylist())
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    for _ in range(EPOCHS):
        for (bucket, value), label in examples:
            old, seen = z[bucket], n[bucket]
            weight = _weights(old, seen)
            guess = 1 / (1 + np.exp(-np.clip(weight @ value, -35, 35)))
            gradient = (guess - label) * value
            more = seen + gradient * gradient
            z[bucket] = old + gradient - (np.sqrt(more) - np.sqrt(seen)) / ALPHA * weight
            n[bucket] = more
    yield pa.record_batch([pa.array([_weights(z, n).astype(np.float32).tobytes()])], ["weights"])


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = TRAINING_ROWS,
) -> Model:
    """Model of ``label_col`` (0 or 1) from labelled texts for whose id ``usable`` holds.

    Of the labelled ids the ``rows`` with the smallest hash are learned from, in that order, in
    one task: ``rows`` is the bound on what it holds. Ids with two labels count as the larger one,
    ids with two texts as the least text; other labels, null labels, null ids and ids without a
    row in ``docs`` are left out. With nothing to learn from, every score is one half.
    """
    ship_package(docs.sparkSession)
    marked = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("id").isNotNull())
        .join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")
    )
    marked = marked.withColumnRenamed("id", id_col).filter(usable).withColumnRenamed(id_col, "id")
    order = F.xxhash64(F.col("id").cast("string"))
    chosen = (
        marked.groupBy("id").agg(F.max("label").alias("label"))
        .withColumn("place", order).orderBy("place", "id").limit(rows)
    )
    # At most ``rows`` ids of a few bytes: the bound of the sample is the bound of the broadcast.
    sample = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        .join(F.broadcast(chosen), "id")
        .groupBy("id", "label", "place").agg(F.min("text").alias("text"))
    )
    ordered = sample.coalesce(1).sortWithinPartitions("place", "id").select("text", "label")
    found = ordered.mapInArrow(give_back(_fit), "weights binary").collect()
    if not found:
        return Model(np.zeros((1 << BITS) + 1, np.float32))
    return Model(np.frombuffer(bytes(found[0]["weights"]), np.float32))


def _scorer(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in _parts(batches):
            margin = [weights[bucket] @ value for bucket, value in _features(batch.column(1))]
            score = 1 / (1 + np.exp(-np.clip(np.array(margin, np.float64), -35, 35)))
            yield pa.record_batch([batch.column(0), pa.array(score)], ["id", "score"])

    return run


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id_col, score)`` of each row's whole text, from 0 to 1; higher: label 1 is likelier.

    Null and empty texts get the score of a text without features. Rows are kept one for one,
    ids may be null or repeat, other columns are ignored. The model (1 MiB) is broadcast.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model.weights)
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", kind), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(give_back(_scorer(shared)), schema).withColumnRenamed("id", id_col)


def filter_quality(
    docs: DataFrame,
    model: Model,
    least: float = 0.7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows of ``docs`` whose score is at least ``least``, with all their columns and no shuffle."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model.weights)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in _parts(batches):
            texts = batch.column(at).cast(pa.string())
            margin = np.array([weights[b] @ v for b, v in _features(texts)], np.float64)
            kept = 1 / (1 + np.exp(-np.clip(margin, -35, 35))) >= least
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(give_back(run), docs.schema)
