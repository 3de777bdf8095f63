"""Cleaning and encoding of the table ``documents``, stage by stage.

Every stage works on all that its predecessor kept. Its result is written as Parquet to the shared
folder and read again, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import byte_bpe, decontamination, line_dedup, ngram_join, quality
from tidegate.llm.queries import fold
from tidegate.session import arrow_rows, materialise


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.7 or more; it learns as ``op7_quality`` does."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels, fold(4) != 2)
    return quality.filter_quality(docs, model, 0.7)


def _lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines that repeat an earlier place go; so do documents of nothing else.

    ``n_chars`` follows the text.
    """
    cut = line_dedup.dedup(docs)
    left = cut.filter((F.col("n_deleted") == 0) | F.col("text").rlike(r"\S"))
    return left.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by a Jaccard index of 0.8."""
    groups = ngram_join.near_duplicates(docs, n=5, similar=(80, 100))
    return ngram_join.keep_one(docs, groups).select(*docs.columns)


def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no 10-word window of a benchmark item occurs."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.remove_documents(docs, items)


def _encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text that is left; texts that do not decode to themselves would show.

    The ids are written before they are decoded: a task that did both would need two Python workers.
    """
    ranks = byte_bpe.read_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    with arrow_rows(spark, ngram_join.BATCH_ROWS):
        encoded = materialise(byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN), "pipeline-tokens")
    decoded = byte_bpe.decode(encoded, ranks)
    return decoded.select(
        "doc_id",
        "tokens",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", _quality),
    ("line dedup", _lines),
    ("n-gram Jaccard join", _near_duplicates),
    ("benchmark decontamination", _decontamination),
    ("byte-level BPE", _encoding),
]

#: The classifier's weights and the byte-pair merges are beyond SQL; tests compare the stages with
#: brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from ``documents`` to token ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
