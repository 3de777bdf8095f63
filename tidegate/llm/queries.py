"""Registered queries of the operators for training data, and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import (
    byte_bpe,
    decontamination,
    embedding_dedup,
    hard_negatives,
    language_id,
    license_scan,
    line_dedup,
    ngram_join,
    oracles,
    pii,
    quality,
    secret_scan,
    warc,
    whitening,
)
from tidegate.session import scratch_path


#: Key of the registered query; a job passes its own.
PSEUDONYM_SECRET = "demonstration"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(modulus: int) -> Column:
    """Fold of a document: CRC-32 of its id as text."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles have a Jaccard index of 0.85."""
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"), n=4, similar=(85, 100))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with its private values replaced by pseudonyms, and their number by kind."""
    return pii.pseudonymise(_table(spark, sf_dir, "documents"), PSEUDONYM_SECRET)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a 10-word window of a benchmark item."""
    found = decontamination.scan(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    items = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", items, "contaminated")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text by the public rank file, and the bytes they decode to, as digests."""
    ranks = byte_bpe.read_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = byte_bpe.encode(
        _table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN
    )
    decoded = byte_bpe.decode(encoded, ranks)
    ids = F.array_join(F.col("tokens").cast("array<string>"), " ")
    return decoded.select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives and read back."""
    path = scratch_path(spark, "warc")
    records = warc.plan_records(_table(spark, sf_dir, "pages"))
    # Compressed, as archives are kept; a file is what one task wrote, so it need not be split.
    warc.write_archives(records, path, compression="gzip")
    found = warc.resolve(warc.reassemble(warc.read_records(spark, path)))
    page = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+):", 1).try_cast("bigint")
    return found.select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
        "complete",
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text; dictionaries come from the folds 1 to 4 of 5."""
    docs = _table(spark, sf_dir, "documents")
    model = language_id.train(docs, fold(5) != 0)
    found = language_id.classify(docs, model)
    return found.select("doc_id", (fold(5) == 0).alias("held_out"), "lang_pred", "score", "rejected")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text; labels are learned from the folds other than 2 of 4."""
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"), fold(4) != 2)
    return quality.score(docs, model).select(
        "doc_id",
        (fold(4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in every text."""
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op8_license_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in every text, also of notices wrapped over lines."""
    return license_scan.windows(_table(spark, sf_dir, "documents"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors linked by a cosine of at least 0.95."""
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the runs of lines, of 50 words or more, that repeat an earlier place."""
    found = line_dedup.dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_deleted", "text")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, for its five best positives."""
    rows = _table(spark, sf_dir, "embeddings")
    shifted = (F.col("label") + 1) % 10
    label = F.when(F.col("vec_id") % 7 == 0, shifted).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the eight leading components of all vectors, each of unit variance.

    Null stands for a deviation beyond 64 bits; the operator returns it as a decimal.
    """
    found = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("bigint"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text: their number by base kind, and where they stand."""
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))
    spans = F.transform("findings", lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"]))
    base = F.filter(spans, lambda s: ~s.startswith(secret_scan.LITERAL + ":"))
    number = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *(number(kind).alias(f"n_{kind}") for kind, _, _ in secret_scan.BASE),
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(spans, ",").alias("spans"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through all stages of ``corpus_pipeline``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_pii": op2_pii,
    "op3_decontamination": op3_decontamination,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_warc": op5_warc,
    "op6_language_id": op6_language_id,
    "op7_quality": op7_quality,
    "op8_license_scan": op8_license_scan,
    "op8_license_windows": op8_license_windows,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_whitening": op12_whitening,
    "op13_secret_scan": op13_secret_scan,
    "pipeline": pipeline,
}

ORACLES = oracles.ORACLES
