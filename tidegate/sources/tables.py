"""Readers: task documents, source catalogues, landed payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.values import blank_to_null
from tidegate.operators.tasks import normalise
from tidegate.schemas import CORRUPT, SOURCE_JSON, TASK_JSON



def flatten_tasks(docs: DataFrame) -> DataFrame:
    """Canonical task columns from decoded documents (unknown keys are already dropped)."""
    p = "taskPayload"
    flat = docs.select(
        F.col("jobId").alias("job_id"),
        F.col("taskId").alias("task_id"),
        F.col("recordingId").alias("tdo_id"),
        "token",
        F.col(f"{p}.recordStartTime").alias("record_start"),
        F.col(f"{p}.recordEndTime").alias("record_end"),
        F.col(f"{p}.recordDuration").alias("record_duration"),
        F.coalesce(f"{p}.startTimeOverride", F.lit(0).cast("bigint")).alias("start_time_override"),
        F.coalesce(f"{p}.tdoOffsetMS", F.lit(0)).alias("tdo_offset_ms"),
        F.col(f"{p}.sourceId").alias("source_id"),
        F.when(
            F.col(f"{p}.sourceDetails").isNotNull(),
            F.struct(
                F.col(f"{p}.sourceDetails.url").alias("url"),
                F.col(f"{p}.sourceDetails.radioStreamUrl").alias("radio_stream_url"),
            ),
        ).alias("source_details"),
        F.col(f"{p}.scheduledJobId").alias("scheduled_job_id"),
        F.col(f"{p}.url").alias("url"),
        F.col(f"{p}.cacheToS3Key").alias("cache_key"),
        F.col(f"{p}.disableKafka").alias("disable_kafka"),
        F.col(f"{p}.disableS3").alias("disable_s3"),
        F.coalesce(f"{p}.scfsWriterBufferSize", F.lit(0)).alias("writer_buffer"),
        F.coalesce(f"{p}.organizationId", F.lit(0).cast("bigint")).alias("organization_id"),
        *([CORRUPT] if CORRUPT in docs.columns else []),
    )
    return normalise(flat)


def read_tasks(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Task documents from JSON lines; unreadable rows keep their text in ``_corrupt_record``."""
    reader = spark.readStream if streaming else spark.read
    docs = (
        reader.schema(f"{TASK_JSON}, {CORRUPT} STRING")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )
    return flatten_tasks(docs)


def decode_tasks(docs: DataFrame, value: str) -> DataFrame:
    """Task documents held as text in a column, e.g. the values of a message log."""
    parsed = F.from_json(
        value,
        f"{TASK_JSON}, {CORRUPT} STRING",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    return flatten_tasks(docs.select(parsed.alias("d")).select("d.*"))


def read_sources(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Source catalogue; JSON documents are brought to the canonical columns."""
    if fmt == "json":
        docs = spark.read.schema(SOURCE_JSON).json(path)
        return docs.select(
            F.col("id").alias("source_id"),
            F.coalesce("sourceType.isLive", F.lit(False)).alias("is_live"),
            F.struct(
                blank_to_null(F.col("details.url")).alias("url"),
                blank_to_null(F.col("details.radioStreamUrl")).alias("radio_stream_url"),
            ).alias("details"),
        )
    return spark.read.format(fmt).load(path).select("source_id", "is_live", "details")


def read_landed_objects(spark: SparkSession, path: str, streaming: bool = False, **options: str) -> DataFrame:
    """Landed payload files, one row each: object, modified_at, n_bytes, payload.

    A row holds 2 GiB at most: Spark fails on a longer file, and such objects belong in a captures
    table of many rows per stream (:func:`read_captures`). Without the payload column only file metadata is read.
    """
    if streaming:
        reader = spark.readStream.schema(
            "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
        )
    else:
        reader = spark.read
    files = reader.format("binaryFile").options(**options).load(path)
    return files.select(
        F.col("path").alias("object"),
        F.col("modificationTime").alias("modified_at"),
        F.col("length").alias("n_bytes"),
        F.col("content").alias("payload"),
    )


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """Captured rows: stream_id, seq, ts, payload."""
    return spark.read.parquet(path).select("stream_id", "seq", "ts", "payload")
