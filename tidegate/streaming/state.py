"""Counters of live streams carried from micro-batch to micro-batch, and digests of landed ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.operators.digest import stream_digests


def landed_rows(
    rows: DataFrame, key: str = "stream_id", order: str = "seq", value: str = "payload"
) -> DataFrame:
    """Rows of a live stream in the shape that :func:`landed_digests` reads back.

    A running MD5 cannot be stored as state, so a stream's rows are landed as they come (append
    mode, no state at all) and digested once it has ended. Rows may arrive late or out of order.
    """
    return rows.select(
        F.col(key).alias("k"),
        F.col(order).cast("bigint").alias("seq"),
        F.col(value).cast("binary").alias("value"),
    )


def landed_digests(landed: DataFrame, key: str = "stream_id") -> DataFrame:
    """Rows, bytes and MD5 of each landed stream."""
    counts = landed.groupBy("k").agg(F.count(F.lit(1)).alias("n_rows"))
    digests = stream_digests(landed, "k", "seq", "value")
    return counts.join(digests, "k").select(F.col("k").alias(key), "n_rows", "n_bytes", "md5")
