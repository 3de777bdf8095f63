"""MD5 of streams that arrive as many rows.

MD5 depends on byte order and cannot be merged, and its running state cannot be stored with public
means: one stream is one chain of work for one task. All streams take the same path. A task holds
one Arrow batch at a time, whatever the length of a stream; a very long stream costs its task time
(some 500 MB a second), and a lost executor costs the streams of its unfinished tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.session import ship_package


def _runs(keys: list) -> Iterator[tuple[int, int]]:
    start = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[start]:
            yield start, i
            start = i


def _digest_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest rows sorted by stream; a stream may span Arrow batches."""
    current, md5, size = None, None, 0
    done: dict[str, list] = {"k": [], "n_bytes": [], "md5": []}

    def close() -> None:
        if md5 is not None:
            done["k"].append(current)
            done["n_bytes"].append(size)
            done["md5"].append(md5.hexdigest())

    key_type = None
    for batch in batches:
        key_type = batch.schema.field(0).type
        keys, values = batch.column(0).to_pylist(), batch.column(1)
        for start, end in _runs(keys):
            if md5 is None or keys[start] != current:
                close()
                current, md5, size = keys[start], hashlib.md5(usedforsecurity=False), 0
            for value in values.slice(start, end - start):
                piece = value.as_buffer()
                if piece is not None:
                    md5.update(piece)
                    size += len(piece)
        if len(done["k"]) >= 10_000:
            yield _batch(done, key_type)
            done = {name: [] for name in done}
    close()
    if done["k"]:
        yield _batch(done, key_type)


def _batch(columns: dict[str, list], key_type: pa.DataType) -> pa.RecordBatch:
    types = {"k": key_type, "n_bytes": pa.int64(), "md5": pa.string()}
    return pa.record_batch({n: pa.array(v, types[n]) for n, v in columns.items()})


def _key_ddl(df: DataFrame, key: str) -> str:
    return df.schema[key].dataType.simpleString()


def _by_stream(rows: DataFrame) -> DataFrame:
    """Whole streams per partition, in order.

    The shuffle is on a hash of the key, not the key: a join on the key below would already have
    that partitioning, Spark would drop the shuffle as redundant, and adaptive execution could
    then split the join for skew and scatter a stream over tasks.
    """
    return rows.repartition(F.xxhash64("k")).sortWithinPartitions("k", "seq")


def stream_digests(
    chunks: DataFrame, key: str = "stream_id", order: str = "seq", value: str = "value"
) -> DataFrame:
    """(stream, n_bytes, md5) of the bytes of each stream in order: one shuffle, one sort."""
    ship_package(chunks.sparkSession)
    rows = chunks.select(
        F.col(key).alias("k"), F.col(order).alias("seq"), F.col(value).cast("binary").alias("value")
    )
    digested = _by_stream(rows).select("k", "value").mapInArrow(
        _digest_sorted, f"k {_key_ddl(chunks, key)}, n_bytes BIGINT, md5 STRING"
    )
    return digested.withColumnRenamed("k", key)
