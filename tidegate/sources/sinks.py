"""Writers: message log, object cache and tee."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.operators.blocks import BLOCK_ROWS

LOG_COLUMNS = ("topic", "partition", "key", "value")


def log_rows(messages: DataFrame) -> DataFrame:
    """Exactly the columns of a message log; text values become bytes."""
    return messages.select(
        F.col("topic").cast("string"),
        F.col("partition").cast("int"),
        F.col("key").cast("string"),
        F.col("value").cast("binary"),
    )


def write_log(
    messages: DataFrame,
    path: str,
    keep: tuple[str, ...] = ("stream_id", "seq", "kind", "n_bytes"),
    cluster_by: tuple[str, ...] = (),
) -> None:
    """Message log as Parquet; the order of a stream is its ``seq`` column, kept with the rows.

    Rows are written where they are, without a shuffle. ``cluster_by`` range-partitions and
    sorts them first, e.g. by (stream_id, seq), where readers gain from clustered files; a hot
    stream then spans several files.
    """
    out = messages.select(*LOG_COLUMNS, *[c for c in keep if c in messages.columns])
    if cluster_by:
        out = out.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    out.write.mode("overwrite").parquet(path)


def with_offsets(
    placed: DataFrame,
    high_water: DataFrame | None = None,
    key: str = "stream_id",
    order: str = "seq",
    spread: int = 64,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Messages with their offset: dense within (topic, partition), rising along each stream.

    ``high_water(topic, partition, next_offset)`` says where partitions go on; others begin at 0.
    Streams are dealt into ``spread`` buckets and cut into blocks of order numbers, so no partition
    meets one task: rows are numbered within (partition, bucket, block), and only the blocks'
    counts meet their partition. The same messages get the same offsets, however they are dealt.
    """
    place, block = ["topic", "partition"], ["_bucket", "_block"]
    rows = placed.withColumns(
        {
            "_bucket": F.pmod(F.xxhash64(key), F.lit(spread).cast("bigint")),
            "_block": F.expr(f"`{order}` div {int(block_rows)}L"),
        }
    )
    within = Window.partitionBy(*place, *block).orderBy(key, order, "key")
    before = Window.partitionBy(*place).orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    counts = rows.groupBy(*place, *block).agg(F.count(F.lit(1)).alias("_n"))
    bases = counts.select(*place, *block, F.coalesce(F.sum("_n").over(before), zero).alias("_base"))
    if high_water is not None:
        bases = bases.join(high_water.select(*place, "next_offset"), place, "left")
        moved = F.col("_base") + F.coalesce("next_offset", zero)
        bases = bases.select(*place, *block, moved.alias("_base"))
    numbered = rows.withColumn("_row", F.row_number().over(within)).join(bases, [*place, *block])
    offset = (F.col("_base") + F.col("_row") - 1).cast("bigint")
    return numbered.withColumn("offset", offset).drop(*block, "_base", "_row")


def high_water(spark: SparkSession, path: str, before_batch: int | None = None) -> DataFrame | None:
    """Next offset per (topic, partition) of a log of :func:`append_log`; None before its first batch."""
    try:
        marks = spark.read.parquet(f"{path}/high_water")
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    if before_batch is not None:
        marks = marks.where(F.col("batch_id") < before_batch)
    return marks.groupBy("topic", "partition").agg(F.max("next_offset").alias("next_offset"))


def append_log(path: str, key: str = "stream_id", order: str = "seq") -> Callable[[DataFrame, int], None]:
    """Writer of placed micro-batches to ``<path>/log``, with offsets that go on from batch to batch.

    Each batch reads the marks of the batches before it, writes its rows, then its own marks, each
    to a folder of its own. A batch that is replayed finds the same marks and replaces what it
    wrote: the same offsets. Marks are one row per partition and batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = f"{path}/log/batch_id={batch_id}"
        marks = high_water(spark, path, batch_id)
        with_offsets(batch, marks, key, order).write.mode("overwrite").parquet(folder)
        written = spark.read.schema("topic STRING, partition INT, offset BIGINT").parquet(folder)
        ends = written.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))
        ends.coalesce(1).write.mode("overwrite").parquet(f"{path}/high_water/batch_id={batch_id}")

    return write


def write_kafka(messages: DataFrame, servers: str, **options: str) -> None:
    """Message log to Kafka (needs the public Kafka connector on the classpath).

    Negative partitions mean "choose by key" and are left to the producer.
    """
    rows = log_rows(messages).withColumn(
        "partition", F.when(F.col("partition") >= 0, F.col("partition"))
    )
    rows.write.format("kafka").option("kafka.bootstrap.servers", servers).options(**options).save()


def write_objects(chunks: DataFrame, path: str, key: str = "dest_key") -> None:
    """Object cache: the ordered chunks of all objects in one table.

    One directory per object would mean one per stream. Instead a Bloom filter on the key lets a
    reader of one object skip the other row groups, and the write needs no shuffle.
    """
    (
        chunks.write.mode("overwrite")
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .parquet(path)
    )


def read_object(spark: SparkSession, path: str, dest_key: str, order: str = "chunk_no") -> DataFrame:
    """Chunks of one cached object in order."""
    return spark.read.parquet(path).where(F.col("dest_key") == dest_key).orderBy(order)


def tee(*writers: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that hands one computed batch to several writers."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for writer in writers:
                writer(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def batch_folder(path: str) -> Callable[[DataFrame, int], None]:
    """Writer that puts each batch into its own folder, so a replayed batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write

