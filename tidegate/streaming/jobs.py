"""Structured Streaming forms of the operators.

Chunking and slicing are the batch functions applied to a streaming DataFrame; only windowed
operators need their own form. Event time must be a TIMESTAMP, and windows close by watermark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidegate.functions.constants import HEARTBEAT_INTERVAL, NO_DATA_TIMEOUT
from tidegate.functions.values import literal_micros, micros
from tidegate.operators.slicing import capture_slice, limit_us, window_bins
from tidegate.session import scratch_path
from tidegate.streaming.progress import Totals

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_table_stream(spark: SparkSession, folder: str, table: str, **options: str) -> DataFrame:
    """File stream over ``<folder>/<table>.parquet``, one file or a folder of files.

    The braces make the path a glob: a file stream refuses the plain path of a single file.
    """
    schema = spark.read.parquet(f"{folder}/{table}.parquet").schema
    return spark.readStream.schema(schema).options(**options).parquet(f"{folder}/{{{table}.parquet}}")


def with_event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def _text(duration: str) -> str:
    return f"{literal_micros(duration)} microseconds"


def heartbeat_windows(
    captures: DataFrame,
    delay: str,
    interval: str = HEARTBEAT_INTERVAL,
    key: str = "stream_id",
    ts: str = "ts",
    n_bytes: str = "n_bytes",
) -> DataFrame:
    """Rows and bytes per stream and interval, sent when the watermark closes the interval.

    ``delay`` is how late a row may come: later ones are dropped, and :func:`run_to_table` counts
    them. The last intervals close with the end of the input (:func:`ending`). Only intervals with data appear; rows are pre-aggregated before the shuffle and state
    holds one row per open (stream, interval). :func:`running_windows` adds running totals.
    """
    timed = with_event_time(captures, ts, delay)
    return (
        timed.groupBy(key, F.window(ts, _text(interval)).alias("w"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(n_bytes).alias("n_bytes"))
        .select(key, F.col("w.start").alias("window_start"), "n_rows", "n_bytes")
    )


def running_windows(windows: DataFrame, key: str = "stream_id") -> DataFrame:
    """Running totals over the written intervals: what a heartbeat at each interval's end reports.

    The table has one row per stream and interval with data, never one per captured row.
    """
    so_far = (
        Window.partitionBy(key)
        .orderBy("window_start")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return windows.select(
        key,
        "window_start",
        F.row_number().over(Window.partitionBy(key).orderBy("window_start")).alias("ordinal"),
        F.sum("n_bytes").over(so_far).alias("bytes_read"),
    )


def session_ends(
    captures: DataFrame,
    delay: str,
    timeout: str = NO_DATA_TIMEOUT,
    key: str = "stream_id",
    ts: str = "ts",
    n_bytes: str = "n_bytes",
) -> DataFrame:
    """Sessions of each stream; a session ends when no row with data arrives for ``timeout``.

    The first session of a stream is what a writer with that timeout would have delivered.
    ``delay`` and the end of the input are as in :func:`heartbeat_windows`.
    """
    timed = with_event_time(captures.where(F.col(n_bytes) > 0), ts, delay)
    return (
        timed.groupBy(key, F.session_window(ts, _text(timeout)).alias("s"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(n_bytes).alias("n_bytes"))
        .select(
            key,
            F.col("s.start").alias("start_time"),
            F.col("s.end").alias("end_time"),
            "n_rows",
            "n_bytes",
        )
    )


def first_sessions(sessions: DataFrame, key: str = "stream_id") -> DataFrame:
    """First finished session of each stream, from the table the stream has written."""
    first = F.min(F.struct("start_time", "end_time", "n_rows", "n_bytes")).alias("s")
    return sessions.groupBy(key).agg(first).select(key, "s.*")


def slice_stream(captures: DataFrame, windows: DataFrame, bin_width: str = "1h") -> DataFrame:
    """Stream-static slice join; windows without a limit go on as long as the stream does."""
    return capture_slice(captures, windows, bin_width)


def slice_streams(
    captures: DataFrame,
    windows: DataFrame,
    longest: str,
    delay: str,
    bin_width: str = "1h",
) -> DataFrame:
    """Slice join of two streams: captured rows and recording windows, both in event time.

    Windows must have a limit of at most ``longest``; that bound and the watermarks let Spark
    drop rows and windows from the join state once nothing can match them any more. A window
    beyond it fails the job rather than being cut; windows without a limit belong in
    :func:`slice_stream`. ``delay`` is how late a row or window may come.
    """
    bin_us = literal_micros(bin_width)
    limit = limit_us(F.col("duration_us"), F.col("reader"))
    fits = F.coalesce(limit <= literal_micros(longest), F.lit(False))
    checked = F.when(fits, F.col("duration_us")).otherwise(
        F.raise_error(F.lit(f"a window has no limit or one beyond {longest}")).cast("bigint")
    )
    spans = with_event_time(windows.withColumn("duration_us", checked), "start_ts", delay)
    limited = window_bins(spans, bin_us, keep=("start_ts",)).withColumnRenamed("stream_id", "_stream")
    rows = with_event_time(captures, "ts", delay).withColumn("_at", micros(F.col("ts")))
    rows = rows.withColumn("_bin", F.floor(F.col("_at") / bin_us))
    reach = F.expr(f"start_ts + INTERVAL {literal_micros(longest)} MICROSECONDS")
    inside = (
        (F.col("stream_id") == F.col("_stream"))
        & (F.col("_bin") == F.col("bin"))
        & (F.col("ts") >= F.col("start_ts"))
        & (F.col("ts") < reach)
        & (F.col("_at") < F.col("end_us"))
    )
    return rows.join(limited, inside).drop("_stream", "_bin", "_at", "bin", "start_us", "end_us", "start_ts")


def ending(stream: DataFrame, ts: str = "ts") -> tuple[DataFrame, Callable[[], None]]:
    """``stream`` with an end: calling the second value says that no more rows will come.

    It lands one row without a key in the far future. Where the watermark follows it, all windows
    and sessions before it close; its own never does.
    """
    spark = stream.sparkSession
    path = scratch_path(spark, "stream-end")
    spark.createDataFrame([], stream.schema).write.parquet(path)
    marks = spark.readStream.schema(stream.schema).parquet(path)

    def end() -> None:
        kinds = {f.name: f.dataType for f in stream.schema}
        fields = [
            F.lit("9999-01-01 00:00:00").cast(kind).alias(name)
            if name == ts
            else (F.lit(1) if name == "n_bytes" else F.lit(None)).cast(kind).alias(name)
            for name, kind in kinds.items()
        ]
        spark.range(1).select(*fields).write.mode("append").parquet(path)

    return stream.unionByName(marks), end


def run_to_table(
    stream: DataFrame,
    label: str,
    mode: str = "append",
    end: Callable[[], None] | None = None,
    report: dict | None = None,
    stateful: bool = False,
    path: str | None = None,
) -> DataFrame:
    """Process everything available into Parquet and return the written table.

    With ``end`` (of :func:`ending`) the input ends there: the same run goes on until every window,
    session and timer is closed. ``report`` gets the run's totals: ``batches``, ``late_rows`` (dropped as
    too late), and the sums of :func:`tidegate.streaming.progress.observed`. ``stateful`` picks
    the state store that processors with timers need. A ``path`` used before goes on from its checkpoint.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, label)
    writer = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", f"{path}/_progress")
    )
    totals = Totals()
    if report is not None:
        spark.streams.addListener(totals)
    try:
        if end is None:
            query = _start(writer.trigger(availableNow=True), f"{path}/rows", stateful)
            query.awaitTermination()
        else:
            query = _start(writer, f"{path}/rows", stateful)
            try:
                query.processAllAvailable()
                end()
                query.processAllAvailable()
            finally:
                query.stop()
        if report is not None:
            report.update(totals.of(query.runId))
    finally:
        if report is not None:
            spark.streams.removeListener(totals)
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def _start(writer: DataStreamWriter, path: str, stateful: bool) -> StreamingQuery:
    """Start a query; it keeps the settings it was started with."""
    spark = SparkSession.active()
    before = spark.conf.get(_STORE, None)
    if stateful:
        spark.conf.set(_STORE, _ROCKSDB)
    try:
        return writer.start(path)
    finally:
        if stateful:
            spark.conf.unset(_STORE) if before is None else spark.conf.set(_STORE, before)


def run_batches(
    stream: DataFrame, label: str, write: Callable[[DataFrame, int], None], mode: str = "append"
) -> None:
    """Process everything available through a ``foreachBatch`` function."""
    path = scratch_path(stream.sparkSession, label)
    query = (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
