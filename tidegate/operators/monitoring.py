"""Heartbeats, final status, ingestion requests, media duration and job-status reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions.constants import (
    DEFAULT_REQUEST_TOPIC,
    DEFAULT_STATUS_TOPIC,
    HEARTBEAT_INTERVAL,
    MESSAGE_BYTES,
    OBJECT_EXTENSION,
)
from tidegate.functions.values import (
    duration_micros,
    human_size,
    literal_micros,
    media_time_micros,
    micros,
)
from tidegate.operators.blocks import BLOCK_ROWS, PIECE, explode_range, with_stream_extent
from tidegate.schemas import JOB_STATUS

_TIME_IN_LINE = r" time=([0-9:.]+) "


def _beats(
    captures: DataFrame, interval: str, key: str, order: str, ts: str, read: str, written: str,
    block_rows: int,
) -> DataFrame:
    """Bytes per stream and tick, one row per tick with data, with the stream's extent."""
    step = literal_micros(interval)
    rows = captures.select(
        F.col(key).alias("k"),
        F.col(order).alias("o"),
        micros(F.col(ts)).alias("us"),
        F.col(read).cast("bigint").alias("r"),
        F.col(written).cast("bigint").alias("w"),
    )
    extent = {"first_us": F.min("us"), "last_us": F.max("us")}
    timed = with_stream_extent(rows, "k", "o", extent, block_rows)
    # A row is seen by the first tick strictly after it.
    tick = F.expr(f"(us - first_us) div {step}L + 1")
    return timed.groupBy("k", "first_us", "last_us", tick.alias("tick")).agg(
        F.sum("r").alias("r"), F.sum("w").alias("w")
    )


def heartbeats(
    captures: DataFrame,
    interval: str = HEARTBEAT_INTERVAL,
    key: str = "stream_id",
    order: str = "seq",
    ts: str = "ts",
    read: str = "n_bytes",
    written: str = "n_bytes",
    block_rows: int = BLOCK_ROWS,
    piece: int = PIECE,
) -> DataFrame:
    """Running heartbeats: one at the start, then one per interval until the last row.

    Rows are summed per stream and tick before the running totals, so the window sees ticks,
    never rows. Idle ticks repeat the last totals: each tick with data emits all ticks up to
    the next one, without a join, in pieces of ``piece`` ticks, so that no gap is too long for an array.
    """
    step = literal_micros(interval)
    beats = _beats(captures, interval, key, order, ts, read, written, block_rows)
    by_tick = Window.partitionBy("k").orderBy("tick")
    so_far = by_tick.rowsBetween(Window.unboundedPreceding, 0)
    last_tick = F.expr(f"(last_us - first_us) div {step}L")
    filled = beats.select(
        "k",
        "first_us",
        F.col("tick"),
        F.least(F.coalesce(F.lead("tick").over(by_tick) - 1, last_tick), last_tick).alias("upto"),
        F.sum("r").over(so_far).alias("r"),
        F.sum("w").over(so_far).alias("w"),
    )
    # The first data tick is always 1; it also emits the heartbeat sent at the start.
    since = F.when(F.col("tick") == 1, F.lit(0).cast("bigint")).otherwise(F.col("tick"))
    each = explode_range(filled.select("k", "r", "w", "upto", since.alias("since")), F.col("since"), F.col("upto"), "tick", piece)
    at_start = F.col("tick") == 0
    return each.select(
        F.col("k").alias(key),
        (F.col("tick") + 1).alias("ordinal"),
        F.lit("running").alias("status"),
        F.expr(f"tick * {step}L div 1000L").alias("uptime_ms"),
        F.when(at_start, 0).otherwise(F.col("r")).alias("bytes_read"),
        F.when(at_start, 0).otherwise(F.col("w")).alias("bytes_written"),
    )


def final_status(
    captures: DataFrame,
    first_errors: DataFrame,
    interval: str = HEARTBEAT_INTERVAL,
    key: str = "stream_id",
    ts: str = "ts",
    read: str = "n_bytes",
    written: str = "n_bytes",
) -> DataFrame:
    """The closing heartbeat: done, or failed with its reason; its ordinal follows the last tick."""
    step = literal_micros(interval)
    at = micros(F.col(ts))
    totals = captures.groupBy(key).agg(
        (F.max(at) - F.min(at)).alias("_us"),
        F.coalesce(F.sum(F.col(read).cast("bigint")), F.lit(0)).alias("bytes_read"),
        F.coalesce(F.sum(F.col(written).cast("bigint")), F.lit(0)).alias("bytes_written"),
    )
    errors = first_errors.select(key, "failure_reason", "error_message")
    return totals.join(errors, key, "left").select(
        key,
        F.expr(f"_us div {step}L + 2").alias("ordinal"),
        F.when(F.col("failure_reason").isNull(), F.lit("done"))
        .otherwise(F.lit("failed"))
        .alias("status"),
        F.expr("_us div 1000L").alias("uptime_ms"),
        "bytes_read",
        "bytes_written",
        "failure_reason",
        "error_message",
    )


def status_log(beats: DataFrame, finals: DataFrame, tasks: DataFrame, key: str = "stream_id") -> DataFrame:
    """Running and final heartbeats of online tasks; offline tasks only log locally."""
    series = beats.unionByName(finals, allowMissingColumns=True)
    offline = tasks.where(F.col("is_offline")).select(key).distinct()
    return series.join(offline, key, "left_anti")


def current_status(series: DataFrame, key: str = "stream_id") -> DataFrame:
    """Latest status of each stream: the row with the highest ordinal."""
    return series.groupBy(key).agg(
        F.max("ordinal").alias("ordinal"), F.max_by("status", "ordinal").alias("status")
    )


def offline_log(beats: DataFrame, tasks: DataFrame, key: str = "stream_id") -> DataFrame:
    """Human-readable progress lines of offline tasks."""
    offline = tasks.where(F.col("is_offline")).select(key).distinct()
    line = F.concat(
        F.lit("-- written: "), human_size(F.col("bytes_written")), F.lit(", status: "), "status"
    )
    return beats.join(offline, key, "left_semi").select(key, "ordinal", line.alias("line"))


def heartbeat_messages(series: DataFrame, tasks: DataFrame, key: str = "stream_id",
                       topic: str = DEFAULT_STATUS_TOPIC) -> DataFrame:
    """Heartbeats as (topic, partition, key, value) messages; the task id is the key.

    ``series`` is a :func:`status_log`: running and final heartbeats of online tasks, the final
    ones with the failure of a failed stream. ``tasks`` has the ids of tasks and engines.
    """
    ids = tasks.select(key, "job_id", "task_id", "tdo_id", "engine_id", "engine_instance_id")
    body = F.to_json(
        F.struct(
            F.col("job_id").alias("jobId"),
            F.col("task_id").alias("taskId"),
            F.col("tdo_id").alias("tdoId"),
            F.col("engine_id").alias("engineId"),
            F.col("engine_instance_id").alias("engineInstanceId"),
            F.col("ordinal").alias("count"),
            "status",
            F.col("uptime_ms").alias("upTime"),
            F.col("bytes_read").alias("bytesRead"),
            F.col("bytes_written").alias("bytesWritten"),
            F.col("error_message").alias("errorMsg"),
            F.col("error_message").alias("failureMsg"),
            F.col("failure_reason").alias("failureReason"),
        )
    )
    return series.join(ids, key).select(
        F.lit(topic).alias("topic"),
        F.lit(-1).alias("partition"),
        F.col("task_id").alias("key"),
        body.cast("binary").alias("value"),
    )


def media_durations(
    logs: DataFrame, key: str = "stream_id", order: str = "line_no", line: str = "line"
) -> DataFrame:
    """Media duration per stream: the last ``time=`` of the last line that has one.

    An unreadable time anywhere voids the duration. Only integers are aggregated, so every
    input partition folds to one row per stream before the shuffle.
    """
    found = F.regexp_extract_all(F.col(line), F.lit(_TIME_IN_LINE), F.lit(1))
    us = media_time_micros(F.element_at(found, -1))
    timed = logs.where(F.col(line).rlike(_TIME_IN_LINE)).select(
        F.col(key), F.col(order).alias("_o"), us.alias("_us")
    )
    folded = timed.groupBy(key).agg(
        F.max_by("_us", "_o").alias("_us"),
        F.max(F.col("_us").isNull()).alias("_bad"),
        F.count(F.lit(1)).alias("n_times"),
    )
    return folded.select(
        key, F.when(~F.col("_bad"), F.col("_us")).alias("duration_us"), "n_times"
    )


def object_summaries(
    objects: DataFrame, durations: DataFrame, key: str = "stream_id"
) -> DataFrame:
    """Start and end (unix seconds) of cached objects; end is start when no duration is known.

    ``objects`` has key, dest_key, start_time, n_bytes.
    """
    us = micros(F.col("start_time"))
    return objects.join(durations.select(key, "duration_us"), key, "left").select(
        key,
        F.concat("dest_key", F.lit(f".{OBJECT_EXTENSION}")).alias("media_uri"),
        F.floor(us / 1_000_000).alias("start_s"),
        F.floor((us + F.coalesce("duration_us", F.lit(0))) / 1_000_000).alias("end_s"),
        "n_bytes",
    )


def offline_requests(
    tasks: DataFrame,
    objects: DataFrame,
    finals: DataFrame,
    key: str = "stream_id",
    topic: str = DEFAULT_REQUEST_TOPIC,
) -> DataFrame:
    """Offline-ingestion requests as messages, one per finished offline task.

    ``tasks`` has key, scheduled_job_id, source_id, organization_id, job_id, task_id, engine_id,
    engine_instance_id and disable_s3; tasks that do not cache their object send no request. The
    final heartbeat tells the bytes read and written.
    """
    caching = tasks.where(~F.coalesce("disable_s3", F.lit(False)))
    totals = finals.select(
        key, "uptime_ms", "status", "error_message", "bytes_read", "bytes_written"
    )
    joined = caching.join(objects.drop("n_bytes"), key).join(totals, key)
    summary = F.struct(
        F.col("organization_id").cast("string").alias("orgId"),
        F.col("job_id").alias("jobId"),
        F.col("task_id").alias("taskId"),
        F.col("engine_id").alias("engineId"),
        F.col("engine_instance_id").alias("engineInstanceId"),
        F.col("bytes_read").alias("bytesRead"),
        F.col("bytes_written").alias("bytesWritten"),
        F.col("uptime_ms").alias("upTime"),
        "status",
        F.col("error_message").alias("errorMsg"),
    )
    body = F.to_json(
        F.struct(
            F.col("scheduled_job_id").alias("scheduledJobId"),
            F.col("source_id").alias("sourceId"),
            F.col("media_uri").alias("mediaUri"),
            F.col("start_s").alias("startTime"),
            F.col("end_s").alias("endTime"),
            summary.alias("sourceTaskSummary"),
        )
    )
    return joined.select(
        F.lit(topic).alias("topic"),
        F.lit(-1).alias("partition"),
        F.col("scheduled_job_id").alias("key"),
        body.cast("binary").alias("value"),
    )


def flatten_job_status(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """One row per task record of each job-status document; counters become numbers.

    A job without records gives one row without a record; documents without a job are left to
    :func:`rejected_job_status`. The one-element array keeps the JSON parse in a generator, so it
    runs once per document.
    """
    parsed = docs.select(F.explode(F.array(F.from_json(doc, JOB_STATUS))).alias("d"))
    records = parsed.where("d.data.job IS NOT NULL").select(
        F.col("d.data.job.id").alias("job_id"),
        F.explode_outer("d.data.job.tasks.records").alias("r"),
    )

    def number(name: str) -> Column:
        return F.col(f"r.taskOutput.{name}").try_cast("bigint")

    return records.select(
        "job_id",
        F.col("r.targetId").alias("target_id"),
        F.col("r.engine.id").alias("engine_id"),
        F.col("r.engine.name").alias("engine_name"),
        F.col("r.status").alias("status"),
        duration_micros(F.col("r.taskOutput.uptime")).alias("uptime_us"),
        number("bytesRead").alias("bytes_read"),
        number("bytesWritten").alias("bytes_written"),
        number("heartbeats").alias("heartbeats"),
        F.col("r.taskOutput.failureReason").alias("failure_reason"),
        F.col("r.executionLocation.data.name").alias("location"),
    )


def rejected_job_status(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Documents that hold no job, by length and digest, with the other columns of ``docs``."""
    job = F.from_json(doc, "data STRUCT<job: STRUCT<id: STRING>>")["data"]["job"]
    text = F.coalesce(F.col(doc), F.lit(""))
    return docs.where(job.isNull()).select(
        *(c for c in docs.columns if c != doc),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        F.sha2(text, 256).alias("sha256"),
    )


def _report(grouped) -> DataFrame:
    return grouped.agg(
        F.count(F.lit(1)).alias("n_tasks"),
        F.sum("uptime_us").alias("uptime_us"),
        F.sum("bytes_read").alias("bytes_read"),
        F.sum("bytes_written").alias("bytes_written"),
    )


def status_report(records: DataFrame) -> DataFrame:
    return _report(records.groupBy("engine_id", "status"))


def status_rollup(records: DataFrame) -> DataFrame:
    """The report with subtotals per engine and a grand total (NULL labels)."""
    return _report(records.rollup("engine_id", "status"))


def reconcile_bytes(
    records: DataFrame, writer_engine: str, message_bytes: int = MESSAGE_BYTES
) -> DataFrame:
    """Bytes written by one engine against bytes read by the others, per target with a writer.

    A target that no other engine reads, or whose readers report no bytes, has lost everything:
    it counts as 0 bytes read and is flagged ``unread``. Both sides come from one conditional group-by instead of a self-join.
    """
    is_writer = F.col("engine_id") == writer_engine
    sides = records.groupBy("target_id").agg(
        F.max(F.when(is_writer, F.col("bytes_written"))).alias("written_bytes"),
        F.min(F.when(~is_writer, F.col("bytes_read"))).alias("read_bytes"),
        F.count(F.when(~is_writer, 1)).alias("n_readers"),
    )
    both = (
        sides.where(F.col("written_bytes").isNotNull())
        .withColumn("unread", F.col("read_bytes").isNull())
        .withColumn("read_bytes", F.coalesce("read_bytes", F.lit(0).cast("bigint")))
    )
    missing = F.col("written_bytes") - F.col("read_bytes")

    def messages(n: str) -> Column:
        return F.ceil(F.col(n) / message_bytes)

    return both.select(
        "target_id",
        "n_readers",
        "written_bytes",
        "read_bytes",
        missing.alias("missing_bytes"),
        (messages("written_bytes") - messages("read_bytes")).alias("missing_messages"),
        (F.col("read_bytes") % message_bytes == 0).alias("whole_messages"),
        "unread",
    )
