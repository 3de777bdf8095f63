"""Heartbeat, status, offline-request and job-status queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators import monitoring as m
from tidegate.operators.failures import failure_reasons
from tidegate.plans.fixtures import view, with_views

INTERVAL = "6h"
WRITER_ENGINE = "e0"


def _captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_bytes")
    return rows.withColumn("n_written", F.octet_length("payload").cast("bigint")).drop("payload")


def heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.heartbeats(_captures(spark, sf_dir), INTERVAL, written="n_written")


def final_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = failure_reasons(view(spark, sf_dir, "v_errors"))
    return m.final_status(_captures(spark, sf_dir), errors, INTERVAL, written="n_written")


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = m.status_log(
        heartbeats(spark, sf_dir), final_status(spark, sf_dir), view(spark, sf_dir, "v_stream_tasks")
    )
    return log.select(
        "stream_id", "ordinal", "status", "uptime_ms", "bytes_read", "bytes_written", "failure_reason", "error_message"
    )


def current_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.current_status(status_log(spark, sf_dir))


def offline_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.offline_log(heartbeats(spark, sf_dir), view(spark, sf_dir, "v_stream_tasks"))


def heartbeat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running and final heartbeats of online tasks as messages."""
    messages = m.heartbeat_messages(
        status_log(spark, sf_dir), view(spark, sf_dir, "v_stream_tasks")
    )
    return messages.withColumn("value", F.col("value").cast("string"))


def media_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.media_durations(view(spark, sf_dir, "v_logs"))


def _objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    cached = (
        view(spark, sf_dir, "v_bytes")
        .groupBy("stream_id")
        .agg(F.min("ts").alias("start_time"), F.sum("n_bytes").alias("n_bytes"))
        .withColumn("dest_key", F.concat(F.lit("cache/"), F.col("stream_id").cast("string")))
    )
    return m.object_summaries(cached, media_duration(spark, sf_dir))


def object_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _objects(spark, sf_dir)


def offline_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    offline = view(spark, sf_dir, "v_stream_tasks").where("is_offline")
    messages = m.offline_requests(offline, _objects(spark, sf_dir), final_status(spark, sf_dir))
    return messages.withColumn("value", F.col("value").cast("string"))


def job_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.flatten_job_status(view(spark, sf_dir, "v_jobs")).select(
        "job_id", "target_id", "engine_id", "engine_name", "status", "uptime_us", "bytes_read",
        "bytes_written",
    )


def job_status_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.status_report(job_status(spark, sf_dir))


def job_status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.status_rollup(job_status(spark, sf_dir))


def byte_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.reconcile_bytes(job_status(spark, sf_dir), WRITER_ENGINE)


def job_status_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job-status documents that hold no job: every sixth one is cut short here."""
    docs = view(spark, sf_dir, "v_jobs")
    number = F.regexp_extract("doc", '"id":"job([0-9]+)"', 1).cast("bigint")
    docs = docs.select("doc", number.alias("job_no"))
    cut = F.when(F.col("job_no") % 6 == 0, F.substring("doc", 1, 20)).otherwise(F.col("doc"))
    return m.rejected_job_status(docs.withColumn("doc", cut)).drop("sha256")


QUERIES = {
    "job_status_rejections": job_status_rejections,
    "heartbeats": heartbeats,
    "final_status": final_status,
    "status_log": status_log,
    "current_status": current_status,
    "offline_log": offline_log,
    "heartbeat_messages": heartbeat_messages,
    "media_duration": media_duration,
    "object_summaries": object_summaries,
    "offline_requests": offline_requests,
    "job_status": job_status,
    "job_status_report": job_status_report,
    "job_status_rollup": job_status_rollup,
    "byte_reconciliation": byte_reconciliation,
}

_STEP = 6 * 3600 * 1_000_000

_BEATS = f"""
extents AS (SELECT stream_id, min(epoch_us(ts)) AS f, max(epoch_us(ts)) AS l FROM v_bytes GROUP BY stream_id),
ticks AS (SELECT stream_id, f, unnest(range(0, (l - f) // {_STEP} + 1)) AS k FROM extents),
beats AS (
  SELECT t.stream_id, CAST(k + 1 AS BIGINT) AS ordinal, 'running' AS status,
         CAST(k * {_STEP} // 1000 AS BIGINT) AS uptime_ms,
         CAST(coalesce(sum(n_bytes) FILTER (WHERE epoch_us(ts) < f + k * {_STEP}), 0) AS BIGINT) AS bytes_read,
         CAST(coalesce(sum(length(payload)) FILTER (WHERE epoch_us(ts) < f + k * {_STEP}), 0) AS BIGINT) AS bytes_written
  FROM ticks t JOIN v_bytes b USING (stream_id) GROUP BY t.stream_id, f, k)"""

_FINALS = f"""
first_errors AS (
  SELECT stream_id, reason, message FROM (
    SELECT e.stream_id, e.message, coalesce(s.reason, 'other') AS reason,
           row_number() OVER (PARTITION BY e.stream_id ORDER BY e.ts, coalesce(s.rank, 99), e.message) AS rn
    FROM v_errors e LEFT JOIN (VALUES
      ('writer_setup', 0, 'file_write_error'), ('api_client', 1, 'api_error'),
      ('catalogue_lookup', 2, 'url_not_found'), ('source_url', 3, 'api_not_found'),
      ('mime_probe', 4, 'invalid_data'), ('window', 5, 'invalid_data'),
      ('stream_read', 6, 'stream_reader_error'), ('stream_write', 7, 'file_write_error')) s(stage, rank, reason) USING (stage))
  WHERE rn = 1),
sums AS (
  SELECT stream_id, max(epoch_us(ts)) - min(epoch_us(ts)) AS us, sum(n_bytes) AS r, sum(length(payload)) AS w
  FROM v_bytes GROUP BY stream_id),
finals AS (
  SELECT stream_id, CAST(us // {_STEP} + 2 AS BIGINT) AS ordinal,
         CASE WHEN reason IS NULL THEN 'done' ELSE 'failed' END AS status,
         CAST(us // 1000 AS BIGINT) AS uptime_ms, CAST(r AS BIGINT) AS bytes_read,
         CAST(w AS BIGINT) AS bytes_written, reason AS failure_reason, message AS error_message
  FROM sums LEFT JOIN first_errors USING (stream_id))"""

_LOG = """
log AS (
  SELECT * FROM (
    SELECT stream_id, ordinal, status, uptime_ms, bytes_read, bytes_written, NULL AS failure_reason, NULL AS error_message FROM beats
    UNION ALL
    SELECT stream_id, ordinal, status, uptime_ms, bytes_read, bytes_written, failure_reason, error_message FROM finals)
  WHERE stream_id NOT IN (SELECT stream_id FROM v_stream_tasks WHERE is_offline))"""

_SIZE = """CASE
  WHEN bytes_written > 1073741824 THEN format('{:.1f} GB', bytes_written / 1073741824.0)
  WHEN bytes_written > 1048576 THEN format('{:.1f} MB', bytes_written / 1048576.0)
  WHEN bytes_written > 1024 THEN format('{:.1f} KB', bytes_written / 1024.0)
  ELSE bytes_written || ' B' END"""

_DURATIONS = """
times AS (
  SELECT stream_id, line_no, regexp_extract(line, ' time=([0-9:.]+) ', 1) AS t
  FROM v_logs WHERE regexp_matches(line, ' time=([0-9:.]+) ')),
durations AS (
  SELECT stream_id, CAST(max_by(us, line_no) AS BIGINT) AS duration_us, CAST(count(*) AS BIGINT) AS n_times
  FROM (SELECT *, (CAST(split_part(t, ':', 1) AS BIGINT) * 3600 + CAST(split_part(t, ':', 2) AS BIGINT) * 60
                   + CAST(split_part(split_part(t, ':', 3), '.', 1) AS BIGINT)) * 1000000 + 40000 AS us FROM times)
  GROUP BY stream_id)"""

_OBJECTS = """
objects AS (
  SELECT stream_id, 'cache/' || stream_id || '.nut' AS media_uri,
         CAST(s // 1000000 AS BIGINT) AS start_s,
         CAST((s + coalesce(duration_us, 0)) // 1000000 AS BIGINT) AS end_s, n AS n_bytes
  FROM (SELECT stream_id, epoch_us(min(ts)) AS s, CAST(sum(n_bytes) AS BIGINT) AS n FROM v_bytes GROUP BY stream_id)
  LEFT JOIN durations USING (stream_id))"""

_RECORDS = """
records AS (
  SELECT 'job' || l_orderkey AS job_id, CAST(l_orderkey AS VARCHAR) AS target_id,
         'e' || (l_suppkey % 5) AS engine_id, 'Engine ' || (l_suppkey % 5) AS engine_name,
         CASE l_returnflag WHEN 'A' THEN 'complete' WHEN 'R' THEN 'failed' ELSE 'aborted' END AS status,
         CAST(l_linenumber AS BIGINT) * 60000000 + CAST(floor(l_quantity) AS BIGINT) * 1000000 + 500000 AS uptime_us,
         l_partkey * 10240 AS bytes_read, l_partkey * 10240 + l_suppkey AS bytes_written
  FROM lineitem)"""

_REPORT = """CAST(count(*) AS BIGINT) AS n_tasks, CAST(sum(uptime_us) AS BIGINT) AS uptime_us,
  CAST(sum(bytes_read) AS BIGINT) AS bytes_read, CAST(sum(bytes_written) AS BIGINT) AS bytes_written"""

ORACLES = {
    "job_status_rejections": "SELECT DISTINCT l_orderkey AS job_no, CAST(20 AS BIGINT) AS n_bytes "
    "FROM lineitem WHERE l_orderkey % 6 = 0",
    "heartbeats": with_views(["v_bytes"], "SELECT * FROM beats", _BEATS),
    "final_status": with_views(["v_bytes", "v_errors"], "SELECT * FROM finals", _FINALS),
    "status_log": with_views(
        ["v_bytes", "v_errors", "v_stream_tasks"], "SELECT * FROM log", _BEATS, _FINALS, _LOG
    ),
    "current_status": with_views(
        ["v_bytes", "v_errors", "v_stream_tasks"],
        "SELECT stream_id, max(ordinal) AS ordinal, max_by(status, ordinal) AS status FROM log GROUP BY stream_id",
        _BEATS,
        _FINALS,
        _LOG,
    ),
    "offline_log": with_views(
        ["v_bytes", "v_stream_tasks"],
        f"SELECT stream_id, ordinal, '-- written: ' || {_SIZE} || ', status: ' || status AS line "
        "FROM beats JOIN v_stream_tasks USING (stream_id) WHERE is_offline",
        _BEATS,
    ),
    "heartbeat_messages": with_views(
        ["v_bytes", "v_errors", "v_stream_tasks"],
        """
SELECT 'engine_status' AS topic, CAST(-1 AS INT) AS partition, task_id AS key,
       '{"jobId":"' || job_id || '","taskId":"' || task_id || '","tdoId":"' || tdo_id || '","engineId":"' || engine_id
         || '","engineInstanceId":"' || engine_instance_id || '","count":' || ordinal
         || ',"status":"' || status || '","upTime":' || uptime_ms || ',"bytesRead":' || bytes_read
         || ',"bytesWritten":' || bytes_written
         || coalesce(',"errorMsg":"' || error_message || '","failureMsg":"' || error_message
                     || '","failureReason":"' || failure_reason || '"', '') || '}' AS value
FROM log JOIN v_stream_tasks USING (stream_id)""",
        _BEATS,
        _FINALS,
        _LOG,
    ),
    "media_duration": with_views(["v_logs"], "SELECT * FROM durations", _DURATIONS),
    "object_summaries": with_views(
        ["v_bytes", "v_logs"], "SELECT * FROM objects", _DURATIONS, _OBJECTS
    ),
    "offline_requests": with_views(
        ["v_bytes", "v_logs", "v_errors", "v_stream_tasks"],
        """
SELECT 'ingestion_queue_0' AS topic, CAST(-1 AS INT) AS partition, scheduled_job_id AS key,
       '{"scheduledJobId":"' || scheduled_job_id || '","sourceId":"' || source_id || '","mediaUri":"' || media_uri
         || '","startTime":' || start_s || ',"endTime":' || end_s
         || ',"sourceTaskSummary":{"orgId":"' || organization_id || '","jobId":"' || job_id || '","taskId":"' || task_id
         || '","engineId":"' || engine_id || '","engineInstanceId":"' || engine_instance_id
         || '","bytesRead":' || bytes_read || ',"bytesWritten":' || bytes_written || ',"upTime":' || uptime_ms
         || ',"status":"' || status || '"' || coalesce(',"errorMsg":"' || error_message || '"', '') || '}}' AS value
FROM v_stream_tasks t JOIN objects USING (stream_id) JOIN finals USING (stream_id)
WHERE is_offline AND NOT disable_s3""",
        _DURATIONS,
        _OBJECTS,
        _FINALS,
    ),
    "job_status": f"WITH {_RECORDS} SELECT * FROM records",
    "job_status_report": f"WITH {_RECORDS} SELECT engine_id, status, {_REPORT} FROM records GROUP BY engine_id, status",
    "job_status_rollup": f"WITH {_RECORDS} SELECT engine_id, status, {_REPORT} FROM records GROUP BY ROLLUP (engine_id, status)",
    "byte_reconciliation": f"""
WITH {_RECORDS},
sides AS (
  SELECT target_id, max(bytes_written) FILTER (WHERE engine_id = '{WRITER_ENGINE}') AS written_bytes,
         min(bytes_read) FILTER (WHERE engine_id <> '{WRITER_ENGINE}') AS read_bytes,
         count(*) FILTER (WHERE engine_id <> '{WRITER_ENGINE}') AS n_readers
  FROM records GROUP BY target_id)
SELECT target_id, CAST(n_readers AS BIGINT) AS n_readers, written_bytes, coalesce(read_bytes, 0) AS read_bytes,
       written_bytes - coalesce(read_bytes, 0) AS missing_bytes,
       CAST(ceil(written_bytes / 10240.0) - ceil(coalesce(read_bytes, 0) / 10240.0) AS BIGINT) AS missing_messages,
       coalesce(read_bytes, 0) % 10240 = 0 AS whole_messages, read_bytes IS NULL AS unread
FROM sides WHERE written_bytes IS NOT NULL""",
}
