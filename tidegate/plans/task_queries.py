"""Task-planning queries over the whole task table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators import tasks as t
from tidegate.plans.fixtures import sources, tasks, view, with_views
from tidegate.session import scratch_path
from tidegate.sources.tables import CORRUPT, decode_tasks, read_sources, read_tasks

NOW = "1998-04-25 00:00:00"


def _now():
    return F.lit(NOW).cast("timestamp")


def _ntz(*names: str):
    return {n: F.col(n).cast("timestamp_ntz") for n in names}


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.validate(tasks(spark, sf_dir))


def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.resolve_sources(t.accepted(validated(spark, sf_dir)), sources(spark, sf_dir))


def planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted tasks with source, window, media time and sink: the whole planning step."""
    windows = t.plan_windows(resolved(spark, sf_dir), _now())
    return t.assign_sink(windows, topic="stream_1", bucket="cache")


def task_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validated(spark, sf_dir).select(
        "job_id", "task_id", "tdo_id", "source_id", "cache_key", "error"
    )


def task_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.rejection_counts(validated(spark, sf_dir))


def override_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = t.merge_overrides(
        tasks(spark, sf_dir), view(spark, sf_dir, "v_overrides"), {"token": "environment-token"}
    )
    return merged.select("job_id", "task_id", "tdo_id", "url", "token")


def source_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolved(spark, sf_dir).select("job_id", "task_id", "stream_url", "is_live", "failure_reason")


def liveness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        resolved(spark, sf_dir)
        .groupBy("is_live", t.is_time_based().alias("is_time_based"))
        .agg(F.count(F.lit(1)).alias("n_tasks"))
    )


def window_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        t.plan_windows(resolved(spark, sf_dir), _now())
        .withColumns(_ntz("window_start"))
        .select(
            "job_id", "task_id", "is_live", "window_start", "duration_us", "wait_us",
            "window_error", "window_reason",
        )
    )


def media_rebase(spark: SparkSession, sf_dir: str) -> DataFrame:
    streams = t.accepted(validated(spark, sf_dir)).withColumns(
        {
            "stream_offset_ms": F.lit(0),
            "stream_start": F.greatest(
                F.coalesce(F.col("record_start").cast("timestamp"), _now()), _now()
            ),
        }
    )
    return (
        t.rebase_media_time(streams, "stream_offset_ms", "stream_start")
        .withColumns(_ntz("stream_start"))
        .select("job_id", "task_id", "stream_offset_ms", "stream_start")
    )


def sink_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = t.accepted(validated(spark, sf_dir))
    return t.assign_sink(accepted, topic="stream_1", bucket="cache").select(
        "job_id", "task_id", "cache_key", "sink"
    )


def topic_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        view(spark, sf_dir, "v_topics")
        .withColumn("a", t.parse_topic(F.col("address")))
        .select("topic_id", "address", "a.topic", "a.partition", "a.key_prefix")
    )


def task_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        t.audit_view(tasks(spark, sf_dir))
        .withColumns(
            {
                "details_url": F.col("source_details.url"),
                "details_radio": F.col("source_details.radio_stream_url"),
            }
        )
        .drop("source_details")
    )


def task_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks as JSON documents with keys the schema lacks; tasks without token are cut short."""
    flat = tasks(spark, sf_dir)
    payload = F.struct(
        F.lit("ingest").alias("mode"),
        F.col("record_start").cast("timestamp").alias("recordStartTime"),
        F.col("record_end").cast("timestamp").alias("recordEndTime"),
        F.col("record_duration").alias("recordDuration"),
        F.col("start_time_override").alias("startTimeOverride"),
        F.col("tdo_offset_ms").alias("tdoOffsetMS"),
        F.col("source_id").alias("sourceId"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.col("cache_key").alias("cacheToS3Key"),
        F.col("organization_id").alias("organizationId"),
    )
    doc = F.to_json(
        F.struct(
            F.col("job_id").alias("jobId"),
            F.col("task_id").alias("taskId"),
            F.col("tdo_id").alias("recordingId"),
            "token",
            payload.alias("taskPayload"),
        )
    )
    broken = F.substring(doc, F.lit(1), F.length(doc) - 1)
    return flat.select(
        F.when(F.col("token").isNull() & F.col("cache_key").isNotNull(), broken)
        .otherwise(doc)
        .alias("value")
    )


_INTAKE = ["job_id", "task_id", "tdo_id", "record_start", "record_duration", "source_id", "url",
           "cache_key", "tdo_offset_ms", "organization_id"]


def _intake(decoded: DataFrame) -> DataFrame:
    return decoded.withColumns(_ntz("record_start")).select(
        *_INTAKE, F.col(CORRUPT).isNotNull().alias("is_corrupt")
    )


def task_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task documents landed as JSON lines and read with the explicit schema."""
    path = scratch_path(spark, "task-intake")
    task_documents(spark, sf_dir).write.text(path)
    return _intake(read_tasks(spark, path))


def task_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents decoded from a text column."""
    return _intake(decode_tasks(task_documents(spark, sf_dir), "value"))


def ingest_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks per sink, liveness and outcome after the whole planning step."""
    reason = F.coalesce("failure_reason", "window_reason", F.lit("ready"))
    return (
        planned(spark, sf_dir)
        .groupBy("sink", "is_live", reason.alias("state"))
        .agg(
            F.count(F.lit(1)).alias("n_tasks"),
            F.sum(F.when(reason == "ready", F.col("duration_us")).otherwise(0)).alias("ready_us"),
        )
    )


def source_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source catalogue landed as JSON documents and read with the explicit schema."""
    path = scratch_path(spark, "sources")
    details = F.struct("url", F.coalesce("radio_stream_url", F.lit("")).alias("radioStreamUrl"))
    doc = F.struct(
        F.col("source_id").alias("id"),
        F.when(F.col("is_live"), F.struct(F.lit(True).alias("isLive"))).alias("sourceType"),
        details.alias("details"),
        F.lit(1).alias("unknown"),
    )
    view(spark, sf_dir, "v_sources").select(F.to_json(doc).alias("value")).write.text(path)
    return read_sources(spark, path, "json").select(
        "source_id", "is_live", "details.url", "details.radio_stream_url"
    )


QUERIES = {
    "source_catalogue": source_catalogue,
    "task_intake": task_intake,
    "task_decode": task_decode,
    "task_validation": task_validation,
    "task_rejections": task_rejections,
    "override_merge": override_merge,
    "source_resolution": source_resolution,
    "liveness": liveness,
    "window_plan": window_plan,
    "media_rebase": media_rebase,
    "sink_assignment": sink_assignment,
    "topic_routing": topic_routing,
    "task_audit": task_audit,
    "ingest_plan": ingest_plan,
}

_DURATION = "regexp_full_match(record_duration, '[+-]?([0-9.]+(ns|us|ms|s|m|h))+')"

VALIDATED = f"""
validated AS (
  SELECT *, CASE
    WHEN cache_key IS NOT NULL AND source_id IS NULL THEN 'missing sourceID'
    WHEN cache_key IS NOT NULL AND scheduled_job_id IS NULL THEN 'missing scheduledJobId'
    WHEN cache_key IS NOT NULL AND NOT has_source_details THEN 'missing sourceDetails'
    WHEN cache_key IS NULL AND tdo_id IS NULL THEN 'missing tdoId'
    WHEN cache_key IS NULL AND source_id IS NULL AND url IS NULL THEN 'either sourceId or URL is required'
    WHEN job_id IS NULL THEN 'missing jobId'
    WHEN task_id IS NULL THEN 'missing taskId'
    WHEN record_duration IS NOT NULL AND (record_start IS NOT NULL OR record_end IS NOT NULL)
      THEN 'only one of "recordDuration" or "recordStartTime"/"recordEndTime" should be provided'
    WHEN record_duration IS NOT NULL AND NOT {_DURATION}
      THEN 'invalid record duration given "' || record_duration || '"'
    WHEN record_start IS NOT NULL AND record_end IS NULL
      THEN '"recordEndTime" is required when "recordStartTime" is set' END AS error
  FROM v_tasks)"""

RESOLVED = """
resolved AS (
  SELECT t.*, coalesce(t.url,
           CASE WHEN has_source_details THEN coalesce(inline_url, inline_radio)
                ELSE coalesce(s.url, s.radio_stream_url) END) AS stream_url,
         (t.url IS NULL AND (has_source_details OR coalesce(s.is_live, false)))
           OR record_start IS NOT NULL OR record_end IS NOT NULL OR record_duration IS NOT NULL AS is_live,
         record_start IS NOT NULL OR record_end IS NOT NULL OR record_duration IS NOT NULL AS is_time_based,
         CASE WHEN t.url IS NULL AND NOT has_source_details AND s.source_id IS NULL THEN 'url_not_found'
              WHEN t.url IS NULL AND coalesce(CASE WHEN has_source_details THEN coalesce(inline_url, inline_radio)
                ELSE coalesce(s.url, s.radio_stream_url) END, '') = '' THEN 'api_not_found' END AS failure_reason
  FROM (SELECT * FROM validated WHERE error IS NULL) t LEFT JOIN v_sources s ON s.source_id = t.source_id)"""

WINDOWED = f"""
started AS (SELECT *, greatest(coalesce(record_start, TIMESTAMP '{NOW}'), TIMESTAMP '{NOW}') AS window_start FROM resolved),
sized AS (
  SELECT *, CAST(CASE
      WHEN record_duration IS NOT NULL THEN CASE record_duration WHEN '30s' THEN 30000000
        WHEN '7m31.25s' THEN 451250000 WHEN '500ns' THEN 1 WHEN '0s' THEN 0 WHEN '1m' THEN 60000000 WHEN '10s' THEN 10000000 END
      WHEN record_end IS NOT NULL THEN epoch_us(record_end) - epoch_us(window_start)
      ELSE 0 END AS BIGINT) AS duration_us,
    CAST(epoch_us(window_start) - epoch_us(TIMESTAMP '{NOW}') AS BIGINT) AS wait_us
  FROM started),
windowed AS (
  SELECT *, CASE WHEN is_live AND record_duration IS NULL AND record_end IS NULL
                   THEN 'recording window must have an end time'
                 WHEN is_live AND duration_us <= 0
                   THEN 'we''ve overshot our recording window completely' END AS window_error
  FROM sized)"""

_SINK = """CASE WHEN cache_key IS NOT NULL AND NOT disable_s3 THEN 'object_cache'
       WHEN NOT disable_kafka THEN 'message_log' ELSE 'file_store' END"""

_INTAKE_SQL = with_views(
    ["v_tasks"],
    """
SELECT CASE WHEN ok THEN job_id END AS job_id, CASE WHEN ok THEN task_id END AS task_id,
       CASE WHEN ok THEN tdo_id END AS tdo_id, CASE WHEN ok THEN record_start END AS record_start,
       CASE WHEN ok THEN record_duration END AS record_duration, CASE WHEN ok THEN source_id END AS source_id,
       CASE WHEN ok THEN url END AS url, CASE WHEN ok THEN cache_key END AS cache_key,
       CAST(CASE WHEN ok THEN tdo_offset_ms ELSE 0 END AS INT) AS tdo_offset_ms,
       CAST(CASE WHEN ok THEN organization_id ELSE 0 END AS BIGINT) AS organization_id,
       NOT ok AS is_corrupt
FROM (SELECT *, token IS NOT NULL OR cache_key IS NULL AS ok FROM v_tasks)""",
)

ORACLES = {
    "source_catalogue": with_views(
        ["v_sources"], "SELECT source_id, is_live, url, radio_stream_url FROM v_sources"
    ),
    "task_intake": _INTAKE_SQL,
    "task_decode": _INTAKE_SQL,
    "task_validation": with_views(
        ["v_tasks"],
        "SELECT job_id, task_id, tdo_id, source_id, cache_key, error FROM validated",
        VALIDATED,
    ),
    "task_rejections": with_views(
        ["v_tasks"],
        "SELECT error, CAST(count(*) AS BIGINT) AS n_tasks FROM validated WHERE error IS NOT NULL GROUP BY error",
        VALIDATED,
    ),
    "override_merge": with_views(
        ["v_tasks", "v_overrides"],
        """
SELECT t.job_id, t.task_id, coalesce(nullif(o.tdo_id, ''), t.tdo_id) AS tdo_id,
       coalesce(o.url, t.url) AS url, coalesce(t.token, 'environment-token') AS token
FROM v_tasks t LEFT JOIN v_overrides o ON o.task_id = t.task_id""",
    ),
    "source_resolution": with_views(
        ["v_tasks", "v_sources"],
        "SELECT job_id, task_id, stream_url, is_live, failure_reason FROM resolved",
        VALIDATED,
        RESOLVED,
    ),
    "liveness": with_views(
        ["v_tasks", "v_sources"],
        "SELECT is_live, is_time_based, CAST(count(*) AS BIGINT) AS n_tasks FROM resolved GROUP BY ALL",
        VALIDATED,
        RESOLVED,
    ),
    "window_plan": with_views(
        ["v_tasks", "v_sources"],
        """SELECT job_id, task_id, is_live, window_start, duration_us, wait_us, window_error,
       CASE WHEN window_error IS NOT NULL THEN 'invalid_data' END AS window_reason FROM windowed""",
        VALIDATED,
        RESOLVED,
        WINDOWED,
    ),
    "media_rebase": with_views(
        ["v_tasks"],
        f"""
SELECT job_id, task_id, CASE WHEN tdo_offset_ms > 0 THEN tdo_offset_ms ELSE 0 END AS stream_offset_ms,
       CASE WHEN start_time_override > 0 THEN make_timestamp(start_time_override * 1000000)
            ELSE greatest(coalesce(record_start, TIMESTAMP '{NOW}'), TIMESTAMP '{NOW}') END AS stream_start
FROM validated WHERE error IS NULL""",
        VALIDATED,
    ),
    "sink_assignment": with_views(
        ["v_tasks"],
        f"SELECT job_id, task_id, cache_key, {_SINK} AS sink FROM validated WHERE error IS NULL",
        VALIDATED,
    ),
    "topic_routing": with_views(
        ["v_topics"],
        r"""
SELECT topic_id, address, CASE WHEN p IS NULL THEN '' ELSE parts[1] END AS topic,
       CAST(coalesce(p, -1) AS INT) AS partition,
       CASE WHEN p IS NULL THEN '' ELSE coalesce(parts[3], '') END AS key_prefix
FROM (SELECT *, CASE WHEN regexp_full_match(parts[2], '[+-]?[0-9]+')
                     THEN TRY_CAST(replace(parts[2], '+', '') AS INT) END AS p
      FROM (SELECT *, string_split(address, ':') AS parts FROM v_topics))""",
    ),
    "task_audit": with_views(
        ["v_tasks"],
        "SELECT * EXCLUDE (token, has_source_details, inline_url, inline_radio), "
        "inline_url AS details_url, inline_radio AS details_radio FROM v_tasks",
    ),
    "ingest_plan": with_views(
        ["v_tasks", "v_sources"],
        f"""
SELECT {_SINK} AS sink, is_live,
       coalesce(failure_reason, CASE WHEN window_error IS NOT NULL THEN 'invalid_data' END, 'ready') AS state,
       CAST(count(*) AS BIGINT) AS n_tasks,
       CAST(sum(CASE WHEN failure_reason IS NULL AND window_error IS NULL THEN duration_us ELSE 0 END) AS BIGINT) AS ready_us
FROM windowed GROUP BY ALL""",
        VALIDATED,
        RESOLVED,
        WINDOWED,
    ),
}
