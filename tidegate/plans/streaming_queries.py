"""Streaming twins: the given files as a file stream, run with ``availableNow``.

In append mode a window or session is sent once the watermark has passed its end, so those still
open when the input ends are not in the result; the SQL twins say so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators import delivery as d
from tidegate.operators.slicing import limit_us, slice_totals
from tidegate.plans.delivery_queries import (
    ORACLES as DELIVERY_ORACLES,
)
from tidegate.plans.delivery_queries import (
    CHUNK_SQL,
    FLAGGED,
    SMALL_MESSAGE,
    document_messages,
    offset_report,
    readable,
    row_init,
)
from tidegate.plans.fixtures import table, view, with_views
from tidegate.plans.routing_queries import BIN, SLICE_CTES
from tidegate.plans.task_queries import _INTAKE_SQL, _intake, task_documents
from tidegate.session import scratch_path
from tidegate.sources.sinks import append_log, batch_folder, tee
from tidegate.sources.tables import read_tasks
from tidegate.streaming import jobs, live
from tidegate.streaming.progress import observed
from tidegate.streaming.state import landed_digests, landed_rows

INTERVAL = "6h"
TIMEOUT = "24h"
DELAY = "1 hour"


def _byte_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = jobs.read_table_stream(spark, sf_dir, "events")
    return events.select(
        F.col("user_id").alias("stream_id"),
        F.col("event_id").alias("seq"),
        "ts",
        (F.col("event_id") * 7919 % 20480).alias("n_bytes"),
        F.col("props").alias("payload"),
    )


def stream_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = jobs.read_table_stream(spark, sf_dir, "documents")
    written = jobs.run_to_table(d.chunk_payloads(docs, "doc_id", "text"), "stream-chunks")
    return written.select("doc_id", "chunk_no", "n_bytes", F.md5("value").alias("value_md5"))


def stream_heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, end = jobs.ending(_byte_stream(spark, sf_dir))
    windows = jobs.heartbeat_windows(rows, DELAY, INTERVAL)
    written = jobs.run_to_table(windows, "stream-heartbeats", end=end)
    return written.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running bytes per stream at the end of each interval."""
    running = jobs.running_windows(stream_heartbeats(spark, sf_dir))
    return running.withColumn("ordinal", F.col("ordinal").cast("bigint"))


def stream_timeouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, end = jobs.ending(_byte_stream(spark, sf_dir))
    sessions = jobs.session_ends(rows, DELAY, TIMEOUT)
    first = jobs.first_sessions(jobs.run_to_table(sessions, "stream-timeouts", end=end))
    return first.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("start_time", "end_time")}
    )


def stream_envelope_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Init, raw and eof messages of live streams; the end of the input ends them."""
    rows, end = jobs.ending(_byte_stream(spark, sf_dir))
    messages = live.live_envelope(rows, DELAY, "87600h", message_bytes=SMALL_MESSAGE)
    sent = live.framed(messages, view(spark, sf_dir, "v_stream_tasks"), row_init(), F.col("key_prefix"))
    landed = jobs.run_to_table(sent, "stream-envelope", end=end, stateful=True)
    return readable(live.with_checksums(landed))


def stream_timed_out_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and eof claims of live streams that the no-data timer has ended."""
    rows, end = jobs.ending(_byte_stream(spark, sf_dir).where("n_bytes > 0"))
    messages = live.live_envelope(rows, DELAY, TIMEOUT, message_bytes=SMALL_MESSAGE)
    streams = view(spark, sf_dir, "v_stream_tasks")
    sent = live.framed(messages, streams, {"jobId": F.lit("j")}, F.col("key_prefix"))
    landed = jobs.run_to_table(sent, "stream-timed-out", end=end, stateful=True)
    audit = d.integrity_audit(live.with_checksums(landed))
    return audit.select("stream_id", "n_messages", "raw_bytes", "missing_seq", "length_mismatch", "digest_mismatch")


def stream_idle_heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heartbeats of live streams, idle ticks included, until the no-data timer ends them."""
    rows, end = jobs.ending(_byte_stream(spark, sf_dir).where("n_bytes > 0"))
    beats = live.live_heartbeats(rows, DELAY, INTERVAL, TIMEOUT)
    return jobs.run_to_table(beats, "stream-idle-heartbeats", end=end, stateful=True)


def stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, bytes and late rows of a run, as its progress reports them, against what it has written."""
    report: dict = {}
    written = jobs.run_to_table(observed(_byte_stream(spark, sf_dir)), "stream-totals", report=report)
    reported = [F.lit(report[name]).cast("bigint").alias(alias) for name, alias in (
        ("rows", "reported_rows"), ("bytes", "reported_bytes"), ("late_rows", "late_rows"),
    )]
    totals = written.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n_bytes").alias("n_bytes"))
    return totals.select("*", *reported)


def stream_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest and counters of live streams, from their landed rows."""
    return landed_digests(jobs.run_to_table(landed_rows(_byte_stream(spark, sf_dir)), "stream-digests"))


def stream_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices of the byte stream, by a table of windows."""
    rows = _byte_stream(spark, sf_dir).select("stream_id", "seq", "ts", "n_bytes")
    slices = jobs.slice_stream(rows, view(spark, sf_dir, "v_windows"), BIN)
    return slice_totals(jobs.run_to_table(slices, "stream-slice"))


def stream_window_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices from two streams, rows and windows; those without a limit come from the table."""
    rows = _byte_stream(spark, sf_dir).select("stream_id", "seq", "ts", "n_bytes")
    signups = jobs.read_table_stream(spark, sf_dir, "events").where("event_type = 'signup'")
    n = F.col("event_id")
    windows = signups.select(
        F.col("user_id").alias("stream_id"),
        n.alias("window_id"),
        F.col("ts").alias("start_ts"),
        F.when(n % 48 == 0, 0).otherwise((n % 48 * 3600000 + n % 1000) * 1000).alias("duration_us"),
        F.element_at(
            F.array(*map(F.lit, ("capture", "rtsp", "plugin", "mjpeg"))), (n % 4 + 1).cast("int")
        ).alias("reader"),
    )
    endless = limit_us(F.col("duration_us"), F.col("reader")).isNull()
    slices = jobs.slice_streams(rows, windows.where(~endless), "72h", DELAY, BIN)
    written = jobs.run_to_table(slices, "stream-window-join")
    rest = jobs.slice_stream(rows, view(spark, sf_dir, "v_windows").where(endless), BIN)
    names = ("window_id", "stream_id", "seq", "n_bytes")
    every = written.select(*names).unionByName(
        jobs.run_to_table(rest, "stream-endless").select(*names)
    )
    return slice_totals(every)


def stream_tee(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document messages sent to two sinks from one computed batch."""
    docs = jobs.read_table_stream(spark, sf_dir, "documents")
    streams = docs.select(
        F.col("doc_id").alias("stream_id"),
        F.concat(F.lit("job"), F.col("doc_id").cast("string")).alias("job_id"),
        F.concat(F.lit("task"), F.col("doc_id").cast("string")).alias("task_id"),
        F.concat(F.lit("tdo"), F.col("doc_id").cast("string")).alias("tdo_id"),
        F.concat(F.lit("task"), F.col("doc_id").cast("string"), F.lit("__")).alias("key_prefix"),
        (F.col("doc_id") % 3 * 20000).cast("int").alias("offset_ms"),
        (F.col("doc_id") + 1717200000).alias("start_s"),
        F.col("lang").alias("container"),
        F.col("text").alias("payload"),
    )
    root = scratch_path(spark, "stream-tee")
    log, store = f"{root}/message_log", f"{root}/file_store"
    jobs.run_batches(
        document_messages(streams), "stream-tee-progress", tee(batch_folder(log), batch_folder(store))
    )

    def totals(name: str, path: str) -> DataFrame:
        written = spark.read.parquet(path)
        return written.groupBy("kind").agg(
            F.lit(name).alias("sink"),
            F.count(F.lit(1)).alias("n_messages"),
            F.sum("n_bytes").alias("n_bytes"),
        )

    return totals("message_log", log).unionByName(totals("file_store", store))


def stream_log_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets of a log that micro-batches append to: half the streams arrive after the others."""
    path, source = scratch_path(spark, "stream-offsets"), scratch_path(spark, "offset-input")
    messages = document_messages(view(spark, sf_dir, "v_streams"))
    placed = d.place_messages(messages, F.lit("stream_1"), F.lit(-1), 8)
    for half in (0, 1):
        placed.where(F.col("stream_id") % 2 == half).write.mode("append").parquet(source)
    stream = spark.readStream.schema(placed.schema).option("maxFilesPerTrigger", 1).parquet(source)
    jobs.run_batches(stream, "stream-offsets-progress", append_log(path))
    return offset_report(spark.read.parquet(f"{path}/log"))


def stream_task_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-tasks")
    task_documents(spark, sf_dir).write.text(path)
    tasks = read_tasks(spark, path, streaming=True)
    return _intake(jobs.run_to_table(tasks, "stream-task-intake"))


QUERIES = {
    "stream_chunks": stream_chunks,
    "stream_heartbeats": stream_heartbeats,
    "stream_progress": stream_progress,
    "stream_timeouts": stream_timeouts,
    "stream_envelope_live": stream_envelope_live,
    "stream_timed_out_messages": stream_timed_out_messages,
    "stream_idle_heartbeats": stream_idle_heartbeats,
    "stream_totals": stream_totals,
    "stream_digests": stream_digests,
    "stream_slice": stream_slice,
    "stream_window_join": stream_window_join,
    "stream_tee": stream_tee,
    "stream_log_offsets": stream_log_offsets,
    "stream_task_intake": stream_task_intake,
}

_CLOSED = """
closed AS (
  SELECT stream_id, w AS window_start, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(n_bytes) AS BIGINT) AS n_bytes
  FROM (SELECT *, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS w FROM v_bytes)
  GROUP BY stream_id, w)"""

ORACLES = {
    "stream_envelope_live": DELIVERY_ORACLES["row_envelope"],
    "stream_timed_out_messages": DELIVERY_ORACLES["timed_out_messages"],
    "stream_idle_heartbeats": with_views(
        ["v_bytes"],
        """
SELECT ticks.stream_id, CAST(n + 1 AS BIGINT) AS ordinal, 'running' AS status,
       CAST(n * 6 * 3600 * 1000 AS BIGINT) AS uptime_ms, CAST(coalesce(sum(n_bytes), 0) AS BIGINT) AS n_bytes
FROM ticks LEFT JOIN flagged ON NOT late AND flagged.stream_id = ticks.stream_id AND ts < tick_at
GROUP BY ticks.stream_id, n""",
        FLAGGED,
        """
spans AS (
  SELECT stream_id, min(ts) AS first_ts, max(ts) + INTERVAL 24 HOUR AS until
  FROM flagged WHERE NOT late GROUP BY stream_id),
ticks AS (
  SELECT stream_id, n, first_ts + n * INTERVAL 6 HOUR AS tick_at
  FROM (SELECT *, unnest(range(0, CAST(date_diff('microsecond', first_ts, until) // 21600000000 + 1 AS BIGINT))) AS n FROM spans))""",
    ),
    "stream_totals": with_views(
        ["v_bytes"],
        "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(n_bytes) AS BIGINT) AS n_bytes, "
        "CAST(count(*) AS BIGINT) AS reported_rows, CAST(sum(n_bytes) AS BIGINT) AS reported_bytes, "
        "CAST(0 AS BIGINT) AS late_rows FROM v_bytes",
    ),
    "stream_chunks": CHUNK_SQL,
    "stream_heartbeats": with_views(["v_bytes"], "SELECT * FROM closed", _CLOSED),
    "stream_progress": with_views(
        ["v_bytes"],
        """
SELECT stream_id, window_start,
       CAST(row_number() OVER (PARTITION BY stream_id ORDER BY window_start) AS BIGINT) AS ordinal,
       CAST(sum(n_bytes) OVER (PARTITION BY stream_id ORDER BY window_start) AS BIGINT) AS bytes_read
FROM closed""",
        _CLOSED,
    ),
    "stream_timeouts": with_views(
        ["v_bytes"],
        """
SELECT stream_id, start_time, end_time, n_rows, n_bytes
FROM (SELECT *, row_number() OVER (PARTITION BY stream_id ORDER BY start_time) AS rn FROM sessions) WHERE rn = 1""",
        """
marked AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY stream_id ORDER BY ts) < INTERVAL 24 HOUR THEN 0 ELSE 1 END AS fresh
  FROM v_bytes WHERE n_bytes > 0),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY stream_id ORDER BY ts) AS s FROM marked),
sessions AS (
  SELECT stream_id, min(ts) AS start_time, max(ts) + INTERVAL 24 HOUR AS end_time,
         CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(n_bytes) AS BIGINT) AS n_bytes
  FROM numbered GROUP BY stream_id, s)""",
    ),
    "stream_digests": with_views(
        ["v_bytes"],
        """
SELECT stream_id, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(length(payload)) AS BIGINT) AS n_bytes,
       md5(string_agg(payload, '' ORDER BY seq)) AS md5
FROM v_bytes GROUP BY stream_id""",
    ),
    "stream_slice": with_views(
        ["v_bytes", "v_windows"],
        "SELECT window_id, stream_id, CAST(count(*) AS BIGINT) AS n_rows, "
        "CAST(sum(n_bytes) AS BIGINT) AS n_bytes FROM slices GROUP BY ALL",
        SLICE_CTES,
    ),
    "stream_window_join": with_views(
        ["v_bytes", "v_windows"],
        "SELECT window_id, stream_id, CAST(count(*) AS BIGINT) AS n_rows, "
        "CAST(sum(n_bytes) AS BIGINT) AS n_bytes FROM slices GROUP BY ALL",
        SLICE_CTES,
    ),
    "stream_tee": """
WITH sizes AS (SELECT octet_length(encode(text)) AS len FROM documents),
kinds AS (
  SELECT 'stream_init' AS kind, count(*) AS n, 0 AS b FROM sizes
  UNION ALL SELECT 'raw_stream', sum((len + 10239) // 10240), sum(len) FROM sizes
  UNION ALL SELECT 'stream_eof', count(*), 0 FROM sizes)
SELECT sink, kind, CAST(n AS BIGINT) AS n_messages, CAST(b AS BIGINT) AS n_bytes
FROM kinds, (VALUES ('message_log'), ('file_store')) s(sink)""",
    "stream_log_offsets": DELIVERY_ORACLES["log_offsets"],
    "stream_task_intake": _INTAKE_SQL,
}
