"""Delivery queries over documents (one row per stream) and events (many rows per stream)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.operators import delivery as d
from tidegate.operators.digest import stream_digests
from tidegate.operators.failures import retry_outcomes
from tidegate.operators.slicing import capture_slice
from tidegate.plans.failure_queries import RETRY_CTES
from tidegate.plans.fixtures import table, view, with_views
from tidegate.plans.routing_queries import SLICE_CTES
from tidegate.sources import sinks
from tidegate.sources.ranges import read_ranges
from tidegate.sources.tables import read_captures
from tidegate.session import materialise, scratch_path

SMALL_MESSAGE = 16
TIMEOUT = "24h"
LANDED_BYTES = 4096
RANGE_BYTES = 1000
#: Of a scan's task; the rows don't depend on it.
PAGE_PARTITION_BYTES = 16 << 20
RANGE_MESSAGE = 256


def _init(offset: Column, start: Column, mime: str, container: Column) -> dict[str, Column]:
    return {
        "jobId": F.col("job_id"),
        "taskId": F.col("task_id"),
        "tdoId": F.col("tdo_id"),
        "offsetMS": offset,
        "mediaStartTimeUTC": start,
        "mimeType": F.lit(mime),
        "ffmpegFormat": container,
    }


def document_init() -> dict[str, Column]:
    return _init(F.col("offset_ms"), F.col("start_s"), "text/plain", F.col("container"))


def row_init() -> dict[str, Column]:
    return _init(F.lit(0), F.lit(1704067200), "application/json", F.lit("json"))


def document_messages(streams: DataFrame) -> DataFrame:
    return d.envelope(streams, "stream_id", "payload", document_init(), F.col("key_prefix"))


def readable(messages: DataFrame) -> DataFrame:
    """Message table with the value as its digest, and as text where it is JSON."""
    is_raw = F.col("kind") == d.KIND_RAW
    return messages.select(
        "stream_id",
        "seq",
        "kind",
        "key",
        "n_bytes",
        F.md5("value").alias("value_md5"),
        F.when(~is_raw, F.col("value").cast("string")).alias("json"),
    )


def chunk_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = d.chunk_payloads(table(spark, sf_dir, "documents"), "doc_id", "text")
    return chunks.select("doc_id", "chunk_no", "n_bytes", F.md5("value").alias("value_md5"))


def stream_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readable(document_messages(view(spark, sf_dir, "v_streams")))


def envelope_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages, length and digest per document stream."""
    return d.envelope_totals(document_messages(view(spark, sf_dir, "v_streams")))


def stream_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.payload_digests(table(spark, sf_dir, "documents"), "doc_id", "text")


def row_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_bytes").withColumn("payload", F.col("payload").cast("binary"))
    return stream_digests(rows, value="payload")


def rechunk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = d.rechunk_rows(view(spark, sf_dir, "v_bytes"), message_bytes=SMALL_MESSAGE)
    return chunks.select(
        "stream_id", "chunk_no", "n_bytes", F.col("value").cast("string").alias("value")
    )


def row_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_bytes").withColumn("payload", F.col("payload").cast("binary"))
    messages = d.envelope_from_rows(
        rows,
        view(spark, sf_dir, "v_stream_tasks"),
        row_init(),
        F.col("key_prefix"),
        message_bytes=SMALL_MESSAGE,
    )
    return readable(messages)


def ingest_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From capture to messages: rows are sliced by recording window, each window is a stream.

    The slices are written once, since lengths, digests and messages each pass over them.
    """
    windows = view(spark, sf_dir, "v_windows")
    rows = view(spark, sf_dir, "v_bytes").select("stream_id", "seq", "ts", "payload")
    slices = capture_slice(rows, windows, "6h").select(
        "window_id", "seq", F.col("payload").cast("binary").alias("payload")
    )
    slices = materialise(slices, "slices")
    text = F.col("window_id").cast("string")
    init = {"jobId": F.concat(F.lit("job"), text), "mimeType": F.lit("application/json")}
    messages = d.envelope_from_rows(
        slices, windows, init, F.concat(F.lit("w"), text, F.lit("__")), "window_id", message_bytes=64
    )
    return messages.select(
        "window_id", "seq", "key", "n_bytes", F.col("value").cast("string").alias("value")
    )


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document message table with faults planted by source, for the audit to find."""
    streams = view(spark, sf_dir, "v_streams")
    faults = F.replace("source", F.lit("src"), F.lit("")).try_cast("int")
    messages = document_messages(streams.withColumn("stream_id", F.struct("stream_id", faults.alias("fault"))))
    flat = messages.select("stream_id.stream_id", "stream_id.fault", "seq", "kind", "key", "n_bytes", "value")
    is_raw = F.col("kind") == d.KIND_RAW
    lost = (
        ((F.col("fault") == 1) & is_raw & (F.col("seq") == 1))
        | ((F.col("fault") == 2) & (F.col("kind") == d.KIND_EOF))
        | ((F.col("fault") == 3) & (F.col("kind") == d.KIND_INIT))
    )
    changed = F.when((F.col("fault") == 4) & is_raw, F.upper(F.hex("value")).cast("binary")).otherwise(
        F.col("value")
    )
    twice = (F.col("fault") == 5) & is_raw & (F.col("seq") == 1)
    times = F.when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    kept = flat.where(~F.coalesce(lost, F.lit(False))).withColumn("value", changed)
    return kept.withColumn("time", F.explode(times)).drop("fault", "time")


def integrity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of a stored message table: it is written once and read by each check."""
    return d.integrity_audit(materialise(damaged_messages(spark, sf_dir), "audited-log"))


def empty_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    attempts = view(spark, sf_dir, "v_attempts")
    failed = retry_outcomes(attempts, ("http",)).where(
        F.col("outcome").isin("exhausted", "non_retryable")
    )
    text = F.col("stream_id").cast("string")
    init = {"jobId": F.concat(F.lit("job"), text), "taskId": F.concat(F.lit("task"), text)}
    prefix = F.concat(F.lit("task"), text, F.lit("__"))
    messages = d.empty_envelopes(
        failed, attempts.where(F.col("bytes_read") > 0), "stream_id", init, prefix
    )
    return messages.select(
        "stream_id", "seq", "kind", "key", "n_bytes", F.col("value").cast("string").alias("json")
    )


def key_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and physical partitions per key, for keyed and for fixed places.

    Rows are dealt out by their place and report the task partition they ended up in.
    """
    rows = view(spark, sf_dir, "v_bytes").select(
        F.concat(F.lit("key_"), F.col("stream_id").cast("string")).alias("key")
    )
    keyed = d.place_messages(rows, F.lit("stream_1"), F.lit(-1), 8)
    fixed = d.place_messages(
        rows.withColumn("key", F.concat(F.lit("fixed_"), "key")), F.lit("stream_2"), F.lit(5), 8
    )
    dealt = keyed.unionByName(fixed).repartition(16, "topic", "partition")
    return dealt.withColumn("task", F.spark_partition_id()).groupBy("key").agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.count_distinct("task").alias("n_partitions"),
        F.count_distinct("partition").alias("n_places"),
        F.min("partition").alias("place"),
    )


def no_data_timeouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = d.no_data_timeouts(view(spark, sf_dir, "v_bytes"), TIMEOUT)
    return ends.withColumn("end_time", F.col("end_time").cast("timestamp_ntz"))


def timed_out_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and eof claims of the streams as the no-data timer lets them through."""
    rows = view(spark, sf_dir, "v_bytes")
    kept = d.cut_at_timeout(rows, d.no_data_timeouts(rows, TIMEOUT))
    streams = kept.select("stream_id").distinct()
    prefix = F.concat(F.lit("task"), F.col("stream_id").cast("string"), F.lit("__"))
    messages = d.envelope_from_rows(kept, streams, {"jobId": F.lit("j")}, prefix, message_bytes=SMALL_MESSAGE)
    audit = d.integrity_audit(materialise(messages, "timed-out-log"))
    return audit.select("stream_id", "n_messages", "raw_bytes", "missing_seq", "length_mismatch", "digest_mismatch")


def byte_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.byte_progress(view(spark, sf_dir, "v_bytes")).select("stream_id", "seq", "bytes_so_far")


def message_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document messages written to a log table and read back."""
    path = scratch_path(spark, "message-log")
    messages = document_messages(view(spark, sf_dir, "v_streams"))
    placed = d.place_messages(messages, F.lit("stream_1"), F.lit(10), 16)
    sinks.write_log(placed, path)
    return spark.read.parquet(path).select(
        "topic", "partition", "key", F.md5("value").alias("value_md5"), "stream_id", "seq"
    )


def object_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document payloads written as cached objects, read back and summed per object."""
    path = scratch_path(spark, "object-cache")
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("cache/"), F.col("doc_id").cast("string"), F.lit(".nut")).alias("dest_key"),
        F.when(F.col("doc_id") % 50 != 0, F.col("text")).otherwise(F.lit("")).alias("text"),
    )
    sinks.write_objects(d.chunk_payloads(docs, "dest_key", "text", keep_empty=True), path)
    return spark.read.parquet(path).groupBy("dest_key").agg(
        F.count(F.lit(1)).alias("n_chunks"), F.sum("n_bytes").alias("n_bytes")
    )


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages landed as captured rows: each object arrives as rows of at most 4 KiB, in any size."""
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("stream_id"), F.col("html").alias("payload")
    )
    rows = d.chunk_payloads(pages, "stream_id", "payload", LANDED_BYTES, keep_empty=True)
    path = scratch_path(spark, "landed")
    ts = F.timestamp_seconds(F.col("chunk_no"))
    rows.select("stream_id", F.col("chunk_no").alias("seq"), ts.alias("ts"), F.col("value").alias("payload")).write.parquet(path)
    return read_captures(spark, path)


def landed_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed objects of the page table: rows, bytes and messages of each, from their lengths."""
    n = F.sum(F.octet_length("payload")).cast("bigint")
    objects = _landed(spark, sf_dir).groupBy("stream_id").agg(
        F.count(F.lit(1)).alias("n_rows"), n.alias("n_bytes")
    )
    return objects.withColumn("n_messages", F.ceil(F.col("n_bytes") / d.MESSAGE_BYTES) + 2)


def landed_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length and MD5 of landed objects that arrive as many rows; none is too long for that."""
    return stream_digests(_landed(spark, sf_dir), value="payload")


def _page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages landed as one file for each fifty of them, read back in ranges of 1,000 bytes.

    The ranges are written once, since messages and digests pass over them several times and a
    Python source is read in full each time.
    """
    path = scratch_path(spark, "page-files")
    pages = table(spark, sf_dir, "pages").select(
        F.expr("page_id div 50").alias("file"), "page_id", F.coalesce("html", F.lit("")).alias("html")
    )
    dealt = pages.repartition("file").sortWithinPartitions("file", "page_id")
    dealt.select("file", "html").write.partitionBy("file").text(path, lineSep="\n")
    rows = read_ranges(spark, path, RANGE_BYTES, PAGE_PARTITION_BYTES)
    file = F.regexp_extract("stream_id", r"file=(-?\d+)/", 1).cast("bigint")
    return materialise(rows.withColumn("stream_id", file), "page-ranges")


def missing_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of messages that are lost or repeated, in streams where runs of both are made."""
    streams = view(spark, sf_dir, "v_streams")
    sent = d.envelope(streams, "stream_id", "payload", document_init(), F.col("key_prefix"), RANGE_MESSAGE)
    lost = (F.col("stream_id") + F.expr("seq div 4")) % 5 == 0
    again = (F.col("stream_id") + F.expr("seq div 3")) % 4 == 1
    copies = F.when(again, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    kept = sent.select("stream_id", "seq").where(~lost)
    return d.sequence_ranges(kept.select("stream_id", "seq", F.explode(copies).alias("copy")))


def log_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets of document messages per partition: their number, ends and order along streams."""
    messages = document_messages(view(spark, sf_dir, "v_streams"))
    placed = d.place_messages(messages, F.lit("stream_1"), F.lit(-1), 8)
    return offset_report(sinks.with_offsets(placed))


def offset_report(log: DataFrame) -> DataFrame:
    along = Window.partitionBy("topic", "partition", "stream_id").orderBy("seq")
    falls = F.coalesce(F.col("offset") <= F.lag("offset").over(along), F.lit(False))
    return log.withColumn("falls", falls).groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.count_distinct("offset").alias("n_offsets"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.count_if("falls").alias("n_falling"),
    )


def landed_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length and MD5 of files read by byte range, and the number and greatest length of their rows."""
    rows = _page_files(spark, sf_dir)
    sizes = rows.groupBy("stream_id").agg(F.count(F.lit(1)).alias("n_rows"), F.max("n_bytes").alias("longest"))
    return sizes.join(stream_digests(rows, value="payload"), "stream_id")


def range_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Init, raw and eof messages of files read by byte range."""
    rows = _page_files(spark, sf_dir)
    prefix = F.concat(F.lit("task"), F.col("stream_id").cast("string"), F.lit("__"))
    streams = rows.select("stream_id").distinct()
    messages = d.envelope_from_rows(rows, streams, {"jobId": F.lit("j")}, prefix)
    return readable(messages)


QUERIES = {
    "chunk_payloads": chunk_payloads,
    "stream_envelope": stream_envelope,
    "envelope_summary": envelope_summary,
    "stream_digest": stream_digest,
    "row_digests": row_digests,
    "rechunk_rows": rechunk_rows,
    "row_envelope": row_envelope,
    "ingest_messages": ingest_messages,
    "integrity_audit": integrity_audit,
    "empty_envelopes": empty_envelopes,
    "key_partitions": key_partitions,
    "no_data_timeouts": no_data_timeouts,
    "timed_out_messages": timed_out_messages,
    "byte_progress": byte_progress,
    "message_log": message_log,
    "object_cache": object_cache,
    "landed_objects": landed_objects,
    "landed_digests": landed_digests,
    "missing_ranges": missing_ranges,
    "log_offsets": log_offsets,
    "landed_ranges": landed_ranges,
    "range_messages": range_messages,
}

_CHUNKS = """
chunks AS (
  SELECT doc_id, i AS chunk_no, encode(text)[i * 10240 + 1 : (i + 1) * 10240] AS value
  FROM (SELECT doc_id, text,
               unnest(range(0, (octet_length(encode(text)) + 10239) // 10240)) AS i
        FROM documents))"""

CHUNK_SQL = f"""
WITH {_CHUNKS}
SELECT doc_id, CAST(chunk_no AS BIGINT) AS chunk_no,
       CAST(octet_length(value) AS BIGINT) AS n_bytes, md5(value) AS value_md5
FROM chunks"""

_DOC_MESSAGES = """
messages AS (
  SELECT stream_id, CAST(0 AS BIGINT) AS seq, 'stream_init' AS kind, CAST(0 AS BIGINT) AS n_bytes,
         encode('{"jobId":"' || job_id || '","taskId":"' || task_id || '","tdoId":"' || tdo_id
           || '","offsetMS":' || offset_ms || ',"mediaStartTimeUTC":' || start_s
           || ',"mimeType":"text/plain","ffmpegFormat":"' || container || '"}') AS value
  FROM v_streams
  UNION ALL
  SELECT doc_id, chunk_no + 1, 'raw_stream', octet_length(value), value FROM chunks
  UNION ALL
  SELECT stream_id, (octet_length(encode(payload)) + 10239) // 10240 + 1, 'stream_eof', 0,
         encode('{"contentLength":' || octet_length(encode(payload)) || ',"md5Checksum":"'
           || md5(payload) || '"}')
  FROM v_streams)"""

_READABLE = """
SELECT stream_id, CAST(seq AS BIGINT) AS seq, kind, key_prefix || kind AS key,
       CAST(n_bytes AS BIGINT) AS n_bytes, md5(value) AS value_md5,
       CASE WHEN kind <> 'raw_stream' THEN decode(value) END AS json
"""

_ROW_TEXTS = """
texts AS (SELECT stream_id, string_agg(payload, '' ORDER BY seq) AS whole FROM v_bytes GROUP BY stream_id)"""

_ROW_CHUNKS = """
row_chunks AS (
  SELECT stream_id, i AS chunk_no, substr(whole, CAST(i * 16 + 1 AS BIGINT), 16) AS value
  FROM (SELECT stream_id, whole, unnest(range(0, (length(whole) + 15) // 16)) AS i FROM texts))"""

FLAGGED = """
gaps AS (SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY stream_id ORDER BY seq) >= INTERVAL 24 HOUR, false) AS gap
         FROM v_bytes WHERE n_bytes > 0),
flagged AS (SELECT *, bool_or(gap) OVER (PARTITION BY stream_id ORDER BY seq) AS late FROM gaps)"""

#: The producer's partition of a key: the remainder of its signed FNV-1a hash, without the sign.
PLACE_SQL = """abs((list_reduce(list_prepend(2166136261::BIGINT, list_transform(range(1, length({key}) + 1),
  lambda i: ascii(({key})[i])::BIGINT)), lambda h, b: (xor(h, b) * 16777619) % 4294967296)
  + 2147483648) % 4294967296 - 2147483648) % {n}"""

PLACED_SQL = f"""
keyed AS (SELECT key_prefix || kind AS k FROM messages JOIN v_streams USING (stream_id)),
placed AS (SELECT 'stream_1' AS topic, CAST({PLACE_SQL.format(key="k", n=8)} AS INTEGER) AS partition FROM keyed)"""

OFFSETS_SQL = """
SELECT topic, partition, CAST(count(*) AS BIGINT) AS n_messages, CAST(count(*) AS BIGINT) AS n_offsets,
       CAST(0 AS BIGINT) AS first_offset, CAST(count(*) - 1 AS BIGINT) AS last_offset, CAST(0 AS BIGINT) AS n_falling
FROM placed GROUP BY topic, partition"""

_PLACE_OF_KEY = PLACE_SQL.format(key="'key_' || user_id", n=8)

_FILES = """
files AS (
  SELECT page_id // 50 AS stream_id, string_agg(coalesce(html, '') || chr(10), '' ORDER BY page_id) AS whole
  FROM pages GROUP BY page_id // 50),
sized AS (SELECT stream_id, whole, encode(whole) AS data, octet_length(encode(whole)) AS n FROM files)"""

ORACLES = {
    "missing_ranges": """
WITH numbers AS (
  SELECT doc_id AS k, unnest(range(0, (coalesce(octet_length(encode(text)), 0) + 255) // 256 + 2)) AS o FROM documents),
kept AS (SELECT k, o, CASE WHEN (k + o // 3) % 4 = 1 THEN 2 ELSE 1 END AS n FROM numbers WHERE (k + o // 4) % 5 <> 0),
gaps AS (SELECT k, coalesce(lag(o) OVER (PARTITION BY k ORDER BY o), -1) AS b, o FROM kept),
twice AS (SELECT k, o, o - row_number() OVER (PARTITION BY k ORDER BY o) AS run FROM kept WHERE n = 2)
SELECT k AS stream_id, b + 1 AS from_seq, o - 1 AS to_seq, 'missing' AS state, CAST(o - b - 1 AS BIGINT) AS n_messages
FROM gaps WHERE o - b > 1
UNION ALL
SELECT k, min(o), max(o), 'repeated', CAST(count(*) AS BIGINT) FROM twice GROUP BY k, run""",
    "log_offsets": with_views(["v_streams"], OFFSETS_SQL, _CHUNKS, _DOC_MESSAGES, PLACED_SQL),
    "landed_ranges": f"""
WITH {_FILES}
SELECT stream_id, CAST((n + 999) // 1000 AS BIGINT) AS n_rows, CAST(least(n, 1000) AS BIGINT) AS longest,
       CAST(n AS BIGINT) AS n_bytes, md5(whole) AS md5
FROM sized""",
    "range_messages": f"""
WITH {_FILES},
pieces AS (SELECT stream_id, data, unnest(range(0, (n + 10239) // 10240)) AS i FROM sized),
messages AS (
  SELECT stream_id, 0 AS seq, 'stream_init' AS kind, 0 AS n_bytes, encode('{{"jobId":"j"}}') AS value FROM sized
  UNION ALL
  SELECT stream_id, i + 1, 'raw_stream', octet_length(data[i * 10240 + 1 : (i + 1) * 10240]),
         data[i * 10240 + 1 : (i + 1) * 10240] FROM pieces
  UNION ALL
  SELECT stream_id, (n + 10239) // 10240 + 1, 'stream_eof', 0,
         encode('{{"contentLength":' || n || ',"md5Checksum":"' || md5(whole) || '"}}') FROM sized)
SELECT stream_id, CAST(seq AS BIGINT) AS seq, kind, 'task' || stream_id || '__' || kind AS key,
       CAST(n_bytes AS BIGINT) AS n_bytes, md5(value) AS value_md5,
       CASE WHEN kind <> 'raw_stream' THEN decode(value) END AS json
FROM messages""",
    "landed_objects": """
SELECT page_id AS stream_id, CAST(greatest((n + 4095) // 4096, 1) AS BIGINT) AS n_rows, CAST(n AS BIGINT) AS n_bytes,
       CAST((n + 10239) // 10240 + 2 AS BIGINT) AS n_messages
FROM (SELECT page_id, octet_length(encode(html)) AS n FROM pages)""",
    "landed_digests": """
SELECT page_id AS stream_id, CAST(octet_length(encode(html)) AS BIGINT) AS n_bytes, md5(html) AS md5 FROM pages""",
    "chunk_payloads": CHUNK_SQL,
    "stream_envelope": with_views(
        ["v_streams"],
        _READABLE + "FROM messages JOIN v_streams USING (stream_id)",
        _CHUNKS,
        _DOC_MESSAGES,
    ),
    "envelope_summary": """
SELECT doc_id AS stream_id,
       CAST((octet_length(encode(text)) + 10239) // 10240 + 2 AS BIGINT) AS n_messages,
       CAST(octet_length(encode(text)) AS BIGINT) AS raw_bytes,
       CAST(octet_length(encode(text)) AS BIGINT) AS content_length,
       md5(text) AS md5_checksum
FROM documents""",
    "stream_digest": """
SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes, md5(text) AS md5
FROM documents""",
    "row_digests": with_views(
        ["v_bytes"],
        "SELECT stream_id, CAST(length(whole) AS BIGINT) AS n_bytes, md5(whole) AS md5 FROM texts",
        _ROW_TEXTS,
    ),
    "rechunk_rows": with_views(
        ["v_bytes"],
        "SELECT stream_id, CAST(chunk_no AS BIGINT) AS chunk_no, "
        "CAST(length(value) AS BIGINT) AS n_bytes, value FROM row_chunks",
        _ROW_TEXTS,
        _ROW_CHUNKS,
    ),
    "row_envelope": with_views(
        ["v_bytes", "v_stream_tasks"],
        _READABLE + "FROM messages JOIN v_stream_tasks USING (stream_id)",
        _ROW_TEXTS,
        _ROW_CHUNKS,
        """
messages AS (
  SELECT stream_id, 0 AS seq, 'stream_init' AS kind, 0 AS n_bytes,
         encode('{"jobId":"' || job_id || '","taskId":"' || task_id || '","tdoId":"' || tdo_id
           || '","offsetMS":0,"mediaStartTimeUTC":1704067200,"mimeType":"application/json",'
           || '"ffmpegFormat":"json"}') AS value
  FROM v_stream_tasks
  UNION ALL
  SELECT stream_id, chunk_no + 1, 'raw_stream', length(value), encode(value) FROM row_chunks
  UNION ALL
  SELECT stream_id, (length(whole) + 15) // 16 + 1, 'stream_eof', 0,
         encode('{"contentLength":' || length(whole) || ',"md5Checksum":"' || md5(whole) || '"}')
  FROM texts)""",
    ),
    "ingest_messages": with_views(
        ["v_bytes", "v_windows"],
        """
SELECT window_id, CAST(0 AS BIGINT) AS seq, 'w' || window_id || '__stream_init' AS key, CAST(0 AS BIGINT) AS n_bytes,
       '{"jobId":"job' || window_id || '","mimeType":"application/json"}' AS value
FROM v_windows
UNION ALL
SELECT window_id, i + 1, 'w' || window_id || '__raw_stream', length(substr(whole, CAST(i * 64 + 1 AS BIGINT), 64)),
       substr(whole, CAST(i * 64 + 1 AS BIGINT), 64)
FROM (SELECT *, unnest(range(0, (length(whole) + 63) // 64)) AS i FROM wholes)
UNION ALL
SELECT window_id, (length(whole) + 63) // 64 + 1, 'w' || window_id || '__stream_eof', 0,
       '{"contentLength":' || length(whole) || ',"md5Checksum":"' || md5(whole) || '"}'
FROM wholes""",
        SLICE_CTES,
        """
wholes AS (
  SELECT w.window_id, coalesce(string_agg(b.payload, '' ORDER BY b.seq), '') AS whole
  FROM v_windows w LEFT JOIN slices s ON s.window_id = w.window_id
    LEFT JOIN v_bytes b ON b.seq = s.seq GROUP BY w.window_id)""",
    ),
    "integrity_audit": """
WITH d AS (
  SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS len,
         CAST((octet_length(encode(text)) + 10239) // 10240 AS BIGINT) AS n,
         TRY_CAST(replace(source, 'src', '') AS INT) AS fault FROM documents),
e AS (
  SELECT *, CASE WHEN fault = 1 AND n >= 1 THEN least(len, 10240) ELSE 0 END AS lost,
         CASE WHEN fault = 1 AND n >= 1 THEN 1 WHEN fault IN (2, 3) THEN 1 ELSE 0 END AS gone,
         CASE WHEN fault = 5 AND n >= 1 THEN 1 ELSE 0 END AS extra
  FROM d)
SELECT doc_id AS stream_id, CAST(n + 2 - gone + extra AS BIGINT) AS n_messages,
       CAST(CASE WHEN fault = 4 THEN len * 2 ELSE len - lost + extra * least(len, 10240) END AS BIGINT) AS raw_bytes,
       coalesce(fault, 0) <> 3 AS has_init,
       coalesce(fault, 0) <> 2 AS has_eof,
       gone = 1 AND coalesce(fault, 0) <> 2 AS missing_seq,
       extra = 1 AS duplicate_seq,
       coalesce(fault, 0) IN (1, 4, 5) AND len > 0 AS length_mismatch,
       coalesce(fault, 0) IN (1, 4, 5) AND len > 0 AS digest_mismatch
FROM e""",
    "empty_envelopes": with_views(
        ["v_attempts"],
        """
SELECT stream_id, CAST(seq AS BIGINT) AS seq, kind, 'task' || stream_id || '__' || kind AS key,
       CAST(0 AS BIGINT) AS n_bytes,
       CASE kind WHEN 'stream_init'
         THEN '{"jobId":"job' || stream_id || '","taskId":"task' || stream_id || '"}'
         ELSE '{"contentLength":0,"md5Checksum":"' || md5('') || '"}' END AS json
FROM outcomes, (VALUES (0, 'stream_init'), (1, 'stream_eof')) k(seq, kind)
WHERE policy = 'http' AND outcome IN ('exhausted', 'non_retryable')
  AND stream_id NOT IN (SELECT stream_id FROM v_attempts WHERE bytes_read > 0)""",
        *RETRY_CTES,
    ),
    "key_partitions": f"""
SELECT prefix || 'key_' || user_id AS key, CAST(count(*) AS BIGINT) AS n_messages,
       CAST(1 AS BIGINT) AS n_partitions, CAST(1 AS BIGINT) AS n_places,
       CAST(CASE WHEN prefix = '' THEN {_PLACE_OF_KEY} ELSE 5 END AS INTEGER) AS place
FROM events, (VALUES (''), ('fixed_')) p(prefix) GROUP BY ALL""",
    "no_data_timeouts": with_views(
        ["v_bytes"],
        """
SELECT stream_id, bool_or(late) AS timed_out,
       max(ts) FILTER (WHERE NOT late)
         + CASE WHEN bool_or(late) THEN INTERVAL 24 HOUR ELSE INTERVAL 0 HOUR END AS end_time,
       CAST(count(*) FILTER (WHERE NOT late) AS BIGINT) AS rows_kept,
       CAST(sum(n_bytes) FILTER (WHERE NOT late) AS BIGINT) AS bytes_kept,
       CAST(count(*) FILTER (WHERE late) AS BIGINT) AS rows_dropped,
       max(seq) FILTER (WHERE NOT late) AS last_seq
FROM flagged GROUP BY stream_id""",
        FLAGGED,
    ),
    "timed_out_messages": with_views(
        ["v_bytes"],
        f"""
SELECT stream_id, CAST((sum(length(payload)) + {SMALL_MESSAGE - 1}) // {SMALL_MESSAGE} + 2 AS BIGINT) AS n_messages,
       CAST(sum(length(payload)) AS BIGINT) AS raw_bytes, false AS missing_seq, false AS length_mismatch,
       false AS digest_mismatch
FROM flagged WHERE NOT late GROUP BY stream_id""",
        FLAGGED,
    ),
    "byte_progress": with_views(
        ["v_bytes"],
        "SELECT stream_id, seq, CAST(sum(n_bytes) OVER (PARTITION BY stream_id ORDER BY seq) AS BIGINT) "
        "AS bytes_so_far FROM v_bytes",
    ),
    "message_log": with_views(
        ["v_streams"],
        "SELECT 'stream_1' AS topic, CAST(10 AS INT) AS partition, key_prefix || kind AS key, "
        "md5(value) AS value_md5, stream_id, CAST(seq AS BIGINT) AS seq "
        "FROM messages JOIN v_streams USING (stream_id)",
        _CHUNKS,
        _DOC_MESSAGES,
    ),
    "object_cache": """
SELECT 'cache/' || doc_id || '.nut' AS dest_key,
       CAST(greatest((n + 10239) // 10240, 1) AS BIGINT) AS n_chunks, CAST(n AS BIGINT) AS n_bytes
FROM (SELECT doc_id, CASE WHEN doc_id % 50 <> 0 THEN octet_length(encode(text)) ELSE 0 END AS n FROM documents)""",
}
