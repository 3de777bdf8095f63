"""Views that give the test tables the shapes of tasks, probes, captures and logs.

Each text runs in Spark SQL and, but for the calls in ``ANSI``, in ANSI-style engines; ``{table}``
marks a base table.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VIEWS = {
    "v_sources": """
SELECT concat('src', cast(c_custkey AS string)) AS source_id,
       c_custkey % 3 = 0 AS is_live,
       CASE WHEN c_custkey % 4 <> 0 THEN concat('http://s', cast(c_custkey AS string), '.example.com/live') END AS url,
       CASE WHEN c_custkey % 8 <> 0 THEN concat('http://r', cast(c_custkey AS string), '.example.com/radio') END AS radio_stream_url
FROM {customer}""",
    "v_tasks": """
SELECT CASE WHEN o_orderkey % 41 <> 0 THEN concat('job', cast(o_orderkey AS string)) END AS job_id,
       CASE WHEN o_orderkey % 43 <> 0 THEN concat('task', cast(o_orderkey AS string)) END AS task_id,
       CASE WHEN o_orderkey % 37 <> 0 THEN concat('tdo', cast(o_orderkey AS string)) END AS tdo_id,
       CASE WHEN o_orderkey % 2 = 0 THEN concat('tok', cast(o_orderkey AS string)) END AS token,
       CASE WHEN o_orderkey % 3 <> 0 THEN concat('http://h', cast(o_custkey AS string), '.example.com/f.mp4') END AS url,
       CASE WHEN o_orderkey % 5 <> 0 THEN concat('src', cast(o_custkey AS string)) END AS source_id,
       CASE WHEN o_orderkey % 4 = 1 THEN o_orderdate END AS record_start,
       CASE WHEN o_orderkey % 4 = 1 AND o_orderkey % 12 <> 1 THEN o_orderdate + INTERVAL '1' HOUR END AS record_end,
       CASE o_orderkey % 20 WHEN 2 THEN '30s' WHEN 6 THEN '7m31.25s' WHEN 10 THEN 'xyz'
                            WHEN 14 THEN '0s' WHEN 18 THEN '1m' WHEN 5 THEN '10s' WHEN 13 THEN '500ns' END AS record_duration,
       CASE WHEN o_orderkey % 11 = 0 THEN concat('cache/', cast(o_orderkey AS string)) END AS cache_key,
       CASE WHEN o_orderkey % 22 = 0 THEN concat('sched', cast(o_orderkey AS string)) END AS scheduled_job_id,
       o_orderkey % 44 = 0 AS has_source_details,
       CASE WHEN o_orderkey % 44 = 0 AND o_custkey % 3 = 0 THEN concat('http://in', cast(o_custkey AS string), '.example.com/live') END AS inline_url,
       CASE WHEN o_orderkey % 44 = 0 AND o_custkey % 3 = 1 THEN concat('http://in', cast(o_custkey AS string), '.example.com/radio') END AS inline_radio,
       o_orderkey % 7 = 0 AS disable_kafka,
       o_orderkey % 33 = 0 AS disable_s3,
       cast(CASE WHEN o_orderkey % 6 = 0 THEN 60000 ELSE 0 END AS int) AS tdo_offset_ms,
       cast(CASE WHEN o_orderkey % 9 = 0 THEN 1717200000 + o_orderkey ELSE 0 END AS bigint) AS start_time_override,
       cast(o_custkey % 10 AS bigint) AS organization_id
FROM {orders}""",
    "v_overrides": """
SELECT concat('task', cast(o_orderkey AS string)) AS task_id,
       CASE WHEN o_orderpriority = '1-URGENT' THEN concat('tdo-over', cast(o_orderkey AS string)) ELSE '' END AS tdo_id,
       CASE WHEN o_orderpriority = '2-HIGH' THEN concat('http://over', cast(o_orderkey AS string), '.example.com/v.mp4') END AS url
FROM {orders} WHERE o_orderstatus = 'O'""",
    "v_topics": """
SELECT c_custkey AS topic_id,
       concat(CASE c_custkey % 10
                WHEN 0 THEN 'stream_1' WHEN 1 THEN 'stream_1:5' WHEN 2 THEN 'stream_2:x:p__'
                WHEN 3 THEN 'stream_3:+7:p__:extra' WHEN 4 THEN 'stream_4: 5:p__' WHEN 5 THEN 'stream_5:99999999999:p__'
                WHEN 6 THEN ':3:' WHEN 7 THEN 'stream_7:-2:p__' WHEN 8 THEN 'stream_8::p__' ELSE 'stream_9:10:task__' END,
              CASE WHEN c_custkey % 10 IN (3, 7, 9) THEN cast(c_custkey AS string) ELSE '' END) AS address
FROM {customer}""",
    "v_probes": """
SELECT page_id, a.attempt,
       CASE WHEN page_id % 13 = 0 THEN concat('RTSP://cam', cast(page_id AS string), '.example.com/live')
            ELSE concat(split_part(split_part(url, '?', 1), '#', 1),
                 CASE page_id % 9 WHEN 0 THEN '.jpg' WHEN 1 THEN '.pdf' WHEN 2 THEN '.mjpg' WHEN 3 THEN '.mpd'
                                  WHEN 4 THEN '.txt?x=1' WHEN 5 THEN '.PDF' WHEN 6 THEN '.mp4' ELSE '' END) END AS url,
       CASE page_id % 9 WHEN 0 THEN 'image/jpeg' WHEN 1 THEN 'application/pdf'
                        WHEN 2 THEN 'multipart/x-mixed-replace; boundary=b' WHEN 3 THEN 'application/dash+xml'
                        WHEN 6 THEN 'video/mp4' WHEN 7 THEN 'text/plain; charset=utf-8' ELSE '' END AS content_type,
       CASE page_id % 9 WHEN 8 THEN '89504E470D0A1A0A' WHEN 5 THEN '255044462D312E34' ELSE '' END AS sniff_hex,
       cast(CASE WHEN page_id % 17 = 0 THEN 503 WHEN page_id % 19 = 0 THEN 404
                 WHEN page_id % 5 = 0 AND a.attempt < 3 THEN 503 ELSE 200 END AS int) AS status_code,
       CASE WHEN page_id % 23 = 0 THEN 'transport' END AS error_kind
FROM (SELECT page_id, url, cast(n AS int) AS attempt
      FROM (SELECT page_id, url, explode(sequence(1, 5)) AS n FROM {pages}) p) a""",
    "v_attempts": """
SELECT cast(floor(event_id / 5) AS bigint) AS stream_id,
       cast(event_id % 5 + 1 AS int) AS attempt_no,
       ts,
       CASE WHEN event_id % 29 = 0 THEN 'transport' END AS error_kind,
       cast(CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_type = 'error' THEN 503 WHEN event_type = 'purchase' THEN 429
                 WHEN event_type = 'signup' THEN 302 WHEN event_type = 'view' THEN 500
                 WHEN event_id % 3 = 0 THEN 404 ELSE 200 END AS int) AS status_code,
       CASE WHEN event_type = 'click' OR event_id % 10 = 3 THEN event_id * 7919 % 20480 ELSE 0 END AS bytes_read
FROM {events}""",
    "v_bytes": """
SELECT user_id AS stream_id, event_id AS seq, ts, event_id * 7919 % 20480 AS n_bytes, props AS payload
FROM {events}""",
    "v_windows": """
SELECT user_id AS stream_id, event_id AS window_id, ts AS start_ts,
       CASE WHEN event_id % 48 = 0 THEN 0 ELSE (event_id % 48 * 3600000 + event_id % 1000) * 1000 END AS duration_us,
       CASE event_id % 4 WHEN 0 THEN 'capture' WHEN 1 THEN 'rtsp' WHEN 2 THEN 'plugin' ELSE 'mjpeg' END AS reader
FROM {events} WHERE event_type = 'signup'""",
    "v_logs": """
SELECT user_id AS stream_id, event_id AS line_no,
       CASE WHEN event_id % 53 = 0 THEN 'http://h.example.com/x: Server returned 503 Service Unavailable'
            WHEN event_id % 47 = 0 THEN 'tcp: Connection refused'
            WHEN event_id % 43 = 0 THEN 'pipe:0: Invalid data found when processing input'
            WHEN event_id % 7 = 0 THEN concat('frame=1 size=2kB time=', lpad(cast(event_id % 15 AS string), 2, '0'), ':',
                 lpad(cast(event_id % 60 AS string), 2, '0'), ':', lpad(cast(event_id % 59 AS string), 2, '0'), '.04 bitrate=9')
            ELSE concat('info ', repeat(props, 8)) END AS line
FROM {events}""",
    "v_errors": """
SELECT user_id AS stream_id, date_trunc('day', ts) AS ts,
       CASE event_id % 9 WHEN 0 THEN 'writer_setup' WHEN 1 THEN 'api_client' WHEN 2 THEN 'catalogue_lookup'
                         WHEN 3 THEN 'source_url' WHEN 4 THEN 'mime_probe' WHEN 5 THEN 'window'
                         WHEN 6 THEN 'stream_read' WHEN 7 THEN 'stream_write' ELSE 'auth' END AS stage,
       concat('error ', cast(event_id AS string)) AS message
FROM {events} WHERE event_type = 'error'""",
    "v_stream_tasks": """
SELECT user_id AS stream_id,
       user_id % 4 = 0 AS is_offline,
       concat('job', cast(user_id AS string)) AS job_id,
       concat('task', cast(user_id AS string)) AS task_id,
       concat('tdo', cast(user_id AS string)) AS tdo_id,
       concat('task', cast(user_id AS string), '__') AS key_prefix,
       concat('sched', cast(user_id AS string)) AS scheduled_job_id,
       concat('src', cast(user_id AS string)) AS source_id,
       user_id % 10 AS organization_id,
       concat('engine', cast(user_id % 3 AS string)) AS engine_id,
       concat('instance', cast(user_id AS string)) AS engine_instance_id,
       user_id % 12 = 0 AS disable_s3
FROM {events} GROUP BY user_id""",
    "v_streams": """
SELECT doc_id AS stream_id,
       concat('job', cast(doc_id AS string)) AS job_id,
       concat('task', cast(doc_id AS string)) AS task_id,
       concat('tdo', cast(doc_id AS string)) AS tdo_id,
       concat('task', cast(doc_id AS string), '__') AS key_prefix,
       cast(doc_id % 3 * 20000 AS int) AS offset_ms,
       1717200000 + doc_id AS start_s,
       lang AS container,
       source,
       text AS payload
FROM {documents}""",
    "v_manifests": """
SELECT l_orderkey AS manifest_id,
       concat('<MPD xmlns="urn:mpeg:dash:schema:mpd:2011" type="static" profiles="p"><Period id="0" start="PT0S"><AdaptationSet id="0">',
              listagg(concat('<Representation id="', l_linenumber, '" mimeType="',
                      CASE WHEN l_returnflag = 'A' THEN 'audio/mp4' ELSE 'video/mp4' END, '" bandwidth="',
                      cast(l_quantity AS bigint) * 1000, '"><SegmentList timescale="1" duration="2"><Initialization sourceURL="i', l_partkey,
                      '"/><SegmentURL media="m', l_partkey, '"/><SegmentURL media="n', l_suppkey, '"/></SegmentList></Representation>'), '')
              WITHIN GROUP (ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice),
              '</AdaptationSet></Period>',
              CASE WHEN l_orderkey % 3 = 0 THEN '<Period id="1" start="PT9S"><AdaptationSet id="0"/><AdaptationSet id="1"><Representation id="late" mimeType="text/vtt" bandwidth="1"><SegmentList duration="5"><Initialization sourceURL="j"/><SegmentURL media="k"/></SegmentList></Representation></AdaptationSet></Period>' ELSE '' END,
              '</MPD>') AS xml
FROM {lineitem} GROUP BY l_orderkey""",
    "v_template_manifests": """
SELECT l_orderkey AS manifest_id,
       concat('<MPD profiles="p"><Period id="0"><AdaptationSet mimeType="video/mp4" segmentAlignment="',
              CASE WHEN l_orderkey % 2 = 0 THEN 'true' ELSE '1' END,
              '"><ContentProtection schemeIdUri="urn:set', l_orderkey % 7, '" value="cenc"/>',
              '<Representation id="r" bandwidth="1000"><ContentProtection schemeIdUri="urn:rep"/>',
              '<SegmentTemplate timescale="1000" media="$Number$" startNumber="1"><SegmentTimeline>',
              listagg(concat('<S ', CASE WHEN l_returnflag = 'A' THEN concat('t="', l_partkey, '" ') ELSE '' END,
                             'd="', cast(l_quantity AS bigint),
                             CASE WHEN l_linestatus = 'O' THEN concat('" r="', l_linenumber) ELSE '' END, '"/>'), '')
              WITHIN GROUP (ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice),
              '</SegmentTimeline></SegmentTemplate></Representation></AdaptationSet></Period></MPD>') AS xml
FROM {lineitem} GROUP BY l_orderkey""",
    "v_timed_manifests": """
SELECT l_orderkey AS manifest_id,
       concat('<MPD mediaPresentationDuration="PT5M"><Period start="PT0S"',
              CASE WHEN l_orderkey % 4 = 0 THEN ' duration="PT4M50.5S"' ELSE '' END,
              '><AdaptationSet><Representation id="r', l_orderkey % 9, '" bandwidth="', l_orderkey % 5 * 1000,
              '"><SegmentTemplate timescale="10" startNumber="', l_orderkey % 3, '" presentationTimeOffset="', l_orderkey % 2 * 30,
              '" initialization="$RepresentationID$/init" media="$RepresentationID$/$Bandwidth%06d$/$Number%04d$-$Time$.m4s"><SegmentTimeline>',
              listagg(concat('<S ', CASE WHEN l_returnflag = 'A' THEN concat('t="', l_linenumber * 400, '" ') ELSE '' END,
                             'd="', cast(l_quantity AS bigint) * 20,
                             CASE l_linestatus WHEN 'O' THEN '" r="-1' ELSE concat('" r="', l_linenumber % 3) END, '"/>'), '')
              WITHIN GROUP (ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice),
              '</SegmentTimeline></SegmentTemplate></Representation></AdaptationSet></Period></MPD>') AS xml
FROM {lineitem} GROUP BY l_orderkey""",
    "v_jobs": """
SELECT to_json(named_struct('data', named_struct('job', named_struct('id', concat('job', l_orderkey), 'tasks', named_struct('records',
       collect_list(named_struct('targetId', cast(l_orderkey AS string),
         'engine', named_struct('id', concat('e', l_suppkey % 5), 'name', concat('Engine ', l_suppkey % 5)),
         'status', CASE l_returnflag WHEN 'A' THEN 'complete' WHEN 'R' THEN 'failed' ELSE 'aborted' END,
         'taskOutput', named_struct('uptime', concat(l_linenumber, 'm', cast(l_quantity AS int), '.5s'),
                       'bytesRead', cast(l_partkey * 10240 AS string), 'bytesWritten', cast(l_partkey * 10240 + l_suppkey AS string))))))))) AS doc
FROM {lineitem} GROUP BY l_orderkey""",
}


# Calls with another spelling in the SQL twins.
ANSI = {"explode(sequence(1, 5))": "unnest(range(1, 6))"}


def _base_tables(text: str) -> list[str]:
    return sorted({field for _, field, _, _ in string.Formatter().parse(text) if field})


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view over the Parquet tables in ``sf_dir``."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    text = VIEWS[name]
    bases = {t: table(spark, sf_dir, t) for t in _base_tables(text)}
    return spark.sql(text, **bases)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_views(names: list[str], body: str, *extra: str) -> str:
    """SQL text with the named views, then ``extra`` CTEs, in front of ``body``."""
    ctes = []
    for name in names:
        text = VIEWS[name]
        plain = text.format(**{t: t for t in _base_tables(text)})
        for spark_call, ansi_call in ANSI.items():
            plain = plain.replace(spark_call, ansi_call)
        ctes.append(f"{name} AS ({plain})")
    return "WITH " + ",\n".join([*ctes, *extra]) + "\n" + body


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical tasks: the inline details become a struct."""
    details = F.when(
        F.col("has_source_details"),
        F.struct(F.col("inline_url").alias("url"), F.col("inline_radio").alias("radio_stream_url")),
    )
    return (
        view(spark, sf_dir, "v_tasks")
        .withColumn("source_details", details)
        .drop("has_source_details", "inline_url", "inline_radio")
    )


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_sources").select(
        "source_id", "is_live", F.struct("url", "radio_stream_url").alias("details")
    )
