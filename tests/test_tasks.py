"""Validation, window, source, sink and topic rules, one row per case."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidegate.operators import tasks as t
from tidegate.sources.tables import CORRUPT, read_sources, read_tasks

NOW = dt.datetime(2019, 7, 16, 12, 0, 0)
DDL = """case STRING, job_id STRING, task_id STRING, tdo_id STRING, url STRING, source_id STRING,
record_start TIMESTAMP, record_end TIMESTAMP, record_duration STRING, cache_key STRING,
scheduled_job_id STRING, source_details STRUCT<url: STRING, radio_stream_url: STRING>,
disable_kafka BOOLEAN, disable_s3 BOOLEAN, tdo_offset_ms INT, start_time_override BIGINT, is_live BOOLEAN"""
FIELDS = [f.split()[0] for f in DDL.replace("STRUCT<url: STRING, radio_stream_url: STRING>", "S").split(",")]
BASE = {
    "job_id": "job1", "task_id": "task1", "tdo_id": "tdo1", "url": "http://h/x",
    "record_start": NOW, "record_end": NOW + dt.timedelta(seconds=30),
    "disable_kafka": False, "disable_s3": False, "tdo_offset_ms": 0, "start_time_override": 0,
    "is_live": True,
}


def frame(spark, cases):
    rows = [tuple({**BASE, **changes, "case": name}.get(f) for f in FIELDS) for name, changes in cases.items()]
    return t.normalise(spark.createDataFrame(rows, DDL))


def by_case(df, *columns):
    rows = df.select("case", *columns).collect()
    return {r[0]: (r[1] if len(columns) == 1 else tuple(r)[1:]) for r in rows}


def test_validation(spark):
    no_window = {"record_start": None, "record_end": None}
    cases = {
        "valid": ({}, None),
        "no job": ({"job_id": ""}, t.MISSING_JOB_ID),
        "no task": ({"task_id": None}, t.MISSING_TASK_ID),
        "no tdo": ({"tdo_id": ""}, t.MISSING_TDO_ID),
        "no window": (no_window, None),
        "start only": ({"record_end": None}, t.END_REQUIRED),
        "end only": ({"record_start": None}, None),
        "start after end": ({"record_start": NOW + dt.timedelta(days=1)}, None),
        "duration and start": ({"record_end": None, "record_duration": "10s"}, t.DURATION_AND_WINDOW),
        "duration": ({**no_window, "record_duration": "10s"}, None),
        "bad duration": ({**no_window, "record_duration": "xyz"}, t.INVALID_DURATION + ' "xyz"'),
        "no url": ({"url": ""}, t.MISSING_SOURCE_OR_URL),
        "source for url": ({"url": "", "source_id": "12345"}, None),
        "job before duration": ({**no_window, "job_id": "", "record_duration": "xyz"}, t.MISSING_JOB_ID),
        "offline": ({"cache_key": "abcd"}, t.MISSING_SOURCE_ID),
        "offline source": ({"cache_key": "abcd", "source_id": "s"}, t.MISSING_SCHEDULED_JOB),
        "offline job": (
            {"cache_key": "abcd", "source_id": "s", "scheduled_job_id": "j"}, t.MISSING_SOURCE_DETAILS),
        "offline valid": (
            {"cache_key": "abcd", "source_id": "s", "scheduled_job_id": "j", "tdo_id": "",
             "source_details": (None, "stream.com")}, None),
    }
    checked = t.validate(frame(spark, {k: v[0] for k, v in cases.items()}))
    assert by_case(checked, "error") == {k: v[1] for k, v in cases.items()}
    assert t.accepted(checked).count() + t.rejected(checked).count() == len(cases)


def test_url_override_makes_a_task_valid(spark):
    tasks = frame(spark, {"no url": {"url": ""}})
    overrides = spark.createDataFrame([("task1", "some.url", "")], "task_id STRING, url STRING, tdo_id STRING")
    merged = t.merge_overrides(tasks, overrides)
    assert by_case(t.validate(merged), "error", "url", "tdo_id") == {"no url": (None, "some.url", "tdo1")}


def test_windows(spark):
    sec = dt.timedelta(seconds=1)
    none = {"record_start": None, "record_end": None}
    cases = {
        "exact": ({}, (NOW, 30_000_000, 0, None)),
        "no window file": ({**none, "is_live": False}, (NOW, 0, 0, None)),
        "no window live": (none, (NOW, 0, 0, t.MISSING_END_TIME)),
        "end passed": ({"record_end": NOW}, (NOW, 0, 0, t.MISSED_WINDOW)),
        "late start": ({"record_start": NOW - 10 * sec}, (NOW, 30_000_000, 0, None)),
        "early start": ({"record_start": NOW + 20 * sec}, (NOW + 20 * sec, 10_000_000, 20_000_000, None)),
        "end only": ({"record_start": None}, (NOW, 30_000_000, 0, None)),
        "duration": ({**none, "record_duration": "1m"}, (NOW, 60_000_000, 0, None)),
        "zero duration": ({**none, "record_duration": "0s"}, (NOW, 0, 0, t.MISSED_WINDOW)),
    }
    plan = t.plan_windows(frame(spark, {k: v[0] for k, v in cases.items()}), F.lit(NOW))
    got = by_case(plan, "window_start", "duration_us", "wait_us", "window_error")
    assert got == {k: v[1] for k, v in cases.items()}


def test_sources(spark):
    catalogue = spark.createDataFrame(
        [("live", True, ("http://cat/live", "http://cat/radio")), ("file", False, ("", "http://cat/radio")),
         ("blank", False, (None, ""))],
        "source_id STRING, is_live BOOLEAN, details STRUCT<url: STRING, radio_stream_url: STRING>",
    )
    free = {"url": None, "record_start": None, "record_end": None}
    cases = {
        "own url": ({**free, "url": "http://own", "source_id": "live"}, ("http://own", False, None)),
        "own url timed": ({"url": "http://own"}, ("http://own", True, None)),
        "inline": ({**free, "source_id": "file", "source_details": ("", "http://in/r")}, ("http://in/r", True, None)),
        "inline blank": ({**free, "source_details": ("", None)}, (None, True, "api_not_found")),
        "catalogue": ({**free, "source_id": "live"}, ("http://cat/live", True, None)),
        "radio": ({**free, "source_id": "file"}, ("http://cat/radio", False, None)),
        "no details": ({**free, "source_id": "blank"}, (None, False, "api_not_found")),
        "unknown": ({**free, "source_id": "nowhere"}, (None, False, "url_not_found")),
    }
    tasks = frame(spark, {k: v[0] for k, v in cases.items()}).drop("is_live")
    got = by_case(t.resolve_sources(tasks, catalogue), "stream_url", "is_live", "failure_reason")
    assert got == {k: v[1] for k, v in cases.items()}


def test_media_time(spark):
    df = frame(spark, {
        "kept": {}, "both": {"tdo_offset_ms": 60000, "start_time_override": 1717200000}, "negative": {"tdo_offset_ms": -5},
    }).withColumns({"off": F.lit(7), "start": F.lit(NOW)})
    got = by_case(t.rebase_media_time(df, "off", "start"), "off", "start")
    moved = dt.datetime(2024, 6, 1)
    assert got == {"kept": (7, NOW), "both": (60000, moved), "negative": (7, NOW)}


def test_sinks(spark):
    cases = {
        "log": ({}, "message_log"),
        "cache": ({"cache_key": "k"}, "object_cache"),
        "cache off": ({"cache_key": "k", "disable_s3": True}, "message_log"),
        "all off": ({"cache_key": "k", "disable_s3": True, "disable_kafka": True}, "file_store"),
        "unset flags": ({"disable_kafka": None, "disable_s3": None}, "message_log"),
    }
    tasks = frame(spark, {k: v[0] for k, v in cases.items()})
    assert by_case(t.assign_sink(tasks, topic="x"), "sink") == {k: v[1] for k, v in cases.items()}
    assert set(by_case(t.assign_sink(tasks, stdout=True), "sink").values()) == {"console"}
    with pytest.raises(ValueError):
        t.assign_sink(tasks)


def test_topic_addresses(spark):
    cases = {
        "stream_1:0:1234abcd__": ("stream_1", 0, "1234abcd__"),
        "t:5": ("t", 5, ""),
        "t:+5:p:more": ("t", 5, "p"),
        "t:-2:p": ("t", -2, "p"),
        "t": ("", -1, ""),
        "": ("", -1, ""),
        "t:x:p": ("", -1, ""),
        "t: 5:p": ("", -1, ""),
        "t::p": ("", -1, ""),
        "t:99999999999": ("", -1, ""),
    }
    df = spark.createDataFrame([(k,) for k in cases], "a STRING")
    got = {r["a"]: (r["topic"], r["partition"], r["key_prefix"])
           for r in df.select("a", t.parse_topic(F.col("a")).alias("p")).select("a", "p.*").collect()}
    assert got == cases


def test_audit_view_has_no_token(spark):
    tasks = frame(spark, {"x": {}}).withColumn("token", F.lit("secret"))
    assert "token" not in t.audit_view(tasks).columns
    broken = tasks.withColumn("_corrupt_record", F.lit('{"token":"secret", broken'))
    shown = t.audit_view(broken).first()
    assert "secret" not in str(shown) and shown["_corrupt_record"].startswith("unreadable: 25 bytes")


def test_task_documents(spark, tmp_path):
    good = {"jobId": "j", "taskId": "t", "recordingId": "r", "token": "x", "clusterId": "ignored",
            "taskPayload": {"url": "", "recordStartTime": "2019-07-16T12:00:00Z", "mode": "ingest",
                            "recordDuration": "30s", "sourceDetails": {"radioStreamUrl": "http://r"}}}
    (tmp_path / "tasks.json").write_text(json.dumps(good) + "\n{\"jobId\": \n")
    rows = {r["job_id"]: r for r in read_tasks(spark, str(tmp_path)).collect()}
    assert rows["j"]["url"] is None and rows["j"]["record_start"] == NOW
    assert rows["j"]["source_details"]["radio_stream_url"] == "http://r"
    assert rows["j"]["disable_kafka"] is False and rows["j"][CORRUPT] is None
    assert rows[None][CORRUPT] is not None


def test_source_documents(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"id":"a","sourceType":{"isLive":true},"details":{"url":"","radioStreamUrl":"r"}}\n')
    row = read_sources(spark, str(tmp_path), "json").first()
    assert (row["source_id"], row["is_live"], row["details"]["url"], row["details"]["radio_stream_url"]) == ("a", True, None, "r")


def test_repeated_ids_do_not_multiply_tasks(spark):
    kinds = "source_id STRING, is_live BOOLEAN, details STRUCT<url: STRING, radio_stream_url: STRING>"
    catalogue = spark.createDataFrame(
        [("s", False, (None, "")), ("s", True, ("http://b", None)), ("s", False, ("http://a", None)), ("s", True, (None, "http://0"))],
        kinds,
    )
    free = {"url": None, "record_start": None, "record_end": None, "source_id": "s"}
    tasks = frame(spark, {"one": free, "two": free}).drop("is_live")
    got = t.resolve_sources(tasks, catalogue)
    assert got.count() == 2
    assert set(by_case(got, "stream_url", "is_live").values()) == {("http://a", False)}
    overrides = spark.createDataFrame(
        [("task1", "b.url", ""), ("task1", "a.url", None), ("task1", "", "t")], "task_id STRING, url STRING, tdo_id STRING"
    )
    merged = t.merge_overrides(frame(spark, {"no url": {"url": ""}}), overrides)
    assert [(r["url"], r["tdo_id"]) for r in merged.select("url", "tdo_id").collect()] == [("a.url", "t")]
