from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tidegate.operators import monitoring as m
from tidegate.plans import fixtures

T0 = dt.datetime(2024, 1, 1)


def captures(spark, rows):
    return spark.createDataFrame(rows, "stream_id BIGINT, seq BIGINT, ts TIMESTAMP, n_bytes BIGINT")


@pytest.mark.parametrize("block_rows", [4, 1 << 18])
def test_heartbeats_with_idle_ticks(spark, block_rows):
    rng = random.Random(11)
    rows, clock = [], {}
    for seq in range(200):
        s = 0 if rng.random() < 0.5 else rng.randrange(1, 4)
        clock[s] = clock.get(s, T0) + dt.timedelta(milliseconds=rng.choice([100, 900, 5000, 12_345]))
        rows.append((s, seq, clock[s], rng.randrange(50)))
    want = []
    for s in clock:
        mine = [r for r in rows if r[0] == s]
        first, last = mine[0][2], mine[-1][2]
        for k in range((last - first) // dt.timedelta(seconds=5) + 1):
            tick = first + k * dt.timedelta(seconds=5)
            n = sum(r[3] for r in mine if r[2] < tick)
            want.append((s, k + 1, "running", k * 5000, n, n))
    out = m.heartbeats(captures(spark, rows), block_rows=block_rows).collect()
    assert sorted(map(tuple, out)) == sorted(want)


def test_final_and_current_status(spark):
    rows = [(1, 0, T0, 5), (1, 1, T0 + dt.timedelta(seconds=12), 7), (2, 2, T0, 1)]
    errors = spark.createDataFrame([(2, "stream_reader_error", "boom")], "stream_id BIGINT, failure_reason STRING, error_message STRING")
    finals = m.final_status(captures(spark, rows), errors)
    got = {r["stream_id"]: tuple(r)[1:] for r in finals.collect()}
    assert got == {
        1: (4, "done", 12000, 12, 12, None, None),
        2: (2, "failed", 0, 1, 1, "stream_reader_error", "boom"),
    }
    tasks = spark.createDataFrame([(1, False), (2, True)], "stream_id BIGINT, is_offline BOOLEAN")
    log = m.status_log(m.heartbeats(captures(spark, rows)), finals, tasks)
    assert {r["stream_id"] for r in log.collect()} == {1}
    assert tuple(m.current_status(log).first()) == (1, 4, "done")
    lines = m.offline_log(m.heartbeats(captures(spark, rows)), tasks).collect()
    assert [tuple(r) for r in lines] == [(2, 1, "-- written: 0 B, status: running")]


def test_media_durations(spark):
    logs = {
        "a": ["x time=00:00:01.00 y", "z time=00:00:02.50  time=00:00:03.25 q", "end"],
        "long": ["f time=13:00:00.00 b"],
        "bad": ["f time=00:99:00.00 b", "f time=00:00:09.00 b"],
        "none": ["time=00:00:01.00 no leading blank"],
    }
    rows = [(s, i, line) for s, lines in logs.items() for i, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "stream_id STRING, line_no BIGINT, line STRING")
    durations = m.media_durations(df)
    assert {r["stream_id"]: r["duration_us"] for r in durations.collect()} == {
        "a": 3_250_000, "long": 46_800_000_000, "bad": None}
    objects = spark.createDataFrame(
        [(s, f"k/{s}", T0, 9) for s in logs], "stream_id STRING, dest_key STRING, start_time TIMESTAMP, n_bytes BIGINT")
    spans = {r["stream_id"]: (r["media_uri"], r["end_s"] - r["start_s"]) for r in m.object_summaries(objects, durations).collect()}
    assert spans == {"a": ("k/a.nut", 3), "long": ("k/long.nut", 46800), "bad": ("k/bad.nut", 0), "none": ("k/none.nut", 0)}


def job_document(job, records):
    return json.dumps({"data": {"job": {"id": job, "tasks": {"records": records}}}})


def record(engine, target="cam-7", status="complete", **output):
    return {"targetId": target, "engine": {"id": engine, "name": engine.title()}, "status": status, "taskOutput": output}


def test_job_status_records(spark):
    first = [
        {**record("copier", status="failed", uptime="2m5.5s", bytesRead="40960", heartbeats="21", failureReason="lost"),
         "executionLocation": {"data": {"name": "rack 3"}}, "unknown": 1},
        record("waiter", status="aborted"),
        record("source", uptime="2m6s", bytesWritten="71680"),
    ]
    docs = [job_document("a", first), job_document("b", []), '{"data":{"job":{"id":"c"}}}', "{broken", "", None]
    df = spark.createDataFrame([(i, doc) for i, doc in enumerate(docs)], "n INT, doc STRING")
    records = m.flatten_job_status(df)
    got = {(r["job_id"], r["engine_id"]): r for r in records.collect()}
    assert set(got) == {("a", "copier"), ("a", "waiter"), ("a", "source"), ("b", None), ("c", None)}
    copier = got["a", "copier"]
    assert (copier["uptime_us"], copier["bytes_read"], copier["heartbeats"]) == (125_500_000, 40960, 21)
    assert copier["location"] == "rack 3" and got["a", "waiter"]["bytes_read"] is None
    rejected = m.rejected_job_status(df).collect()
    assert sorted((r["n"], r["n_bytes"]) for r in rejected) == [(3, 7), (4, 0), (5, 0)]
    assert m.status_rollup(records).count() == m.status_report(records).count() + 5


def test_reconciliation_reports_total_loss(spark):
    rows = [
        ("both", "w", None, 71680), ("both", "r", 40960, None), ("alone", "w", None, 30000),
        ("silent", "w", None, 20480), ("silent", "r", None, None), ("unwritten", "r", 5, None),
    ]
    df = spark.createDataFrame(rows, "target_id STRING, engine_id STRING, bytes_read BIGINT, bytes_written BIGINT")
    got = {r["target_id"]: tuple(r)[1:] for r in m.reconcile_bytes(df, "w").collect()}
    assert got == {
        "both": (1, 71680, 40960, 30720, 3, True, False),
        "alone": (0, 30000, 0, 30000, 3, True, True),
        "silent": (1, 20480, 0, 20480, 2, True, True),
    }


def test_offline_requests(spark):
    tasks = spark.createDataFrame([(1, "sched", "src", 7, "j", "t", "e", "i", None), (2, "x", "src", 7, "j", "u", "e", "i", True)],
        "stream_id BIGINT, scheduled_job_id STRING, source_id STRING, organization_id BIGINT, job_id STRING, task_id STRING, "
        "engine_id STRING, engine_instance_id STRING, disable_s3 BOOLEAN")
    objects = spark.createDataFrame([(1, "k.nut", 100, 130, 55), (2, "l.nut", 1, 2, 3)],
        "stream_id BIGINT, media_uri STRING, start_s BIGINT, end_s BIGINT, n_bytes BIGINT")
    finals = spark.createDataFrame([(1, 900, "failed", "boom", 70, 55), (2, 1, "done", None, 3, 3)],
        "stream_id BIGINT, uptime_ms BIGINT, status STRING, error_message STRING, bytes_read BIGINT, bytes_written BIGINT")
    [row] = m.offline_requests(tasks, objects, finals).collect()
    assert (row["topic"], row["key"]) == ("ingestion_queue_0", "sched")
    assert json.loads(row["value"]) == {
        "scheduledJobId": "sched", "sourceId": "src", "mediaUri": "k.nut", "startTime": 100, "endTime": 130,
        "sourceTaskSummary": {"orgId": "7", "jobId": "j", "taskId": "t", "engineId": "e", "engineInstanceId": "i",
                              "bytesRead": 70, "bytesWritten": 55, "upTime": 900, "status": "failed", "errorMsg": "boom"}}


def test_fixture_views_cover_every_rejection(spark, sf_dir):
    from tidegate.operators import tasks as t

    checked = t.validate(fixtures.tasks(spark, sf_dir))
    assert t.rejection_counts(checked).count() == 10


@pytest.mark.parametrize("piece", [1, 3, 1 << 16])
def test_ticks_come_in_pieces(spark, piece):
    rows = [(1, 0, dt.datetime(2024, 1, 1), 5), (1, 1, dt.datetime(2024, 1, 1, 0, 0, 52), 7), (2, 0, dt.datetime(2024, 1, 1), 1)]
    captures = spark.createDataFrame(rows, "stream_id BIGINT, seq BIGINT, ts TIMESTAMP, n_bytes BIGINT")
    got = sorted(map(tuple, m.heartbeats(captures, "5s", piece=piece).collect()))
    want = [(1, n + 1, "running", n * 5000, 5 if n else 0, 5 if n else 0) for n in range(11)]
    assert got == [*want, (2, 1, "running", 0, 0, 0)]


def test_a_gap_of_centuries(spark):
    """More idle ticks than an array may hold: they are counted without being gathered."""
    rows = [(1, 0, dt.datetime(1600, 1, 1), 5), (1, 1, dt.datetime(2000, 1, 1), 7)]
    captures = spark.createDataFrame(rows, "stream_id BIGINT, seq BIGINT, ts TIMESTAMP_NTZ, n_bytes BIGINT")
    seconds = (dt.date(2000, 1, 1) - dt.date(1600, 1, 1)).days * 86400
    assert seconds // 5 > 1 << 31
    assert len(m.heartbeats(captures, "5s").take(3)) == 3
    assert m.heartbeats(captures, "1m").agg(F.max("ordinal")).first()[0] == seconds // 60 + 1
