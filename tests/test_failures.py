from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidegate.operators import failures as f
from tidegate.functions.constants import LOG_RULES

T0 = dt.datetime(2024, 1, 1)


def test_retryable_statuses(spark):
    cases = {399: True, 500: True, 429: True, 299: True, 200: True, 400: False, 401: False, 499: False}
    df = spark.createDataFrame([(k,) for k in cases], "s INT")
    assert {r["s"]: r["ok"] for r in df.select("s", f.status_retryable(F.col("s")).alias("ok")).collect()} == cases


def outcomes(spark, attempts):
    """attempts: list of (status, error_kind, bytes_read) of one stream."""
    rows = [(1, i, *a) for i, a in enumerate(attempts, start=1)]
    df = spark.createDataFrame(rows, "stream_id BIGINT, attempt_no INT, status_code INT, error_kind STRING, bytes_read BIGINT")
    return {r["policy"]: (r["attempts"], r["outcome"], r["wait_s"]) for r in f.retry_outcomes(df).collect()}


def test_always_unavailable(spark):
    got = outcomes(spark, [(503, None, 0)] * 5)
    assert got == {
        "http": (5, "exhausted", 31), "capture": (5, "exhausted", 31),
        "manifest": (5, "exhausted", 31), "probe": (5, "exhausted", 15)}


def test_success_after_one_failure(spark):
    got = outcomes(spark, [(503, None, 0), (200, None, 9)])
    assert set(got.values()) == {(2, "success", 1)}


def test_not_found(spark):
    got = outcomes(spark, [(404, None, 0)] * 3)
    assert got["http"] == (1, "non_retryable", 0)
    assert got["capture"] == got["manifest"] == (3, "incomplete", 7)
    assert got["probe"] == (3, "incomplete", 7)


def test_transport_error_and_partial_read(spark):
    got = outcomes(spark, [(None, "transport", 0), (None, "transport", 10)])
    assert got["http"] == (1, "non_retryable", 0)
    assert got["probe"] == (1, "success", 0)
    assert got["capture"] == (2, "partial", 1)
    assert got["manifest"] == (2, "incomplete", 3)


def log_frame(spark, logs):
    rows = [(s, i, line) for s, lines in logs.items() for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "stream_id STRING, line_no BIGINT, line STRING").repartition(3)


def test_triage_rules(spark):
    logs = {name: ["banner", f"x {phrase} y", "bye"] for phrases, name in LOG_RULES for phrase in phrases[:1]}
    logs["last"] = ["banner", "http://h/x: Operation timed out"]
    logs["order"] = ["Invalid data found when processing input", "tcp: Connection refused", "Server returned 503"]
    logs["old"] = ["Server returned 401", "i" * 2100, "end"]
    logs["cut"] = ["Connection refused" + "i" * 2040, "end"]
    logs["long"] = ["j" * 3000]
    got = {r["stream_id"]: r["error_class"] for r in f.log_triage(log_frame(spark, logs)).collect()}
    want = {name: name for _, name in LOG_RULES}
    want |= {"last": logs["last"][1], "order": "HTTP error 503", "old": "end", "cut": "end", "long": "j" * 2047}
    assert got == want


def test_triage_fallbacks(spark):
    logs = log_frame(spark, {"a": ["one", "two"]})
    assert f.log_triage(logs, exit_error="signal: killed").first()["error_class"] == "signal: killed"
    assert f.log_triage(logs, tool="plugin").first()["error_class"] == "two"
    assert f.log_triage(logs, exit_error="signal: killed", tool="plugin").first()["error_class"] == "signal: killed"


@pytest.mark.parametrize("block_rows", [4, 1 << 18])
def test_tail_of_a_hot_log(spark, block_rows):
    rng = random.Random(3)
    logs = {f"s{i}": ["l" * rng.choice([0, 3, 200, 900]) + str(n) for n in range(300 if i == 0 else 20)] for i in range(4)}
    tail = f.log_tail(log_frame(spark, logs), block_rows=block_rows).orderBy("stream_id", "line_no").collect()
    got = {}
    for r in tail:
        got.setdefault(r["stream_id"], []).append(r["line"])
    for stream, lines in logs.items():
        text = "".join(line + "\n" for line in lines)[-2048:]
        assert "".join(line + "\n" for line in got[stream]) == text


def test_first_error_wins(spark):
    rows = [
        ("a", T0 + dt.timedelta(seconds=5), "stream_read", "later"), ("a", T0, "stream_write", "first"),
        ("b", T0, "stream_write", "w"), ("b", T0, "stream_read", "r"), ("c", T0, "auth", "token"),
    ]
    df = spark.createDataFrame(rows, "stream_id STRING, ts TIMESTAMP, stage STRING, message STRING")
    got = {r["stream_id"]: (r["failure_reason"], r["error_message"]) for r in f.failure_reasons(df).collect()}
    assert got == {"a": ("file_write_error", "first"), "b": ("stream_reader_error", "r"), "c": ("other", "token")}
