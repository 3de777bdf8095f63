"""Live delivery and heartbeats across micro-batches, restarts and late rows, against plain Python."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from tidegate.operators import delivery as d
from tidegate.session import scratch_path
from tidegate.streaming import jobs, live
from tidegate.streaming.progress import observed

T0 = dt.datetime(2024, 1, 1)
DDL = "stream_id BIGINT, seq BIGINT, ts TIMESTAMP, n_bytes BIGINT, payload BINARY, last BOOLEAN"


def _rows(n, streams, seed):
    """Rows in time order; stream 0 has half of them, gaps reach 70 s."""
    rng = random.Random(seed)
    rows, clock = [], dt.timedelta(0)
    for seq in range(n):
        stream = 0 if rng.random() < 0.5 else rng.randrange(1, streams)
        clock += dt.timedelta(microseconds=rng.choice([1, 400_000, 2_000_000, 9_000_000]))
        if rng.random() < 0.02:
            clock += dt.timedelta(seconds=70)
        data = rng.randbytes(rng.choice([0, 1, 7, 40, 100]))
        rows.append((stream, seq, T0 + clock, len(data), data, False))
    return rows


def _land(spark, path, rows):
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(path)


def _stream(spark, path, **options):
    return spark.readStream.schema(DDL).options(**options).parquet(path)


def _folder(spark, parts, label):
    path = scratch_path(spark, label)
    for part in parts:
        _land(spark, path, part)
        time.sleep(1.1)  # the file source orders by second
    return path


def _delivered(rows, timeout):
    """Bytes of each stream up to its end: its rows of data before the first gap, or up to its end mark."""
    out = {}
    for stream in {r[0] for r in rows}:
        last, data = None, None
        for _, _, ts, _, value, is_end in sorted((r for r in rows if r[0] == stream), key=lambda r: r[1]):
            if not value and not is_end:
                continue
            if timeout and last is not None and ts - last >= timeout:
                break
            last, data = ts, (data or b"") + value
            if is_end:
                break
        if data is not None:
            out[stream] = data
    return out


def _messages(table):
    out = {}
    for row in table.collect():
        out.setdefault(row["stream_id"], []).append((row["seq"], row["kind"], bytes(row["value"] or b""), row["content_length"]))
    return {s: sorted(m) for s, m in out.items()}


def _expected(delivered, size):
    out = {}
    for stream, data in delivered.items():
        raw = [(i // size + 1, d.KIND_RAW, data[i : i + size], None) for i in range(0, len(data), size)]
        out[stream] = [(0, d.KIND_INIT, b"", None), *raw, (len(raw) + 1, d.KIND_EOF, b"", len(data))]
    return out


@pytest.mark.parametrize("batches, size, timeout", [(1, 64, 30), (4, 16, 30), (3, 1000, 3600)])
def test_messages_do_not_depend_on_micro_batches(spark, batches, size, timeout):
    rows = _rows(240, 5, batches)
    step = -(-len(rows) // batches)
    path = _folder(spark, [rows[i : i + step] for i in range(0, len(rows), step)], "live-input")
    stream, end = jobs.ending(_stream(spark, path, maxFilesPerTrigger="1"))
    messages = live.live_envelope(stream, "5 seconds", f"{timeout}s", message_bytes=size)
    table = jobs.run_to_table(messages, "t-live", end=end, stateful=True)
    assert _messages(table) == _expected(_delivered(rows, dt.timedelta(seconds=timeout)), size)


def test_rows_out_of_order_end_marks_and_late_rows(spark):
    rows = [r for r in _rows(120, 4, 9) if r[4]]
    stream_1 = [r for r in rows if r[0] == 1]
    marked = [(*r[:5], r is stream_1[len(stream_1) // 2]) for r in rows]
    marked.append((9, 500, rows[-1][2], 0, b"", True))  # a stream that is nothing but its end
    rng = random.Random(1)
    cut = len(marked) // 2
    parts = [marked[:cut], marked[cut:]]
    rng.shuffle(parts[0])
    rng.shuffle(parts[1])
    late = [(0, -1, T0 - dt.timedelta(seconds=60), 4, b"late", False)]
    path = _folder(spark, [*parts, late], "live-odd")
    stream, end = jobs.ending(_stream(spark, path, maxFilesPerTrigger="1"))
    report = {}
    messages = live.live_envelope(stream, "1 second", None, end="last", message_bytes=32)
    table = jobs.run_to_table(messages, "t-odd", end=end, stateful=True, report=report)
    got, want = _messages(table), _expected(_delivered(marked, None), 32)
    for stream_id in (0, 2, 3):  # neither timeout nor end: what is left below a message stays
        want[stream_id] = [m for m in want[stream_id] if m[1] != d.KIND_EOF and (m[1] == d.KIND_INIT or len(m[2]) == 32)]
    assert got == want
    assert report["late_rows"] == 1 and report["batches"] >= 3


def test_restart_from_the_checkpoint(spark):
    rows = _rows(160, 4, 3)
    path, out = scratch_path(spark, "live-restart"), scratch_path(spark, "t-restart")
    for part in (rows[:50], rows[50:51], rows[51:]):
        _land(spark, path, part)
        messages = live.live_envelope(_stream(spark, path), "2 seconds", "20s", message_bytes=48)
        jobs.run_to_table(messages, "t-restart", stateful=True, path=out)
    _land(spark, path, [(None, 10**6, dt.datetime(9999, 1, 1), 0, None, False)])
    table = jobs.run_to_table(messages, "t-restart", stateful=True, path=out)
    assert _messages(table) == _expected(_delivered(rows, dt.timedelta(seconds=20)), 48)


def test_an_ended_stream_stays_ended_until_it_is_forgotten(spark):
    second = lambda n: T0 + dt.timedelta(seconds=n)
    rows = [(1, n, second(n), 2, b"ab", False) for n in (0, 10, 200, 1000)]
    tick = [(2, n, second(n), 1, b"x", False) for n in (100, 300, 700, 1100, 1300)]
    order = [[rows[0], rows[1]], [tick[0]], [rows[2]], [tick[1]], [tick[2]], [rows[3]], [tick[3]], [tick[4]]]
    path = _folder(spark, order, "live-forget")
    counts = {}
    for forget in (None, "500s"):
        stream, end = jobs.ending(_stream(spark, path, maxFilesPerTrigger="1"))
        messages = live.live_envelope(stream, "1 second", "30s", message_bytes=4, forget=forget)
        table = jobs.run_to_table(messages, "t-forget", end=end, stateful=True)
        counts[forget] = sorted(m[2] for m in _messages(table)[1] if m[1] == d.KIND_RAW)
    assert counts == {None: [b"abab"], "500s": [b"ab", b"abab"]}


def test_framed_messages_pass_the_audit(spark):
    rows = _rows(150, 4, 6)
    path = _folder(spark, [rows[:70], rows[70:]], "live-framed")
    stream, end = jobs.ending(_stream(spark, path, maxFilesPerTrigger="1"))
    streams = spark.range(3).selectExpr("id AS stream_id", "concat('p', id, '__') AS prefix")
    sent = live.framed(
        live.live_envelope(stream, "2 seconds", "25s", message_bytes=50), streams, {"jobId": F.lit("j")}, F.col("prefix")
    )
    landed = jobs.run_to_table(sent, "t-framed", end=end, stateful=True)
    delivered = _delivered(rows, dt.timedelta(seconds=25))
    whole = live.with_checksums(landed)
    for row in d.integrity_audit(whole).collect():
        assert row["raw_bytes"] == len(delivered[row["stream_id"]])
        assert not (row["missing_seq"] or row["duplicate_seq"] or row["length_mismatch"] or row["digest_mismatch"])
    for row in whole.where(F.col("kind") == d.KIND_EOF).collect():
        data = delivered[row["stream_id"]]
        claim = {"contentLength": len(data), "md5Checksum": hashlib.md5(data).hexdigest()}
        assert json.loads(bytes(row["value"])) == claim
        assert row["key"] == (f"p{row['stream_id']}__stream_eof" if row["stream_id"] < 3 else None)


def _beats(rows, step, timeout):
    out = []
    for stream in {r[0] for r in rows}:
        mine = sorted((r[2], r[3]) for r in rows if r[0] == stream)
        kept = [mine[0]]
        for row in mine[1:]:
            if row[0] - kept[-1][0] >= timeout:
                break
            kept.append(row)
        first, at, n = kept[0][0], kept[0][0], 0
        while at <= kept[-1][0] + timeout:
            size = sum(b for ts, b in kept if ts < at)
            out.append((stream, n + 1, "running", n * step // dt.timedelta(milliseconds=1), size))
            n += 1
            at = first + n * step
    return sorted(out)


@pytest.mark.parametrize("batches", [1, 4])
def test_heartbeats_of_idle_streams(spark, batches):
    rows = _rows(200, 5, 20 + batches)
    step = -(-len(rows) // batches)
    path = _folder(spark, [rows[i : i + step] for i in range(0, len(rows), step)], "live-beats")
    stream, end = jobs.ending(_stream(spark, path, maxFilesPerTrigger="1"))
    beats = live.live_heartbeats(stream, "3 seconds", "5s", "45s")
    table = jobs.run_to_table(beats, "t-beats", end=end, stateful=True)
    assert sorted(map(tuple, table.collect())) == _beats(rows, dt.timedelta(seconds=5), dt.timedelta(seconds=45))


def test_totals_of_more_batches_than_a_query_remembers(spark):
    path = scratch_path(spark, "many-batches")
    n = 120
    rows = spark.range(n).selectExpr(
        "id % 3 AS stream_id", "id AS seq", "timestamp_seconds(id * 10) AS ts", "id AS n_bytes",
        "CAST('x' AS BINARY) AS payload", "false AS last",
    )
    rows.repartition(n, "seq").write.option("maxRecordsPerFile", 1).parquet(path)
    report = {}
    stream = observed(_stream(spark, path, maxFilesPerTrigger="1"))
    table = jobs.run_to_table(stream.select("stream_id", "n_bytes"), "t-many", report=report)
    assert table.count() == n
    assert report["batches"] >= n and (report["rows"], report["bytes"]) == (n, n * (n - 1) // 2)
