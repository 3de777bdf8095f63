"""Chunks, envelopes, digests and timeouts, also on a stream that holds most rows."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from tidegate.operators import delivery as d
from tidegate.operators.digest import stream_digests
from tidegate.sources import sinks
from tidegate.sources.tables import read_captures, read_landed_objects

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def hot_rows():
    """Rows of 6 streams; stream 0 holds more than a third of them."""
    rng = random.Random(7)
    rows, clock = [], {}
    for seq in range(600):
        stream = 0 if rng.random() < 0.5 else rng.randrange(1, 6)
        clock[stream] = clock.get(stream, T0) + dt.timedelta(seconds=rng.choice([1, 2, 5, 30, 70 if seq > 300 else 3]))
        rows.append((stream, seq, clock[stream], rng.randbytes(rng.choice([0, 1, 7, 40, 100]))))
    return rows


@pytest.fixture(scope="module")
def hot(spark, hot_rows):
    df = spark.createDataFrame(hot_rows, "stream_id BIGINT, seq BIGINT, ts TIMESTAMP, payload BINARY")
    return df.repartition(5).withColumn("n_bytes", F.octet_length("payload").cast("bigint"))


def whole(rows):
    out = {}
    for stream, _, _, payload in sorted(rows, key=lambda r: r[1]):
        out[stream] = out.get(stream, b"") + payload
    return out


def test_five_kib_make_seven_messages(spark):
    df = spark.createDataFrame([(1, bytes(5120))], "id INT, data BINARY")
    init = {"taskId": F.lit("task1"), "jobId": F.lit("job1"), "tdoId": F.lit("tdo1"), "offsetMS": F.lit(20000),
            "mimeType": F.lit("video/mp4"), "ffmpegFormat": F.lit("mp4"), "mediaStartTimeUTC": F.lit(1717200000)}
    rows = d.envelope(df, "id", "data", init, F.lit("prefix__"), 1024).orderBy("seq").collect()
    assert [r["key"] for r in rows] == ["prefix__stream_init"] + ["prefix__raw_stream"] * 5 + ["prefix__stream_eof"]
    assert json.loads(rows[0]["value"]) == {
        "jobId": "job1", "taskId": "task1", "tdoId": "tdo1", "offsetMS": 20000,
        "mediaStartTimeUTC": 1717200000, "mimeType": "video/mp4", "ffmpegFormat": "mp4"}
    assert all(bytes(r["value"]) == bytes(1024) for r in rows[1:6])
    assert json.loads(rows[6]["value"]) == {"contentLength": 5120, "md5Checksum": hashlib.md5(bytes(5120)).hexdigest()}


@pytest.mark.parametrize("size", [0, 1, 1023, 1024, 1025, 4096])
def test_chunks_are_lossless(spark, size):
    data = random.Random(size).randbytes(size)
    df = spark.createDataFrame([(1, data)], "id INT, data BINARY")
    rows = d.chunk_payloads(df, "id", "data", 1024).orderBy("chunk_no").collect()
    assert len(rows) == -(-size // 1024)
    assert b"".join(bytes(r["value"]) for r in rows) == data
    messages = d.envelope(df, "id", "data", {"jobId": F.lit("j")}, F.lit(""), 1024).count()
    assert messages == 2 + -(-size // 1024)


def test_missing_payload_is_an_empty_stream(spark):
    df = spark.createDataFrame([(1, None)], "id INT, data BINARY")
    rows = d.envelope(df, "id", "data", {"jobId": F.lit("j")}, F.lit("")).orderBy("seq").collect()
    assert [r["kind"] for r in rows] == ["stream_init", "stream_eof"]
    assert json.loads(rows[1]["value"]) == {"contentLength": 0, "md5Checksum": hashlib.md5().hexdigest()}


@pytest.mark.parametrize("block_rows", [16, 1 << 18])
def test_rechunked_rows(hot, hot_rows, block_rows):
    got = {}
    for r in d.rechunk_rows(hot, message_bytes=64, block_rows=block_rows).collect():
        got.setdefault(r["stream_id"], {})[r["chunk_no"]] = bytes(r["value"])
    for stream, data in whole(hot_rows).items():
        pieces = [data[i : i + 64] for i in range(0, len(data), 64)]
        assert [got[stream][i] for i in range(len(got[stream]))] == pieces


def test_digests_of_streams(hot, hot_rows):
    got = {
        r["stream_id"]: (r["n_bytes"], r["md5"])
        for r in stream_digests(hot, value="payload").collect()
    }
    assert got == {s: (len(b), hashlib.md5(b).hexdigest()) for s, b in whole(hot_rows).items()}


@pytest.mark.parametrize("runtime_broadcast", ["-1", "10MB"])
def test_digests_when_a_join_is_replanned(spark, hot, hot_rows, runtime_broadcast):
    """A join that is split for skew or broadcast at run time must not scatter a stream."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": runtime_broadcast,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        keyed = hot.join(spark.range(6).withColumnRenamed("id", "stream_id"), "stream_id")
        want = sorted((s, len(b), hashlib.md5(b).hexdigest()) for s, b in whole(hot_rows).items())
        rows = stream_digests(keyed, value="payload").collect()
        assert sorted(map(tuple, rows)) == want
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_envelope_of_rows_passes_its_own_audit(spark, hot, hot_rows):
    streams = spark.range(8).select(F.col("id").alias("stream_id"))
    messages = d.envelope_from_rows(
        hot, streams, {"jobId": F.lit("j")}, F.concat(F.lit("s"), F.col("stream_id").cast("string"), F.lit("__")),
        message_bytes=64, block_rows=32,
    )
    audit = {r["stream_id"]: r for r in d.integrity_audit(messages).collect()}
    sizes = {s: len(b) for s, b in whole(hot_rows).items()}
    assert set(audit) == set(range(8))
    for stream, row in audit.items():
        assert row["raw_bytes"] == sizes.get(stream, 0)
        assert row["n_messages"] == 2 + -(-sizes.get(stream, 0) // 64)
        assert row["has_init"] and row["has_eof"]
        assert not (row["missing_seq"] or row["duplicate_seq"] or row["length_mismatch"] or row["digest_mismatch"])


def test_audit_tells_gaps_from_repeats(spark):
    rows = [(1, s, d.KIND_RAW, b"x") for s in (0, 1, 1, 3)] + [(2, s, d.KIND_RAW, b"x") for s in (0, 1, 1)]
    messages = spark.createDataFrame(rows, "stream_id BIGINT, seq BIGINT, kind STRING, value BINARY")
    got = {r["stream_id"]: (r["missing_seq"], r["duplicate_seq"]) for r in d.integrity_audit(messages).collect()}
    assert got == {1: (True, True), 2: (False, True)}


def expected_timeouts(rows, limit):
    out = {}
    for stream in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == stream and r[3]), key=lambda r: r[1])
        kept = [mine[0]]
        for before, row in zip(mine, mine[1:]):
            if row[2] - before[2] >= limit:
                break
            kept.append(row)
        late = len(kept) < len(mine)
        out[stream] = {
            "stream_id": stream,
            "timed_out": late,
            "end_time": kept[-1][2] + (limit if late else dt.timedelta(0)),
            "rows_kept": len(kept),
            "bytes_kept": sum(len(r[3]) for r in kept),
            "rows_dropped": len(mine) - len(kept),
            "last_seq": kept[-1][1],
        }
    return out


@pytest.mark.parametrize("block_rows", [8, 64, 1 << 18])
@pytest.mark.parametrize("limit", [5, 30, 60])
def test_timeouts(hot, hot_rows, block_rows, limit):
    ends = d.no_data_timeouts(hot, f"{limit}s", block_rows=block_rows).collect()
    got = {r["stream_id"]: r.asDict() for r in ends}
    assert got == expected_timeouts(hot_rows, dt.timedelta(seconds=limit))


def test_timeout_counts_from_the_start(spark):
    rows = spark.createDataFrame(
        [(1, 0, T0 + dt.timedelta(seconds=61), 5), (2, 0, T0 + dt.timedelta(seconds=59), 5)],
        "stream_id BIGINT, seq BIGINT, ts TIMESTAMP, n_bytes BIGINT")
    starts = spark.createDataFrame([(1, T0), (2, T0), (3, T0)], "stream_id BIGINT, start_time TIMESTAMP")
    got = {r["stream_id"]: (r["timed_out"], r["end_time"], r["rows_kept"], r["rows_dropped"])
           for r in d.no_data_timeouts(rows, starts=starts).collect()}
    minute = T0 + dt.timedelta(seconds=60)
    assert got == {1: (True, minute, 0, 1), 2: (False, T0 + dt.timedelta(seconds=59), 1, 0), 3: (True, minute, 0, 0)}


@pytest.mark.parametrize("block_rows", [8, 1 << 18])
def test_byte_progress(hot, hot_rows, block_rows):
    got = {(r["stream_id"], r["seq"]): r["bytes_so_far"] for r in d.byte_progress(hot, block_rows=block_rows).collect()}
    total = {}
    for stream, seq, _, payload in sorted(hot_rows, key=lambda r: r[1]):
        total[stream] = total.get(stream, 0) + len(payload)
        assert got[stream, seq] == total[stream]
    assert len(got) == len(hot_rows)


def test_empty_envelopes_are_sent_once(spark):
    failed = spark.createDataFrame([(1,), (1,), (2,)], "stream_id BIGINT")
    written = spark.createDataFrame([(2,), (2,)], "stream_id BIGINT")
    rows = d.empty_envelopes(failed, written, "stream_id", {"jobId": F.lit("j")}, F.lit("p__")).collect()
    assert sorted((r["stream_id"], r["seq"], r["key"]) for r in rows) == [(1, 0, "p__stream_init"), (1, 1, "p__stream_eof")]


def test_same_key_same_partition(spark):
    rows = spark.range(20).select(F.concat(F.lit("key_"), (F.col("id") % 4).cast("string")).alias("key"))
    auto = d.place_messages(rows, F.lit("t"), F.lit(-1), 8)
    assert [r["n"] for r in auto.groupBy("key").agg(F.countDistinct("partition").alias("n")).collect()] == [1] * 4
    fixed = d.place_messages(rows, F.lit("t"), F.lit(100), 8)
    assert {r["partition"] for r in fixed.collect()} == {100}


def test_log_and_objects_read_back(spark, tmp_path):
    df = spark.createDataFrame([(i, bytes([i]) * (i * 500)) for i in range(1, 9)], "stream_id BIGINT, data BINARY")
    messages = d.envelope(df, "stream_id", "data", {"jobId": F.lit("j")}, F.lit("p__"), 1000)
    sinks.write_log(d.place_messages(messages, F.lit("t"), F.lit(3), 4), str(tmp_path / "log"))
    back = spark.read.parquet(str(tmp_path / "log"))
    assert back.count() == messages.count()
    assert sinks.log_rows(back).columns == list(sinks.LOG_COLUMNS)
    chunks = d.chunk_payloads(df.withColumn("dest_key", F.concat(F.lit("k"), F.col("stream_id").cast("string"))), "dest_key", "data", 1000)
    sinks.write_objects(chunks, str(tmp_path / "objects"))
    body = b"".join(bytes(r["value"]) for r in sinks.read_object(spark, str(tmp_path / "objects"), "k7").collect())
    assert body == bytes([7]) * 3500


def test_tee_writes_both_and_replays_in_place(spark, tmp_path):
    write = sinks.tee(sinks.batch_folder(str(tmp_path / "a")), sinks.batch_folder(str(tmp_path / "b")))
    batch = spark.range(10)
    write(batch, 0)
    write(batch, 0)
    write(batch, 1)
    assert spark.read.parquet(str(tmp_path / "a")).count() == spark.read.parquet(str(tmp_path / "b")).count() == 20


def test_captures_read_back(spark, hot, tmp_path):
    hot.write.parquet(str(tmp_path / "captures"))
    back = read_captures(spark, str(tmp_path / "captures"))
    assert back.columns == ["stream_id", "seq", "ts", "payload"] and back.count() == hot.count()


def test_landed_files_become_messages(spark, tmp_path):
    (tmp_path / "a.mov").write_bytes(bytes(25_000))
    objects = read_landed_objects(spark, str(tmp_path))
    messages = d.envelope(objects, "object", "payload", {"jobId": F.lit("j")}, F.lit("")).collect()
    assert len(messages) == 2 + 3 and objects.first()["n_bytes"] == 25_000


def test_empty_objects_are_kept(spark):
    df = spark.createDataFrame([("a", b""), ("b", None), ("c", b"xyz")], "dest_key STRING, payload BINARY")
    rows = d.chunk_payloads(df, "dest_key", "payload", 2, keep_empty=True).collect()
    assert sorted((r["dest_key"], r["chunk_no"], r["n_bytes"]) for r in rows) == [
        ("a", 0, 0), ("b", 0, 0), ("c", 0, 2), ("c", 1, 1)]
