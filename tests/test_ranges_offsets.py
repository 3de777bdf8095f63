"""Lost and repeated ranges, producer-equal places, offsets over micro-batches, and slice totals."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidegate.operators import delivery as d
from tidegate.operators import slicing as s
from tidegate.sources import sinks

T0 = dt.datetime(2024, 1, 1)


def _ranges(numbers):
    out, seen = [], Counter(numbers)
    last = max(seen)
    for state, member in (("missing", lambda o: o not in seen), ("repeated", lambda o: seen[o] > 1)):
        run = None
        for o in range(last + 2):
            if o <= last and member(o):
                run = run or [o, o, 0]
                run[1] = o
                run[2] += 1 if state == "missing" else seen[o] - 1
            elif run:
                out.append((run[0], run[1], state, run[2]))
                run = None
    return out


@pytest.mark.parametrize("block_rows", [1, 4, 7, 1 << 18])
def test_ranges_match_brute_force(spark, block_rows):
    rng = random.Random(6)
    streams = {k: [o for o in range(rng.randrange(1, 60)) if rng.random() < 0.6 for _ in range(rng.choice([1, 1, 2, 3]))] for k in range(12)}
    streams[20] = [0]
    streams[21] = [9, 9, 9]
    streams[22] = [o for o in range(30) for _ in "ab"]
    streams[23] = [1000]
    rows = [(k, o) for k, numbers in streams.items() for o in numbers]
    rows += [(1, -5), (1, None), (2, None)]
    messages = spark.createDataFrame(rows, "stream_id BIGINT, seq BIGINT").repartition(4)
    got = sorted(map(tuple, d.sequence_ranges(messages, block_rows=block_rows).collect()))
    assert got == sorted((k, *r) for k, numbers in streams.items() if numbers for r in _ranges(numbers))


def test_fnv_vectors_and_places(spark):
    vectors = {"": 0x811C9DC5, "a": 0xE40C292C, "b": 0xE70C2DE5, "foobar": 0xBF9CF968, "é😀": None, None: None}

    def fnv(text):
        h = 0x811C9DC5
        for byte in text.encode():
            h = (h ^ byte) * 0x01000193 % (1 << 32)
        return h

    df = spark.createDataFrame([(k,) for k in vectors] + [("a\x00\xff",)], "key STRING")
    got = {r["key"]: r["h"] for r in df.select("key", d.fnv1a(F.col("key")).alias("h")).collect()}
    assert got == {k: (None if k is None else fnv(k)) for k in got}
    assert all(got[k] == v for k, v in vectors.items() if v is not None)
    for partitions in (1, 7, 8):
        placed = d.place_messages(df, F.lit("t"), F.lit(-1), partitions).collect()
        for row in placed:
            h = fnv(row["key"] or "")
            signed = h - (1 << 32) if h >= 1 << 31 else h
            want = abs(signed) % partitions if row["key"] is not None else 0
            assert row["partition"] == want


def _log(n, seed, skip=()):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        stream = 0 if rng.random() < 0.5 else rng.randrange(1, 9)
        if i not in skip:
            rows.append(("t", stream % 3, f"k{stream}", stream, i))
    return rows


DDL = "topic STRING, partition INT, key STRING, stream_id BIGINT, seq BIGINT"


@pytest.mark.parametrize("spread, block_rows", [(1, 1 << 18), (3, 16)])
def test_offsets_are_dense_and_follow_streams(spark, spread, block_rows):
    rows = _log(300, 2)
    marks = spark.createDataFrame([("t", 1, 40), ("other", 0, 9)], "topic STRING, partition INT, next_offset BIGINT")
    df = spark.createDataFrame(rows, DDL)
    first = sinks.with_offsets(df.repartition(5), marks, spread=spread, block_rows=block_rows).collect()
    again = sinks.with_offsets(df.repartition(2), marks, spread=spread, block_rows=block_rows).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))
    for partition in range(3):
        mine = sorted((r["offset"], r["stream_id"], r["seq"]) for r in first if r["partition"] == partition)
        base = 40 if partition == 1 else 0
        assert [m[0] for m in mine] == list(range(base, base + sum(r[1] == partition for r in rows)))
        for stream in {m[1] for m in mine}:
            along = [m[2] for m in mine if m[1] == stream]
            assert along == sorted(along)


def test_replayed_batches_write_the_same_offsets(spark, tmp_path):
    path = str(tmp_path / "log")
    write = sinks.append_log(path)
    assert sinks.high_water(spark, path) is None
    batches = [spark.createDataFrame(_log(60, seed), DDL) for seed in (1, 2, 3)]
    for i, batch in enumerate(batches):
        write(batch, i)
    read = lambda: sorted(map(tuple, spark.read.parquet(f"{path}/log").select("batch_id", "partition", "offset", "stream_id", "seq").collect()))
    once = read()
    write(batches[1], 1)  # a replay after a later batch
    write(batches[2], 2)
    assert read() == once
    write(batches[0].limit(0), 3)
    total = Counter(r[1] for r in once)
    marks = {(r["topic"], r["partition"]): r["next_offset"] for r in sinks.high_water(spark, path).collect()}
    assert marks == {("t", p): n for p, n in total.items()}
    for partition, n in total.items():
        assert sorted(r[2] for r in once if r[1] == partition) == list(range(n))


@pytest.mark.parametrize("bin_width", ["1s", "1m", "24h"])
def test_window_totals_equal_the_joined_slices(spark, bin_width):
    rng = random.Random(4)
    rows = [(rng.choice([0, 0, 0, 1, 2]), i, T0 + dt.timedelta(milliseconds=500 * rng.randrange(400)), rng.choice([0, 5, 9])) for i in range(500)]
    captures = spark.createDataFrame(rows, "stream_id BIGINT, seq BIGINT, ts TIMESTAMP, n_bytes BIGINT")
    spans = [
        (rng.choice([0, 0, 1, 3]), i, T0 + dt.timedelta(milliseconds=500 * rng.randrange(-50, 450)),
         rng.choice([0, 1, 500_000, 20_000_000, 10**9]), rng.choice(["capture", "plugin", "rtsp", "mjpeg"]))
        for i in range(80)
    ]
    windows = spark.createDataFrame(spans, "stream_id BIGINT, window_id BIGINT, start_ts TIMESTAMP, duration_us BIGINT, reader STRING")
    want = s.slice_totals(s.capture_slice(captures, windows, "1m"))
    names = ["window_id", "stream_id", "n_rows", "n_bytes"]
    got = s.window_totals(captures, windows, bin_width)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(map(tuple, want.select(*names).collect()))
    assert s.window_totals(captures.limit(0), windows).count() == 0
