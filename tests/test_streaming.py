"""Streaming forms across several micro-batches against the batch operators."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from tidegate.operators import delivery as d
from tidegate.plans.fixtures import view
from tidegate.session import scratch_path
from tidegate.streaming import jobs
from tidegate.streaming.state import landed_digests, landed_rows


@pytest.fixture(scope="module")
def parts(spark, sf_dir):
    """The byte table as four files in time order, one per micro-batch."""
    path = scratch_path(spark, "stream-input")
    rows = view(spark, sf_dir, "v_bytes")
    quarter = rows.count() // 4 + 1
    for i in range(4):
        part = rows.where(F.floor(F.col("seq") / quarter) == i)
        part.coalesce(1).write.mode("append").parquet(path)
    return rows, spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_windows_equal_batch(parts):
    rows, stream = parts
    live, end = jobs.ending(stream)
    report = {}
    got = jobs.run_to_table(jobs.heartbeat_windows(live, "1 hour", "6h"), "t-windows", end=end, report=report)
    want = (
        rows.groupBy("stream_id", F.window(F.col("ts").cast("timestamp"), "6 hours").alias("w"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("b"))
        .select("stream_id", "w.start", "n", "b")
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert report["late_rows"] == 0


def test_late_rows_are_counted(spark):
    path = scratch_path(spark, "late-input")
    ddl = "stream_id BIGINT, ts TIMESTAMP, n_bytes BIGINT"
    for hour in (50, 80, 1):
        row = spark.range(1).selectExpr("id AS stream_id", f"timestamp_seconds({hour * 3600}) AS ts", "5L AS n_bytes")
        row.coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(path)
    live, end = jobs.ending(stream)
    report = {}
    got = jobs.run_to_table(jobs.heartbeat_windows(live, "1 hour", "6h"), "t-late", end=end, report=report)
    assert got.count() == 2 and report["late_rows"] == 1


def test_first_sessions_equal_batch_timeouts(parts):
    rows, stream = parts
    live, end = jobs.ending(stream)
    sessions = jobs.run_to_table(jobs.session_ends(live, "1 hour", "24h"), "t-sessions", end=end)
    got = {r["stream_id"]: (r["n_rows"], r["n_bytes"]) for r in jobs.first_sessions(sessions).collect()}
    batch = d.no_data_timeouts(rows, "24h").collect()
    assert got == {r["stream_id"]: (r["rows_kept"], r["bytes_kept"]) for r in batch if r["rows_kept"]}


def test_digests_of_landed_micro_batches(parts):
    import hashlib

    rows, stream = parts
    written = jobs.run_to_table(landed_rows(stream), "t-digests")
    got = {r["stream_id"]: (r["n_rows"], r["md5"]) for r in landed_digests(written).collect()}
    texts = {}
    for r in rows.orderBy("seq").select("stream_id", "payload").collect():
        texts.setdefault(r["stream_id"], []).append(r["payload"])
    assert got == {s: (len(t), hashlib.md5("".join(t).encode()).hexdigest()) for s, t in texts.items()}


def test_window_join_over_micro_batches(spark, parts, sf_dir):
    from tidegate.operators.slicing import capture_slice

    rows, stream = parts
    windows = view(spark, sf_dir, "v_windows").where("duration_us > 0")
    windows = windows.withColumn("duration_us", F.col("duration_us") + 24 * 3600 * 1_000_000)
    path = scratch_path(spark, "window-input")
    quarter = rows.count() // 4 + 1
    for i in range(4):
        windows.where(F.floor(F.col("window_id") / quarter) == i).coalesce(1).write.mode("append").parquet(path)
    window_stream = spark.readStream.schema(windows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = jobs.run_to_table(jobs.slice_streams(stream, window_stream, "72h", "1 hour", "6h"), "t-join")
    want = capture_slice(rows, windows, "6h")
    key = ("window_id", "seq")
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, want.select(*key).collect()))


def test_windows_beyond_the_bound_fail(spark, parts, sf_dir):
    _, stream = parts
    path = scratch_path(spark, "long-window")
    view(spark, sf_dir, "v_windows").limit(3).withColumn("duration_us", F.lit(10**12)).write.parquet(path)
    windows = spark.readStream.schema(view(spark, sf_dir, "v_windows").schema).parquet(path)
    with pytest.raises(Exception, match="beyond 72h"):
        jobs.run_to_table(jobs.slice_streams(stream, windows, "72h", "1 hour", "6h"), "t-long")


def test_a_table_may_be_a_folder(spark, sf_dir):
    folder = scratch_path(spark, "tables")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    pages.repartition(3).write.parquet(f"{folder}/pages.parquet")
    for place in (folder, sf_dir):
        stream = jobs.read_table_stream(spark, place, "pages", maxFilesPerTrigger="1").select("page_id")
        assert jobs.run_to_table(stream, "t-folder").count() == pages.count()


def test_tee_keeps_batches_apart(spark, parts):
    from tidegate.sources.sinks import batch_folder, tee

    rows, stream = parts
    root = scratch_path(spark, "t-tee")
    jobs.run_batches(stream, "t-tee-progress", tee(batch_folder(f"{root}/a"), batch_folder(f"{root}/b")))
    for sink in "ab":
        back = spark.read.parquet(f"{root}/{sink}")
        assert back.count() == rows.count()
        assert back.select("batch_id").distinct().count() >= 4
