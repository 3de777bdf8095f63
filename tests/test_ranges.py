"""Files as captured rows: cuts, pruning, many tasks for one file, digests and envelopes."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidegate.operators import delivery as d
from tidegate.operators.digest import stream_digests
from tidegate.sources.ranges import read_ranges


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    root = tmp_path_factory.mktemp("landed")
    rng = random.Random(5)
    sizes = {"a.ts": 10_001, "b": 0, "deep/c.ts": 640, "deep/d.ts": 64, "deep/e é.ts": 63, "f": 65}
    files = {}
    for name, size in sizes.items():
        path = root / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(rng.randbytes(size))
        files[str(path)] = path.read_bytes()
    for name in ("_SUCCESS", ".a.crc", "_temporary/x"):
        (root / name).parent.mkdir(exist_ok=True)
        (root / name).write_bytes(b"not data")
    return str(root), files


@pytest.mark.parametrize("range_bytes, partition_bytes", [(64, 64), (64, 1000), (1, 7), (1 << 20, 1 << 26), (100, 1)])
def test_rows_are_the_files(spark, landed, range_bytes, partition_bytes):
    root, files = landed
    rows = read_ranges(spark, root, range_bytes, partition_bytes).collect()
    got = {}
    for row in sorted(rows, key=lambda r: r["seq"]):
        assert row["n_bytes"] == len(row["payload"]) <= range_bytes
        assert row["ts"] is not None
        got.setdefault(row["stream_id"], []).append(bytes(row["payload"]))
    assert {path: b"".join(parts) for path, parts in got.items()} == files
    for path, data in files.items():
        assert len(got[path]) == max(1, -(-len(data) // range_bytes))
        assert [r["seq"] for r in rows if r["stream_id"] == path] == list(range(len(got[path])))


def test_one_file_is_read_by_many_tasks(spark, landed):
    root, files = landed
    rows = read_ranges(spark, f"file://{root}/a.ts", 64, 640)
    tasks = rows.groupBy(F.spark_partition_id()).agg(F.sum("n_bytes").alias("n")).collect()
    assert len(tasks) == 16 and max(r["n"] for r in tasks) == 640
    few = read_ranges(spark, root, 64, 1 << 20)
    assert few.rdd.getNumPartitions() == 1


def test_lengths_without_opening_files(spark, landed, monkeypatch):
    root, files = landed
    lean = read_ranges(spark, root, 100, columns=("stream_id", "n_bytes"))
    assert lean.columns == ["stream_id", "n_bytes"]
    sizes = {r["stream_id"]: r["n"] for r in lean.groupBy("stream_id").agg(F.sum("n_bytes").alias("n")).collect()}
    assert sizes == {path: len(data) for path, data in files.items()}
    with pytest.raises(Exception, match="no such columns"):
        spark.read.format("byte_ranges").schema("other STRING").load(root).collect()


def test_names_leave_files_out(spark, landed):
    root, files = landed
    rows = read_ranges(spark, root, 64, 64, names="*.ts")
    assert {r["stream_id"] for r in rows.collect()} == {p for p in files if p.endswith(".ts")}


def test_filters_of_one_query_do_not_reach_the_next(spark, landed):
    root, files = landed
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        rows = read_ranges(spark, root, 64, 640)
        one = rows.where((F.col("stream_id") == f"{root}/f") & (F.col("n_bytes") < 64))
        assert [(r["seq"], r["n_bytes"]) for r in one.collect()] == [(1, 1)]
        assert {r["stream_id"] for r in rows.collect()} == set(files)
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_digests_and_messages_of_files(spark, landed):
    root, files = landed
    rows = read_ranges(spark, root, 64, 640)
    got = {r["stream_id"]: (r["n_bytes"], r["md5"]) for r in stream_digests(rows, value="payload").collect()}
    assert got == {path: (len(data), hashlib.md5(data).hexdigest()) for path, data in files.items()}
    streams = rows.select("stream_id").distinct()
    messages = d.envelope_from_rows(rows, streams, {"jobId": F.lit("j")}, F.lit("p__"), message_bytes=100)
    for row in d.integrity_audit(messages).collect():
        size = len(files[row["stream_id"]])
        assert (row["n_messages"], row["raw_bytes"]) == (2 + -(-size // 100), size)
        assert not (row["missing_seq"] or row["length_mismatch"] or row["digest_mismatch"])


def test_no_such_path(spark, tmp_path):
    with pytest.raises(Exception, match="nowhere"):
        read_ranges(spark, str(tmp_path / "nowhere")).collect()
    assert read_ranges(spark, str(tmp_path)).count() == 0
