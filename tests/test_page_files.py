"""Page files are read once, in long reads and few tasks, whatever the length of their ranges."""

from __future__ import annotations

from pyspark.sql.types import StructType
from pyarrow import fs

from tidegate.plans import delivery_queries
from tidegate.sources import ranges


class _Counting:
    def __init__(self, opened, reads):
        self.opened, self.reads = opened, reads

    def read_at(self, n, at):
        self.reads.append((at, n))
        return self.opened.read_at(n, at)

    def close(self):
        self.opened.close()


def test_short_ranges_come_with_one_read(spark, tmp_path, monkeypatch):
    data = bytes(i * 31 % 251 for i in range(25_001))
    (tmp_path / "a").write_bytes(data)
    reads = []

    class System:
        def __getattr__(self, name):
            return getattr(fs.LocalFileSystem(), name)

        def open_input_file(self, path):
            return _Counting(fs.LocalFileSystem().open_input_file(path), reads)

    monkeypatch.setattr(ranges, "_file_system", lambda path: (System(), path))
    monkeypatch.setattr(ranges, "_READ_BYTES", 10_050, raising=False)
    schema = StructType.fromDDL(", ".join(f"{c} {kind}" for c, kind in ranges.COLUMNS.items()))
    reader = ranges.ByteRangeReader({"path": str(tmp_path), "rangeBytes": "100"}, schema)
    rows = [row for part in reader.partitions() for batch in reader.read(part) for row in batch.to_pylist()]
    assert [(r["seq"], r["payload"]) for r in rows] == [
        (i, data[i * 100 : i * 100 + 100]) for i in range(251)
    ]
    assert reads == [(0, 10_000), (10_000, 10_000), (20_000, 5_001)]


def test_ranges_of_page_files_are_written_once(spark, tmp_path):
    pages = [(i, "u", "é" * 3000 if i % 7 else None) for i in range(500)]
    spark.createDataFrame(pages, "page_id BIGINT, url STRING, html STRING").write.parquet(f"{tmp_path}/pages.parquet")
    rows = delivery_queries._page_files(spark, str(tmp_path))
    assert "byte_ranges" not in rows._jdf.queryExecution().executedPlan().toString()
    # 500 pages are 2.6 MB in ten files: one task reads them, where 100,000 bytes were one before.
    assert len(rows.inputFiles()) == 1
    sizes = {}
    for row in rows.collect():
        sizes[row["stream_id"]] = sizes.get(row["stream_id"], 0) + len(row["payload"])
    assert sizes == {
        f: sum(len((html or "").encode()) + 1 for i, _, html in pages if i // 50 == f) for f in range(10)
    }
