from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidegate.functions.urls import has_suffix, url_path
from tidegate.functions.values import (
    duration_micros,
    duration_nanos,
    human_size,
    literal_micros,
    media_time_micros,
)


def column(spark, values, expr, ddl="v STRING"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, {ddl}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_durations(spark):
    cases = {
        "30s": 30_000_000_000,
        "1m": 60_000_000_000,
        "7m31.25s": 451_250_000_000,
        "2.5µs": 2_500,
        "2.5μs": 2_500,
        "1h1m1s1ms1us1ns": 3_661_001_001_001,
        "0": 0,
        "0s": 0,
        "-1.5h": -5_400_000_000_000,
        "+.5s": 500_000_000,
        "1.s": 1_000_000_000,
        "xyz": None,
        "": None,
        "5": None,
        "s": None,
        ".s": None,
        "1 s": None,
        "1s ": None,
        "3000000h": None,
    }
    assert column(spark, list(cases), duration_nanos) == list(cases.values())
    assert column(spark, ["7m31.25s", "1ns", "xyz"], duration_micros) == [451_250_000, 0, None]


def test_literal_durations():
    assert literal_micros("6h") == 21_600_000_000
    assert literal_micros("250ms") == 250_000
    with pytest.raises(ValueError):
        literal_micros("soon")


def test_human_size(spark):
    sizes = [0, 1024, 1025, 1536, 5_000_000_000, 1 << 41]
    want = ["0 B", "1024 B", "1.0 KB", "1.5 KB", "4.7 GB", "2.0 TB"]
    assert column(spark, sizes, human_size, "v BIGINT") == want


def test_media_time(spark):
    cases = {
        "00:00:01.50": 1_500_000,
        "12:34:56.789": 45_296_789_000,
        "13:00:00.000": 46_800_000_000,
        "23:59:59.99": 86_399_990_000,
        "00:01:02.123456": 62_123_000,
        "00:01": 65_000_000,
        "00:99:00.00": None,
    }
    assert column(spark, list(cases), media_time_micros) == list(cases.values())


def test_url_suffixes(spark):
    pictures = (".webp", ".svg")
    cases = {
        "https://cdn.test/a/logo.svg": True,
        "https://cdn.test/photo.webp?w=200&h=100": True,
        "https://cdn.test/photo.webp#top": True,
        "https://cdn.test/photo%2Ewebp": True,
        "/local/part.svg": True,
        "https://cdn.test/photo.WEBP": False,
        "https://cdn.test/clip.webm": False,
        "https://cdn.test/clip.webm?poster=x.svg": False,
        "https://cdn.test/clip#x.svg": False,
        "https://cdn.test": False,
        "https://logo.svg": False,
        "https://cdn.test/%zz.svg": False,
        "svg": False,
    }
    assert column(spark, list(cases), lambda c: has_suffix(c, pictures)) == list(cases.values())


def test_url_path(spark):
    assert column(spark, ["http://h/a+b%20c?q"], url_path) == ["/a+b c"]


def test_package_archive(tmp_path):
    import zipfile

    from tidegate.session import package_archive

    names = zipfile.ZipFile(package_archive(str(tmp_path))).namelist()
    assert "tidegate/functions/values.py" in names and "tidegate/__init__.py" in names


def test_scratch_folder_follows_the_session(spark):
    from tidegate.session import materialise, scratch_path

    base = f"{spark.conf.get('spark.checkpoint.dir')}/scratch-{spark.sparkContext.applicationId}"
    assert scratch_path(spark, "x").startswith(f"{base}/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert materialise(spark.range(3), "x").count() == 3


def test_scratch_is_dropped(tmp_path, monkeypatch, spark):
    from tidegate import session

    monkeypatch.setattr(session, "shared_dir", lambda _: f"file://{tmp_path}")
    session.materialise(spark.range(3), "x")
    assert any(tmp_path.iterdir())
    session.drop_scratch(spark)
    assert not any(p.is_dir() for p in tmp_path.iterdir())
