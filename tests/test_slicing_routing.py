from __future__ import annotations

import datetime as dt
import random

import pytest

from tidegate.operators import routing as r
from tidegate.operators import slicing as s
from tidegate.operators.signatures import default_signatures, identify

T0 = dt.datetime(2024, 1, 1)
SEC = dt.timedelta(seconds=1)


@pytest.mark.parametrize("bin_width", ["10s", "1h", "240h"])
def test_slices_equal_brute_force(spark, bin_width):
    rng = random.Random(5)
    rows = [(0 if rng.random() < 0.5 else rng.randrange(1, 5), i, T0 + dt.timedelta(milliseconds=rng.randrange(600_000)))
            for i in range(800)]
    readers = ["capture", "plugin", "rtsp", "mjpeg"]
    windows = [(rng.randrange(5), w, T0 + dt.timedelta(milliseconds=rng.randrange(-60_000, 600_000)),
                rng.choice([0, 1, 1_500, 10_000_000, 2_300_400, 90_000_000]), rng.choice(readers)) for w in range(60)]
    captures = spark.createDataFrame(rows, "stream_id BIGINT, seq BIGINT, ts TIMESTAMP")
    spans = spark.createDataFrame(
        windows, "stream_id BIGINT, window_id BIGINT, start_ts TIMESTAMP, duration_us BIGINT, reader STRING")
    want = set()
    for stream, window, start, us, reader in windows:
        if reader in ("rtsp", "mjpeg"):
            end = start + SEC * -(-us // 1_000_000)
        elif us:
            end = start + dt.timedelta(milliseconds=round(us / 1000))
        else:
            end = dt.datetime.max
        want |= {(window, q) for st, q, ts in rows if st == stream and start <= ts < end}
    out = s.capture_slice(captures, spans, bin_width).select("window_id", "seq").collect()
    assert sorted(map(tuple, out)) == sorted(want)


def test_slice_totals(spark):
    df = spark.createDataFrame([(1, 7, 5), (1, 7, 6)], "window_id INT, stream_id INT, n_bytes BIGINT")
    assert tuple(s.slice_totals(df).first()) == (1, 7, 2, 11)


def probes(spark, rows):
    ddl = "id STRING, url STRING, attempt INT, status_code INT, content_type STRING, sniff_hex STRING, error_kind STRING"
    return spark.createDataFrame(rows, ddl)


def test_mime_classes(spark):
    rows = [
        ("image", "http://h/a", 1, 503, "text/plain", "", None),
        ("image", "http://h/a", 2, 200, "image/png", "", None),
        ("sniffed", "http://h/b", 1, 200, "", "255044462D312E", None),
        ("unknown", "http://h/c", 1, 200, "", "0000", None),
        ("suffix", "http://h/c.doc?x=1", 1, 200, "application/octet-stream", "", None),
        ("charset", "http://h/d", 1, 200, "text/plain; charset=utf-8", "", None),
        ("other charset", "http://h/d", 1, 200, "text/plain; charset=latin1", "", None),
        ("down", "http://h/e", 1, None, "image/png", "", "transport"),
        *[("gone", "http://h/f", n, 404, "image/png", "", None) for n in range(1, 6)],
        *[("late", "http://h/g", n, 404 if n < 6 else 200, "image/png", "", None) for n in range(1, 7)],
    ]
    got = {x["id"]: tuple(x)[2:] for x in r.classify_mime(probes(spark, rows), "id").collect()}
    assert got == {
        "image": ("image/png", True, False, False),
        "sniffed": ("application/pdf", False, True, False),
        "unknown": ("", False, False, False),
        "suffix": ("application/octet-stream", False, True, False),
        "charset": ("text/plain; charset=utf-8", False, True, False),
        "other charset": ("text/plain; charset=latin1", False, False, False),
        "down": ("", False, False, False),
        "gone": ("", False, False, True),
        "late": ("", False, False, True),
    }


def test_routes(spark):
    plain = ("", False, False, False, False)
    cases = {
        "RTSP://cam/x": (plain, ("rtsp", False, False, None)),
        "http://h.org/a.png": (("image/png", True, False, False, True), ("http", False, False, None)),
        "https://h.org/a.pdf": (("", False, True, False, True), ("http", False, False, None)),
        "http://h.org/v": (("multipart/x-mixed-replace; boundary=b", False, False, False, True), ("mjpeg", False, False, None)),
        "http://h.org/v.cgi?x": (plain, ("mjpeg", False, False, None)),
        "http://h.org/v.mpd": (("application/dash+xml", False, False, False, True), ("capture", False, True, None)),
        "http://www.plug.tv/v.mpd": (("application/dash+xml", False, False, False, True), ("plugin", False, True, None)),
        "http://h.org/live": (("", False, False, False, True), ("capture", False, False, None)),
        "http://h.org/file": (plain, ("http", False, False, None)),
        "http://h.org/bad": (("", False, False, True, False), (None, False, False, "invalid_data")),
        "rtmp://www.plug.tv/v.mjpg": (("", False, False, True, True), ("plugin", False, False, None)),
        "rtmp://h.org/v": (("", False, False, False, True), ("capture", False, False, None)),
        "http://api.vendor.com/media-streamer/stream/1": (plain, ("http", True, False, None)),
    }
    rows = [(u, *c[0]) for u, c in cases.items()]
    urls = spark.createDataFrame(
        rows, "url STRING, mime STRING, is_image BOOLEAN, is_text BOOLEAN, probe_failed BOOLEAN, is_live BOOLEAN")
    domains = spark.createDataFrame([("plug.tv",), ("plug.tv",)], "domain STRING")
    out = r.assign_routes(urls, domains, auth_word="vendor")
    got = {x["url"]: (x["route"], x["needs_auth"], x["patch_manifest"], x["failure_reason"]) for x in out.collect()}
    assert got == {u: c[1] for u, c in cases.items()}


def test_signatures_match_brute_force(spark):
    table = [(r["mime"], r["at"], bytes.fromhex(r["pattern"]), bytes.fromhex(r["mask"]), r["skip_space"])
             for r in default_signatures(spark).collect()]
    assert len(table) > 60 and all(len(p) == len(m) for _, _, p, m, _ in table)

    def brute(data):
        best = []
        for mime, at, pattern, mask, skip in table:
            text = data.lstrip(b"\t\n\f\r ") if skip else data
            head = text[at : at + len(pattern)]
            if len(head) == len(pattern) and all(a & m == p & m for a, p, m in zip(head, pattern, mask)):
                best.append((-sum(m > 0 for m in mask), mime))
        return min(best)[1] if best else None

    rng = random.Random(2)
    heads = [b"", b"\x00", b" \n<HtMl>x", b"<html\x00", b"<!doctype HTML ", b"  <!--x", b"RIFF1234WAVEfmt", b"RIFF1234WEBPVP8", b"<b>", b"<bODY>",
             b"....ftypmp42", b"%PDF-1", b"<?xml v", b"x" * 34 + b"LP"]
    for _, at, pattern, mask, _ in table:
        body = bytes((p & m) | (rng.randrange(256) & ~m & 0xFF) for p, m in zip(pattern, mask))
        heads += [bytes(rng.randrange(256) for _ in range(at)) + body + b"tail", body[:-1], b" " * 3 + body]
    rows = [(i, h.hex().upper() if i % 2 else h.hex()) for i, h in enumerate(heads)] + [(len(heads), None)]
    df = spark.createDataFrame(rows, "id INT, head STRING")
    got = {r["id"]: r["mime"] for r in identify(df, "head", ["id"], default_signatures(spark), "mime").collect()}
    assert got == {**{i: brute(h) for i, h in enumerate(heads)}, len(heads): None}


def test_own_signatures_and_bounds(spark):
    ddl = "mime STRING, at INT, pattern STRING, mask STRING, skip_space BOOLEAN"
    own = spark.createDataFrame(
        [("b/short", 0, "AABB", "FFFF", False), ("a/long", 0, "AABB00CC", "FFFF00FF", False), ("c/same", 1, "BB11", "FFFF", False), ("d/none", 0, "00", "00", False)], ddl)
    df = spark.createDataFrame([(1, "AABB99CC"), (2, "AABB9900"), (3, "AABB11"), (4, "99")], "id INT, head STRING")
    got = {r["id"]: r["mime"] for r in identify(df, "head", ["id"], own, "mime").collect()}
    assert got == {1: "a/long", 2: "b/short", 3: "b/short", 4: None}
    many = spark.range(101).selectExpr("'x' AS mime", "CAST(id AS INT) AS at", "'AA' AS pattern", "'FF' AS mask", "false AS skip_space")
    with pytest.raises(ValueError, match="at most"):
        identify(df, "head", ["id"], many)
