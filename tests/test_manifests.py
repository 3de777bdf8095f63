from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidegate.functions.values import iso_duration_micros
from tidegate.operators import manifests as m
from tidegate.schemas import MANIFEST_TIMES, MANIFEST_TOTALS


def manifest(reps, sets=1, period='id="0" start="PT0S" duration="PT6M13.25S"'):
    body = "".join(f"<AdaptationSet>{reps}</AdaptationSet>" for _ in range(sets))
    return ('<?xml version="1.0"?>\n<MPD xmlns="urn:mpeg:dash:schema:mpd:2011" profiles="p" type="static">'
            f"<Period {period}>{body}</Period></MPD>")


def rep(i=0, mime="audio/mp4", bandwidth=56000, inner="", n=12):
    segments = "".join(f'<SegmentURL media="m{k}"/>' for k in range(n))
    return (f'<Representation id="{i}" mimeType="{mime}" codecs="c" bandwidth="{bandwidth}">{inner}'
            f'<SegmentList timescale="10" duration="5"><Initialization sourceURL="init"/>{segments}</SegmentList></Representation>')


AUDIO = manifest(rep())
VIDEO = manifest(rep(mime="video/mp4", n=41))
TEMPLATE = manifest(
    '<ContentProtection schemeIdUri="urn:a" value="cenc"/>'
    '<Representation id="t" bandwidth="7"><ContentProtection schemeIdUri="urn:b"/>'
    '<SegmentTemplate timescale="1000" media="$Number$"><SegmentTimeline><S t="0" d="10" r="2"/><S d="5"/></SegmentTimeline>'
    "</SegmentTemplate></Representation>")


def parsed(spark, docs):
    return m.parse_manifests(spark.createDataFrame(list(docs.items()), "manifest_id STRING, xml STRING"))


def test_rejects_what_is_not_a_manifest(spark):
    docs = {"ok": AUDIO, "open": "<MPD><Period>", "text": "hello", "number": manifest(rep(bandwidth="abc")), "blank": ""}
    out = parsed(spark, docs)
    assert {r["manifest_id"] for r in m.rejected_manifests(out).collect()} == {"open", "text", "number", "blank"}


def test_single_audio(spark):
    docs = {
        "audio": AUDIO, "video": VIDEO, "two sets": manifest(rep(), sets=2), "two reps": manifest(rep() + rep(1)),
        "no reps": manifest(""), "no mime": manifest('<Representation id="0"/>'),
    }
    out = parsed(spark, docs).select("manifest_id", m.is_single_audio().alias("x")).collect()
    assert {r["manifest_id"] for r in out if r["x"]} == {"audio"}


def test_patch(spark):
    docs = {"audio": AUDIO, "video": VIDEO}
    patched = m.patch_manifests(parsed(spark, docs))
    xml = {r["manifest_id"]: r["patched_xml"] for r in patched.collect()}
    assert "PT6M13.25S" not in xml["audio"] + xml["video"]
    again = m.parse_manifests(patched.select("manifest_id", F.col("patched_xml").alias("xml")))
    rows = {(r["manifest_id"], r["rep_id"]): (r["mime_type"], r["bandwidth"], r["n_segments"], r["duration_units"])
            for r in m.renditions(again).collect()}
    assert rows == {
        ("audio", "0"): ("audio/mp4", 56000, 12, 60), ("audio", "1"): ("audio/mp4", 0, 12, 60),
        ("video", "0"): ("video/mp4", 56000, 41, 205)}
    assert m.segments(again).where("manifest_id = 'video'").count() == 41


def test_templates_and_protection(spark):
    out = parsed(spark, {"t": TEMPLATE})
    row = m.renditions(out).first()
    assert (row["n_segments"], row["duration_units"]) == (4, 35)
    assert [tuple(r)[1:] for r in m.timeline_segments(out).orderBy("entry_no").collect()] == [
        ("t", 1000, 0, 0, 10, 3), ("t", 1000, 1, None, 5, 1)]
    assert sorted(map(tuple, m.protections(out).fillna("").collect())) == [
        ("t", "", "urn:a", "cenc"), ("t", "t", "urn:b", "")]


def test_best_rendition(spark):
    docs = {
        "top": manifest(rep(0, bandwidth=5) + rep(1, bandwidth=9) + rep(2, bandwidth=7)),
        "tie": manifest(rep("b", bandwidth=9) + rep("a", bandwidth=9)),
        "none": manifest(""),
    }
    out = {r["manifest_id"]: (r["rep_id"], r["bandwidth"]) for r in m.best_rendition(parsed(spark, docs)).collect()}
    assert out == {"top": ("1", 9), "tie": ("a", 9)}


def test_union_attribute(spark):
    cases = {"1": (1, None, False), "true": (None, True, False), "False": (None, False, False), "maybe": (None, None, True), None: (None, None, False)}
    df = spark.createDataFrame([(k,) for k in cases], "v STRING")
    got = {r["v"]: tuple(r["x"]) for r in df.select("v", m.union_uint(F.col("v")).alias("x")).collect()}
    assert got == cases


def test_every_period_is_read_and_written(spark):
    second = '<Period id="1"><AdaptationSet/><AdaptationSet>' + rep(7, "video/mp4") + "</AdaptationSet></Period></MPD>"
    docs = {"two": AUDIO.replace("</MPD>", second)}
    out = parsed(spark, docs)
    rows = [(r["period_no"], r["set_no"], r["rep_id"]) for r in m.renditions(out).collect()]
    assert sorted(rows) == [(0, 0, "0"), (1, 1, "7")]
    assert m.segments(out).count() == 24 and m.best_rendition(out).first()["rep_id"] == "0"
    assert not out.select(m.is_single_audio().alias("x")).first()["x"]
    again = m.parse_manifests(m.patch_manifests(out).select("manifest_id", F.col("patched_xml").alias("xml")))
    assert sorted((r["period_no"], r["set_no"], r["rep_id"]) for r in m.renditions(again).collect()) == sorted(rows)


def _unroll(timeline, start_number, end):
    """(number, start, duration) of each segment, entry by entry."""
    out, time, number = [], 0, start_number
    for i, (t, length, r) in enumerate(timeline):
        time = time if t is None else t
        after = timeline[i + 1][0] if i + 1 < len(timeline) else end
        if r is not None and r < 0:
            n = 1 if after is None or length == 0 else max(0, -((time - after) // length))
        else:
            n = (r or 0) + 1
        for _ in range(n):
            out.append((number, time, length))
            number, time = number + 1, time + length
    return out


PERIODS = {
    'start="PT0S" duration="PT30S"': 300, 'duration="PT1M0.55S"': 605, "": 900, 'start="PT10S"': 800, 'duration="soon"': 900,
}


@pytest.mark.parametrize("piece", [2, 1 << 16])
def test_timelines_are_unrolled(spark, piece):
    rng = random.Random(8)
    docs, want = {}, []
    for i, (period, length) in enumerate(PERIODS.items()):
        for j in range(6):
            offset, first = rng.choice([0, 40]), rng.choice([None, 0, 7])
            entries, at = [], 0
            for k in range(rng.randrange(1, 7)):
                restart = at + rng.choice([0, 25, 100]) if rng.random() < 0.6 else None
                entries.append((restart, rng.choice([1, 7, 20]), rng.choice([None, 0, 1, 4])))
                at = (restart if restart is not None else at) + entries[-1][1] * ((entries[-1][2] or 0) + 1)
            for k in range(len(entries)):  # open repeats stand before a restart or at the end
                if (k + 1 == len(entries) or entries[k + 1][0] is not None) and rng.random() < 0.5:
                    entries[k] = (*entries[k][:2], -1)
            parts = "".join(
                "<S " + (f't="{t}" ' if t is not None else "") + f'd="{d}"' + (f' r="{r}"' if r is not None else "") + "/>"
                for t, d, r in entries
            )
            number = f'startNumber="{first}"' if first is not None else ""
            name = f"{i}-{j}"
            docs[name] = (
                f'<MPD mediaPresentationDuration="PT90S"><Period {period}><AdaptationSet><Representation id="x{j}" bandwidth="70">'
                f'<SegmentTemplate timescale="10" presentationTimeOffset="{offset}" {number} initialization="$RepresentationID$.i" '
                f'media="$$$RepresentationID$/$Bandwidth%04d$/$Number%03d$_$Time$_$Other$"><SegmentTimeline>{parts}</SegmentTimeline>'
                "</SegmentTemplate></Representation></AdaptationSet></Period></MPD>"
            )
            for n, start, d in _unroll(entries, 1 if first is None else first, offset + length):
                url = f"$x{j}/0070/{n:03d}_{start}_$Other$"
                want.append((name, 0, 0, 0, f"x{j}", n, start, d, 10, f"x{j}.i", url, (start - offset) * 100_000))
    texts = spark.createDataFrame(list(docs.items()), "manifest_id STRING, xml STRING")
    out = m.parse_manifests(texts, schema=MANIFEST_TIMES)
    names = "manifest_id period_no set_no rep_no rep_id number start_units duration_units timescale init_url url start_us".split()
    assert sorted(map(tuple, m.segment_times(out, piece=piece).select(*names).collect())) == sorted(want)
    totals = {r["manifest_id"]: (r["n_segments"], r["duration_units"]) for r in
              m.renditions(m.parse_manifests(texts, schema=MANIFEST_TOTALS)).collect()}
    assert totals == {k: (sum(w[0] == k for w in want), sum(w[7] for w in want if w[0] == k)) for k in docs}


def test_next_period_bounds_an_open_repeat(spark):
    rep = ('<AdaptationSet><Representation id="r"><SegmentTemplate media="$Number$$"><SegmentTimeline><S d="4" r="-1"/>'
           "</SegmentTimeline></SegmentTemplate></Representation></AdaptationSet>")
    docs = {
        "next": f'<MPD><Period start="PT1M">{rep}</Period><Period start="PT1M30S"/></MPD>',
        "unknown": f"<MPD><Period>{rep}</Period></MPD>",
    }
    texts = spark.createDataFrame(list(docs.items()), "manifest_id STRING, xml STRING")
    out = m.segment_times(m.parse_manifests(texts, schema=MANIFEST_TIMES))
    found = sorted((r["manifest_id"], r["number"], r["start_us"], r["url"]) for r in out.collect())
    assert found == [("next", i + 1, i * 4_000_000, f"{i + 1}$") for i in range(8)] + [("unknown", 1, 0, "1$")]


def test_listed_segments_have_times(spark):
    out = m.segment_times(m.parse_manifests(spark.createDataFrame([("a", AUDIO)], "manifest_id STRING, xml STRING"), schema=MANIFEST_TIMES))
    rows = out.orderBy("number").select("number", "start_units", "duration_units", "start_us", "init_url", "url").collect()
    assert [tuple(r) for r in rows] == [(k + 1, 5 * k, 5, 500_000 * k, "init", f"m{k}") for k in range(12)]


def test_segment_times_sort_once(spark):
    """The windows share one sort of slim rows, and a manifest is parsed once."""
    xml = (
        '<MPD><Period start="PT0S"><AdaptationSet><Representation id="r" bandwidth="5">'
        '<SegmentTemplate media="" startNumber="3"><SegmentTimeline><S t="7" d="2" r="1"/><S d="3"/><S t="40" d="1"/>'
        '</SegmentTimeline></SegmentTemplate><SegmentList duration="4" presentationTimeOffset="9"><SegmentURL media="x"/>'
        '<SegmentURL media="y"/></SegmentList></Representation></AdaptationSet></Period></MPD>'
    )
    rows = spark.createDataFrame([(1, xml)], "manifest_id bigint, xml string")
    times = m.segment_times(m.parse_manifests(rows))
    plan = times._jdf.queryExecution().executedPlan().toString()
    assert len([line for line in plan.splitlines() if "Sort [" in line]) == 1
    assert plan.count("from_xml(") == 1
    got = sorted((r["number"], r["start_units"], r["duration_units"], r["url"]) for r in times.collect())
    assert got == [(1, 9, 4, "x"), (2, 13, 4, "y"), (3, 7, 2, ""), (4, 9, 2, ""), (5, 11, 3, ""), (6, 40, 1, "")]


def test_urls_filled_by_whole_texts_are_those_of_their_parts(spark):
    """Odd templates: pairs of dollar signs, widths of all kinds, several widths, nulls."""
    rng = random.Random(3)
    pieces = [
        "$", "$$", "$Number$", "$Time$", "$RepresentationID$", "$Bandwidth$", "$Number%05d$", "$Number%5d$", "$Time%012d$",
        "$Number%00d$", "$Number%03d$", "$Bandwidth%06d$", "$RepresentationID%07d$", "$Other$", "$Other%02d$", "%20", "/", "a",
        "$Number%d$", "$Number%99999999999d$", "$Time%x$", "N", "<", ">", "Number", "$number$", "é",
    ]
    rows = [("".join(rng.choices(pieces, k=rng.randrange(7))), r, b, n, t) for _ in range(600) for r, b, n, t in [rng.choice(
        [("v1", 70, 8, 123456), ("$Number$", None, 1, 0), (None, 5, None, 3), ("x%03d", 1, -4, None), ("a$b", 123456789, 100000, -12)]
    )]]
    rows += [(None, "v1", 70, 8, 1), ("$Number%00000000005d$", "v1", 70, 8, 1)]
    df = spark.createDataFrame(rows, "t STRING, r STRING, b BIGINT, n BIGINT, s BIGINT")
    fixed, values = {"RepresentationID": F.col("r"), "Bandwidth": F.col("b")}, {"Number": F.col("n"), "Time": F.col("s")}
    out = m._with_url(m._with_url(df, "init", F.col("t"), fixed), "media", F.col("t"), fixed, later=True)
    parts = m.template_parts(F.col("t"), fixed, ("Number", "Time"))
    got = out.select(
        "t", F.col("init"), m.fill_parts(m.template_parts(F.col("t"), fixed), {}).alias("want_init"),
        m._filled("media", values).alias("media"), m.fill_parts(parts, values).alias("want_media"), "media_Number",
    ).collect()
    assert [r for r in got if r["init"] != r["want_init"] or r["media"] != r["want_media"]] == []
    assert {r["media_Number"] for r in got} >= {None, -1, 0, 3, 5}


def test_durations_in_iso_form(spark):
    cases = {
        "P1DT2H3M4.5S": 93_784_500_000, "PT5M": 300_000_000, "PT0S": 0, "P2D": 172_800_000_000, "PT1H": 3_600_000_000,
        "PT3.S": 3_000_000, "P": None, "PT": None, "P1DT": None, "5M": None, "": None, "PT1M2H": None, "PDT5S": None,
        "DHMS": None, "PT5S\n": 5_000_000, "PT\n": None, "PT123456789012345S": 0, None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "v STRING")
    got = {r["v"]: r["x"] for r in df.select("v", iso_duration_micros(F.col("v")).alias("x")).collect()}
    assert got == cases


def test_short_entries_are_dealt_out(spark):
    """Entries with equal numbers of segments don't meet in one task."""
    xml = ('<MPD><Period><AdaptationSet><Representation id="r"><SegmentTemplate media="$Number$"><SegmentTimeline><S d="4"/>'
           '<S d="4"/></SegmentTimeline></SegmentTemplate></Representation></AdaptationSet></Period></MPD>')
    rows = spark.createDataFrame([(i, xml) for i in range(200)], "manifest_id bigint, xml string")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        times = m.segment_times(m.parse_manifests(rows, schema=MANIFEST_TIMES))
        sizes = [r["count"] for r in times.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sum(sizes) == 400 and max(sizes) < 200
