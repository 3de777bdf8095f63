"""Manifest queries over manifests built from order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators import manifests as m
from tidegate.plans.fixtures import view
from tidegate.schemas import (
    MANIFEST,
    MANIFEST_RENDITIONS,
    MANIFEST_SEGMENTS,
    MANIFEST_TIMES,
    MANIFEST_TOTALS,
)


def _parsed(spark: SparkSession, sf_dir: str, schema: str = MANIFEST) -> DataFrame:
    return m.parse_manifests(view(spark, sf_dir, "v_manifests"), schema=schema)


def manifest_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = m.all_sets()
    return _parsed(spark, sf_dir).select(
        "manifest_id",
        F.col("mpd._xmlns").alias("xmlns"),
        F.col("mpd._type").alias("type"),
        F.col("mpd._profiles").alias("profiles"),
        F.array_join("mpd.Period._id", ",").alias("period_ids"),
        F.array_join("mpd.Period._start", ",").alias("period_starts"),
        F.size(sets).cast("bigint").alias("n_sets"),
        F.aggregate(sets, F.lit(0), lambda n, s: n + F.greatest(F.size(s["Representation"]), F.lit(0)))
        .cast("bigint")
        .alias("n_renditions"),
    )


def manifest_renditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.renditions(_parsed(spark, sf_dir, MANIFEST_TOTALS))


def manifest_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.segments(_parsed(spark, sf_dir, MANIFEST_SEGMENTS))


def single_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = _parsed(spark, sf_dir, MANIFEST_RENDITIONS)
    return heads.select("manifest_id", m.is_single_audio().alias("single_audio"))


def manifest_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renditions of the patched manifests after writing and parsing them again."""
    patched = m.patch_manifests(_parsed(spark, sf_dir)).select("manifest_id", "patched_xml")
    again = m.parse_manifests(patched, "patched_xml", MANIFEST_TOTALS)
    return m.renditions(again).select(
        "manifest_id", "period_no", "rep_no", "rep_id", "mime_type", "bandwidth", "n_segments", "duration_units"
    )


def best_rendition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.best_rendition(_parsed(spark, sf_dir, MANIFEST_RENDITIONS))


def _templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.parse_manifests(view(spark, sf_dir, "v_template_manifests"))


def manifest_timelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = m.timeline_segments(_templates(spark, sf_dir))
    return entries.withColumns(
        {"entry_no": F.col("entry_no").cast("bigint"), "t": F.coalesce("t", F.lit(-1).cast("bigint"))}
    )


def manifest_template_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments and length of template renditions; the MIME type comes from their set."""
    return m.renditions(_templates(spark, sf_dir)).select(
        "manifest_id", "rep_id", "mime_type", "n_segments", "duration_units"
    )


def _timed(spark: SparkSession, sf_dir: str, schema: str) -> DataFrame:
    return m.parse_manifests(view(spark, sf_dir, "v_timed_manifests"), schema=schema)


def manifest_segment_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number, start and URLs of every segment of timelines with restarts and open repeats."""
    times = m.segment_times(_timed(spark, sf_dir, MANIFEST_TIMES))
    return times.select("manifest_id", "number", "start_units", "duration_units", "start_us", "init_url", "url")


def manifest_open_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments and length of the same timelines, folded in place."""
    return m.renditions(_timed(spark, sf_dir, MANIFEST_TOTALS)).select(
        "manifest_id", "rep_id", "n_segments", "duration_units"
    )


def manifest_protections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.protections(_templates(spark, sf_dir))


def manifest_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The integer-or-boolean attribute of each set, taken apart."""
    sets = _templates(spark, sf_dir).select("manifest_id", F.explode(m.all_sets()).alias("s"))
    parts = m.union_uint(F.col("s._segmentAlignment"))
    return sets.select("manifest_id", parts.alias("a")).select(
        "manifest_id",
        F.col("a.u").cast("string").alias("as_integer"),
        F.col("a.b").cast("string").alias("as_boolean"),
        "a.invalid",
    )


def manifest_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests that cannot be read: every fifth one is cut short here."""
    texts = view(spark, sf_dir, "v_manifests")
    cut = F.when(F.col("manifest_id") % 5 == 0, F.substring("xml", 1, 60)).otherwise(F.col("xml"))
    parsed = m.parse_manifests(texts.withColumn("xml", cut), schema=MANIFEST_RENDITIONS)
    return m.rejected_manifests(parsed).select("manifest_id")


QUERIES = {
    "manifest_rejections": manifest_rejections,
    "manifest_parse": manifest_parse,
    "manifest_renditions": manifest_renditions,
    "manifest_segments": manifest_segments,
    "single_audio": single_audio,
    "manifest_patch": manifest_patch,
    "best_rendition": best_rendition,
    "manifest_timelines": manifest_timelines,
    "manifest_template_totals": manifest_template_totals,
    "manifest_segment_times": manifest_segment_times,
    "manifest_open_totals": manifest_open_totals,
    "manifest_protections": manifest_protections,
    "manifest_alignment": manifest_alignment,
}

_REPS = """
WITH reps AS (
  SELECT l_orderkey AS manifest_id, CAST(l_linenumber AS VARCHAR) AS rep_id,
         CASE WHEN l_returnflag = 'A' THEN 'audio/mp4' ELSE 'video/mp4' END AS mime_type,
         CAST(floor(l_quantity) AS BIGINT) * 1000 AS bandwidth, l_partkey, l_suppkey,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS BIGINT) AS rep_no,
         count(*) OVER (PARTITION BY l_orderkey) AS n
  FROM lineitem)
"""

_ENTRIES = """
WITH entries AS (
  SELECT l_orderkey AS manifest_id,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS BIGINT) AS entry_no,
         CASE WHEN l_returnflag = 'A' THEN l_partkey END AS t,
         CAST(floor(l_quantity) AS BIGINT) AS d,
         CAST(CASE WHEN l_linestatus = 'O' THEN l_linenumber + 1 ELSE 1 END AS BIGINT) AS repeats
  FROM lineitem)
"""

_TIMED = """
WITH entries AS (
  SELECT l_orderkey AS m, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k,
         CASE WHEN l_returnflag = 'A' THEN l_linenumber * 400 END AS t, CAST(floor(l_quantity) AS BIGINT) * 20 AS d,
         CASE l_linestatus WHEN 'O' THEN -1 ELSE l_linenumber % 3 END AS r,
         l_orderkey % 2 * 30 + CASE WHEN l_orderkey % 4 = 0 THEN 2905 ELSE 3000 END AS until
  FROM lineitem),
runs AS (
  SELECT *, count(t) OVER (PARTITION BY m ORDER BY k) AS run,
         CASE WHEN lead(k) OVER w IS NULL THEN until ELSE lead(t) OVER w END AS after
  FROM entries WINDOW w AS (PARTITION BY m ORDER BY k)),
starts AS (
  SELECT *, coalesce(max(t) OVER (PARTITION BY m, run), 0)
         + coalesce(sum(d * CASE WHEN r < 0 THEN 1 ELSE r + 1 END) OVER (PARTITION BY m, run ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
  FROM runs),
counted AS (
  SELECT *, CASE WHEN r >= 0 THEN r + 1 WHEN after IS NULL THEN 1 ELSE greatest(ceil((after - s) / d), 0) END AS n FROM starts),
placed AS (
  SELECT *, m % 3 + coalesce(sum(n) OVER (PARTITION BY m ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM counted),
each AS (SELECT *, unnest(range(0, CAST(n AS BIGINT))) AS i FROM placed)
"""

ORACLES = {
    "manifest_segment_times": _TIMED
    + """SELECT m AS manifest_id, CAST(first + i AS BIGINT) AS number, CAST(s + i * d AS BIGINT) AS start_units, d AS duration_units,
       CAST((s + i * d - m % 2 * 30) * 100000 AS BIGINT) AS start_us, 'r' || (m % 9) || '/init' AS init_url,
       'r' || (m % 9) || '/' || printf('%06d', m % 5 * 1000) || '/' || printf('%04d', CAST(first + i AS BIGINT)) || '-'
         || CAST(s + i * d AS BIGINT) || '.m4s' AS url
FROM each""",
    "manifest_open_totals": _TIMED
    + """SELECT m AS manifest_id, 'r' || (m % 9) AS rep_id, CAST(sum(n) AS BIGINT) AS n_segments, CAST(sum(n * d) AS BIGINT) AS duration_units
FROM placed GROUP BY m""",
    "manifest_rejections": "SELECT DISTINCT l_orderkey AS manifest_id FROM lineitem WHERE l_orderkey % 5 = 0",
    "manifest_parse": """
SELECT l_orderkey AS manifest_id, 'urn:mpeg:dash:schema:mpd:2011' AS xmlns, 'static' AS type, 'p' AS profiles,
       CASE WHEN l_orderkey % 3 = 0 THEN '0,1' ELSE '0' END AS period_ids,
       CASE WHEN l_orderkey % 3 = 0 THEN 'PT0S,PT9S' ELSE 'PT0S' END AS period_starts,
       CAST(CASE WHEN l_orderkey % 3 = 0 THEN 3 ELSE 1 END AS BIGINT) AS n_sets,
       CAST(count(*) + CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_renditions
FROM lineitem GROUP BY l_orderkey""",
    "manifest_renditions": _REPS
    + """SELECT manifest_id, CAST(0 AS BIGINT) AS period_no, CAST(0 AS BIGINT) AS set_no, rep_no, rep_id, mime_type,
       bandwidth, CAST(2 AS BIGINT) AS n_segments, CAST(4 AS BIGINT) AS duration_units FROM reps
UNION ALL SELECT DISTINCT manifest_id, 1, 1, 0, 'late', 'text/vtt', 1, 1, 5 FROM reps WHERE manifest_id % 3 = 0""",
    "manifest_segments": _REPS
    + """SELECT manifest_id, rep_id, 'i' || l_partkey AS init_url, CAST(k AS BIGINT) AS segment_no,
       CASE k WHEN 0 THEN 'm' || l_partkey ELSE 'n' || l_suppkey END AS media
FROM reps, (VALUES (0), (1)) s(k)
UNION ALL SELECT DISTINCT manifest_id, 'late', 'j', 0, 'k' FROM reps WHERE manifest_id % 3 = 0""",
    "single_audio": _REPS
    + """SELECT manifest_id, bool_and(n = 1 AND mime_type = 'audio/mp4' AND manifest_id % 3 <> 0) AS single_audio
FROM reps GROUP BY manifest_id""",
    "manifest_patch": _REPS
    + """SELECT manifest_id, CAST(0 AS BIGINT) AS period_no, rep_no, rep_id, mime_type, bandwidth,
       CAST(2 AS BIGINT) AS n_segments, CAST(4 AS BIGINT) AS duration_units FROM reps
UNION ALL
SELECT manifest_id, 0, 1, '1', mime_type, 0, 2, 4 FROM reps WHERE n = 1 AND mime_type = 'audio/mp4' AND manifest_id % 3 <> 0
UNION ALL
SELECT DISTINCT manifest_id, 1, 0, 'late', 'text/vtt', 1, 1, 5 FROM reps WHERE manifest_id % 3 = 0""",
    "manifest_timelines": _ENTRIES
    + "SELECT manifest_id, 'r' AS rep_id, CAST(1000 AS BIGINT) AS timescale, entry_no, coalesce(t, -1) AS t, d, repeats FROM entries",
    "manifest_template_totals": _ENTRIES
    + """SELECT manifest_id, 'r' AS rep_id, 'video/mp4' AS mime_type, CAST(sum(repeats) AS BIGINT) AS n_segments,
       CAST(sum(d * repeats) AS BIGINT) AS duration_units FROM entries GROUP BY manifest_id""",
    "manifest_protections": """
SELECT DISTINCT l_orderkey AS manifest_id, NULL::VARCHAR AS rep_id, 'urn:set' || (l_orderkey % 7) AS scheme_id_uri, 'cenc' AS value
FROM lineitem
UNION ALL
SELECT DISTINCT l_orderkey, 'r', 'urn:rep', NULL FROM lineitem""",
    "manifest_alignment": """
SELECT DISTINCT l_orderkey AS manifest_id, CASE WHEN l_orderkey % 2 = 1 THEN '1' END AS as_integer,
       CASE WHEN l_orderkey % 2 = 0 THEN 'true' END AS as_boolean, false AS invalid
FROM lineitem""",
    "best_rendition": _REPS
    + """SELECT manifest_id, rep_id, bandwidth FROM (
  SELECT *, row_number() OVER (PARTITION BY manifest_id ORDER BY bandwidth DESC, rep_id) AS rn FROM reps) WHERE rn = 1""",
}
