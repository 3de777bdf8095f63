"""Slice, URL and routing queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.constants import MJPEG_SUFFIXES, TEXT_MIME_TYPES, TEXT_SUFFIXES
from tidegate.functions.urls import has_suffix
from tidegate.operators import routing as r
from tidegate.operators import slicing as s
from tidegate.operators.signatures import default_signatures, identify
from tidegate.plans.fixtures import table, view, with_views

BIN = "6h"
AUTH_WORD = "example.net"
# The set of this query; the operator takes any.
IMAGE_SUFFIXES = (".jpg", ".webp", ".svg")


def capture_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_bytes").select("stream_id", "seq", "ts", "n_bytes")
    slices = s.capture_slice(rows, view(spark, sf_dir, "v_windows"), BIN)
    return slices.select("window_id", "stream_id", "seq", "n_bytes")


def slice_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.window_totals(view(spark, sf_dir, "v_bytes"), view(spark, sf_dir, "v_windows"), BIN)


def suffix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return view(spark, sf_dir, "v_probes").select(
        "page_id",
        "attempt",
        "url",
        has_suffix(url, IMAGE_SUFFIXES).alias("is_image_url"),
        has_suffix(url, TEXT_SUFFIXES).alias("is_text_url"),
        has_suffix(url, MJPEG_SUFFIXES).alias("is_mjpeg_url"),
    )


def mime_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.classify_mime(view(spark, sf_dir, "v_probes"), "page_id")


#: Bytes put before every page, by its number: none, white space, or what another format starts with.
PREFIXES = (
    "", "0D0A2009", "89504E470D0A1A0A", "52494646AABBCCDD5745425056503820", "0000001866747970", "464F524DAABBCCDD41494646",
    "1F8B08", "526172211A0700", "EFBBBF", "252150532D41646F62652D", "52494646", "FFD8FF", "424D",
)


def content_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content types of pages by their leading bytes, some of them made to look like other formats."""
    pages = table(spark, sf_dir, "pages")
    prefix = F.element_at(F.array(*map(F.lit, PREFIXES)), (F.col("page_id") % len(PREFIXES) + 1).cast("int"))
    heads = pages.select(
        "page_id", F.concat(prefix, F.hex(F.substring(F.coalesce("html", F.lit("")).cast("binary"), 1, 64))).alias("head")
    )
    return identify(heads, "head", ["page_id"], default_signatures(spark), "mime").select(
        "page_id", F.coalesce("mime", F.lit("")).alias("mime")
    )


def plugin_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains a plug-in can handle: those of the pages in English."""
    host = F.regexp_extract("url", r"^https?://([^:/?#]*)", 1)
    english = table(spark, sf_dir, "pages").where(F.contains("html", F.lit('<html lang="en">')))
    return english.select(F.substring_index(host, ".", -2).alias("domain")).distinct()


def reader_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = mime_classes(spark, sf_dir).withColumn("is_live", F.col("mime") == "")
    routes = r.assign_routes(urls, plugin_domains(spark, sf_dir), AUTH_WORD, auth_path="/en/")
    return routes.select(
        "page_id", "url", "mime", "route", "needs_auth", "patch_manifest", "failure_reason"
    )


QUERIES = {
    "capture_slice": capture_slice,
    "slice_totals": slice_totals,
    "suffix_filter": suffix_filter,
    "mime_classes": mime_classes,
    "content_types": content_types,
    "reader_routes": reader_routes,
}

SLICE_CTES = """
cut AS (
  SELECT stream_id, window_id, epoch_us(start_ts) AS s,
         CASE WHEN reader IN ('rtsp', 'mjpeg') THEN CAST(ceil(duration_us / 1000000.0) AS BIGINT) * 1000000
              WHEN duration_us > 0 THEN CAST(round_even(duration_us / 1000.0, 0) AS BIGINT) * 1000 END AS len
  FROM v_windows),
slices AS (
  SELECT window_id, b.stream_id, seq, n_bytes
  FROM v_bytes b JOIN cut c ON c.stream_id = b.stream_id AND epoch_us(b.ts) >= c.s
   AND (c.len IS NULL OR epoch_us(b.ts) < c.s + c.len))"""

_PATH = r"regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"


def _ends(path: str, suffixes: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"suffix({path}, '{s}')" for s in suffixes) + ")"


_MIME = f"""
answers AS (
  SELECT page_id, url, min(attempt) FILTER (WHERE error_kind IS NOT NULL OR status_code BETWEEN 200 AND 299) AS a
  FROM v_probes GROUP BY ALL),
picked AS (
  SELECT x.page_id, x.url, a IS NULL AS probe_failed,
         CASE WHEN p.error_kind IS NOT NULL OR a IS NULL THEN ''
              WHEN p.content_type <> '' THEN p.content_type
              WHEN p.sniff_hex LIKE '89504E470D0A1A0A%' THEN 'image/png'
              WHEN p.sniff_hex LIKE '255044462D%' THEN 'application/pdf' ELSE '' END AS mime,
         {_PATH.replace("url", "x.url")} AS path
  FROM answers x LEFT JOIN v_probes p ON p.page_id = x.page_id AND p.attempt = x.a),
classes AS (
  SELECT page_id, url, mime, path, starts_with(mime, 'image/') AS is_image,
         mime IN ({", ".join(f"'{m}'" for m in TEXT_MIME_TYPES)}) OR {_ends("path", TEXT_SUFFIXES)} AS is_text,
         probe_failed
  FROM picked)"""

ORACLES = {
    "content_types": """
SELECT page_id, CASE page_id % 13
    WHEN 2 THEN 'image/png' WHEN 3 THEN 'image/webp' WHEN 4 THEN 'video/mp4' WHEN 5 THEN 'audio/aiff'
    WHEN 6 THEN 'application/x-gzip' WHEN 7 THEN 'application/x-rar-compressed' WHEN 8 THEN 'text/plain'
    WHEN 9 THEN 'application/postscript' WHEN 11 THEN 'image/jpeg' WHEN 12 THEN 'image/bmp' WHEN 10 THEN ''
    ELSE CASE WHEN regexp_matches(html, '^[\t\n\f\r ]*(<(!DOCTYPE HTML|HTML|HEAD|SCRIPT|IFRAME|H1|DIV|FONT|TABLE|A|STYLE|TITLE|B|BODY|BR|P)[ >]|<!--)', 'i')
              THEN 'text/html' ELSE '' END END AS mime
FROM pages""",
    "capture_slice": with_views(
        ["v_bytes", "v_windows"], "SELECT window_id, stream_id, seq, n_bytes FROM slices", SLICE_CTES
    ),
    "slice_totals": with_views(
        ["v_bytes", "v_windows"],
        "SELECT window_id, stream_id, CAST(count(*) AS BIGINT) AS n_rows, "
        "CAST(sum(n_bytes) AS BIGINT) AS n_bytes FROM slices GROUP BY ALL",
        SLICE_CTES,
    ),
    "suffix_filter": with_views(
        ["v_probes"],
        f"SELECT page_id, attempt, url, {_ends(_PATH, IMAGE_SUFFIXES)} AS is_image_url, "
        f"{_ends(_PATH, TEXT_SUFFIXES)} AS is_text_url, {_ends(_PATH, MJPEG_SUFFIXES)} AS is_mjpeg_url "
        "FROM v_probes",
    ),
    "mime_classes": with_views(
        ["v_probes"],
        "SELECT page_id, url, mime, is_image, is_text, probe_failed FROM classes",
        _MIME,
    ),
    "reader_routes": with_views(
        ["v_probes"],
        f"""
SELECT page_id, url, mime,
       CASE WHEN failed THEN NULL WHEN is_rtsp THEN 'rtsp'
            WHEN is_http AND (is_image OR is_text) THEN 'http'
            WHEN is_http AND is_mjpeg THEN 'mjpeg'
            WHEN domain IN (SELECT domain FROM plugins) THEN 'plugin'
            WHEN mime = '' THEN 'capture' ELSE 'http' END AS route,
       is_http AND contains(url, '{AUTH_WORD}') AND contains(url, '/en/') AS needs_auth,
       is_http AND NOT failed AND NOT (is_image OR is_text) AND NOT is_mjpeg
         AND starts_with(mime, 'application/dash+xml') AS patch_manifest,
       CASE WHEN failed THEN 'invalid_data' END AS failure_reason
FROM (SELECT *, is_http AND probe_failed AS failed FROM (
  SELECT *, regexp_matches(url, '(?i)^rtsp:/') AS is_rtsp, regexp_matches(url, '(?i)^https?:/') AS is_http,
         starts_with(mime, 'multipart/x-mixed-replace') OR {_ends("path", MJPEG_SUFFIXES)} AS is_mjpeg,
         regexp_extract(lower(split_part(split_part(split_part(url, '://', 2), '/', 1), ':', 1)), '([^.]*[.][^.]*)$', 1) AS domain
  FROM classes))""",
        _MIME,
        r"""
plugins AS (
  SELECT DISTINCT regexp_extract(split_part(split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), ':', 1), '?', 1), '#', 1),
                                 '([^.]*[.][^.]*)$', 1) AS domain
  FROM pages WHERE contains(html, '<html lang="en">'))""",
    ),
}
