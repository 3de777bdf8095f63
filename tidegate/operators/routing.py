"""MIME classification, reader routes and rendition choice."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.constants import (
    DASH_MIME,
    MAX_ATTEMPTS,
    MJPEG_MIME,
    MJPEG_SUFFIXES,
    TEXT_MIME_TYPES,
    TEXT_SUFFIXES,
)
from tidegate.functions.urls import HTTP_REGEX, RTSP_REGEX, has_suffix, url_host
from tidegate.operators.signatures import default_signatures, identify


def classify_mime(
    probes: DataFrame,
    key: str,
    text_types: Iterable[str] = TEXT_MIME_TYPES,
    text_suffixes: Iterable[str] = TEXT_SUFFIXES,
    max_attempts: int = MAX_ATTEMPTS,
    signatures: DataFrame | None = None,
) -> DataFrame:
    """One row per probed URL: mime, is_image, is_text and probe_failed.

    The first attempt that answers decides. A transport failure answers with a blank type; an answer without
    a type has that of its leading bytes in ``signatures`` (by default the public sniffing table).
    Picking the first answer is a partially aggregated ``min`` over a struct led by the attempt.
    """
    transport = F.col("error_kind").isNotNull()
    answered = transport | F.col("status_code").between(200, 299)
    stated = F.when(transport, F.lit("")).otherwise(F.nullif(F.col("content_type"), F.lit("")))
    answer = F.struct("attempt", stated.alias("mime"), F.col("sniff_hex").alias("hex"))
    first = F.min(F.when(answered, answer))
    chosen = (
        probes.where(F.col("attempt") <= max_attempts)
        .groupBy(key, "url")
        .agg(first.alias("answer"))
    )
    bytes_known = chosen.withColumn("_hex", F.when(F.col("answer.mime").isNull(), F.col("answer.hex")))
    if signatures is None:
        signatures = default_signatures(probes.sparkSession)
    typed = identify(bytes_known, "_hex", [key, "url"], signatures, "_sniffed")
    found = F.coalesce("answer.mime", "_sniffed", F.lit(""))
    return typed.select(
        key,
        "url",
        found.alias("mime"),
        found.startswith("image/").alias("is_image"),
        (found.isin(*text_types) | has_suffix(F.col("url"), text_suffixes)).alias("is_text"),
        F.col("answer").isNull().alias("probe_failed"),
    )


def assign_routes(
    urls: DataFrame,
    plugin_domains: DataFrame,
    auth_word: str,
    auth_path: str = "/media-streamer/stream",
) -> DataFrame:
    """Add ``route``, ``needs_auth``, ``patch_manifest`` and ``failure_reason``.

    ``urls`` has url, is_live and the columns of :func:`classify_mime`; ``plugin_domains`` has
    one ``domain`` per row (the last two labels of a host) that a plug-in reader can handle.
    """
    url = F.col("url")
    known = plugin_domains.select(
        F.lower("domain").alias("_domain"), F.lit(True).alias("_plugin")
    ).distinct()
    domain = F.substring_index(url_host(url), ".", -2)
    joined = urls.withColumn("_domain", domain).join(known, "_domain", "left")

    rtsp = url.rlike(RTSP_REGEX)
    http = url.rlike(HTTP_REGEX) & ~rtsp
    failed = http & F.col("probe_failed")
    mjpeg = F.col("mime").startswith(MJPEG_MIME) | has_suffix(url, MJPEG_SUFFIXES)
    plugin = F.coalesce("_plugin", F.lit(False))
    document = F.col("is_image") | F.col("is_text")
    falls_through = ~rtsp & ~(http & (document | mjpeg))
    route = (
        F.when(failed, F.lit(None).cast("string"))
        .when(rtsp, F.lit("rtsp"))
        .when(http & document, F.lit("http"))
        .when(http & mjpeg, F.lit("mjpeg"))
        .when(plugin, F.lit("plugin"))
        .when(F.col("is_live"), F.lit("capture"))
        .otherwise(F.lit("http"))
    )
    return joined.withColumns(
        {
            "route": route,
            "needs_auth": http & F.contains(url, F.lit(auth_word)) & F.contains(url, F.lit(auth_path)),
            "patch_manifest": http & ~failed & falls_through & F.col("mime").startswith(DASH_MIME),
            "failure_reason": F.when(failed, F.lit("invalid_data")),
        }
    ).drop("_domain", "_plugin")
