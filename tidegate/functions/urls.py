"""URL predicates. The path is taken with one regex, so any SQL engine can agree with it."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

PATH_REGEX = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"
HOST_REGEX = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^@/?#]*@)?([^:/?#]*)"
RTSP_REGEX = r"(?i)^rtsp:/"
HTTP_REGEX = r"(?i)^https?:/"


def url_path(url: Column) -> Column:
    """Decoded path without query and fragment; NULL where an escape is malformed."""
    path = F.regexp_extract(url, PATH_REGEX, 1)
    decoded = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(path, F.lit("%")), decoded).otherwise(path)


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST_REGEX, 1))


def has_suffix(url: Column, suffixes: Iterable[str]) -> Column:
    """Case-sensitive suffix test on the path; unusable URLs are false."""
    path = url_path(url)
    hit = reduce(lambda a, b: a | b, [path.endswith(s) for s in suffixes])
    return F.coalesce(hit, F.lit(False))
