"""Time, size and duration expressions."""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.functions.constants import DURATION_UNITS, MEDIA_TIME_LAYOUT

_NUMBER = r"([0-9]+\.?[0-9]*|\.[0-9]+)"
_UNIT = "(" + "|".join(unit for unit, _ in DURATION_UNITS) + ")"
MICROS = 1_000_000


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a timestamp with or without zone (UTC session)."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us)


def duration_nanos(text: Column) -> Column:
    """Nanoseconds of texts such as ``7m31.25s``; NULL where the text is not a duration."""
    factor = F.create_map(*[F.lit(v) for unit, n in DURATION_UNITS for v in (unit, n)])
    number = F.regexp_extract_all(text, F.lit(_NUMBER + _UNIT), F.lit(1))
    unit = F.regexp_extract_all(text, F.lit(_NUMBER + _UNIT), F.lit(2))
    parts = F.zip_with(
        number, unit, lambda n, u: n.try_cast("decimal(28,9)") * factor[u].cast("decimal(14,0)")
    )
    total = F.aggregate(
        parts,
        F.lit(0).cast("decimal(38,6)"),
        lambda acc, x: (acc + x).cast("decimal(38,6)"),
    )
    # try_cast drops what does not fit 64 bits; using the total once keeps it computed once.
    sign = F.when(text.startswith("-"), -1).otherwise(1)
    return F.when(text.rlike(r"^[+-]?0$"), F.lit(0).cast("bigint")).when(
        text.rlike(f"^[+-]?({_NUMBER}{_UNIT})+$"), (F.floor(total) * sign).try_cast("bigint")
    )


def duration_micros(text: Column) -> Column:
    return F.floor(duration_nanos(text) / F.lit(1000).cast("decimal(4,0)")).cast("bigint")


def literal_micros(text: str) -> int:
    """Driver-side twin of :func:`duration_micros` for parameters."""
    if not re.fullmatch(f"({_NUMBER}{_UNIT})+", text):
        raise ValueError(f"not a duration: {text!r}")
    nanos = dict(DURATION_UNITS)
    total = sum(Decimal(n) * nanos[u] for n, u in re.findall(_NUMBER + _UNIT, text))
    return int(total) // 1000


def human_size(n_bytes: Column) -> Column:
    """``1.5 KB`` style text in powers of 1024; plain bytes up to and including 1024."""
    out = F.concat(n_bytes.cast("string"), F.lit(" B"))
    for power, unit in enumerate(("KB", "MB", "GB", "TB", "PB", "EB"), start=1):
        size = 1024**power
        scaled = F.bround(n_bytes.cast("double") / float(size), 1)
        text = F.concat(F.format_string("%.1f", scaled), F.lit(f" {unit}"))
        out = F.when(n_bytes > size, text).otherwise(out)
    return out


def media_time_micros(text: Column) -> Column:
    """Microseconds of ``HH:MM:SS.fff``; shorter texts are completed from the layout text."""
    width = len(MEDIA_TIME_LAYOUT)
    kept = F.substring(text, 1, width)
    full = F.concat(kept, F.substring(F.lit(MEDIA_TIME_LAYOUT), F.length(kept) + 1, F.lit(width)))
    shape = r"^([0-9]{2}):([0-5][0-9]):([0-5][0-9])\.([0-9]{3})$"

    def field(i: int) -> Column:
        return F.regexp_extract(full, shape, i).try_cast("bigint")

    whole = (field(1) * 3600 + field(2) * 60 + field(3)) * MICROS + field(4) * 1000
    return F.when(full.rlike(shape), whole)


def iso_duration_micros(text: Column) -> Column:
    """Microseconds of durations such as ``P1DT2H3M4.5S`` (days at most); NULL for other texts."""
    shape = r"^P(?:([0-9]+)D)?(?:T(?:([0-9]+)H)?(?:([0-9]+)M)?(?:([0-9]+(?:\.[0-9]*)?)S)?)?$"

    def field(i: int, unit: str, factor: int) -> Column:
        # Only where there is something to cast: an empty text raises an error inside, which takes longer than all else.
        number = F.when(text.contains(unit), F.regexp_extract(text, shape, i).try_cast("decimal(20,6)"))
        return F.coalesce(number, F.lit(0)) * factor

    seconds = field(1, "D", 86400) + field(2, "H", 3600) + field(3, "M", 60) + field(4, "S", 1)
    some = text.rlike(shape) & ~text.rlike("[PT]$")
    return F.when(some, (seconds * MICROS).try_cast("bigint"))
