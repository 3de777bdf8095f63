"""Task planning: validation, overrides, source resolution, windows and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.values import (
    blank_to_null,
    duration_nanos,
    duration_nanos,
    from_micros,
    micros,
)
from tidegate.schemas import CORRUPT

# Texts of the validation contract, fixed values.
MISSING_SOURCE_ID = "missing sourceID"
MISSING_SCHEDULED_JOB = "missing scheduledJobId"
MISSING_SOURCE_DETAILS = "missing sourceDetails"
MISSING_TDO_ID = "missing tdoId"
MISSING_SOURCE_OR_URL = "either sourceId or URL is required"
MISSING_JOB_ID = "missing jobId"
MISSING_TASK_ID = "missing taskId"
DURATION_AND_WINDOW = (
    'only one of "recordDuration" or "recordStartTime"/"recordEndTime" should be provided'
)
INVALID_DURATION = "invalid record duration given"
END_REQUIRED = '"recordEndTime" is required when "recordStartTime" is set'
MISSING_END_TIME = "recording window must have an end time"
MISSED_WINDOW = "we've overshot our recording window completely"

_TEXT_FIELDS = ("job_id", "task_id", "tdo_id", "url", "source_id", "record_duration", "cache_key",
                "scheduled_job_id", "token")


def normalise(tasks: DataFrame) -> DataFrame:
    """Absent values become NULL (text) or false (flags)."""
    changes = {c: blank_to_null(F.col(c)) for c in _TEXT_FIELDS if c in tasks.columns}
    for flag in ("disable_kafka", "disable_s3"):
        if flag in tasks.columns:
            changes[flag] = F.coalesce(flag, F.lit(False))
    return tasks.withColumns(changes)


def is_offline() -> Column:
    return F.col("cache_key").isNotNull()


def is_time_based() -> Column:
    fields = ("record_start", "record_end", "record_duration")
    return F.coalesce(*[F.col(c).cast("string") for c in fields]).isNotNull()


def validate(tasks: DataFrame) -> DataFrame:
    """Add ``error``: the first broken rule, or NULL for an acceptable task."""

    def missing(name: str) -> Column:
        return F.col(name).isNull()

    offline = is_offline()
    has_duration = F.col("record_duration").isNotNull()
    has_window = F.col("record_start").isNotNull() | F.col("record_end").isNotNull()
    bad_duration = F.concat(F.lit(INVALID_DURATION + ' "'), "record_duration", F.lit('"'))
    rules = [
        (offline & missing("source_id"), F.lit(MISSING_SOURCE_ID)),
        (offline & missing("scheduled_job_id"), F.lit(MISSING_SCHEDULED_JOB)),
        (offline & missing("source_details"), F.lit(MISSING_SOURCE_DETAILS)),
        (~offline & missing("tdo_id"), F.lit(MISSING_TDO_ID)),
        (~offline & missing("source_id") & missing("url"), F.lit(MISSING_SOURCE_OR_URL)),
        (missing("job_id"), F.lit(MISSING_JOB_ID)),
        (missing("task_id"), F.lit(MISSING_TASK_ID)),
        (has_duration & has_window, F.lit(DURATION_AND_WINDOW)),
        (has_duration & duration_nanos(F.col("record_duration")).isNull(), bad_duration),
        (F.col("record_start").isNotNull() & missing("record_end"), F.lit(END_REQUIRED)),
    ]
    return tasks.withColumn("error", F.coalesce(*[F.when(rule, text) for rule, text in rules]))


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("error").isNull()).drop("error")


def rejected(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("error").isNotNull())


def rejection_counts(validated: DataFrame) -> DataFrame:
    return rejected(validated).groupBy("error").agg(F.count(F.lit(1)).alias("n_tasks"))


def _spread(wanted: Column, *salt: str) -> Column:
    """Join key that scatters rows without a wanted key instead of piling them up as NULL.

    The filler starts with a NUL character, which no identifier contains, so it matches nothing.
    """
    filler = F.concat(F.lit("\0"), F.xxhash64(*salt).cast("string"))
    return F.coalesce(wanted, filler)


def merge_overrides(
    tasks: DataFrame, overrides: DataFrame, defaults: dict[str, object] | None = None
) -> DataFrame:
    """Fields of ``overrides`` win over the task, defaults fill blanks.

    A ``task_id`` that repeats counts once: of each field, the least value that is not blank.
    """
    fields = [c for c in overrides.columns if c != "task_id"]
    defaults = defaults or {}
    keyed = overrides.select(
        F.col("task_id").alias("_key"),
        *[
            (blank_to_null(F.col(c)) if overrides.schema[c].dataType.simpleString() == "string"
             else F.col(c)).alias(f"_over_{c}")
            for c in fields
        ],
    )
    # One row per task, whatever the table holds: a repeated id must not multiply tasks.
    keyed = keyed.groupBy("_key").agg(*[F.min(f"_over_{c}").alias(f"_over_{c}") for c in fields])
    salted = tasks.withColumn("_key", _spread(F.col("task_id"), "job_id", "tdo_id"))
    merged = salted.join(keyed, "_key", "left")
    changes = {}
    for c in set(fields) | set(defaults):
        choices = ([F.col(f"_over_{c}")] if c in fields else []) + [F.col(c)]
        if c in defaults:
            choices.append(F.lit(defaults[c]))
        changes[c] = F.coalesce(*choices)
    return merged.withColumns(changes).select(*tasks.columns)


def resolve_sources(tasks: DataFrame, sources: DataFrame) -> DataFrame:
    """Add ``stream_url``, ``is_live`` and ``failure_reason``.

    Precedence: the task's URL, its inline details, the catalogue. Only tasks that need the
    catalogue carry its key into the join; whether the catalogue is broadcast is left to its
    size, and a hot source in a shuffled join is split by adaptive execution. A source that the
    catalogue lists several times counts once: its first row with a URL, in order of its columns.
    """
    catalogue = sources.select(
        F.col("source_id").alias("_key"),
        F.col("is_live").alias("_live"),
        blank_to_null(F.col("details.url")).alias("_url"),
        blank_to_null(F.col("details.radio_stream_url")).alias("_radio"),
    )
    # One row per source: a repeated id must not multiply tasks.
    empty = (F.col("_url").isNull() & F.col("_radio").isNull()).alias("empty")
    first = F.min(F.struct(empty, F.col("_url").isNull(), "_url", "_radio", "_live")).alias("first")
    catalogue = catalogue.groupBy("_key").agg(first).select(
        "_key", "first._live", "first._url", "first._radio", F.lit(True).alias("_found")
    )
    needs_details = F.col("url").isNull()
    inline = needs_details & F.col("source_details").isNotNull()
    lookup = needs_details & F.col("source_details").isNull()
    keyed = tasks.withColumn(
        "_key", _spread(F.when(lookup, F.col("source_id")), "job_id", "task_id", "tdo_id")
    )
    joined = keyed.join(catalogue, "_key", "left")
    details_url = F.when(
        inline,
        F.coalesce(
            blank_to_null(F.col("source_details.url")),
            blank_to_null(F.col("source_details.radio_stream_url")),
        ),
    ).otherwise(F.coalesce("_url", "_radio"))
    stream_url = F.coalesce("url", details_url)
    live = F.when(inline, F.lit(True)).when(lookup, F.coalesce("_live", F.lit(False)))
    reason = F.when(lookup & F.col("_found").isNull(), F.lit("url_not_found")).when(
        stream_url.isNull(), F.lit("api_not_found")
    )
    return joined.withColumns(
        {
            "failure_reason": reason,
            "is_live": F.coalesce(live, F.lit(False)) | is_time_based(),
            "stream_url": stream_url,
        }
    ).drop("_key", "_live", "_url", "_radio", "_found")


def plan_windows(tasks: DataFrame, now: Column) -> DataFrame:
    """Add the recording window of each task as of ``now``; needs ``is_live``."""
    now_us = micros(now)
    start_us = F.greatest(F.coalesce(micros(F.col("record_start")), now_us), now_us)
    # Rounded up, so that a window of less than a microsecond is a short one and not a missed one.
    nanos = duration_nanos(F.col("record_duration"))
    given = F.ceil(nanos / F.lit(1000).cast("decimal(4,0)")).cast("bigint")
    duration = (
        F.when(F.col("record_duration").isNotNull(), F.coalesce(given, F.lit(0)))
        .when(F.col("record_end").isNotNull(), micros(F.col("record_end")) - F.col("_start_us"))
        .otherwise(F.lit(0))
    )
    open_ended = F.col("record_duration").isNull() & F.col("record_end").isNull()
    error = F.when(F.col("is_live") & open_ended, F.lit(MISSING_END_TIME)).when(
        F.col("is_live") & (F.col("duration_us") <= 0), F.lit(MISSED_WINDOW)
    )
    return (
        tasks.withColumn("_start_us", start_us)
        .withColumn("duration_us", duration.cast("bigint"))
        .withColumns(
            {
                "window_start": from_micros(F.col("_start_us")),
                "wait_us": F.col("_start_us") - now_us,
                "window_error": error,
            }
        )
        .withColumn(
            "window_reason", F.when(F.col("window_error").isNotNull(), F.lit("invalid_data"))
        )
        .drop("_start_us")
    )


def rebase_media_time(tasks: DataFrame, offset_ms: str, start_time: str) -> DataFrame:
    """Positive task values replace the stream's own start offset and start time."""
    override = F.timestamp_seconds("start_time_override")
    return tasks.withColumns(
        {
            offset_ms: F.when(F.col("tdo_offset_ms") > 0, F.col("tdo_offset_ms")).otherwise(
                F.col(offset_ms)
            ),
            start_time: F.when(F.col("start_time_override") > 0, override).otherwise(
                F.col(start_time).cast("timestamp")
            ),
        }
    )


def assign_sink(
    tasks: DataFrame, topic: str = "", bucket: str = "", stdout: bool = False
) -> DataFrame:
    """Add ``sink``: console, object_cache, message_log or file_store."""
    if not (stdout or topic or bucket):
        raise ValueError("an output topic or bucket name is required")
    sink = (
        F.when(F.lit(stdout), F.lit("console"))
        .when(is_offline() & ~F.col("disable_s3"), F.lit("object_cache"))
        .when(~F.col("disable_kafka"), F.lit("message_log"))
        .otherwise(F.lit("file_store"))
    )
    return tasks.withColumn("sink", sink)


def parse_topic(address: Column) -> Column:
    """``topic:partition[:prefix]`` as a struct; a bad address is ('', -1, '')."""
    parts = F.split(address, ":", -1)
    number = F.try_element_at(parts, F.lit(2))
    partition = F.when(number.rlike(r"^[+-]?[0-9]+$"), number.try_cast("int"))
    usable = partition.isNotNull()
    return F.struct(
        F.when(usable, parts[0]).otherwise(F.lit("")).alias("topic"),
        F.coalesce(partition, F.lit(-1)).alias("partition"),
        F.when(usable, F.coalesce(F.try_element_at(parts, F.lit(3)), F.lit("")))
        .otherwise(F.lit(""))
        .alias("key_prefix"),
    )


def audit_view(tasks: DataFrame) -> DataFrame:
    """Tasks without their token: the form every log and report uses.

    The text of an unreadable document may hold the token anywhere, so its length and digest
    stand for it.
    """
    shown = tasks.drop("token")
    if CORRUPT not in shown.columns:
        return shown
    size = F.octet_length(CORRUPT).cast("string")
    text = F.concat(F.lit("unreadable: "), size, F.lit(" bytes, sha256 "), F.sha2(CORRUPT, 256))
    return shown.withColumn(CORRUPT, text)
