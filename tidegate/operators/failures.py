"""Retry outcomes, status classes, tool-log triage and failure reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions.constants import (
    FIRST_WAIT_SECONDS,
    LOG_RULES,
    MAX_ATTEMPTS,
    REASON_OTHER,
    STAGE_REASONS,
    TOOL_LOG_BYTES,
)
from tidegate.functions.values import micros
from tidegate.operators.blocks import BLOCK, BLOCK_ROWS, with_block

POLICIES = ("http", "capture", "manifest", "probe")
_OUTCOMES = ("success", "partial", "non_retryable")


def status_retryable(status: Column) -> Column:
    return (status < 400) | (status >= 500) | (status == 429)


def status_class(status: Column, error_kind: Column) -> Column:
    return (
        F.when(error_kind.isNotNull(), F.lit("transport"))
        .when(status.between(200, 299), F.lit("ok"))
        .when(status_retryable(status), F.lit("retryable"))
        .otherwise(F.lit("non_retryable"))
    )


def status_counts(attempts: DataFrame) -> DataFrame:
    cls = status_class(F.col("status_code"), F.col("error_kind"))
    return attempts.groupBy(cls.alias("status_class")).agg(
        F.count(F.lit(1)).alias("n_attempts"),
        F.coalesce(F.sum("bytes_read"), F.lit(0)).alias("bytes_read"),
    )


def _stop_code(policy: str) -> Column:
    """0 success, 1 partial, 2 non-retryable; NULL lets the policy try again."""
    cls = status_class(F.col("status_code"), F.col("error_kind"))
    ok = cls == "ok"
    some = F.col("bytes_read") > 0
    if policy == "http":
        return (
            F.when(ok, 0).when(some, 1).when(cls.isin("transport", "non_retryable"), 2)
        )
    if policy == "capture":
        return F.when(ok, 0).when(some, 1)
    if policy == "manifest":
        return F.when(ok, 0)
    if policy == "probe":
        return F.when(ok | (cls == "transport"), 0)
    raise ValueError(f"unknown policy {policy!r}")


def retry_outcomes(
    attempts: DataFrame,
    policies: tuple[str, ...] = POLICIES,
    key: str = "stream_id",
    max_attempts: int = MAX_ATTEMPTS,
) -> DataFrame:
    """How each retry policy would have ended on each stream's attempts.

    One group-by for all policies. The terminal attempt and its outcome are packed into one
    integer (attempt * 4 + code), so its minimum is a plain partial aggregate with no sorting
    or windowing of a stream's attempts. Waits double from one second after every failed
    attempt; the probe alone does not wait after its last one.
    """
    counted = attempts.where(F.col("attempt_no").between(1, max_attempts))
    packed = [
        F.min(F.col("attempt_no").cast("bigint") * 4 + _stop_code(p)).alias(f"_{p}")
        for p in policies
    ]
    ends = counted.groupBy(key).agg(F.max("attempt_no").alias("_last"), *packed)

    def outcome(policy: str) -> Column:
        stop = F.col(f"_{policy}")
        terminal = F.coalesce(F.floor(stop / 4), F.col("_last")).cast("int")
        kind = F.when(
            stop.isNotNull(), F.element_at(F.array(*map(F.lit, _OUTCOMES)), (stop % 4 + 1).cast("int"))
        ).otherwise(
            F.when(F.col("_last") == max_attempts, F.lit("exhausted")).otherwise(F.lit("incomplete"))
        )
        failures = terminal - F.when(stop.isNotNull(), 1).otherwise(0)
        waits = F.least(failures, F.lit(max_attempts - 1)) if policy == "probe" else failures
        wait = (F.pow(F.lit(2.0), waits) - 1) * FIRST_WAIT_SECONDS
        return F.struct(
            F.lit(policy).alias("policy"),
            terminal.alias("attempts"),
            kind.alias("outcome"),
            wait.cast("bigint").alias("wait_s"),
        )

    return ends.select(key, F.inline(F.array(*[outcome(p) for p in policies])))


def _keep_tail(lines: DataFrame, by: list[str], order: str, limit: int) -> DataFrame:
    """Lines of each group of which at least one byte lies in its last ``limit`` bytes."""
    newer = Window.partitionBy(*by).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    return lines.withColumn("_after", F.coalesce(F.sum("_size").over(newer), F.lit(0))).where(
        F.col("_after") < limit
    )


def log_tail(
    logs: DataFrame,
    key: str = "stream_id",
    order: str = "line_no",
    line: str = "line",
    limit: int = TOOL_LOG_BYTES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The last ``limit`` bytes of each log, line by line; the oldest line is cut to its tail.

    Lines are cut to their last ``limit`` bytes before any shuffle; no more of one can be kept.
    Tails are taken per (stream, block) first. What reaches the per-stream window is at most
    ``limit`` bytes per block, so a hot log is reduced before it meets its own task.
    """
    whole = F.col(line).cast("binary")
    length = F.octet_length(whole)
    short = F.when(length > limit, F.substring(whole, length - limit + 1, F.lit(limit))).otherwise(whole)
    lean = logs.select(key, order, short.alias("_raw"), (length.cast("bigint") + 1).alias("_size"))
    sized = with_block(lean, order, block_rows)
    tails = _keep_tail(sized, [key, BLOCK], order, limit)
    kept = _keep_tail(tails, [key], order, limit)
    room = (F.lit(limit) - F.col("_after") - 1).cast("int")
    raw = F.col("_raw")
    cut = F.when(room <= 0, F.lit("")).otherwise(
        F.substring(raw, F.octet_length(raw) - room + 1, room).cast("string")
    )
    text = F.when(F.col("_size") + F.col("_after") > limit, cut).otherwise(raw.cast("string"))
    return kept.select(key, order, text.alias(line))


def _rule_number(line: Column) -> Column:
    """Number (from 1) of the first log rule whose phrase occurs in the line."""
    hits = [
        F.when(F.greatest(*[F.contains(line, F.lit(p)) for p in phrases], F.lit(False)), F.lit(no))
        for no, (phrases, _) in enumerate(LOG_RULES, start=1)
    ]
    return F.coalesce(*hits)


def log_triage(
    logs: DataFrame,
    exit_error: str = "exit status 1",
    tool: str = "capture",
    key: str = "stream_id",
    order: str = "line_no",
    line: str = "line",
    limit: int = TOOL_LOG_BYTES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One error class per stream from the end of its tool log.

    For the capture tool the lowest matching rule wins, then the last line if the exit text is
    ``exit status 1``, then the exit text. The plug-in tool takes its last line unless killed.
    """
    tail = log_tail(logs, key, order, line, limit, block_rows)
    facts = tail.groupBy(key).agg(
        F.min(_rule_number(F.col(line))).alias("rule_no"),
        F.max_by(line, order).alias("last_line"),
    )
    classes = F.array(*[F.lit(name) for _, name in LOG_RULES])
    if tool == "capture":
        fallback = F.col("last_line") if exit_error == "exit status 1" else F.lit(exit_error)
        found = F.coalesce(F.try_element_at(classes, F.col("rule_no")), fallback)
    else:
        found = F.lit(exit_error) if exit_error == "signal: killed" else F.col("last_line")
    return facts.select(key, "rule_no", found.alias("error_class"))


def failure_reasons(
    errors: DataFrame, key: str = "stream_id", ts: str = "ts"
) -> DataFrame:
    """The first error of each stream with its reason; unknown stages count as other.

    Errors at the same instant are ordered by processing stage.
    """
    ranks = F.create_map(*[F.lit(v) for i, (s, _) in enumerate(STAGE_REASONS) for v in (s, i)])
    reasons = F.create_map(*[F.lit(v) for pair in STAGE_REASONS for v in pair])
    rank = F.coalesce(F.try_element_at(ranks, F.col("stage")), F.lit(len(STAGE_REASONS)))
    reason = F.coalesce(F.try_element_at(reasons, F.col("stage")), F.lit(REASON_OTHER))
    first = F.min(
        F.struct(
            micros(F.col(ts)).alias("us"),
            rank.alias("rank"),
            F.col("message"),
            reason.alias("reason"),
        )
    )
    return (
        errors.groupBy(key)
        .agg(first.alias("first"), F.count(F.lit(1)).alias("n_errors"))
        .select(
            key,
            F.col("first.reason").alias("failure_reason"),
            F.col("first.message").alias("error_message"),
            "n_errors",
        )
    )
