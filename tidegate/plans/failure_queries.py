"""Retry, status, log and failure-reason queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.constants import LOG_RULES
from tidegate.operators import failures as f
from tidegate.plans.fixtures import view, with_views


def retry_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return f.retry_outcomes(view(spark, sf_dir, "v_attempts"))


def status_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return f.status_counts(view(spark, sf_dir, "v_attempts"))


def log_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    triage = f.log_triage(view(spark, sf_dir, "v_logs"))
    return triage.withColumn("rule_no", F.coalesce("rule_no", F.lit(0)))


def plugin_log_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return f.log_triage(view(spark, sf_dir, "v_logs"), tool="plugin").select(
        "stream_id", "error_class"
    )


def failure_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return f.failure_reasons(view(spark, sf_dir, "v_errors"))


QUERIES = {
    "retry_outcomes": retry_outcomes,
    "status_classes": status_classes,
    "log_triage": log_triage,
    "plugin_log_triage": plugin_log_triage,
    "failure_reasons": failure_reasons,
}

_CLASS = """CASE WHEN error_kind IS NOT NULL THEN 'transport'
  WHEN status_code BETWEEN 200 AND 299 THEN 'ok'
  WHEN status_code < 400 OR status_code >= 500 OR status_code = 429 THEN 'retryable'
  ELSE 'non_retryable' END"""

RETRY_CTES = (
    f"classed AS (SELECT *, {_CLASS} AS cls FROM v_attempts)",
    """
tried AS (
  SELECT c.*, policy,
    CASE WHEN cls = 'ok' THEN 'success'
         WHEN policy = 'probe' AND cls = 'transport' THEN 'success'
         WHEN policy IN ('http', 'capture') AND bytes_read > 0 THEN 'partial'
         WHEN policy = 'http' AND cls IN ('transport', 'non_retryable') THEN 'non_retryable' END AS stop
  FROM classed c, (VALUES ('http'), ('capture'), ('manifest'), ('probe')) p(policy))""",
    """
ends AS (
  SELECT stream_id, policy, min(attempt_no) FILTER (WHERE stop IS NOT NULL) AS s, max(attempt_no) AS l
  FROM tried GROUP BY ALL)""",
    """
outcomes AS (
  SELECT e.stream_id, e.policy, CAST(coalesce(s, l) AS INT) AS attempts,
    coalesce(t.stop, CASE WHEN l = 5 THEN 'exhausted' ELSE 'incomplete' END) AS outcome,
    CAST(pow(2, CASE WHEN e.policy = 'probe' THEN least(4, coalesce(s - 1, l)) ELSE coalesce(s - 1, l) END) - 1 AS BIGINT) AS wait_s
  FROM ends e LEFT JOIN tried t ON t.stream_id = e.stream_id AND t.policy = e.policy AND t.attempt_no = e.s)""",
)

_TAIL = """
sized AS (
  SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY stream_id ORDER BY line_no DESC
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS after
  FROM v_logs),
tail AS (
  SELECT stream_id, line_no,
         CASE WHEN after + length(line) + 1 > 2048
              THEN CASE WHEN 2047 - after > 0 THEN right(line, CAST(2047 - after AS BIGINT)) ELSE '' END
              ELSE line END AS line
  FROM sized WHERE after < 2048)"""


def _rule_values() -> str:
    rows = [
        f"({no}, '{phrase}', '{name}')"
        for no, (phrases, name) in enumerate(LOG_RULES, start=1)
        for phrase in phrases
    ]
    return "rules AS (SELECT * FROM (VALUES " + ", ".join(rows) + ") r(rule_no, phrase, class))"


ORACLES = {
    "retry_outcomes": with_views(["v_attempts"], "SELECT * FROM outcomes", *RETRY_CTES),
    "status_classes": with_views(
        ["v_attempts"],
        "SELECT cls AS status_class, CAST(count(*) AS BIGINT) AS n_attempts, "
        "CAST(sum(bytes_read) AS BIGINT) AS bytes_read FROM classed GROUP BY cls",
        RETRY_CTES[0],
    ),
    "log_triage": with_views(
        ["v_logs"],
        """
SELECT stream_id, CAST(coalesce(min(rules.rule_no), 0) AS INT) AS rule_no,
       coalesce(min_by(class, rule_no), max_by(tail.line, line_no)) AS error_class
FROM tail LEFT JOIN rules ON contains(tail.line, phrase) GROUP BY stream_id""",
        _TAIL,
        _rule_values(),
    ),
    "plugin_log_triage": with_views(
        ["v_logs"],
        "SELECT stream_id, max_by(line, line_no) AS error_class FROM tail GROUP BY stream_id",
        _TAIL,
    ),
    "failure_reasons": with_views(
        ["v_errors"],
        """
SELECT stream_id, reason AS failure_reason, message AS error_message, CAST(n AS BIGINT) AS n_errors
FROM (SELECT e.stream_id, e.message, coalesce(s.reason, 'other') AS reason,
             count(*) OVER (PARTITION BY e.stream_id) AS n,
             row_number() OVER (PARTITION BY e.stream_id ORDER BY e.ts, coalesce(s.rank, 99), e.message) AS rn
      FROM v_errors e LEFT JOIN stages s USING (stage))
WHERE rn = 1""",
        """
stages AS (SELECT * FROM (VALUES
  ('writer_setup', 0, 'file_write_error'), ('api_client', 1, 'api_error'),
  ('catalogue_lookup', 2, 'url_not_found'), ('source_url', 3, 'api_not_found'),
  ('mime_probe', 4, 'invalid_data'), ('window', 5, 'invalid_data'),
  ('stream_read', 6, 'stream_reader_error'), ('stream_write', 7, 'file_write_error')) s(stage, rank, reason))""",
    ),
}
