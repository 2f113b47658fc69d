"""Saved dashboard queries and alerts over the serving views. The limits are those of the reports.

`as_of` stands for the present, so that a report can be repeated. Nulls sort first in descending order, and ties are broken
by the remaining key columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.exprs import percent

#: Alert name -> column of the daily figures that must stay 0.
ALERTS = {"Canonical failures in 30d > 0": "canonical_failed", "Validation failures in 30d > 0": "validation_runs_failed"}


def submission_status(overview: DataFrame) -> DataFrame:
    return overview.groupBy("submission_status").agg(F.count("*").alias("submissions")).orderBy(F.desc("submissions"), "submission_status")


def daily_kpis(kpis: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    columns = ("submissions_received", "parse_succeeded", "parse_failed", "validation_runs_succeeded", "validation_runs_failed", "canonical_succeeded", "canonical_failed", "canonical_skipped")
    return kpis.where(F.col("day") >= F.date_sub(as_of, days)).select("day", *columns).orderBy("day")


def canonical_pending(months: DataFrame, limit: int = 200) -> DataFrame:
    due = months.where((F.col("pending_rebuild_events") > 0) | (F.col("canonical_latest_status") == "FAILED"))
    columns = ("state", "file_type", "atomic_month", "canonical_latest_status", "pending_rebuild_events", "canonical_build_attempts", "canonical_build_successes", "last_success_at")
    return due.select(*columns).orderBy(F.desc_nulls_first("pending_rebuild_events"), F.desc_nulls_first("atomic_month"), "state", "file_type").limit(limit)


def _recent(findings: DataFrame, as_of: Column, days: int) -> DataFrame:
    return findings.where(F.col("validation_ended_at") >= as_of - F.expr(f"INTERVAL {int(days)} DAYS"))


def fail_rates(findings: DataFrame, as_of: Column, days: int = 30, limit: int = 200) -> DataFrame:
    hit = lambda s: F.count_if(F.col("failed") & (F.col("severity") == s))
    out = _recent(findings, as_of, days).groupBy("submitter_id", "state", "file_type").agg(
        hit("HARD").alias("hard_fail_findings"), hit("SOFT").alias("soft_fail_findings"), F.count("*").alias("total_findings"), percent(F.count_if("failed"), F.count("*")).alias("failed_pct")
    )
    return out.orderBy(F.desc("hard_fail_findings"), F.desc("soft_fail_findings"), "submitter_id", "state", "file_type").limit(limit)


def top_rules(findings: DataFrame, as_of: Column, days: int = 30, limit: int = 50) -> DataFrame:
    out = _recent(findings, as_of, days).groupBy("rule_name", "severity").agg(F.count_if("failed").alias("failed_count"), F.count("*").alias("evaluated_count"), percent(F.count_if("failed"), F.count("*")).alias("failed_pct"))
    return out.orderBy(F.desc("failed_count"), "rule_name", "severity").limit(limit)


def month_control(submitter_months: DataFrame, months: DataFrame, limit: int = 500) -> DataFrame:
    keys = ["state", "file_type", "atomic_month"]
    j = submitter_months.join(months.select(*keys, "canonical_build_attempts", "canonical_build_successes", "last_success_at"), keys, "left")
    columns = ("state", "file_type", "atomic_month", "submitter_id", "winning_submission_id", "winning_validation_outcome", "canonical_latest_status", "canonical_rebuild_pending", "pending_rebuild_events", "canonical_build_attempts", "canonical_build_successes", "last_success_at")
    return j.select(*columns).orderBy(F.desc_nulls_first("atomic_month"), "state", "file_type", "submitter_id").limit(limit)


def alerts(daily: DataFrame) -> DataFrame:
    """(alert, value, triggered): the largest daily value of each watched column."""
    rows = F.array(*(F.struct(F.lit(k).alias("alert"), F.col(c).alias("value")) for k, c in ALERTS.items()))
    top = daily.agg(*(F.max(c).alias(c) for c in ALERTS.values())).select(F.inline(rows))
    return top.select("alert", "value", F.coalesce(F.col("value") > 0, F.lit(False)).alias("triggered"))
