"""Analytic views over the metadata tables. Each takes a dictionary of DataFrames by table name.

Latest rows are aggregates rather than ranked windows, so that a join whose columns nobody asks for is removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.exprs import safe_ratio
from quarry.operators.latest import latest_per_key

Tables = dict[str, DataFrame]
MONTH = ["state", "file_type", "atomic_month"]


def _severity(t: Tables) -> DataFrame:
    """Findings with their run, rule and the resolved severity and threshold."""
    f, run, rule, bound = t["validation_finding"], t["validation_run"], t["validation_rule"], t["validation_rule_set_rule"]
    run = run.select("validation_run_id", F.col("submission_id"), "rule_set_id", F.col("started_at").alias("validation_started_at"), F.col("ended_at").alias("validation_ended_at"), F.col("status").alias("validation_run_status"), F.col("outcome").alias("validation_outcome"))
    rule = rule.select("rule_id", F.col("name").alias("rule_name"), "rule_kind", "default_severity", "default_threshold_type", "default_threshold_value")
    bound = bound.select("rule_set_id", "rule_id", "severity_override", "threshold_type_override", "threshold_value_override")
    j = f.join(run, "validation_run_id").join(rule, "rule_id").join(bound, ["rule_set_id", "rule_id"], "left")
    for c in ("severity", "threshold_type", "threshold_value"):
        j = j.withColumn(c, F.coalesce(f"{c}_override", f"default_{c}"))
    return j


def _failed(severity: str) -> Column:
    return F.sum(F.when((F.col("passed") == F.lit(False)) & (F.col("severity") == severity), 1).otherwise(0))


def _latest_run(df: DataFrame, number: str) -> DataFrame:
    """The latest run of each submission. Runs of one are few and apart, so they meet before the maxima: partial ones would be sorted for nothing."""
    return latest_per_key(df.repartition("submission_id"), ["submission_id"], ["started_at", number])


def submission_overview(t: Tables) -> DataFrame:
    # one version for each layout: as an aggregate, so that the planner knows it
    s, layout = t["submission"], t["layout_registry"].groupBy("layout_id").agg(F.max("layout_version").alias("layout_version"))
    parse = _latest_run(t["parse_run"].select("submission_id", "parse_run_id", "status", "started_at", "ended_at"), "parse_run_id")
    parse = parse.withColumnsRenamed({"status": "parse_status", "started_at": "parse_started_at", "ended_at": "parse_ended_at"})
    totals = t["parse_file_metrics"].groupBy("parse_run_id").agg(*(F.sum(c).alias(f"parse_{c}") for c in ("rows_read", "rows_written", "rows_rejected")))
    run = _latest_run(t["validation_run"].select("submission_id", "validation_run_id", "status", "outcome", "started_at", "ended_at", "total_rows"), "validation_run_id")
    run = run.withColumnsRenamed({"status": "validation_run_status", "outcome": "validation_outcome", "started_at": "validation_started_at", "ended_at": "validation_ended_at", "total_rows": "validation_total_rows"})
    counts = _severity(t).groupBy("validation_run_id").agg(_failed("HARD").alias("hard_failed_rules"), _failed("SOFT").alias("soft_failed_rules"))
    gold = _latest_run(t["submitter_gold_build"].select("submission_id", "submitter_gold_build_id", "status", "started_at", "ended_at"), "submitter_gold_build_id")
    gold = gold.withColumnsRenamed({"status": "submitter_gold_status", "started_at": "submitter_gold_started_at", "ended_at": "submitter_gold_ended_at"})
    wins = t["submitter_month_pointer"].groupBy(F.col("winning_submission_id").alias("submission_id")).agg(F.count("*").alias("wins"))
    # what lies by submission comes first, so that its rows move once for all of it, and once more for each kind of run
    j = s.join(layout, "layout_id", "left").join(parse, "submission_id", "left").join(run, "submission_id", "left").join(gold, "submission_id", "left").join(wins, "submission_id", "left")
    j = j.join(totals, "parse_run_id", "left").join(counts, "validation_run_id", "left")
    return j.select(
        "submission_id", "submitter_id", "state", "file_type", "layout_id", "layout_version", "coverage_start_month", "coverage_end_month", "received_at", F.col("status").alias("submission_status"),
        "parse_run_id", "parse_status", "parse_started_at", "parse_ended_at", "parse_rows_read", "parse_rows_written", "parse_rows_rejected", "validation_run_id", "validation_run_status",
        "validation_outcome", "validation_started_at", "validation_ended_at", "validation_total_rows", "hard_failed_rules", "soft_failed_rules", "submitter_gold_build_id", "submitter_gold_status",
        "submitter_gold_started_at", "submitter_gold_ended_at", F.coalesce("wins", F.lit(0)).alias("months_currently_winning"),
    )


def validation_findings(t: Tables) -> DataFrame:
    s = t["submission"].select("submission_id", "submitter_id", "state", "file_type", "layout_id")
    return _severity(t).join(s, "submission_id").select(
        "validation_finding_id", "validation_run_id", "submission_id", "submitter_id", "state", "file_type", "layout_id", "rule_set_id", "rule_id", "rule_name", "rule_kind", "severity", "threshold_type",
        "threshold_value", "scope_month", "violations_count", "denominator_count", "violations_rate", "passed", (F.col("passed") == F.lit(False)).alias("failed"), "sample_object_key", "computed_at",
        "validation_started_at", "validation_ended_at", "validation_run_status", "validation_outcome",
    )


def _latest_canonical(t: Tables) -> DataFrame:
    return latest_per_key(t["canonical_month_build"], MONTH, ["started_at", "canonical_month_build_id"])


def _pending(t: Tables) -> DataFrame:
    return t["canonical_rebuild_queue"].where("processed_at IS NULL").groupBy(*MONTH).agg(F.count("*").alias("pending"))


def submitter_month_status(t: Tables) -> DataFrame:
    p = t["submitter_month_pointer"]
    s = t["submission"].select(F.col("submission_id").alias("winning_submission_id"), F.col("received_at").alias("winning_submission_received_at"))
    run = t["validation_run"].select(F.col("validation_run_id").alias("winning_validation_run_id"), F.col("outcome").alias("winning_validation_outcome"), F.col("ended_at").alias("winning_validation_ended_at"))
    latest = _latest_canonical(t).select(*MONTH, "canonical_month_build_id", F.col("status").alias("canonical_latest_status"), F.col("started_at").alias("canonical_latest_started_at"), F.col("ended_at").alias("canonical_latest_ended_at"))
    j = p.join(s, "winning_submission_id", "left").join(run, "winning_validation_run_id", "left").join(latest, MONTH, "left").join(_pending(t), MONTH, "left")
    n = F.coalesce("pending", F.lit(0))
    return j.select(
        "state", "file_type", "submitter_id", "atomic_month", "winning_submission_id", "replaced_submission_id", "winning_validation_run_id", "winner_timestamp", "updated_at", "reason",
        "winning_submission_received_at", "winning_validation_outcome", "winning_validation_ended_at", "canonical_month_build_id", "canonical_latest_status", "canonical_latest_started_at",
        "canonical_latest_ended_at", n.alias("pending_rebuild_events"), (n > 0).alias("canonical_rebuild_pending"),
    )


def canonical_month_status(t: Tables) -> DataFrame:
    latest = _latest_canonical(t).select(*MONTH, "canonical_schema_id", "canonical_month_build_id", F.col("status").alias("canonical_latest_status"), F.col("started_at").alias("canonical_latest_started_at"), F.col("ended_at").alias("canonical_latest_ended_at"), "input_fingerprint", "output_prefix")
    done = F.col("status") == "SUCCEEDED"
    counts = t["canonical_month_build"].groupBy(*MONTH).agg(F.count("*").alias("canonical_build_attempts"), F.sum(F.when(done, 1).otherwise(0)).alias("canonical_build_successes"), F.max(F.when(done, F.col("ended_at"))).alias("last_success_at"))
    cover = t["submitter_month_pointer"].groupBy(*MONTH).agg(F.count("*").alias("winners"))
    schema = t["canonical_schema"].select("canonical_schema_id", F.col("schema_version").alias("canonical_schema_version"))
    j = latest.join(cover, MONTH, "full_outer").join(counts, MONTH, "left").join(_pending(t), MONTH, "left").join(schema, "canonical_schema_id", "left")
    return j.select(
        *MONTH, "canonical_schema_id", "canonical_month_build_id", "canonical_latest_status", "canonical_latest_started_at", "canonical_latest_ended_at", "input_fingerprint", "output_prefix", "canonical_schema_version",
        "canonical_build_attempts", "canonical_build_successes", "last_success_at", F.coalesce("pending", F.lit(0)).alias("pending_rebuild_events"), F.coalesce("winners", F.lit(0)).alias("submitter_winner_count"),
    )


def _daily(df: DataFrame, ts: str, **measures: tuple[str, str]) -> DataFrame:
    """Counts a day of rows whose column has a value."""
    return df.where(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("day")).agg(*(F.count_if(F.col(c) == v).alias(k) for k, (c, v) in measures.items()))


def spine(spark: SparkSession, low: Column, high: Column, bounds: DataFrame) -> DataFrame:
    """A row for each day between two expressions over a one-row frame."""
    return bounds.select(F.explode(F.sequence(low, high, F.expr("INTERVAL 1 DAY"))).alias("day"))


def dashboard_kpis_daily(t: Tables, today: Column | None = None) -> DataFrame:
    today = F.current_date() if today is None else today
    day = F.to_date("received_at")
    bounds = t["submission"].agg(F.coalesce(F.min(day), F.date_sub(today, 30)).alias("low"), F.greatest(F.coalesce(F.max(day), today), today).alias("high"))
    out = spine(bounds.sparkSession, F.col("low"), F.col("high"), bounds)
    state = lambda s: ("status", s)
    parts = [
        t["submission"].where("received_at IS NOT NULL").groupBy(day.alias("day")).agg(F.count("*").alias("submissions_received")),
        _daily(t["parse_run"], "ended_at", parse_succeeded=state("SUCCEEDED"), parse_failed=state("FAILED")),
        _daily(t["validation_run"], "ended_at", validation_runs_succeeded=state("SUCCEEDED"), validation_runs_failed=state("FAILED"), validation_outcome_pass=("outcome", "PASS"), validation_outcome_warn=("outcome", "PASS_WITH_WARNINGS"), validation_outcome_fail_hard=("outcome", "FAIL_HARD")),
        _daily(t["submitter_gold_build"], "ended_at", submitter_gold_succeeded=state("SUCCEEDED"), submitter_gold_failed=state("FAILED")),
        _daily(t["canonical_month_build"], "ended_at", canonical_succeeded=state("SUCCEEDED"), canonical_skipped=state("SKIPPED"), canonical_failed=state("FAILED")),
    ]
    for p in parts:
        out = out.join(p, "day", "left")
    return out.select("day", *(F.coalesce(c, F.lit(0)).alias(c) for c in out.columns if c != "day"))


def parse_column_health(t: Tables) -> DataFrame:
    totals = t["parse_file_metrics"].groupBy("parse_run_id").agg(F.sum("rows_written").alias("rows_written"))
    s = t["submission"].select("submission_id", "submitter_id", "state", "file_type")
    j = t["parse_column_metrics"].select("parse_run_id", "column_name", "null_count", "invalid_count").join(t["parse_run"].select("parse_run_id", "submission_id"), "parse_run_id").join(s, "submission_id").join(totals, "parse_run_id", "left")
    n = F.col("rows_written")
    return j.select("parse_run_id", "submission_id", "submitter_id", "state", "file_type", "column_name", "null_count", "invalid_count", "rows_written", safe_ratio(F.col("null_count"), n).alias("null_rate"), safe_ratio(F.col("invalid_count"), n).alias("invalid_rate"))


def validation_summary(t: Tables) -> DataFrame:
    rolled = _severity(t).groupBy("validation_run_id").agg(
        F.count("*").alias("rules_evaluated"), F.sum(F.when(F.col("passed"), 1).otherwise(0)).alias("rules_passed"), F.sum(F.when(F.col("passed") == F.lit(False), 1).otherwise(0)).alias("rules_failed"),
        _failed("HARD").alias("hard_rules_failed"), _failed("SOFT").alias("soft_rules_failed"), F.sum("violations_count").alias("total_violations"),
    )
    s = t["submission"].select("submission_id", "submitter_id", "state", "file_type")
    j = t["validation_run"].join(s, "submission_id").join(rolled, "validation_run_id", "left")
    return j.select(
        "validation_run_id", "submission_id", "submitter_id", "state", "file_type", "rule_set_id", "started_at", "ended_at", F.col("status").alias("validation_run_status"), F.col("outcome").alias("validation_outcome"), "total_rows",
        "rules_evaluated", "rules_passed", "rules_failed", "hard_rules_failed", "soft_rules_failed", "total_violations",
    )


def submission_timeline(t: Tables) -> DataFrame:
    s = t["submission"].select("submission_id", "submitter_id", "state", "file_type")
    parts = [t["submission"].select("submission_id", "submitter_id", "state", "file_type", F.lit("SUBMISSION_RECEIVED").alias("event_type"), F.col("status").alias("event_status"), F.col("received_at").alias("event_at"))]
    for table, name, status in (("parse_run", "PARSE_RUN", F.col("status")), ("validation_run", "VALIDATION_RUN", F.coalesce("outcome", "status")), ("submitter_gold_build", "SUBMITTER_GOLD_BUILD", F.col("status"))):
        run = t[table].select("submission_id", F.lit(name).alias("event_type"), status.alias("event_status"), F.coalesce("ended_at", "started_at").alias("event_at"))
        parts.append(run.join(s, "submission_id").select(*parts[0].columns))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


VIEWS = {f.__name__: f for f in (submission_overview, validation_findings, submitter_month_status, canonical_month_status, dashboard_kpis_daily, parse_column_health, validation_summary, submission_timeline)}


def drop(spark: SparkSession, prefix: str = "serving_") -> None:
    """The reverse of `register`: views that others may rest on go last."""
    for name in reversed(VIEWS):
        spark.catalog.dropTempView(prefix + name)


def register(t: Tables, prefix: str = "serving_") -> dict[str, DataFrame]:
    """All views as temporary views of the session; those of an earlier call are dropped first, the last one first."""
    drop(next(iter(t.values())).sparkSession, prefix)
    out = {name: build(t) for name, build in VIEWS.items()}
    for name, df in out.items():
        df.createOrReplaceTempView(prefix + name)
    return out
