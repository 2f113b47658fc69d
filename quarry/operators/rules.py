"""Declarative data-quality rules: resolution, compilation to predicates, one-pass evaluation, outcome."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions import re2
from quarry.functions.exprs import to_double
from quarry.sources.files import ObjectStore

#: Statements that a custom query must not hold, as whole words (fixed values).
BLOCKED = ("DROP", "DELETE", "UPDATE", "INSERT", "CREATE", "ALTER", "COPY", "ATTACH", "DETACH", "EXPORT", "IMPORT", "PRAGMA")
KINDS = ("NOT_NULL", "RANGE", "ALLOWED_VALUES", "REGEX", "UNIQUE_KEY", "CUSTOM_SQL")
SAMPLE_ROWS = 100

#: Outcome -> status of the submission (fixed values).
STATUS = {"PASS": "VALIDATED", "PASS_WITH_WARNINGS": "VALIDATED_WITH_WARNINGS", "FAIL_HARD": "VALIDATION_FAILED"}


@dataclass(frozen=True)
class Rule:
    rule_id: str
    name: str
    kind: str
    severity: str = "HARD"
    threshold_type: str = "COUNT"
    threshold: float = 0.0
    params: dict = field(default_factory=dict, hash=False)
    sql: str | None = None
    enabled: bool = True

    def __post_init__(self) -> None:
        if self.kind == "REGEX" and "pattern" in self.params:
            re2.translate(self.params["pattern"])  # a pattern that can't be had is an error here, not in a job

    def override(self, severity: str | None = None, threshold_type: str | None = None, threshold: float | None = None, params: dict | str | None = None, enabled: bool = True) -> Rule:
        """The rule as a rule set binds it: given values win, parameters are merged one level deep."""
        params = json.loads(params) if isinstance(params, str) else params
        return replace(
            self, severity=severity or self.severity, threshold_type=threshold_type or self.threshold_type, threshold=self.threshold if threshold is None else threshold,
            params={**self.params, **(params or {})}, enabled=enabled,
        )


#: Rules that a fresh installation starts with (fixed values).
DEFAULT_RULES = (
    Rule("patient_not_null", "patient_not_null", "NOT_NULL", "HARD", "COUNT", 0, {"column": "PATIENT"}),
    Rule("code_in_range", "code_in_range", "RANGE", "SOFT", "RATE", 0.01, {"column": "CODE", "min": 1, "max": 99999}),
    Rule("encounter_unique", "encounter_unique", "UNIQUE_KEY", "HARD", "COUNT", 0, {"columns": ["Id", "START"]}),
)


def guard(sql: str) -> str:
    """A custom query without comments, if it is one SELECT and holds no blocked word."""
    bare = re.sub(r"/\*.*?\*/", "", re.sub(r"--[^\n]*", "", sql), flags=re.S).strip()
    if not re.match(r"(?i)select\b", bare):
        raise ValueError("a custom query must start with SELECT")
    words = set(re.findall(r"\w+", bare.upper()))
    if hit := sorted(words.intersection(BLOCKED)):
        raise ValueError(f"a custom query must not hold {', '.join(hit)}")
    return bare


def predicate(rule: Rule) -> Column | None:
    """Whether a row violates the rule; None for rules that no single row decides. Null values violate NOT_NULL only."""
    p = rule.params
    c = F.col(f"`{p['column']}`") if "column" in p else None
    if rule.kind == "NOT_NULL":
        return c.isNull()
    if rule.kind == "RANGE":
        d = to_double(F.trim(c.cast("string")))
        low, high = p.get("min"), p.get("max")
        out = [x for x in (d < low if low is not None else None, d > high if high is not None else None) if x is not None]
        return d.isNotNull() & reduce(lambda a, b: a | b, out, F.lit(False))
    if rule.kind == "ALLOWED_VALUES":
        return c.isNotNull() & ~c.cast("string").isin([str(v) for v in p["values"]])
    if rule.kind == "REGEX":
        return c.isNotNull() & ~c.cast("string").rlike(re2.translate(p["pattern"]))
    if rule.kind in ("UNIQUE_KEY", "CUSTOM_SQL"):
        return None
    raise ValueError(f"rule kind {rule.kind} is unknown")


def repeated_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that more than one row has, null being a value like others, with the number of rows."""
    return df.groupBy(*(F.col(f"`{c}`") for c in columns)).agg(F.count("*").alias("_rows")).where("_rows > 1")


def violating_rows(df: DataFrame, rule: Rule) -> DataFrame:
    """The rows that violate a rule."""
    if (test := predicate(rule)) is not None:
        return df.where(test)
    if rule.kind == "UNIQUE_KEY":
        columns = rule.params["columns"]
        keys = repeated_keys(df, columns).select(*(F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(columns)))
        same = reduce(lambda a, b: a & b, (F.col(f"`{c}`").eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(columns)))
        return df.join(keys, same, "left_semi")
    sql = guard(rule.sql or rule.params["sql"])
    return _with_silver(df, sql)


def _with_silver(df: DataFrame, sql: str) -> DataFrame:
    """The query over a table `silver`, a common table expression: literals and columns of that name mean what they say."""
    escaped = sql.rstrip("; \t\r\n").replace("{", "{{").replace("}", "}}")
    return df.sparkSession.sql("WITH silver AS (SELECT * FROM {silver_rows}) " + escaped, silver_rows=df)


def evaluate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule_id, name, rule_kind, severity, threshold_type, threshold_value, violations_count, denominator_count,
    violations_rate, passed): a row for each enabled rule.

    All rules that single rows decide, and the row count, are one aggregate over one scan; a unique key adds an
    aggregate of its own, a custom query its own plan.
    """
    rules = [r for r in rules if r.enabled]
    tests = {r.rule_id: predicate(r) for r in rules}
    counts = df.agg(F.count("*").alias("total"), *(F.count_if(t).alias(f"v_{i}") for i, t in enumerate(tests.values()) if t is not None))
    found = []
    total = counts.select("total")
    entries = [F.struct(F.lit(i).alias("at"), F.col(f"v_{i}").alias("v")) for i, t in enumerate(tests.values()) if t is not None]
    if entries:
        found.append(counts.select("total", F.inline(F.array(*entries))))
    for i, r in enumerate(rules):
        if r.kind == "UNIQUE_KEY":
            v = repeated_keys(df, r.params["columns"]).agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("v"))
        elif r.kind == "CUSTOM_SQL":
            v = violating_rows(df, r).agg(F.count("*").alias("v"))
        else:
            continue
        found.append(total.crossJoin(v).select("total", F.lit(i).alias("at"), "v"))  # one row by one row
    if not found:
        return _verdict(total.select("total", F.lit(0).alias("at"), F.lit(0).cast("long").alias("v")).limit(0), rules)
    return _verdict(reduce(DataFrame.unionByName, found), rules)


def _verdict(found: DataFrame, rules: list[Rule]) -> DataFrame:
    rows = [(i, r.rule_id, r.name, r.kind, r.severity, r.threshold_type, float(r.threshold)) for i, r in enumerate(rules)]
    known = found.sparkSession.createDataFrame(rows, "at int, rule_id string, name string, rule_kind string, severity string, threshold_type string, threshold_value double")
    out = found.join(F.broadcast(known), "at").withColumnsRenamed({"v": "violations_count", "total": "denominator_count"})
    return with_passed(out).select("rule_id", "name", "rule_kind", "severity", "threshold_type", "threshold_value", "violations_count", "denominator_count", "violations_rate", "passed")


def with_passed(df: DataFrame) -> DataFrame:
    """Rate (0 without rows) and whether the count or the rate is within the threshold."""
    rate = F.when(F.col("denominator_count") > 0, F.col("violations_count") / F.col("denominator_count")).otherwise(0.0)
    df = df.withColumn("violations_rate", rate)
    return df.withColumn("passed", F.when(F.col("threshold_type") == "RATE", F.col("violations_rate") <= F.col("threshold_value")).otherwise(F.col("violations_count") <= F.col("threshold_value")))


def outcome(findings: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Any failed HARD rule fails, else any failed SOFT rule warns; with the submission's status."""
    failed = lambda s: F.coalesce(F.max(~F.col("passed") & (F.col("severity") == s)), F.lit(False))
    out = findings.groupBy(*(by or [])).agg(failed("HARD").alias("hard"), failed("SOFT").alias("soft"))
    word = F.when(F.col("hard"), "FAIL_HARD").when(F.col("soft"), "PASS_WITH_WARNINGS").otherwise("PASS")
    status = F.create_map(*(F.lit(x) for kv in STATUS.items() for x in kv))
    return out.select(*(by or []), word.alias("outcome"), F.element_at(status, word).alias("submission_status"))


def samples(df: DataFrame, rules: list[Rule], order: list[str], most: int = SAMPLE_ROWS) -> DataFrame:
    """Up to `most` violating rows of each rule, in a stated order, with the rule's id; row rules share one scan.

    The limit is the feature: a sample for people to read. A rank limit is pushed below the shuffle.
    """
    tests = [(r, predicate(r)) for r in rules if r.enabled]
    parts = []
    if simple := [(r, t) for r, t in tests if t is not None]:
        ids = F.array_compact(F.array(*(F.when(t, F.lit(r.rule_id)) for r, t in simple)))
        parts.append(df.withColumn("rule_id", F.explode(ids)))
    parts += [violating_rows(df, r).withColumn("rule_id", F.lit(r.rule_id)) for r, t in tests if t is None and r.kind == "UNIQUE_KEY"]
    if not parts:
        return df.withColumn("rule_id", F.lit("")).limit(0)
    rank = F.row_number().over(Window.partitionBy("rule_id").orderBy(*order))
    return reduce(DataFrame.unionByName, parts).withColumn("_rank", rank).where(F.col("_rank") <= most).drop("_rank")


#: Bins of submissions without months, which only unbounded windows meet.
SALTS = 64


def _by_month(s: DataFrame, r: DataFrame) -> DataFrame:
    """Submissions (s0, s1) with the rule sets of their type whose windows may overlap: an interval join on bins of a month.

    Either side is there once for each of its months, and a pair counts in the first month that both have. Windows are
    cut to the months that submissions cover at all. Submissions without a month are dealt over `SALTS` bins, which
    unbounded windows are in too, so no key but (type, month) is ever hot.
    """
    span = s.agg(F.min(F.least("s0", "s1")).alias("low"), F.max(F.greatest("s0", "s1")).alias("high")).first()
    number = lambda d: F.year(d) * 12 + F.month(d)
    low, high = F.lit(span["low"]).cast("date"), F.lit(span["high"]).cast("date")
    salt = -1 - F.pmod(F.xxhash64("submission_id"), F.lit(SALTS)).cast("int")
    s = s.withColumn("a", F.when(F.col("s0").isNotNull() & F.col("s1").isNotNull(), number("s0")).otherwise(salt))
    s = s.withColumn("bin", F.explode(F.sequence("a", F.when(F.col("a") > 0, F.greatest("a", number("s1"))).otherwise(F.col("a")))))
    begin, end = number(F.greatest(F.coalesce("effective_start", low), low)), number(F.least(F.coalesce("effective_end", high), high))
    # a window whose end is before its start overlaps what covers both, and has the months between them
    months = F.sequence(F.least(begin, end), F.greatest(begin, end)) if span["low"] else F.array().cast("array<int>")
    free = F.col("effective_start").isNull() & F.col("effective_end").isNull()
    bins = F.concat(months, F.when(free, F.sequence(F.lit(-SALTS), F.lit(-1))).otherwise(F.array().cast("array<int>")))
    r = r.withColumn("_bins", bins).withColumn("b", F.array_min(F.filter("_bins", lambda x: x > 0))).withColumn("_bin", F.explode("_bins")).drop("_bins")
    version = F.col("rv").isNull() | (F.col("rv") == F.col("layout_version"))
    once = (F.col("a") < 0) | (F.col("bin") == F.greatest("a", "b"))
    met = s.join(r, (F.col("rt") == F.col("file_type")) & (F.col("_bin") == F.col("bin")) & version).where(once)
    rest = s.select("submission_id", "file_type", "layout_version", "s0", "s1").distinct().join(met.select("submission_id"), "submission_id", "left_anti")
    columns = ["submission_id", "file_type", "layout_version", "s0", "s1", "rule_set_id", "rt", "rv", "effective_start", "effective_end"]
    return met.select(columns).unionByName(rest, allowMissingColumns=True)


def resolve_rule_set(submissions: DataFrame, rule_sets: DataFrame, strict_tiers: bool = False) -> DataFrame:
    """(submission_id, rule_set_id, tier, candidates): the rule set of each submission, null if none or several fit.

    Submissions: submission_id, file_type, layout_version, coverage_start_month, coverage_end_month. Rule sets:
    rule_set_id, file_type, layout_version?, effective_start?, effective_end?, status. A bounded window must overlap
    the coverage; a submission with one of its months alone covers that month. Tiers: the layout's version within its window, the version, the type within its window, the type.
    An unbounded window counts as overlapping, unless `strict_tiers` sets it apart.
    """
    from quarry.functions.exprs import month_end, month_start

    s = submissions.select("submission_id", "file_type", "layout_version", month_start(F.coalesce("coverage_start_month", "coverage_end_month")).alias("s0"), month_end(F.coalesce("coverage_end_month", "coverage_start_month")).alias("s1"))
    r = rule_sets.where("status = 'ACTIVE'").select("rule_set_id", F.col("file_type").alias("rt"), F.col("layout_version").alias("rv"), "effective_start", "effective_end")
    bounded = F.col("effective_start").isNotNull() | F.col("effective_end").isNotNull()
    overlap = F.coalesce(
        F.col("s0").isNotNull() & F.col("s1").isNotNull() & (F.coalesce(F.col("s0") <= F.col("effective_end"), F.lit(True))) & (F.coalesce(F.col("s1") >= F.col("effective_start"), F.lit(True))), F.lit(False)
    )
    joined = _by_month(s, r)
    fits = ~bounded | overlap
    inside = (bounded & overlap) if strict_tiers else fits
    tier = F.when(F.col("rule_set_id").isNull() | ~fits, None).when(F.col("rv").isNotNull() & inside, 1).when(F.col("rv").isNotNull(), 2).when(inside, 3).otherwise(4)
    per = joined.withColumn("tier", tier).groupBy("submission_id", "tier").agg(F.count("rule_set_id").alias("candidates"), F.min("rule_set_id").alias("one"))
    best = per.groupBy("submission_id").agg(F.min_by(F.struct("tier", "candidates", "one"), F.coalesce("tier", F.lit(9))).alias("b"))
    chosen = F.when((F.col("b.candidates") == 1) & F.col("b.tier").isNotNull(), F.col("b.one"))
    return best.select("submission_id", chosen.alias("rule_set_id"), F.col("b.tier").alias("tier"), F.when(F.col("b.tier").isNull(), 0).otherwise(F.col("b.candidates")).cast("long").alias("candidates"))


def validate(spark: SparkSession, silver: DataFrame, rules: list[Rule], sample_dir: str | None = None, order: list[str] | None = None, report: tuple[ObjectStore, str] | None = None) -> dict:
    """Findings, outcome, rows and rows by month of a silver table; samples are written for rules with violations, and the
    whole as JSON to a key of an object store, if given."""
    findings = [r.asDict() for r in evaluate(silver, rules).orderBy("name", "rule_id").collect()]
    frame = spark.createDataFrame([(f["severity"], f["passed"]) for f in findings], "severity string, passed boolean")
    verdict = outcome(frame).first()
    months = {r[0]: r[1] for r in silver.groupBy("atomic_month").count().collect()} if "atomic_month" in silver.columns else {}
    if sample_dir and any(f["violations_count"] for f in findings):
        samples(silver, rules, order or silver.columns).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("rule_id").parquet(sample_dir)
        broken = {f["rule_id"] for f in findings if f["violations_count"]}
        for r in (x for x in rules if x.enabled and x.kind == "CUSTOM_SQL" and x.rule_id in broken):
            violating_rows(silver, r).limit(SAMPLE_ROWS).write.mode("overwrite").parquet(f"{sample_dir}/rule_id={r.rule_id}")
    out = {"findings": findings, "outcome": verdict["outcome"], "submission_status": verdict["submission_status"], "total_rows": silver.count() if not findings else findings[0]["denominator_count"], "rows_by_month": months}
    if report:
        report[0].put(report[1], json.dumps(out, sort_keys=True, default=str).encode())
    return out
