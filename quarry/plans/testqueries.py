"""A query for each operator on the star-schema tables, and SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import exprs, strptime
from quarry.operators import canonical, intake, rules, winners
from quarry.operators.latest import latest_per_key
from quarry.operators.parse import metrics, type_columns
from quarry.plans import dashboards, serving, standins
from quarry.sources.files import scan_csv
from quarry.sources.layouts import CORRUPT, CanonicalColumn, CanonicalSchema, Layout, LayoutColumn

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

AS_OF = "TIMESTAMP_NTZ '1998-01-01 00:00:00'"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- parsing ----------------------------------------------------------------------------------------------------

EVENTS = Layout("events/v1", "events", "v1", (LayoutColumn("EVENT", "integer", True), LayoutColumn("SEEN_AT", "datetime"), LayoutColumn("VALUE", "decimal"), LayoutColumn("KIND", "string")), anchor="SEEN_AT", date_formats=("%Y-%m-%d %H:%M:%S", "%Y-%m-%d"))

_BAD_VALUE = "event_id % 17 = 0"
_RAW = f"""SELECT CAST(event_id AS STRING) AS EVENT, CASE WHEN event_id % 13 = 0 THEN '2024-13-45' WHEN event_id % 11 = 0 THEN ' ' ELSE substr(CAST(ts AS STRING), 1, 10) END AS SEEN_AT,
    CASE WHEN {_BAD_VALUE} THEN 'n/a' ELSE CAST(CAST(value AS DECIMAL(18,2)) AS STRING) END AS VALUE, event_type AS KIND FROM events"""


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_RAW.replace("FROM events", "FROM {events}"), events=read(spark, sf_dir, "events"))


_TYPED = f"raw AS ({_RAW}), typed AS (SELECT try_cast(trim(EVENT) AS BIGINT) AS e, try_strptime(nullif(trim(SEEN_AT), ''), '%Y-%m-%d') AS a, try_cast(nullif(trim(VALUE), '') AS DOUBLE) AS v, nullif(trim(SEEN_AT), '') AS at_, nullif(trim(VALUE), '') AS val_, KIND FROM raw), flagged AS (SELECT *, (at_ IS NOT NULL AND a IS NULL) AS bad_a, (val_ IS NOT NULL AND v IS NULL) AS bad_v FROM typed)"


@query(f"WITH {_TYPED} SELECT 'SEEN_AT' AS column_name, count(*) FILTER (WHERE NOT bad_a AND NOT bad_v AND a IS NULL) AS null_count, count(*) FILTER (WHERE bad_a) AS invalid_count FROM flagged UNION ALL SELECT 'VALUE', count(*) FILTER (WHERE NOT bad_a AND NOT bad_v AND v IS NULL), count(*) FILTER (WHERE bad_v) FROM flagged")
def typed_parse_metrics(spark, sf_dir):
    m = metrics(type_columns(raw_events(spark, sf_dir), EVENTS), EVENTS)
    rows = F.array(*(F.struct(F.lit(EVENTS.columns[i].name).alias("column_name"), F.col(f"null_{i}").alias("null_count"), F.col(f"invalid_{i}").alias("invalid_count")) for i in (1, 2)))
    return m.select(F.inline(rows))


@query(f"WITH {_TYPED} SELECT count(*) AS rows_read, count(*) FILTER (WHERE NOT bad_a AND NOT bad_v) AS rows_written, count(*) FILTER (WHERE bad_a OR bad_v) AS rows_rejected FROM flagged")
def reject_split(spark, sf_dir):
    return metrics(type_columns(raw_events(spark, sf_dir), EVENTS), EVENTS).select(F.col("read").alias("rows_read"), F.col("written").alias("rows_written"), F.col("rejected").alias("rows_rejected"))


@query("SELECT coalesce(strftime(o_orderdate, '%Y-%m'), '__unknown__') AS atomic_month, count(*) AS n FROM orders GROUP BY 1 UNION ALL SELECT coalesce(strftime(CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE l_shipdate END, '%Y-%m'), '__unknown__'), count(*) FROM lineitem GROUP BY 1")
def atomic_month_partition(spark, sf_dir):
    a = read(spark, sf_dir, "orders").groupBy(exprs.atomic_month(F.col("o_orderdate")).alias("atomic_month")).agg(F.count("*").alias("n"))
    b = read(spark, sf_dir, "lineitem").groupBy(exprs.atomic_month(F.when(F.col("l_partkey") % 10 != 0, F.col("l_shipdate"))).alias("atomic_month")).agg(F.count("*").alias("n"))
    return a.unionByName(b)


# ---- rules ------------------------------------------------------------------------------------------------------

_EVENT_RULES = [
    rules.Rule("r1", "value_there", "NOT_NULL", "HARD", "COUNT", 0, {"column": "value"}),
    rules.Rule("r2", "value_in_range", "RANGE", "SOFT", "RATE", 0.25, {"column": "value", "min": 10, "max": 90}),
    rules.Rule("r3", "known_type", "ALLOWED_VALUES", "HARD", "COUNT", 0, {"column": "event_type", "values": ["click", "view", "purchase", "signup"]}),
    rules.Rule("r4", "props_json", "REGEX", "SOFT", "RATE", 0.0, {"column": "props", "pattern": r'^\{"k": [0-9]+\}$'}),
]
_VIOLATES = ("value IS NULL", "value IS NOT NULL AND (value < 10 OR value > 90)", "event_type IS NOT NULL AND event_type NOT IN ('click', 'view', 'purchase', 'signup')", "props IS NOT NULL AND NOT regexp_matches(props, '^\\{\"k\": [0-9]+\\}$')")


def _rule_sql(rs: list[rules.Rule], tests: tuple[str, ...], table: str) -> str:
    parts = [
        f"SELECT '{r.rule_id}' AS rule_id, '{r.name}' AS name, '{r.kind}' AS rule_kind, '{r.severity}' AS severity, '{r.threshold_type}' AS threshold_type, CAST({r.threshold} AS DOUBLE) AS threshold_value, count(*) FILTER (WHERE {t}) AS violations_count, count(*) AS denominator_count FROM {table}"
        for r, t in zip(rs, tests, strict=True)
    ]
    return f"SELECT *, violations_rate <= threshold_value AS passed FROM (SELECT *, CASE WHEN denominator_count > 0 THEN violations_count / denominator_count ELSE 0.0 END AS violations_rate FROM ({' UNION ALL '.join(parts)})) WHERE threshold_type = 'RATE' UNION ALL SELECT *, CASE WHEN denominator_count > 0 THEN violations_count / denominator_count ELSE 0.0 END, violations_count <= threshold_value FROM ({' UNION ALL '.join(parts)}) WHERE threshold_type = 'COUNT'"


def _one(table: str, r: rules.Rule, test: str, name: str) -> None:
    def f(spark, sf_dir):
        return rules.evaluate(read(spark, sf_dir, table), [r])

    f.__name__ = name
    query(_rule_sql([r], (test,), table))(f)


@query(_rule_sql(_EVENT_RULES, _VIOLATES, "events"))
def multi_rule_one_pass(spark, sf_dir):
    return rules.evaluate(read(spark, sf_dir, "events"), _EVENT_RULES)


_one("orders", rules.Rule("n", "n", "NOT_NULL", "HARD", "COUNT", 0, {"column": "o_orderpriority"}), "o_orderpriority IS NULL", "rule_not_null")
_one("lineitem", rules.Rule("g", "g", "RANGE", "SOFT", "RATE", 0.5, {"column": "l_quantity", "min": 5, "max": 45}), "l_quantity < 5 OR l_quantity > 45", "rule_range")
_one("customer", rules.Rule("a", "a", "ALLOWED_VALUES", "SOFT", "RATE", 0.5, {"column": "c_mktsegment", "values": ["BUILDING", "MACHINERY"]}), "c_mktsegment NOT IN ('BUILDING', 'MACHINERY')", "rule_allowed_values")
_one("part", rules.Rule("x", "x", "REGEX", "HARD", "COUNT", 5, {"column": "p_brand", "pattern": "[13]$"}), "NOT regexp_matches(p_brand, '[13]$')", "rule_regex")

#: Patterns that mean something else, or nothing, to Java.
_DIALECT = (r"^[[:digit:]]+$", r"^(click|view)$", r"(?P<k>e.)v", r"(?s)e.v", r"(?m)^view$", r"[[:^alpha:]{]", r"\Q{\E", r"(?U)\d+?\z", r"^\pL+\pN*$", r"[^\W\d]\b", r"(?i)V[[:alpha:]&&e]", r"\x7b|\.$")
_DIALECT_TEXT = "CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN event_type || chr(10) WHEN 2 THEN event_type || chr(10) || props ELSE CAST(user_id AS {text}) END"


@query(" UNION ALL ".join(f"SELECT 'p{i}' AS rule_id, count(*) FILTER (WHERE NOT regexp_matches(t, '{p}')) AS violations_count FROM (SELECT {_DIALECT_TEXT.format(text='VARCHAR')} AS t FROM events)" for i, p in enumerate(_DIALECT)))
def rule_regex_dialect(spark, sf_dir):
    events = read(spark, sf_dir, "events").select(F.expr(_DIALECT_TEXT.format(text="STRING")).alias("t"))
    return rules.evaluate(events, [rules.Rule(f"p{i}", f"p{i}", "REGEX", params={"column": "t", "pattern": p}) for i, p in enumerate(_DIALECT)]).select("rule_id", "violations_count")


_UNIQUE = rules.Rule("u", "u", "UNIQUE_KEY", "HARD", "COUNT", 0, {"columns": ["l_orderkey", "l_linenumber"]})
_DUP = "(SELECT l_orderkey AS k1, l_linenumber AS k2 FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)"


@query(f"SELECT 'u' AS rule_id, CAST((SELECT count(*) FROM lineitem JOIN {_DUP} d ON l_orderkey = k1 AND l_linenumber = k2) AS BIGINT) AS violations_count, count(*) AS denominator_count FROM lineitem")
def rule_unique_key(spark, sf_dir):
    return rules.evaluate(read(spark, sf_dir, "lineitem"), [_UNIQUE]).select("rule_id", "violations_count", "denominator_count")


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem JOIN {_DUP} d ON l_orderkey = k1 AND l_linenumber = k2")
def rule_unique_key_sample(spark, sf_dir):
    return rules.violating_rows(read(spark, sf_dir, "lineitem"), _UNIQUE).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


_CUSTOM = rules.Rule("c", "c", "CUSTOM_SQL", "HARD", "COUNT", 0, {}, "SELECT * FROM silver WHERE o_totalprice > 300000 AND o_orderstatus = 'P' -- dear and open")


@query("SELECT 'c' AS rule_id, count(*) FILTER (WHERE o_totalprice > 300000 AND o_orderstatus = 'P') AS violations_count, count(*) AS denominator_count FROM orders")
def rule_custom_sql(spark, sf_dir):
    return rules.evaluate(read(spark, sf_dir, "orders"), [_CUSTOM]).select("rule_id", "violations_count", "denominator_count")


_TEXT = "CASE WHEN event_id % 5 = 0 THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || 'd' WHEN event_id % 5 = 1 THEN ' ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END"


@query(f"SELECT 't' AS rule_id, count(*) FILTER (WHERE TRY_CAST(v AS DOUBLE) < 10 OR TRY_CAST(v AS DOUBLE) > 90) AS violations_count, count(*) AS denominator_count FROM (SELECT {_TEXT} AS v FROM events)")
def rule_range_text(spark, sf_dir):
    v = F.floor("value").cast("bigint").cast("string")
    df = read(spark, sf_dir, "events").select(F.when(F.col("event_id") % 5 == 0, F.concat(v, F.lit("d"))).when(F.col("event_id") % 5 == 1, F.concat(F.lit(" "), v)).otherwise(v).alias("v"))
    return rules.evaluate(df, [rules.Rule("t", "t", "RANGE", params={"column": "v", "min": 10, "max": 90})]).select("rule_id", "violations_count", "denominator_count")


@query("SELECT 'l' AS rule_id, count(*) FILTER (WHERE event_type = 'click' AND user_id % 2 = 0) AS violations_count, count(*) AS denominator_count FROM events")
def rule_custom_sql_literal(spark, sf_dir):
    df = read(spark, sf_dir, "events").select(F.when(F.col("event_type") == "click", "silver").otherwise("gold").alias("silver"), "user_id")
    rule = rules.Rule("l", "l", "CUSTOM_SQL", sql="SELECT s.* FROM silver s WHERE s.silver = 'silver' AND user_id % 2 = 0")
    return rules.evaluate(df, [rule]).select("rule_id", "violations_count", "denominator_count")


@query("SELECT o_orderstatus, CASE WHEN count(*) FILTER (WHERE o_totalprice > 400000) > 0 THEN 'FAIL_HARD' WHEN count(*) FILTER (WHERE o_totalprice < 1000) > 0.05 * count(*) THEN 'PASS_WITH_WARNINGS' ELSE 'PASS' END AS outcome, CASE WHEN count(*) FILTER (WHERE o_totalprice > 400000) > 0 THEN 'VALIDATION_FAILED' WHEN count(*) FILTER (WHERE o_totalprice < 1000) > 0.05 * count(*) THEN 'VALIDATED_WITH_WARNINGS' ELSE 'VALIDATED' END AS submission_status FROM orders GROUP BY 1")
def validation_outcome(spark, sf_dir):
    counted = read(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count_if(F.col("o_totalprice") > 400000).alias("h"), F.count_if(F.col("o_totalprice") < 1000).alias("s"), F.count("*").alias("denominator_count"))
    kinds = F.array(*(F.struct(F.lit(a).alias("severity"), F.lit(t).alias("threshold_type"), F.lit(x).alias("threshold_value"), F.col(c).alias("violations_count")) for a, t, x, c in (("HARD", "COUNT", 0.0, "h"), ("SOFT", "RATE", 0.05, "s"))))
    return rules.outcome(rules.with_passed(counted.select("o_orderstatus", "denominator_count", F.inline(kinds))), ["o_orderstatus"])


@query("SELECT r.rule_id, r.event_id, r.value FROM (SELECT 'r2' AS rule_id, event_id, value, row_number() OVER (ORDER BY event_id) AS n FROM events WHERE value < 10 OR value > 90 UNION ALL SELECT 'r3', event_id, value, row_number() OVER (ORDER BY event_id) FROM events WHERE event_type = 'error') r WHERE n <= 100")
def violation_samples(spark, sf_dir):
    return rules.samples(read(spark, sf_dir, "events"), _EVENT_RULES[:3], ["event_id"]).select("rule_id", "event_id", "value")


_PART_OVERRIDE = "SELECT p_partkey AS k, CASE WHEN p_size % 2 = 0 THEN 'SOFT' END AS severity_override, CASE WHEN p_size % 3 = 0 THEN CAST(p_size AS DOUBLE) END AS threshold_override FROM part WHERE p_size % 5 <> 0"


@query(f"SELECT p_partkey, coalesce(severity_override, 'HARD') AS severity, coalesce(threshold_override, 0.5) AS threshold FROM part LEFT JOIN ({_PART_OVERRIDE}) o ON p_partkey = k")
def override_resolution(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    given = spark.sql(_PART_OVERRIDE.replace("FROM part", "FROM {part}"), part=part)
    return part.join(given, part["p_partkey"] == given["k"], "left").select("p_partkey", F.coalesce("severity_override", F.lit("HARD")).alias("severity"), F.coalesce("threshold_override", F.lit(0.5)).alias("threshold"))


_SETS = """SELECT 'A' AS rule_set_id, 'medical' AS file_type, CAST(NULL AS STRING) AS layout_version, CAST(NULL AS DATE) AS effective_start, CAST(NULL AS DATE) AS effective_end, 'ACTIVE' AS status
    UNION ALL SELECT 'B', 'medical', 'v1', DATE '1996-01-01', DATE '1997-06-30', 'ACTIVE' UNION ALL SELECT 'C', 'pharmacy', CAST(NULL AS STRING), DATE '1995-03-01', CAST(NULL AS DATE), 'ACTIVE'
    UNION ALL SELECT 'D', 'pharmacy', CAST(NULL AS STRING), DATE '1999-01-01', CAST(NULL AS DATE), 'ACTIVE' UNION ALL SELECT 'E', 'members', 'v1', CAST(NULL AS DATE), CAST(NULL AS DATE), 'RETIRED'"""


@query(f"""{standins.ctes("submission")}, sets AS ({_SETS}), fit AS (SELECT submission_id, rule_set_id, CASE WHEN r.layout_version IS NOT NULL THEN 1 ELSE 3 END AS tier FROM submission s JOIN sets r ON r.file_type = s.file_type AND r.status = 'ACTIVE' AND (r.layout_version IS NULL OR r.layout_version = 'v1')
    AND CAST(s.coverage_start_month || '-01' AS DATE) <= coalesce(effective_end, DATE '9999-12-31') AND last_day(CAST(s.coverage_end_month || '-01' AS DATE)) >= coalesce(effective_start, DATE '0001-01-01')),
    best AS (SELECT submission_id, min(tier) AS tier FROM fit GROUP BY 1), n AS (SELECT submission_id, tier, count(*) AS candidates, min(rule_set_id) AS one FROM fit JOIN best USING (submission_id, tier) GROUP BY 1, 2)
    SELECT s.submission_id, CASE WHEN candidates = 1 THEN one END AS rule_set_id, n.tier, coalesce(candidates, 0) AS candidates FROM submission s LEFT JOIN n ON n.submission_id = s.submission_id""")
def rule_set_resolution(spark, sf_dir):
    s = standins.load(spark, sf_dir)["submission"].withColumn("layout_version", F.lit("v1"))
    return rules.resolve_rule_set(s, spark.sql(_SETS))


# ---- mapping ----------------------------------------------------------------------------------------------------

_PARTY = CanonicalSchema("party/v1", "party", "v1", (CanonicalColumn("id", "TEXT", True), CanonicalColumn("name", "TEXT", True), CanonicalColumn("nation", "BIGINT"), CanonicalColumn("balance", "DOUBLE"), CanonicalColumn("segment", "TEXT"), CanonicalColumn("note", "DATE")))


@query("SELECT 'C' || CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation, c_acctbal * 2 + 1 AS balance, c_mktsegment AS segment, CAST(NULL AS DATE) AS note, 'customer' AS submitter_id FROM customer UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS BIGINT), s_acctbal, 'SUPPLY', CAST(NULL AS DATE), 'supplier' FROM supplier")
def mapping_union(spark, sf_dir):
    one = {"id": {"expr": "'C' || c_custkey"}, "name": {"coalesce": ["no_such", "c_name"]}, "nation": {"source": "C_NATIONKEY", "cast": "BIGINT"}, "balance": {"expr": "c_acctbal * 2 + 1"}, "segment": {"source": "c_mktsegment"}}
    two = {"id": {"source": "s_suppkey"}, "name": {"source": "s_name"}, "nation": {"source": "s_nationkey"}, "balance": {"source": "s_acctbal"}, "segment": {"const": "SUPPLY"}}
    a = canonical.map_to_canonical(read(spark, sf_dir, "customer"), _PARTY, one, {"submitter_id": F.lit("customer")})
    return a.unionByName(canonical.map_to_canonical(read(spark, sf_dir, "supplier"), _PARTY, two, {"submitter_id": F.lit("supplier")}))


_BOOKS = CanonicalSchema("orders/v1", "orders", "v1", (CanonicalColumn("id", "TEXT", True), CanonicalColumn("total", "DOUBLE"), CanonicalColumn("day", "DATE", True), CanonicalColumn("kind", "TEXT")))


@query("SELECT 'F' || CAST(o_orderkey AS VARCHAR) AS id, o_totalprice AS total, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderstatus = 'P' THEN 'partial' ELSE o_orderpriority END AS kind, strftime(o_orderdate, '%Y-%m') AS atomic_month, 'desk' || o_orderstatus AS submitter_id, 's' || o_orderstatus AS source_submission_id FROM orders WHERE strftime(o_orderdate, '%Y-%m') IN ('1996-03', '1996-05')")
def canonical_month_build(spark, sf_dir):
    """Three submitters' tables with months, built onto one schema by two mappings; a build without rows takes April away again."""
    import uuid

    top = (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/") + f"/months-{uuid.uuid4().hex}"
    orders = read(spark, sf_dir, "orders").withColumn("atomic_month", exprs.atomic_month(F.col("o_orderdate"))).where("atomic_month IN ('1996-03', '1996-04', '1996-05')")
    one = {"id": {"expr": "'F' || o_orderkey"}, "total": {"source": "o_totalprice"}, "day": {"source": "o_orderdate", "cast": "DATE"}, "kind": {"coalesce": ["none", "o_orderpriority"]}}
    two = one | {"kind": {"const": "partial"}}
    desks = []
    for status in "FOP":
        orders.where(F.col("o_orderstatus") == status).repartition("atomic_month").write.partitionBy("atomic_month").parquet(f"{top}/{status}")
        desks.append(canonical.Winner(f"desk{status}", f"s{status}", "L2" if status == "P" else "L1", "M", "v1", two if status == "P" else one, f"{top}/{status}"))
    orders.where("atomic_month = '1996-03'").drop("atomic_month").limit(0).write.parquet(f"{top}/none")
    for month in ("1996-03", "1996-04", "1996-05"):
        canonical.build_month(spark, f"{top}/canonical", "TX", "orders", month, _BOOKS, desks, None, F.lit(None).cast("timestamp"))
    nobody = canonical.Winner("desk0", "s0", "L1", "M", "v1", one, f"{top}/none")
    canonical.build_month(spark, f"{top}/canonical", "TX", "orders", "1996-04", _BOOKS, [nobody], None, F.lit(None).cast("timestamp"))
    return spark.read.parquet(f"{top}/canonical").select("id", "total", "day", "kind", "atomic_month", "submitter_id", "source_submission_id")


@query("SELECT n_name, sha256(string_agg(s_name || '|' || CAST(s_suppkey AS VARCHAR), chr(10) ORDER BY s_name || '|' || CAST(s_suppkey AS VARCHAR))) AS fingerprint FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1")
def input_fingerprint(spark, sf_dir):
    j = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name").agg(exprs.fingerprint(F.collect_list(F.concat_ws("|", "s_name", F.col("s_suppkey").cast("string")))).alias("fingerprint"))


@query("WITH a AS (SELECT s_nationkey AS k, sha256(string_agg(s_name, chr(10) ORDER BY s_name)) AS f FROM supplier GROUP BY 1), b AS (SELECT s_nationkey AS k, sha256(string_agg(s_name, chr(10) ORDER BY s_name)) AS f FROM supplier WHERE s_suppkey % 20 <> 0 GROUP BY 1) SELECT a.k AS nationkey, CASE WHEN a.f IS NOT DISTINCT FROM b.f THEN 'SKIPPED' ELSE 'BUILD' END AS decision FROM a LEFT JOIN b ON a.k = b.k")
def rebuild_skip(spark, sf_dir):
    s = read(spark, sf_dir, "supplier")
    mark = lambda df, c: df.groupBy(F.col("s_nationkey").alias("nationkey")).agg(exprs.fingerprint(F.collect_list("s_name")).alias(c))
    j = mark(s, "now").join(mark(s.where("s_suppkey % 20 <> 0"), "then"), "nationkey", "left")
    return j.select("nationkey", F.when(F.col("now").eqNullSafe(F.col("then")), "SKIPPED").otherwise("BUILD").alias("decision"))


# ---- latest, winners, queue -------------------------------------------------------------------------------------


@query("SELECT user_id, ts, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_user(spark, sf_dir):
    return latest_per_key(read(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value"), ["user_id"], ["ts", "event_id"])


_OFFERS = "SELECT o_orderstatus AS state, o_orderpriority AS file_type, strftime(o_orderdate, '%Y-%m') AS atomic_month, o_orderkey AS seq, o_orderkey AS submission_id, o_orderdate AS ts FROM orders"
_RECORDS = f"offers AS ({_OFFERS}), b AS (SELECT *, max(ts) OVER (PARTITION BY state, file_type, atomic_month ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM offers), rec AS (SELECT * FROM b WHERE best IS NULL OR ts > best)"
_KEYS = ["state", "file_type", "atomic_month"]


def _offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.date_format("o_orderdate", "yyyy-MM")
    return read(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("state"), F.col("o_orderpriority").alias("file_type"), month.alias("atomic_month"), F.col("o_orderkey").alias("seq"), F.col("o_orderkey").alias("submission_id"), F.col("o_orderdate").alias("ts"))


@query(f"WITH {_RECORDS} SELECT state, file_type, atomic_month, arg_max(submission_id, ts) AS winning_submission_id, max(ts) AS winner_timestamp FROM rec GROUP BY ALL")
def winner_pointer(spark, sf_dir):
    return winners.resolve(_offers(spark, sf_dir), _KEYS, ["seq"], "ts").drop("replaced_submission_id")


@query(f"WITH {_RECORDS} SELECT state, file_type, atomic_month, submission_id AS winning_submission_id, lag(submission_id) OVER (PARTITION BY state, file_type, atomic_month ORDER BY ts) AS replaced_submission_id FROM rec QUALIFY row_number() OVER (PARTITION BY state, file_type, atomic_month ORDER BY ts DESC) = 1")
def winner_history_replaced(spark, sf_dir):
    return winners.resolve(_offers(spark, sf_dir), _KEYS, ["seq"], "ts").drop("winner_timestamp")


@query(f"WITH {_RECORDS} SELECT state, file_type, atomic_month, count(*) AS changes FROM rec GROUP BY ALL")
def pointer_changes(spark, sf_dir):
    return winners.record_breakers(_offers(spark, sf_dir), _KEYS, ["seq"], "ts").groupBy(*_KEYS).agg(F.count("*").alias("changes"))


@query("SELECT c_nationkey AS nationkey, count(*) AS customers, coalesce(any_value(p.n), 0) AS pending FROM customer LEFT JOIN (SELECT CAST(user_id % 25 AS INTEGER) AS k, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1) p ON c_nationkey = k GROUP BY 1")
def pending_queue(spark, sf_dir):
    pending = read(spark, sf_dir, "events").where("event_type = 'error'").groupBy((F.col("user_id") % 25).cast("int").alias("nationkey")).agg(F.count("*").alias("pending"))
    return read(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count("*").alias("customers")).join(pending, "nationkey", "left").select("nationkey", "customers", F.coalesce("pending", F.lit(0)).alias("pending"))


@query(f"{standins.ctes('canonical_rebuild_queue')} SELECT state, file_type, atomic_month, max(queue_id) AS high_water, count(*) AS events FROM (SELECT * FROM canonical_rebuild_queue WHERE processed_at IS NULL ORDER BY enqueued_at, queue_id LIMIT 250) GROUP BY ALL")
def queue_drain(spark, sf_dir):
    return winners.drain(standins.load(spark, sf_dir)["canonical_rebuild_queue"])


# ---- spine, joins, sets -----------------------------------------------------------------------------------------


@query("SELECT d.day, coalesce(e.n, 0) AS events, coalesce(e.errors, 0) AS errors, coalesce(o.n, 0) AS orders FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT date_trunc('day', min(ts)) - INTERVAL 3 DAY AS lo, date_trunc('day', max(ts)) AS hi FROM events)) d LEFT JOIN (SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1) e ON e.day = d.day LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1) o ON o.day = d.day")
def date_spine_kpis(spark, sf_dir):
    e, o = read(spark, sf_dir, "events"), read(spark, sf_dir, "orders")
    bounds = e.agg(F.date_sub(F.to_date(F.min("ts")), 3).alias("lo"), F.to_date(F.max("ts")).alias("hi"))
    a = e.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("events"), F.count_if(F.col("event_type") == "error").alias("errors"))
    b = o.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("orders"))
    out = serving.spine(spark, F.col("lo"), F.col("hi"), bounds).join(a, "day", "left").join(b, "day", "left")
    return out.select("day", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("events", "errors", "orders")))


@query("SELECT coalesce(c.k, s.k) AS nationkey, coalesce(c.n, 0) AS customers, coalesce(s.n, 0) AS suppliers, n_name FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_nationkey % 3 <> 0 GROUP BY 1) c FULL OUTER JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_nationkey % 4 <> 0 GROUP BY 1) s ON c.k = s.k LEFT JOIN nation ON n_nationkey = coalesce(c.k, s.k)")
def full_outer_coalesce(spark, sf_dir):
    c = read(spark, sf_dir, "customer").where("c_nationkey % 3 <> 0").groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count("*").alias("customers"))
    s = read(spark, sf_dir, "supplier").where("s_nationkey % 4 <> 0").groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count("*").alias("suppliers"))
    n = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_name")
    return c.join(s, "nationkey", "full_outer").join(n, "nationkey", "left").select("nationkey", F.coalesce("customers", F.lit(0)).alias("customers"), F.coalesce("suppliers", F.lit(0)).alias("suppliers"), "n_name")


@query("SELECT 'ORDER' AS event_type, o_orderkey AS id, o_orderdate AS event_at FROM orders UNION ALL SELECT 'SHIP', l_orderkey, coalesce(CASE WHEN l_linenumber = 1 THEN NULL ELSE l_shipdate END, o_orderdate) FROM lineitem JOIN orders ON l_orderkey = o_orderkey UNION ALL SELECT upper(event_type), event_id, ts FROM events")
def timeline_union(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    a = o.select(F.lit("ORDER").alias("event_type"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("event_at"))
    ship = F.coalesce(F.when(F.col("l_linenumber") != 1, F.col("l_shipdate")), F.col("o_orderdate"))
    b = read(spark, sf_dir, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(F.lit("SHIP").alias("event_type"), F.col("l_orderkey").alias("id"), ship.alias("event_at"))
    c = read(spark, sf_dir, "events").select(F.upper("event_type").alias("event_type"), F.col("event_id").alias("id"), F.col("ts").alias("event_at"))
    return a.unionByName(b).unionByName(c)


@query("SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS errors, count(*) AS events, round(100.0 * count(*) FILTER (WHERE event_type = 'error') / count(*), 2) AS failed_pct FROM events GROUP BY 1 ORDER BY errors DESC, user_id LIMIT 50")
def fail_rate_topk(spark, sf_dir):
    bad = F.count_if(F.col("event_type") == "error")
    return read(spark, sf_dir, "events").groupBy("user_id").agg(bad.alias("errors"), F.count("*").alias("events"), exprs.percent(bad, F.count("*")).alias("failed_pct")).orderBy(F.desc("errors"), "user_id").limit(50)


@query("SELECT o_orderpriority, count(*) AS n, CASE WHEN count(*) > 0 THEN CAST(count(*) FILTER (WHERE o_custkey % 3 = 0) AS DOUBLE) / count(*) END AS null_rate FROM orders GROUP BY 1")
def column_health(spark, sf_dir):
    empty = F.count_if(F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")).isNull())
    return read(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"), exprs.safe_ratio(empty, F.count("*")).alias("null_rate"))


# ---- intake -----------------------------------------------------------------------------------------------------


@query(r"SELECT p_partkey, CASE WHEN regexp_matches(f, '(?i)^medical_\d{6}_\d{6}\.(txt|csv|gz)$') THEN 'medical' WHEN regexp_matches(f, '(?i)^pharmacy_\d{6}_\d{6}\.(txt|csv|gz)$') THEN 'pharmacy' ELSE 'unknown' END AS file_type, nullif(regexp_extract(f, '(?i)^(medical|pharmacy)_(\d{6})_\d{6}\.(txt|csv|gz)$', 2), '') AS start_month FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'medical_2024' WHEN 1 THEN 'Pharmacy_2024' WHEN 2 THEN 'notes_2024' ELSE 'medical-2024' END || lpad(CAST(1 + p_size % 12 AS VARCHAR), 2, '0') || '_202412.' || CASE WHEN p_size % 2 = 0 THEN 'csv' ELSE 'GZ' END AS f FROM part)")
def routing_regex(spark, sf_dir):
    kind = F.when(F.col("p_partkey") % 4 == 0, "medical_2024").when(F.col("p_partkey") % 4 == 1, "Pharmacy_2024").when(F.col("p_partkey") % 4 == 2, "notes_2024").otherwise("medical-2024")
    name = F.concat(kind, F.lpad((1 + F.col("p_size") % 12).cast("string"), 2, "0"), F.lit("_202412."), F.when(F.col("p_size") % 2 == 0, "csv").otherwise("GZ"))
    parsed = read(spark, sf_dir, "part").select("p_partkey", intake.filename_columns(name).alias("x"))
    return parsed.select("p_partkey", F.col("x.file_type").alias("file_type"), F.col("x.start").alias("start_month"))


_NOW = "TIMESTAMP_NTZ '2024-02-01 00:00:00'"


@query("SELECT 'inbox/' || p_brand || '/' || CAST(p_partkey AS VARCHAR) AS object_key, CAST(p_size AS BIGINT) + CASE WHEN p_partkey % 7 = 0 AND p_partkey % 11 <> 0 THEN 1 ELSE 0 END AS bytes, p_partkey % 13 = 0 OR (p_partkey % 7 = 0 AND p_partkey % 11 <> 0) AND p_partkey % 11 <> 0 AS changed, CASE WHEN p_partkey % 13 <> 0 AND p_partkey % 5 = 0 THEN 'MOVED' ELSE 'SEEN' END AS status FROM part")
def change_detection(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    key = F.concat(F.lit("inbox/"), F.col("p_brand"), F.lit("/"), F.col("p_partkey").cast("string"))
    t0 = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")
    state = part.where("p_partkey % 13 <> 0").select(key.alias("object_key"), F.col("p_brand").alias("submitter_id"), t0.alias("first_seen_at"), t0.alias("last_seen_at"), t0.alias("last_changed_at"), F.col("p_size").cast("long").alias("bytes"), F.lit("e").alias("etag"), F.when(F.col("p_partkey") % 5 == 0, "MOVED").otherwise("SEEN").alias("status"))
    grown = F.when((F.col("p_partkey") % 7 == 0), 1).otherwise(0)
    listing = part.where("p_partkey % 11 <> 0 OR p_partkey % 13 = 0").select(key.alias("object_key"), (F.col("p_size").cast("long") + F.when(F.col("p_partkey") % 11 != 0, grown).otherwise(0)).alias("bytes"), F.lit("e").alias("etag"))
    return intake.detect_changes(state, listing, F.expr(_NOW)).select("object_key", "bytes", "changed", "status")


@query("WITH o AS (SELECT 'inbox/u' || CAST(user_id % 40 AS VARCHAR) || '/d' || CAST(user_id AS VARCHAR) || '/' || CASE WHEN event_type = 'signup' AND event_id % 3 = 0 THEN '_SUCCESS' ELSE CAST(event_id AS VARCHAR) || '.csv' END AS object_key, max(ts) AS ts FROM events GROUP BY 1), d AS (SELECT *, regexp_extract(object_key, '^(.*/)[^/]*$', 1) AS folder, split_part(object_key, '/', 2) AS submitter_id FROM o WHERE NOT suffix(object_key, '/_SUCCESS')), m AS (SELECT regexp_replace(object_key, '_SUCCESS$', '') AS folder FROM o WHERE suffix(object_key, '/_SUCCESS')) SELECT object_key, submitter_id, CASE WHEN m.folder IS NOT NULL THEN 'MARKER' ELSE 'QUIESCENCE' END AS grouping_method FROM d LEFT JOIN m ON m.folder = d.folder WHERE m.folder IS NOT NULL OR ts <= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 10 MINUTE")
def marker_quiescence(spark, sf_dir):
    last = F.when((F.col("event_type") == "signup") & (F.col("event_id") % 3 == 0), "_SUCCESS").otherwise(F.concat(F.col("event_id").cast("string"), F.lit(".csv")))
    key = F.concat(F.lit("inbox/u"), (F.col("user_id") % 40).cast("string"), F.lit("/d"), F.col("user_id").cast("string"), F.lit("/"), last)
    objects = read(spark, sf_dir, "events").groupBy(key.alias("object_key")).agg(F.max("ts").alias("last_changed_at"))
    objects = objects.withColumns({"last_seen_at": F.col("last_changed_at"), "submitter_id": F.get(F.split("object_key", "/"), F.lit(1)), "status": F.lit("SEEN")})
    return intake.closed_groups(objects, F.expr("TIMESTAMP_NTZ '2024-01-20 00:00:00'")).select("object_key", "submitter_id", "grouping_method")


@query("SELECT strftime(o_orderdate, '%Y-%m') AS atomic_month, count(*) AS n FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1996-04' OR (strftime(o_orderdate, '%Y-%m') = '1996-03' AND o_orderkey % 2 = 0) GROUP BY 1")
def partition_roundtrip(spark, sf_dir):
    """Writes months, replaces one, and reads one back with its partition filter."""
    import uuid

    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/roundtrip-{uuid.uuid4().hex}"
    orders = read(spark, sf_dir, "orders").withColumn("atomic_month", exprs.atomic_month(F.col("o_orderdate")))
    orders.repartition("atomic_month").write.partitionBy("atomic_month").parquet(path)
    march = orders.where("atomic_month = '1996-03' AND o_orderkey % 2 = 0")
    march.repartition("atomic_month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("atomic_month").parquet(path)
    return spark.read.parquet(path).where("atomic_month IN ('1996-03', '1996-04')").groupBy("atomic_month").agg(F.count("*").alias("n"))


#: Formats, and expressions that both engines have for texts in them; months 13 and 14 and short days occur.
_Y, _M, _D = "CAST(year(o_orderdate) AS {t})", "lpad(CAST(month(o_orderdate) + o_orderkey % 3 AS {t}), 2, '0')", "lpad(CAST(day(o_orderdate) AS {t}), 2, '0')"
_DAY = "CAST(day(o_orderdate) AS {t})"
_NAME = "substr('JanFebMarAprMayJunJulAugSepOctNovDec', month(o_orderdate) * 3 - 2, 3)"
_STRPTIME = {
    "%Y%m%d": f"{_Y} || {_M} || {_D}", "%Y%m%d%H%M%S": f"{_Y} || {_M} || {_D} || '2359' || lpad(CAST(o_orderkey % 62 AS {{t}}), 2, '0')", "%Y%j": f"{_Y} || lpad(CAST(1 + o_orderkey % 366 AS {{t}}), 3, '0')", "%Y%m": f"{_Y} || {_M}",
    "%m/%d/%y": f"{_M} || '/' || {_DAY} || '/' || lpad(CAST(o_orderkey % 100 AS {{t}}), 2, '0')", "%d-%b-%Y": f"{_DAY} || '-' || {_NAME} || '-' || {_Y}", "%Y-%m-%d %I:%M %p": f"{_Y} || '-' || {_M} || '-' || {_DAY} || ' ' || CAST(o_orderkey % 14 AS {{t}}) || ':05 ' || CASE WHEN o_orderkey % 2 = 0 THEN 'am' ELSE 'PM' END",
    "%H:%M:%S.%f": "'1:2:3.' || CAST(o_orderkey AS {t})",
}


@query(" UNION ALL ".join(f"SELECT '{f}' AS format, o_orderkey, CAST(try_strptime({x.format(t='VARCHAR')}, '{f}') AS TIMESTAMP) AS at FROM orders" for f, x in _STRPTIME.items()))
def strptime_formats(spark, sf_dir):
    """Dates of eight formats, from one scan. A few MB of orders are many rows to parse, so rows are dealt to all cores first."""
    tasks = max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate").repartition(tasks)
    each = F.array(*(F.struct(F.lit(f).alias("format"), strptime.parse(F.expr(x.format(t="STRING")), f).alias("at")) for f, x in _STRPTIME.items()))
    return orders.select("o_orderkey", F.inline(each))


_NOTE = "CASE WHEN event_id % 3 = 0 THEN event_type || chr(10) || props || ',' || chr(10) WHEN event_id % 3 = 1 THEN '\"' || event_type ELSE event_type END"
NOTES = Layout("notes/v1", "notes", "v1", (LayoutColumn("EVENT", "integer", True), LayoutColumn("NOTE", "string"), LayoutColumn("VALUE", "decimal")))


@query(f"SELECT event_id AS \"EVENT\", {_NOTE} AS \"NOTE\", value AS \"VALUE\" FROM events")
def csv_multiline(spark, sf_dir):
    """Written as CSV with line feeds, quotes and delimiters in fields, and read in splits."""
    import uuid

    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/notes-{uuid.uuid4().hex}"
    events = read(spark, sf_dir, "events").select(F.col("event_id").alias("EVENT"), F.expr(_NOTE).alias("NOTE"), F.col("value").alias("VALUE"))
    events.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return type_columns(scan_csv(spark, [path], NOTES), NOTES).where(F.col(CORRUPT).isNull() & ~F.col("_row_rejected")).select("EVENT", "NOTE", "VALUE")


_RULES = "(1, '*', 'medical', 'medical_', 'csv', 'W', 100), (2, '*', 'pharmacy', '(?i)pharm.*_2024', NULL, 'P', 100), (3, 'u1', 'medical', NULL, 'CSV', 'OWN', 10), (4, 'u2', 'notes', 'notes_20240?[1-6]', NULL, 'N', 5), (5, '*', 'any', NULL, NULL, 'ANY', 500), (6, 'u3', 'medical', 'medical-|Pharmacy_', 'gz', 'X', 1)"
_FILE = "CASE p_partkey % 4 WHEN 0 THEN 'medical_2024' WHEN 1 THEN 'Pharmacy_2024' WHEN 2 THEN 'notes_2024' ELSE 'medical-2024' END || lpad(CAST(1 + p_size % 12 AS {t}), 2, '0') || '.' || CASE WHEN p_size % 2 = 0 THEN 'csv' ELSE 'tar.GZ' END"


@query(f"WITH r(rule_id, rs, rt, pattern, extension, rl, priority) AS (VALUES {_RULES}), f AS (SELECT p_partkey, 'u' || CAST(p_partkey % 5 AS VARCHAR) AS submitter_id, {_FILE.format(t='VARCHAR')} AS filename FROM part) SELECT p_partkey AS group_id, rule_id, rs = submitter_id AS own FROM f JOIN r ON (rs = submitter_id OR rs = '*') AND (extension IS NULL OR suffix(lower(filename), '.' || lower(extension))) AND (pattern IS NULL OR regexp_matches(filename, '^(?:' || pattern || ')'))")
def routing_matches(spark, sf_dir):
    """Files and the rules that match them, by the index of rules."""
    rules_ = spark.sql(f"SELECT * FROM VALUES {_RULES} AS r(rule_id, rs, rt, pattern, extension, rl, priority)")
    files = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("group_id"), F.concat(F.lit("u"), (F.col("p_partkey") % 5).cast("string")).alias("submitter_id"), F.expr(_FILE.format(t="STRING")).alias("filename"))
    return intake._matching(files, rules_).select("group_id", "rule_id", (F.col("rs") == F.col("submitter_id")).alias("own"))


_MAPPINGS = "('L0', 'C', 'm1', 'v2', '{}', 'ACTIVE'), ('L0', 'C', 'm2', 'v10', '{}', 'ACTIVE'), ('L0', 'C', 'm3', 'v11', '{}', 'OLD'), ('L1', 'C', 'm4', 'v1', '{}', 'ACTIVE'), ('L2', 'D', 'm5', 'v3', '{}', 'ACTIVE'), ('L2', 'C', 'm6', 'v9', '{}', 'ACTIVE')"


@query(f"{standins.ctes('submission', 'submitter_month_pointer')}, m(layout_id, canonical_schema_id, mapping_id, mapping_version, mapping_json, status) AS (VALUES {_MAPPINGS}), newest AS (SELECT * FROM m WHERE status = 'ACTIVE' QUALIFY row_number() OVER (PARTITION BY layout_id, canonical_schema_id ORDER BY CAST(substr(mapping_version, 2) AS INTEGER) DESC) = 1) SELECT p.state, p.file_type, p.submitter_id, p.atomic_month, p.winning_submission_id, s.layout_id, n.canonical_schema_id, n.mapping_id, n.mapping_version FROM submitter_month_pointer p JOIN submission s ON s.submission_id = p.winning_submission_id JOIN newest n ON n.layout_id = s.layout_id")
def winner_mappings(spark, sf_dir):
    """Each month's winners with their layout and the newest active mapping of it, versions by number."""
    t = standins.load(spark, sf_dir)
    mappings = spark.sql(f"SELECT *, current_timestamp() AS created_at FROM VALUES {_MAPPINGS} AS m(layout_id, canonical_schema_id, mapping_id, mapping_version, mapping_json, status)")
    return canonical.winners_with_mappings(t["submitter_month_pointer"], t["submission"], mappings).select("state", "file_type", "submitter_id", "atomic_month", "winning_submission_id", "layout_id", "canonical_schema_id", "mapping_id", "mapping_version")


@query("SELECT coalesce(a.k, b.k) AS k, coalesce(a.name, b.name) AS name, CASE WHEN b.k IS NOT NULL THEN b.balance ELSE a.balance END AS balance FROM (SELECT c_custkey AS k, c_name AS name, c_acctbal AS balance FROM customer WHERE c_custkey % 3 <> 0) a FULL JOIN (SELECT c_custkey + 1000000 AS k, c_name AS name, -c_acctbal AS balance FROM customer WHERE c_custkey % 2 = 0) b ON a.name = b.name")
def registry_upsert(spark, sf_dir):
    """Definitions by name: those that are there keep their key and take the new values."""
    c = read(spark, sf_dir, "customer")
    now = c.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    new = c.where("c_custkey % 2 = 0").select((F.col("c_custkey") + 1000000).alias("k"), F.col("c_name").alias("name"), (-F.col("c_acctbal")).alias("balance"))
    return intake.upsert(now, new, ["name"], "k")


_FOLDER = "'inbox/' || p_brand || '/d' || CAST(p_size AS {t})"


@query(f"WITH o AS (SELECT {_FOLDER.format(t='VARCHAR')} AS inbox_prefix, {_FOLDER.format(t='VARCHAR')} || '/' || CAST(p_partkey AS VARCHAR) || '.csv' AS object_key, p_partkey AS bytes, CASE WHEN p_partkey % 9 > 0 THEN 'e' || CAST(p_partkey AS VARCHAR) END AS etag FROM part), g AS (SELECT inbox_prefix, count(*) AS objects, sha256(inbox_prefix || '|' || string_agg(object_key || ':' || CAST(bytes AS VARCHAR) || ':' || coalesce(etag, ''), '|' ORDER BY object_key)) AS fingerprint FROM o GROUP BY 1) SELECT * FROM g WHERE fingerprint NOT IN (SELECT fingerprint FROM g WHERE suffix(inbox_prefix, '7'))")
def new_groups(spark, sf_dir):
    """Closed groups by a fingerprint of their files, without those that a submission has."""
    part = read(spark, sf_dir, "part")
    folder = F.expr(_FOLDER.format(t="STRING"))
    objects = part.select(F.concat(folder, F.lit("/"), F.col("p_partkey").cast("string"), F.lit(".csv")).alias("object_key"), F.col("p_partkey").alias("bytes"), F.when(F.col("p_partkey") % 9 > 0, F.concat(F.lit("e"), F.col("p_partkey").cast("string"))).alias("etag"))
    groups = objects.select("object_key", F.get(F.split("object_key", "/"), F.lit(1)).alias("submitter_id"), F.regexp_replace("object_key", "/[^/]*$", "").alias("inbox_prefix"), F.lit("MARKER").alias("grouping_method"))
    marked = intake.group_fingerprint(groups, objects)
    known = marked.where(F.col("inbox_prefix").endswith("7")).select(F.col("fingerprint").alias("group_fingerprint"))
    return intake.new_groups(marked, known).select("inbox_prefix", F.size("object_keys").cast("long").alias("objects"), "fingerprint")


_WHEN = "CASE event_id % 5 WHEN 0 THEN substr(CAST(ts AS {t}), 1, 19) WHEN 1 THEN replace(substr(CAST(ts AS {t}), 1, 19), ' ', 'T') WHEN 2 THEN substr(CAST(ts AS {t}), 1, 10) WHEN 3 THEN 'on ' || substr(CAST(ts AS {t}), 1, 10) ELSE '2024-02-3' || CAST(event_id % 10 AS {t}) END"


@query(f"SELECT event_id, try_cast({_WHEN.format(t='VARCHAR')} AS TIMESTAMP) AS at FROM events")
def iso_timestamps(spark, sf_dir):
    """Text as a time without a format; what is no date is null."""
    return read(spark, sf_dir, "events").select("event_id", exprs.to_timestamp(F.expr(_WHEN.format(t="STRING"))).alias("at"))


@query(f"{standins.ctes('canonical_rebuild_queue')}, done AS (SELECT state, file_type, atomic_month FROM (SELECT * FROM canonical_rebuild_queue WHERE processed_at IS NULL ORDER BY enqueued_at, queue_id LIMIT 250) GROUP BY ALL) SELECT q.queue_id, q.processed_at IS NOT NULL OR d.state IS NOT NULL AS processed FROM canonical_rebuild_queue q LEFT JOIN done d ON d.state = q.state AND d.file_type = q.file_type AND d.atomic_month = q.atomic_month")
def queue_marked(spark, sf_dir):
    """The queue after its oldest months are done: all their pending events are."""
    queue = standins.load(spark, sf_dir)["canonical_rebuild_queue"].withColumn("processed_at", F.col("processed_at").cast("timestamp_ntz"))
    return winners.mark_processed(queue, winners.drain(queue), F.expr(_NOW)).select("queue_id", F.col("processed_at").isNotNull().alias("processed"))


# ---- serving views and dashboards -------------------------------------------------------------------------------

_SEV = "sev AS (SELECT f.*, r.submission_id, r.rule_set_id, r.started_at AS validation_started_at, r.ended_at AS validation_ended_at, r.status AS validation_run_status, r.outcome AS validation_outcome, k.name AS rule_name, k.rule_kind, coalesce(b.severity_override, k.default_severity) AS severity, coalesce(b.threshold_type_override, k.default_threshold_type) AS threshold_type, coalesce(b.threshold_value_override, k.default_threshold_value) AS threshold_value FROM validation_finding f JOIN validation_run r USING (validation_run_id) JOIN validation_rule k USING (rule_id) LEFT JOIN validation_rule_set_rule b ON b.rule_set_id = r.rule_set_id AND b.rule_id = f.rule_id)"
_VAL = ("validation_finding", "validation_run", "validation_rule", "validation_rule_set_rule")


def _top(table: str, key: str, tie: str) -> str:
    return f"(SELECT * FROM {table} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY started_at DESC, {tie} DESC) = 1)"


_FIND = f"{standins.ctes('submission', *_VAL)}, {_SEV}, found AS (SELECT validation_finding_id, validation_run_id, sev.submission_id, submitter_id, state, file_type, layout_id, rule_set_id, rule_id, rule_name, rule_kind, severity, threshold_type, threshold_value, scope_month, violations_count, denominator_count, violations_rate, passed, NOT passed AS failed, sample_object_key, computed_at, validation_started_at, validation_ended_at, validation_run_status, validation_outcome FROM sev JOIN submission s ON s.submission_id = sev.submission_id)"
_MONTHS = f"lb AS {_top('canonical_month_build', 'state, file_type, atomic_month', 'canonical_month_build_id')}, q AS (SELECT state, file_type, atomic_month, count(*) AS n FROM canonical_rebuild_queue WHERE processed_at IS NULL GROUP BY ALL)"
_CANON = f"{standins.ctes('canonical_month_build', 'canonical_rebuild_queue', 'submitter_month_pointer', 'canonical_schema', 'submission', 'validation_run')}, {_MONTHS}, months AS (SELECT k.state, k.file_type, k.atomic_month, lb.canonical_schema_id, lb.canonical_month_build_id, lb.status AS canonical_latest_status, lb.started_at AS canonical_latest_started_at, lb.ended_at AS canonical_latest_ended_at, lb.input_fingerprint, lb.output_prefix, schema_version AS canonical_schema_version, c.attempts AS canonical_build_attempts, c.successes AS canonical_build_successes, c.last AS last_success_at, coalesce(q.n, 0) AS pending_rebuild_events, coalesce(w.n, 0) AS submitter_winner_count FROM (SELECT state, file_type, atomic_month FROM canonical_month_build UNION SELECT state, file_type, atomic_month FROM submitter_month_pointer) k LEFT JOIN lb USING (state, file_type, atomic_month) LEFT JOIN (SELECT state, file_type, atomic_month, count(*) AS attempts, count(*) FILTER (WHERE status = 'SUCCEEDED') AS successes, max(ended_at) FILTER (WHERE status = 'SUCCEEDED') AS last FROM canonical_month_build GROUP BY ALL) c USING (state, file_type, atomic_month) LEFT JOIN q USING (state, file_type, atomic_month) LEFT JOIN (SELECT state, file_type, atomic_month, count(*) AS n FROM submitter_month_pointer GROUP BY ALL) w USING (state, file_type, atomic_month) LEFT JOIN canonical_schema s ON s.canonical_schema_id = lb.canonical_schema_id), sms AS (SELECT p.*, s.received_at AS winning_submission_received_at, r.outcome AS winning_validation_outcome, r.ended_at AS winning_validation_ended_at, lb.canonical_month_build_id, lb.status AS canonical_latest_status, lb.started_at AS canonical_latest_started_at, lb.ended_at AS canonical_latest_ended_at, coalesce(q.n, 0) AS pending_rebuild_events, coalesce(q.n, 0) > 0 AS canonical_rebuild_pending FROM submitter_month_pointer p LEFT JOIN submission s ON s.submission_id = winning_submission_id LEFT JOIN validation_run r ON r.validation_run_id = winning_validation_run_id LEFT JOIN lb ON lb.state = p.state AND lb.file_type = p.file_type AND lb.atomic_month = p.atomic_month LEFT JOIN q ON q.state = p.state AND q.file_type = p.file_type AND q.atomic_month = p.atomic_month)"

_OVER = f"""{standins.ctes('submission', 'layout_registry', 'parse_run', 'parse_file_metrics', 'submitter_gold_build', 'submitter_month_pointer', *_VAL)}, {_SEV}
    SELECT s.submission_id, submitter_id, state, file_type, s.layout_id, layout_version, coverage_start_month, coverage_end_month, received_at, s.status AS submission_status, p.parse_run_id, p.status AS parse_status, p.started_at AS parse_started_at, p.ended_at AS parse_ended_at,
    CAST(m.a AS BIGINT) AS parse_rows_read, CAST(m.b AS BIGINT) AS parse_rows_written, CAST(m.c AS BIGINT) AS parse_rows_rejected, v.validation_run_id, v.status AS validation_run_status, v.outcome AS validation_outcome, v.started_at AS validation_started_at, v.ended_at AS validation_ended_at, v.total_rows AS validation_total_rows,
    f.h AS hard_failed_rules, f.w AS soft_failed_rules, g.submitter_gold_build_id, g.status AS submitter_gold_status, g.started_at AS submitter_gold_started_at, g.ended_at AS submitter_gold_ended_at, coalesce(n.n, 0) AS months_currently_winning
    FROM submission s LEFT JOIN layout_registry l ON l.layout_id = s.layout_id LEFT JOIN {_top('parse_run', 'submission_id', 'parse_run_id')} p ON p.submission_id = s.submission_id
    LEFT JOIN (SELECT parse_run_id, sum(rows_read) AS a, sum(rows_written) AS b, sum(rows_rejected) AS c FROM parse_file_metrics GROUP BY 1) m ON m.parse_run_id = p.parse_run_id LEFT JOIN {_top('validation_run', 'submission_id', 'validation_run_id')} v ON v.submission_id = s.submission_id
    LEFT JOIN (SELECT validation_run_id, count(*) FILTER (WHERE NOT passed AND severity = 'HARD') AS h, count(*) FILTER (WHERE NOT passed AND severity = 'SOFT') AS w FROM sev GROUP BY 1) f ON f.validation_run_id = v.validation_run_id
    LEFT JOIN {_top('submitter_gold_build', 'submission_id', 'submitter_gold_build_id')} g ON g.submission_id = s.submission_id LEFT JOIN (SELECT winning_submission_id, count(*) AS n FROM submitter_month_pointer GROUP BY 1) n ON n.winning_submission_id = s.submission_id"""

_KPI_PARTS = {"parse_run": ("parse", ("SUCCEEDED", "FAILED")), "submitter_gold_build": ("submitter_gold", ("SUCCEEDED", "FAILED")), "canonical_month_build": ("canonical", ("SUCCEEDED", "SKIPPED", "FAILED"))}
_KPI_JOIN = " ".join(f"LEFT JOIN (SELECT CAST(ended_at AS DATE) AS day, {', '.join(f'''count(*) FILTER (WHERE status = '{s}') AS {p}_{s.lower()}''' for s in states)} FROM {t} WHERE ended_at IS NOT NULL GROUP BY 1) {t}_ ON {t}_.day = d.day" for t, (p, states) in _KPI_PARTS.items())
_KPI_COLUMNS = [f"{p}_{s.lower()}" for p, states in _KPI_PARTS.values() for s in states] + ["submissions_received", "validation_runs_succeeded", "validation_runs_failed", "validation_outcome_pass", "validation_outcome_warn", "validation_outcome_fail_hard"]
_KPIS = f"""{standins.ctes('submission', 'parse_run', 'validation_run', 'submitter_gold_build', 'canonical_month_build')}, kpis AS (SELECT d.day, {', '.join(f'coalesce({c}, 0) AS {c}' for c in _KPI_COLUMNS)}
    FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT date_trunc('day', min(received_at)) AS lo, greatest(date_trunc('day', max(received_at)), TIMESTAMP '1998-01-01') AS hi FROM submission)) d
    LEFT JOIN (SELECT CAST(received_at AS DATE) AS day, count(*) AS submissions_received FROM submission GROUP BY 1) s ON s.day = d.day {_KPI_JOIN}
    LEFT JOIN (SELECT CAST(ended_at AS DATE) AS day, count(*) FILTER (WHERE status = 'SUCCEEDED') AS validation_runs_succeeded, count(*) FILTER (WHERE status = 'FAILED') AS validation_runs_failed, count(*) FILTER (WHERE outcome = 'PASS') AS validation_outcome_pass, count(*) FILTER (WHERE outcome = 'PASS_WITH_WARNINGS') AS validation_outcome_warn, count(*) FILTER (WHERE outcome = 'FAIL_HARD') AS validation_outcome_fail_hard FROM validation_run WHERE ended_at IS NOT NULL GROUP BY 1) v ON v.day = d.day)"""
_TODAY = "DATE '1998-01-01'"


def _view(name: str, sql: str, build: Callable[[dict], DataFrame]) -> None:
    def f(spark, sf_dir):
        return build(standins.load(spark, sf_dir))

    f.__name__ = name
    query(sql)(f)


_REPORT_30 = "validation_ended_at >= TIMESTAMP '1998-01-01' - INTERVAL 30 DAY"
_DAILY_COLUMNS = "day, submissions_received, parse_succeeded, parse_failed, validation_runs_succeeded, validation_runs_failed, canonical_succeeded, canonical_failed, canonical_skipped"
_DAILY = f"SELECT {_DAILY_COLUMNS} FROM kpis WHERE day >= DATE '1998-01-01' - INTERVAL 30 DAY"


def _kpis(t: dict) -> DataFrame:
    return serving.dashboard_kpis_daily(t, F.expr(_TODAY))


_view("view_submission_overview", _OVER, serving.submission_overview)
_view("view_validation_findings", f"{_FIND} SELECT * FROM found", serving.validation_findings)
_view("view_submitter_month_status", f"{_CANON} SELECT * FROM sms", serving.submitter_month_status)
_view("view_canonical_month_status", f"{_CANON} SELECT * FROM months", serving.canonical_month_status)
_view("view_dashboard_kpis_daily", f"{_KPIS} SELECT * FROM kpis", _kpis)
_view("view_parse_column_health", f"{standins.ctes('submission', 'parse_run', 'parse_file_metrics', 'parse_column_metrics')} SELECT c.parse_run_id, p.submission_id, submitter_id, state, file_type, column_name, null_count, invalid_count, CAST(w AS BIGINT) AS rows_written, CASE WHEN w > 0 THEN CAST(null_count AS DOUBLE) / CAST(w AS BIGINT) END AS null_rate, CASE WHEN w > 0 THEN CAST(invalid_count AS DOUBLE) / CAST(w AS BIGINT) END AS invalid_rate FROM parse_column_metrics c JOIN parse_run p USING (parse_run_id) JOIN submission s ON s.submission_id = p.submission_id LEFT JOIN (SELECT parse_run_id, sum(rows_written) AS w FROM parse_file_metrics GROUP BY 1) t USING (parse_run_id)", serving.parse_column_health)
_view("view_validation_summary", f"{standins.ctes('submission', *_VAL)}, {_SEV} SELECT r.validation_run_id, r.submission_id, submitter_id, state, file_type, r.rule_set_id, started_at, ended_at, r.status AS validation_run_status, outcome AS validation_outcome, total_rows, rules_evaluated, rules_passed, rules_failed, hard_rules_failed, soft_rules_failed, total_violations FROM validation_run r JOIN submission s ON s.submission_id = r.submission_id LEFT JOIN (SELECT validation_run_id, count(*) AS rules_evaluated, count(*) FILTER (WHERE passed) AS rules_passed, count(*) FILTER (WHERE NOT passed) AS rules_failed, count(*) FILTER (WHERE NOT passed AND severity = 'HARD') AS hard_rules_failed, count(*) FILTER (WHERE NOT passed AND severity = 'SOFT') AS soft_rules_failed, CAST(sum(violations_count) AS BIGINT) AS total_violations FROM sev GROUP BY 1) f USING (validation_run_id)", serving.validation_summary)
_view("view_submission_timeline", f"{standins.ctes('submission', 'parse_run', 'validation_run', 'submitter_gold_build')}, e AS (SELECT submission_id, 'SUBMISSION_RECEIVED' AS event_type, status AS event_status, received_at AS event_at FROM submission UNION ALL SELECT submission_id, 'PARSE_RUN', status, coalesce(ended_at, started_at) FROM parse_run UNION ALL SELECT submission_id, 'VALIDATION_RUN', coalesce(outcome, status), coalesce(ended_at, started_at) FROM validation_run UNION ALL SELECT submission_id, 'SUBMITTER_GOLD_BUILD', status, coalesce(ended_at, started_at) FROM submitter_gold_build) SELECT e.submission_id, submitter_id, state, file_type, event_type, event_status, event_at FROM e JOIN submission s ON s.submission_id = e.submission_id", serving.submission_timeline)
_view("dash_submission_status", f"{standins.ctes('submission')} SELECT status AS submission_status, count(*) AS submissions FROM submission GROUP BY 1", lambda t: dashboards.submission_status(serving.submission_overview(t)))
_view("dash_daily_kpis", f"{_KPIS} {_DAILY}", lambda t: dashboards.daily_kpis(_kpis(t), F.expr(_TODAY)))
_view("dash_canonical_pending", f"{_CANON} SELECT state, file_type, atomic_month, canonical_latest_status, pending_rebuild_events, canonical_build_attempts, canonical_build_successes, last_success_at FROM months WHERE pending_rebuild_events > 0 OR canonical_latest_status = 'FAILED' ORDER BY pending_rebuild_events DESC, atomic_month DESC, state, file_type LIMIT 200", lambda t: dashboards.canonical_pending(serving.canonical_month_status(t)))
_view("dash_fail_rates", f"{_FIND} SELECT submitter_id, state, file_type, count(*) FILTER (WHERE failed AND severity = 'HARD') AS hard_fail_findings, count(*) FILTER (WHERE failed AND severity = 'SOFT') AS soft_fail_findings, count(*) AS total_findings, round(100.0 * count(*) FILTER (WHERE failed) / count(*), 2) AS failed_pct FROM found WHERE {_REPORT_30} GROUP BY 1, 2, 3 ORDER BY 4 DESC, 5 DESC, 1, 2, 3 LIMIT 200", lambda t: dashboards.fail_rates(serving.validation_findings(t), F.expr(AS_OF)))
_view("dash_top_rules", f"{_FIND} SELECT rule_name, severity, count(*) FILTER (WHERE failed) AS failed_count, count(*) AS evaluated_count, round(100.0 * count(*) FILTER (WHERE failed) / count(*), 2) AS failed_pct FROM found WHERE {_REPORT_30} GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 50", lambda t: dashboards.top_rules(serving.validation_findings(t), F.expr(AS_OF)))
_view("dash_month_control", f"{_CANON} SELECT sms.state, sms.file_type, sms.atomic_month, submitter_id, winning_submission_id, winning_validation_outcome, sms.canonical_latest_status, canonical_rebuild_pending, sms.pending_rebuild_events, canonical_build_attempts, canonical_build_successes, last_success_at FROM sms LEFT JOIN months m ON m.state = sms.state AND m.file_type = sms.file_type AND m.atomic_month = sms.atomic_month ORDER BY 3 DESC, 1, 2, 4 LIMIT 500", lambda t: dashboards.month_control(serving.submitter_month_status(t), serving.canonical_month_status(t)))
_view("dash_alerts", f"{_KPIS}, daily AS ({_DAILY}) SELECT 'Canonical failures in 30d > 0' AS alert, max(canonical_failed) AS value, max(canonical_failed) > 0 AS triggered FROM daily UNION ALL SELECT 'Validation failures in 30d > 0', max(validation_runs_failed), max(validation_runs_failed) > 0 FROM daily", lambda t: dashboards.alerts(dashboards.daily_kpis(_kpis(t), F.expr(_TODAY))))
