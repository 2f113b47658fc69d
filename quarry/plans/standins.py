"""Metadata tables made from the star-schema tables, by SQL that Spark and DuckDB both run.

They exist so that the serving views and the set-based operators can be run, checked and timed on real volumes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_TYPE = "CASE {0} % 3 WHEN 0 THEN 'medical' WHEN 1 THEN 'pharmacy' ELSE 'members' END"
_STATE = "CASE {0} % 4 WHEN 0 THEN 'TX' WHEN 1 THEN 'CA' WHEN 2 THEN 'NY' ELSE 'OH' END"
_RUNS = "SELECT l_orderkey, l_linenumber, min(l_shipdate) AS t0, max(l_shipdate) AS t1, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber"
_ID = "'{0}' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"

TABLES = {
    "submission": f"""SELECT 's' || CAST(o_orderkey AS STRING) AS submission_id, 'c' || CAST(o_custkey % 50 AS STRING) AS submitter_id, {_STATE.format('o_custkey')} AS state, {_TYPE.format('o_custkey')} AS file_type,
        'L' || CAST(o_custkey % 3 AS STRING) AS layout_id, substr(CAST(o_orderdate AS STRING), 1, 7) AS coverage_start_month, substr(CAST(o_orderdate AS STRING), 1, 7) AS coverage_end_month, o_orderdate AS received_at,
        CASE o_orderstatus WHEN 'F' THEN 'VALIDATED' WHEN 'O' THEN 'PARSED' ELSE 'READY_FOR_PARSE' END AS status FROM orders""",
    "layout_registry": "SELECT 'L0' AS layout_id, 'v1' AS layout_version UNION ALL SELECT 'L1', 'v2'",
    "parse_run": f"SELECT {_ID.format('p')} AS parse_run_id, 's' || CAST(l_orderkey AS STRING) AS submission_id, t0 AS started_at, CASE WHEN l_linenumber = 2 THEN NULL ELSE t1 END AS ended_at, CASE WHEN l_orderkey % 7 = 0 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status FROM ({_RUNS}) r WHERE l_linenumber <= 3",
    "parse_file_metrics": f"SELECT {_ID.format('p')} AS parse_run_id, CAST(l_quantity AS BIGINT) AS rows_read, CAST(l_quantity AS BIGINT) - CAST(l_suppkey % 2 AS BIGINT) AS rows_written, CAST(l_suppkey % 2 AS BIGINT) AS rows_rejected FROM lineitem WHERE l_linenumber <= 3",
    "parse_column_metrics": f"SELECT {_ID.format('p')} AS parse_run_id, c.column_name, CAST((l_orderkey + c.k) % 5 AS BIGINT) AS null_count, CAST((l_orderkey * c.k) % 3 AS BIGINT) AS invalid_count FROM ({_RUNS}) r JOIN (SELECT 'START' AS column_name, 1 AS k UNION ALL SELECT 'STOP', 2) c ON l_linenumber <= 3",
    "validation_run": f"SELECT {_ID.format('v')} AS validation_run_id, 's' || CAST(l_orderkey AS STRING) AS submission_id, 'R' || CAST(l_orderkey % 2 AS STRING) AS rule_set_id, t0 AS started_at, t1 AS ended_at, CASE WHEN l_orderkey % 11 = 0 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status, CASE l_orderkey % 3 WHEN 0 THEN 'PASS' WHEN 1 THEN 'FAIL_HARD' ELSE 'PASS_WITH_WARNINGS' END AS outcome, n * 100 AS total_rows FROM ({_RUNS}) r WHERE l_linenumber BETWEEN 3 AND 5",
    "validation_rule": "SELECT 'k1' AS rule_id, 'patient_not_null' AS name, 'NOT_NULL' AS rule_kind, 'HARD' AS default_severity, 'COUNT' AS default_threshold_type, CAST(0 AS DOUBLE) AS default_threshold_value UNION ALL SELECT 'k2', 'code_in_range', 'RANGE', 'SOFT', 'RATE', CAST(0.01 AS DOUBLE)",
    "validation_rule_set_rule": "SELECT 'R0' AS rule_set_id, 'k1' AS rule_id, 'SOFT' AS severity_override, CAST(NULL AS STRING) AS threshold_type_override, CAST(5 AS DOUBLE) AS threshold_value_override",
    "validation_finding": f"SELECT {_ID.format('v')} AS validation_run_id, k.rule_id, {_ID.format('f')} || k.rule_id AS validation_finding_id, CAST(NULL AS STRING) AS scope_month, CAST(l_orderkey % 9 AS BIGINT) AS violations_count, n * 100 AS denominator_count, CAST(l_orderkey % 9 AS DOUBLE) / (n * 100) AS violations_rate, (l_orderkey + k.j) % 4 <> 0 AS passed, CAST(NULL AS STRING) AS sample_object_key, t1 AS computed_at FROM ({_RUNS}) r JOIN (SELECT 'k1' AS rule_id, 1 AS j UNION ALL SELECT 'k2', 2) k ON l_linenumber BETWEEN 3 AND 5",
    "submitter_gold_build": f"SELECT {_ID.format('g')} AS submitter_gold_build_id, 's' || CAST(l_orderkey AS STRING) AS submission_id, t0 AS started_at, t1 AS ended_at, CASE WHEN l_orderkey % 13 = 0 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status FROM ({_RUNS}) r WHERE l_linenumber IN (1, 6)",
    "submitter_month_pointer": f"""SELECT {_STATE.format('o_custkey')} AS state, {_TYPE.format('o_custkey')} AS file_type, 'c' || CAST(o_custkey % 50 AS STRING) AS submitter_id, substr(CAST(o_orderdate AS STRING), 1, 7) AS atomic_month,
        max('s' || CAST(o_orderkey AS STRING)) AS winning_submission_id, min('s' || CAST(o_orderkey AS STRING)) AS replaced_submission_id, max('v' || CAST(o_orderkey AS STRING) || '-3') AS winning_validation_run_id,
        max(o_orderdate) AS winner_timestamp, max(o_orderdate) AS updated_at, 'newer' AS reason FROM orders GROUP BY 1, 2, 3, 4""",
    "canonical_month_build": f"""SELECT 'b' || CAST(o_orderkey AS STRING) AS canonical_month_build_id, {_STATE.format('o_custkey')} AS state, {_TYPE.format('o_custkey')} AS file_type, substr(CAST(o_orderdate AS STRING), 1, 7) AS atomic_month, 'C' || CAST(o_custkey % 3 AS STRING) AS canonical_schema_id,
        o_orderdate AS started_at, o_orderdate AS ended_at, CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' WHEN 'O' THEN 'SKIPPED' ELSE 'FAILED' END AS status, 'fp' || CAST(o_custkey AS STRING) AS input_fingerprint, 'gold' AS output_prefix FROM orders WHERE o_custkey % 5 <> 0""",
    "canonical_rebuild_queue": f"SELECT event_id AS queue_id, {_STATE.format('user_id')} AS state, {_TYPE.format('user_id')} AS file_type, '1996-0' || CAST(1 + event_id % 9 AS STRING) AS atomic_month, ts AS enqueued_at, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS processed_at FROM events",
    "canonical_schema": "SELECT 'C0' AS canonical_schema_id, 'v1' AS schema_version UNION ALL SELECT 'C1', 'v1'",
}

SOURCES = ("orders", "lineitem", "events")


class Tables(dict):
    """The tables by name, each made when it is first asked for; all of them if all are asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._sf_dir, self._sources = spark, sf_dir, {}

    def _source(self, name: str) -> DataFrame:
        if name not in self._sources:
            self._sources[name] = self._spark.read.parquet(f"{self._sf_dir}/{name}.parquet")
        return self._sources[name]

    def __missing__(self, name: str) -> DataFrame:
        sql = TABLES[name]
        used = {n: self._source(n) for n in SOURCES if f"FROM {n}" in sql}
        for n in used:
            sql = sql.replace(f"FROM {n}", f"FROM {{{n}}}")
        self[name] = self._spark.sql(sql, **used)
        return self[name]

    def _all(self) -> dict[str, DataFrame]:
        return {n: self[n] for n in TABLES}

    def items(self):
        return self._all().items()

    def values(self):
        return self._all().values()

    def __iter__(self):
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)


def load(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def ctes(*names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({TABLES[n]})" for n in names)
