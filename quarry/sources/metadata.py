"""The metadata tables as Parquet in an object store: versioned files, a pointer that changes at once, keyed upserts.

A table's state is one folder `<root>/<table>/v<n>`; the file `<root>/<table>/_current` names the one that counts. A write
makes a new folder and then moves the pointer, so readers see the old state or the new one, and a failed write leaves
nothing but a folder that nobody reads. One writer at a time, as the jobs that write here run one after another.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.intake import upsert
from quarry.sources.files import ObjectStore

_RUN = "started_at timestamp, ended_at timestamp, status string"
_MONTH = "state string, file_type string, atomic_month string"
_FILE = "file_type string, status string"

#: Columns of the tables; the first is the key (fixed names).
SCHEMAS = {
    "submitter": "submitter_id string, name string, state string, created_at timestamp",
    "layout_registry": f"layout_id string, submitter_id string, layout_key string, layout_version string, {_FILE}, schema_json string, parser_config_json string, created_at timestamp",
    "submitter_file_config": f"rule_id long, submitter_id string, {_FILE}, pattern string, extension string, layout_id string, priority int",
    "inbox_object": "object_key string, submitter_id string, first_seen_at timestamp, last_seen_at timestamp, last_changed_at timestamp, bytes long, etag string, status string",
    "submission": "submission_id string, submitter_id string, state string, file_type string, layout_id string, layout_version string, coverage_start_month string, coverage_end_month string, received_at timestamp, group_fingerprint string, inbox_prefix string, raw_prefix string, status string",
    "submission_file": "submission_file_id string, submission_id string, raw_object_key string, bytes long, etag string",
    "parse_run": f"parse_run_id string, submission_id string, {_RUN}, error string, report_object_key string, silver_prefix string",
    "parse_file_metrics": "parse_file_metrics_id string, parse_run_id string, raw_object_key string, rows_read long, rows_written long, rows_rejected long",
    "parse_column_metrics": "parse_column_metrics_id string, parse_run_id string, column_name string, null_count long, invalid_count long",
    "validation_rule": "rule_id string, name string, rule_kind string, default_severity string, default_threshold_type string, default_threshold_value double, params_json string, sql_text string",
    "validation_rule_set": "rule_set_id string, name string, file_type string, layout_version string, effective_start date, effective_end date, status string",
    "validation_rule_set_rule": "rule_set_rule_id string, rule_set_id string, rule_id string, enabled boolean, severity_override string, threshold_type_override string, threshold_value_override double, params_override_json string",
    "validation_run": f"validation_run_id string, submission_id string, rule_set_id string, {_RUN}, outcome string, total_rows long, report_object_key string, error string",
    "validation_finding": "validation_finding_id string, validation_run_id string, rule_id string, scope_month string, violations_count long, denominator_count long, violations_rate double, passed boolean, sample_object_key string, computed_at timestamp",
    "submitter_gold_build": f"submitter_gold_build_id string, submission_id string, {_RUN}, error string",
    "submitter_month_pointer": f"pointer_id string, {_MONTH}, submitter_id string, winning_submission_id string, replaced_submission_id string, winning_validation_run_id string, winner_timestamp timestamp, updated_at timestamp, reason string",
    "canonical_rebuild_queue": f"queue_id long, {_MONTH}, enqueued_at timestamp, reason string, processed_at timestamp",
    "canonical_schema": f"canonical_schema_id string, schema_version string, {_FILE}, schema_json string",
    "canonical_mapping": "mapping_id string, layout_id string, canonical_schema_id string, mapping_version string, status string, mapping_json string, created_at timestamp",
    "canonical_month_build": f"canonical_month_build_id string, {_MONTH}, canonical_schema_id string, {_RUN}, input_fingerprint string, output_prefix string, error string",
    "heartbeat": "heartbeat_id string, service string, beat_at timestamp",
    "job_run": "run_key string, job string, done_at timestamp",
}


class Metadata:
    """Read, replace, append to and upsert into the tables under a root that Hadoop's file systems reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.store = ObjectStore(spark, self.root)

    def _version(self, table: str) -> int:
        key = f"{table}/_current"
        return int(self.store.get(key)) if self.store.exists(key) else 0

    def read(self, table: str) -> DataFrame:
        """The table as it is now; one that was never written is empty."""
        version = self._version(table)
        if not version:
            return self.spark.createDataFrame([], SCHEMAS[table])
        return self.spark.read.schema(SCHEMAS[table]).parquet(f"{self.root}/{table}/v{version}")

    def replace(self, table: str, rows: DataFrame) -> None:
        """`rows` become the table; columns that they lack are null, others are dropped. The state before is kept until the next write."""
        version = self._version(table)
        empty = self.spark.createDataFrame([], SCHEMAS[table])
        out = rows.select(*(F.col(c).cast(t).alias(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in empty.dtypes))
        out.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.root}/{table}/v{version + 1}")
        self.store.put(f"{table}/_current", str(version + 1).encode())
        if version > 1:
            self.store.delete(f"{table}/v{version - 1}")

    def rows(self, table: str, rows: list[dict]) -> DataFrame:
        """A frame of the table's columns."""
        schema = self.spark.createDataFrame([], SCHEMAS[table]).schema
        return self.spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)

    def append(self, table: str, rows: list[dict]) -> None:
        if rows:
            self.replace(table, self.read(table).unionByName(self.rows(table, rows)))

    def sync(self, table: str, rows: list[dict], identity: list[str]) -> None:
        """Definitions replace those of equal identity, which keep their key; the same rows again change nothing."""
        key = self.read(table).columns[0]
        self.replace(table, upsert(self.read(table), self.rows(table, rows), identity, key))

    def seed(self, table: str, rows: list[dict], name: str = "name") -> None:
        """Adds the rows whose name is not there yet."""
        new = self.rows(table, rows)
        self.replace(table, self.read(table).unionByName(new.join(self.read(table).select(name), name, "left_anti").select(*new.columns)))

    def update(self, table: str, changes: dict[str, dict]) -> None:
        """Given columns of the rows of given keys."""
        df = self.read(table)
        key = df.columns[0]
        names = sorted({c for x in changes.values() for c in x})
        for c in names:
            cases = [(k, x[c]) for k, x in changes.items() if c in x]
            df = df.withColumn(c, reduce(lambda out, kv: F.when(F.col(key) == kv[0], F.lit(kv[1])).otherwise(out), cases, F.col(c)))
        self.replace(table, df)
