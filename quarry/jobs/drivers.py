"""Jobs over the metadata store: inbox to submissions, parse, validate, merge into submitters' months, canonical builds.

Each job takes what is due, oldest first, and records a run for each piece of work. What is due follows from a submission's
status, which is written behind the work and its run: a job that broke off anywhere is started again with the same work,
whose writes of data replace what is there. A submission is recorded before its objects are moved, and a sweep first
ends the moves that an earlier one began. One submission that fails has its error in its run, stops no other, and
comes behind those that have failed less often. Sizes of batches are those of the pickers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.exprs import UNKNOWN_MONTH
from quarry.operators import canonical, intake, parse, rules, winners
from quarry.operators.latest import latest_per_key
from quarry.plans import serving
from quarry.sources.files import ObjectStore, discover_months, scan_months
from quarry.sources.layouts import CanonicalColumn, CanonicalSchema, Layout, layout_from
from quarry.sources.metadata import Metadata
from quarry.streaming.inbox import due, run_key

POINTER = ["state", "file_type", "submitter_id", "atomic_month"]
RECEIVING = "RECEIVING"
VALID = ("VALIDATED", "VALIDATED_WITH_WARNINGS")


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def load_rules(meta: Metadata, rule_set_id: str) -> list[rules.Rule]:
    """The enabled rules that a set binds, with its overrides, in order of names."""
    bound = meta.read("validation_rule_set_rule").where((F.col("rule_set_id") == rule_set_id) & F.coalesce("enabled", F.lit(True)))
    rows = bound.drop("rule_set_id", "enabled").join(meta.read("validation_rule"), "rule_id").orderBy("name", "rule_id").collect()  # definitions, not data
    out = []
    for r in rows:
        params = json.loads(r["params_json"] or "{}")
        rule = rules.Rule(r["rule_id"], r["name"], r["rule_kind"], r["default_severity"], r["default_threshold_type"], r["default_threshold_value"] or 0.0, params, r["sql_text"] or params.get("sql"))
        out.append(rule.override(r["severity_override"], r["threshold_type_override"], r["threshold_value_override"], r["params_override_json"]))
    return out


def seed_rule_set(meta: Metadata, name: str = "default", file_type: str = "medical", given: tuple[rules.Rule, ...] = rules.DEFAULT_RULES) -> None:
    """The rules of a fresh installation and a set that binds them all; what is there by name stays as it is."""
    meta.seed("validation_rule", [
        {"rule_id": r.rule_id, "name": r.name, "rule_kind": r.kind, "default_severity": r.severity, "default_threshold_type": r.threshold_type, "default_threshold_value": float(r.threshold), "params_json": json.dumps(r.params), "sql_text": r.sql}
        for r in given
    ])
    meta.seed("validation_rule_set", [{"rule_set_id": f"{name}/{file_type}", "name": f"{name}/{file_type}", "file_type": file_type, "status": "ACTIVE"}])
    meta.seed("validation_rule_set_rule", [{"rule_set_rule_id": f"{name}/{file_type}/{r.rule_id}", "rule_set_id": f"{name}/{file_type}", "rule_id": r.rule_id, "enabled": True} for r in given], "rule_set_rule_id")


def sync_layouts(meta: Metadata, definitions: list[dict], now: datetime) -> None:
    """Layout definitions (schema and parser configuration) to the registry, by submitter, type, key and version."""
    rows = []
    for d in definitions:
        x = layout_from(d)
        rows.append({"layout_id": x.layout_id, "submitter_id": x.submitter_id, "layout_key": x.key, "layout_version": x.version, "file_type": x.file_type, "status": x.status, "schema_json": json.dumps(d["schema"]), "parser_config_json": json.dumps(d["parser_config"]), "created_at": now})
    meta.sync("layout_registry", rows, ["submitter_id", "file_type", "layout_key", "layout_version"])


def sync_file_config(meta: Metadata, configs: list[dict]) -> None:
    """Routing rules, by submitter, type, pattern, extension and layout."""
    meta.sync("submitter_file_config", [{"status": "ACTIVE", "priority": 100} | c for c in configs], ["submitter_id", "file_type", "pattern", "extension", "layout_id"])


def sync_canonical(meta: Metadata, schemas: list[CanonicalSchema], mappings: list[dict], now: datetime) -> None:
    """Canonical schemas by type and version, mappings by layout, schema and version."""
    to_json = lambda s: json.dumps([[c.name, c.type, c.required] for c in s.columns])
    meta.sync("canonical_schema", [{"canonical_schema_id": s.schema_id, "schema_version": s.version, "file_type": s.file_type, "status": "ACTIVE", "schema_json": to_json(s)} for s in schemas], ["file_type", "schema_version"])
    meta.sync("canonical_mapping", [
        {"mapping_id": m["mapping_id"], "layout_id": m["layout_id"], "canonical_schema_id": m["canonical_schema_id"], "mapping_version": m.get("mapping_version", "v1"), "status": m.get("status", "ACTIVE"), "mapping_json": json.dumps(m["mapping"]), "created_at": now}
        for m in mappings
    ], ["layout_id", "canonical_schema_id", "mapping_version"])


def heartbeat(meta: Metadata, service: str = "engine", now: Callable[[], datetime] = utc_now) -> None:
    """Shows that store and metadata can be written: a row, and an object to read back."""
    meta.append("heartbeat", [{"heartbeat_id": uuid.uuid4().hex, "service": service, "beat_at": now()}])
    meta.store.put(f"health/{service}.txt", b"hello")


@dataclass
class Jobs:
    """`root` holds inbox/, raw/, silver/, gold/, canonical/ and reports/ on any file system that Spark reaches."""

    spark: SparkSession
    meta: Metadata
    root: str
    now: Callable[[], datetime] = utc_now
    store: ObjectStore = field(init=False)

    def __post_init__(self) -> None:
        self.root = self.root.rstrip("/")
        self.store = ObjectStore(self.spark, self.root)

    def _at(self):
        return F.lit(self.now())

    # --- inbox

    def sweep(self, quiet_minutes: int = intake.QUIET_MINUTES) -> list[str]:
        """Lists the inbox, records what changed, and makes a submission of each closed group that is new.

        Changes are told by size and etag against the last listing, so an object that comes late with an old time counts.
        Submissions whose objects an earlier sweep has not moved to the end come first.
        """
        for r in self.meta.read("submission").where(F.col("status") == RECEIVING).collect():
            self._receive(r.asDict())
        listing = self.spark.createDataFrame([(o["object_key"], o["bytes"], o["etag"]) for o in self.store.list("inbox")], "object_key string, bytes long, etag string")
        self.meta.replace("inbox_object", intake.detect_changes(self.meta.read("inbox_object"), listing, self._at()))
        objects = self.meta.read("inbox_object")
        groups = intake.group_fingerprint(intake.closed_groups(objects, self._at(), quiet_minutes), objects)
        made = []
        for g in intake.new_groups(groups, self.meta.read("submission")).orderBy("inbox_prefix").collect():
            files = self.spark.createDataFrame([("g", g["submitter_id"], k.rsplit("/", 1)[-1]) for k in g["object_keys"]], "group_id string, submitter_id string, filename string")
            routed = intake.route(files, self.meta.read("submitter_file_config"), self.meta.read("layout_registry")).first()
            layout = self.meta.read("layout_registry").where(F.col("layout_id") == routed["layout_id"]).select("layout_version").first() if routed["layout_id"] else None
            state = self.meta.read("submitter").where(F.col("submitter_id") == g["submitter_id"]).select("state").first()
            new = self._inbox(g["fingerprint"]).plan(g["submitter_id"], g["inbox_prefix"], g["object_keys"], routed["file_type"], g["fingerprint"], self.now().isoformat())
            row = {k: v for k, v in new.items() if k not in ("files", "received_at")} | {
                "file_type": routed["file_type"], "layout_id": routed["layout_id"], "layout_version": layout[0] if layout else None, "received_at": self.now(), "group_fingerprint": g["fingerprint"],
                "inbox_prefix": g["inbox_prefix"], "submitter_id": g["submitter_id"], "state": state[0] if state else None, "status": RECEIVING,
            }
            self.meta.append("submission", [row])
            self._receive(row)
            made.append(row["submission_id"])
        return made

    def _inbox(self, fingerprint: str) -> intake.Inbox:
        return intake.Inbox(self.store, lambda: fingerprint[:32])

    def _receive(self, row: dict) -> None:
        """Moves a recorded submission's objects and makes it ready; what of it is done already is not done again."""
        sid, raw = row["submission_id"], row["raw_prefix"]
        keys = self.spark.createDataFrame([(k,) for k in self._inbox(sid).move(raw)], "object_key string")
        found = self.store.list(f"{raw}/data")
        old = self.meta.read("submission_file").where(F.col("submission_id") != sid)
        self.meta.replace("submission_file", old.unionByName(self.meta.rows("submission_file", [{"submission_file_id": f"{sid}-{i}", "submission_id": sid, "raw_object_key": o["object_key"], "bytes": o["bytes"], "etag": o["etag"]} for i, o in enumerate(found)])))
        self.meta.replace("inbox_object", intake.claim(self.meta.read("inbox_object"), keys, "MOVED"))
        self.meta.update("submission", {sid: {"status": "READY_FOR_PARSE" if row["layout_id"] else "NEEDS_REVIEW"}})

    def _each(self, job: str, table: str, id_column: str, statuses: tuple[str, ...], failed: str | None, batch: int, work: Callable[[dict, str], dict], done: DataFrame | None = None) -> list[str]:
        """Runs `work` over due submissions: a run row for each, its error if it fails, and behind it the submission's new status."""
        out = []
        runs = self.meta.read(table).where("status = 'FAILED'").select("submission_id")
        for s in due(self.meta.read("submission"), statuses, done, batch, runs).collect():  # at most a batch
            s, run = s.asDict(), uuid.uuid4().hex
            started = self.now()
            entry = {id_column: run, "submission_id": s["submission_id"], "started_at": started}
            try:
                status = work(s, run)
                entry |= {"ended_at": self.now(), "status": "SUCCEEDED"} | status.pop("run", {})
            except Exception as e:  # noqa: BLE001 - recorded with its run
                entry |= {"ended_at": self.now(), "status": "FAILED", "error": str(e)[:2000]}
                status = {"status": failed} if failed else {}
            self.meta.append(table, [entry])
            if status:
                self.meta.update("submission", {s["submission_id"]: status})
            self.meta.append("job_run", [{"run_key": run_key(job, [s["submission_id"], run]), "job": job, "done_at": self.now()}])
            out.append(s["submission_id"])
        return out

    # --- parse, validate, merge

    def layout(self, layout_id: str) -> Layout:
        r = self.meta.read("layout_registry").where(F.col("layout_id") == layout_id).first()
        return layout_from({"layout_id": layout_id, "submitter_id": r["submitter_id"], "layout_key": r["layout_key"], "layout_version": r["layout_version"], "file_type": r["file_type"], "schema": json.loads(r["schema_json"]), "parser_config": json.loads(r["parser_config_json"])})

    def silver(self, s: dict) -> str:
        return f"{self.root}/silver/{s['submitter_id']}/{s['file_type']}/{s['submission_id']}"

    def parse_due(self, batch: int = 25) -> list[str]:
        def work(s: dict, run: str) -> dict:
            files = self.meta.read("submission_file").where(F.col("submission_id") == s["submission_id"]).orderBy("raw_object_key").collect()
            key = f"reports/parse/{run}.json"
            got = parse.parse_to_silver(self.spark, [f"{self.root}/{f['raw_object_key']}" for f in files], self.layout(s["layout_id"]), self.silver(s), s["submission_id"], self.now(), f"{self.root}/rejected/{s['submission_id']}", (self.store, key))
            counts = ("rows_read", "rows_written", "rows_rejected")
            self.meta.append("parse_file_metrics", [{"parse_file_metrics_id": f"{run}-{i}", "parse_run_id": run, "raw_object_key": f["raw_object_key"]} | {c: f[c] for c in counts} for i, f in enumerate(got.files)])
            self.meta.append("parse_column_metrics", [{"parse_column_metrics_id": f"{run}-{i}", "parse_run_id": run} | c for i, c in enumerate(got.columns)])
            return {"status": "PARSED", "run": {"report_object_key": key, "silver_prefix": self.silver(s)}}

        return self._each("parse", "parse_run", "parse_run_id", ("READY_FOR_PARSE",), "PARSE_FAILED", batch, work)

    def validate_due(self, batch: int = 25) -> list[str]:
        def work(s: dict, run: str) -> dict:
            chosen = rules.resolve_rule_set(self.meta.read("submission").where(F.col("submission_id") == s["submission_id"]), self.meta.read("validation_rule_set")).first()
            if not chosen["rule_set_id"]:
                raise ValueError(f"{chosen['candidates']} rule sets fit")
            key = f"reports/validation/{run}.json"
            samples = f"samples/{run}"
            found = rules.validate(self.spark, self.spark.read.parquet(self.silver(s)), load_rules(self.meta, chosen["rule_set_id"]), f"{self.root}/{samples}", None, (self.store, key))
            now = self.now()
            self.meta.append("validation_finding", [
                {k: f[k] for k in ("rule_id", "violations_count", "denominator_count", "violations_rate", "passed")}
                | {"validation_finding_id": f"{run}-{i}", "validation_run_id": run, "computed_at": now, "sample_object_key": f"{samples}/rule_id={f['rule_id']}" if f["violations_count"] else None}
                for i, f in enumerate(found["findings"])
            ])
            return {"status": found["submission_status"], "run": {"rule_set_id": chosen["rule_set_id"], "outcome": found["outcome"], "total_rows": found["total_rows"], "report_object_key": key}}

        return self._each("validate", "validation_run", "validation_run_id", ("PARSED",), None, batch, work)

    def gold(self, state: str, file_type: str, submitter_id: str) -> str:
        return f"{self.root}/gold/{state}/{file_type}/{submitter_id}"

    def merge_due(self, batch: int = 25) -> list[str]:
        """Offers a validated submission's months; where it wins, its rows replace the month and a rebuild is queued."""

        def work(s: dict, run: str) -> dict:
            state = s["state"] or UNKNOWN_MONTH
            silver = scan_months(self.spark, self.silver(s))
            months = discover_months(silver)
            last = latest_per_key(self.meta.read("validation_run").where((F.col("submission_id") == s["submission_id"]) & (F.col("status") == "SUCCEEDED")), ["submission_id"], ["ended_at"]).first()
            offers = self.spark.createDataFrame([(state, s["file_type"], s["submitter_id"], m, s["submission_id"], (last["ended_at"] if last else None) or s["received_at"], 0) for m in months], "state string, file_type string, submitter_id string, atomic_month string, submission_id string, winner_timestamp timestamp, n int")
            pointers = self.meta.read("submitter_month_pointer")
            merged, changed = winners.merge(pointers, offers, POINTER, ["n"])
            won = sorted(r["atomic_month"] for r in changed.collect())
            if not won:
                return {}
            winners.overwrite_months(silver, self.gold(state, s["file_type"], s["submitter_id"]), None if won == ["__all__"] else won, s["submitter_id"], state, s["file_type"], self._at())
            own = F.col("winning_submission_id") == s["submission_id"]
            kept = pointers.select(*POINTER, "pointer_id", F.col("winning_validation_run_id").alias("_run"), F.col("updated_at").alias("_at"), F.col("reason").alias("_why"))
            out = merged.join(kept, POINTER, "left").withColumns({
                "pointer_id": F.coalesce("pointer_id", F.concat_ws("/", *POINTER)), "winning_validation_run_id": F.when(own, F.lit(last["validation_run_id"] if last else None)).otherwise(F.col("_run")),
                "updated_at": F.when(own, self._at()).otherwise(F.col("_at")), "reason": F.when(own, "newer").otherwise(F.col("_why")),
            })
            queue = winners.enqueue(self.meta.read("canonical_rebuild_queue"), changed, self._at(), "winner_changed")
            self.meta.replace("canonical_rebuild_queue", queue)
            self.meta.replace("submitter_month_pointer", out)
            return {}

        done = self.meta.read("submitter_gold_build").where("status = 'SUCCEEDED'")
        return self._each("merge", "submitter_gold_build", "submitter_gold_build_id", VALID, None, batch, work, done)

    # --- canonical months

    def rebuild_due(self, most: int = 250) -> list[tuple[str, str, str, str]]:
        """(state, file_type, month, status) of the queue's oldest months; unchanged inputs are skipped by fingerprint."""
        todo = winners.drain(self.meta.read("canonical_rebuild_queue"), most)
        out = []
        for m in todo.orderBy("high_water").collect():
            state, file_type, month = m["state"], m["file_type"], m["atomic_month"]
            entry = {"canonical_month_build_id": uuid.uuid4().hex, "state": state, "file_type": file_type, "atomic_month": month, "started_at": self.now(), "output_prefix": f"canonical/{state}/{file_type}"}
            try:
                entry |= self._build(state, file_type, month)
            except Exception as e:  # noqa: BLE001 - recorded with its build
                entry |= {"status": "FAILED", "error": str(e)[:2000]}
            self.meta.append("canonical_month_build", [entry | {"ended_at": self.now()}])
            key = run_key("rebuild", [state, file_type, month], m["high_water"])
            self.meta.append("job_run", [{"run_key": key, "job": "rebuild", "done_at": self.now()}])
            out.append((state, file_type, month, entry["status"]))
        if out:
            done = self.spark.createDataFrame([x[:3] for x in out], "state string, file_type string, atomic_month string")
            self.meta.replace("canonical_rebuild_queue", winners.mark_processed(self.meta.read("canonical_rebuild_queue"), done, self._at()))
        return out

    def _build(self, state: str, file_type: str, month: str) -> dict:
        r = canonical.latest_schema(self.meta.read("canonical_schema"), file_type).first()
        if r is None:
            raise ValueError(f"no active schema of {file_type}")
        schema = CanonicalSchema(r["canonical_schema_id"], file_type, r["schema_version"], tuple(CanonicalColumn(*c) for c in json.loads(r["schema_json"])))
        here = (F.col("state") == state) & (F.col("file_type") == file_type) & (F.col("atomic_month") == month)
        mappings = self.meta.read("canonical_mapping").where(F.col("canonical_schema_id") == schema.schema_id)
        found = canonical.winners_with_mappings(self.meta.read("submitter_month_pointer").where(here), self.meta.read("submission"), mappings).collect()  # a row for each submitter
        chosen = [canonical.Winner(w["submitter_id"], w["winning_submission_id"], w["layout_id"], w["mapping_id"], w["mapping_version"], json.loads(w["mapping_json"]), self.gold(state, file_type, w["submitter_id"])) for w in found]
        before = latest_per_key(self.meta.read("canonical_month_build").where(here & F.col("status").isin("SUCCEEDED", "SKIPPED")), ["state", "file_type", "atomic_month"], ["started_at"]).first()
        got = canonical.build_month(self.spark, f"{self.root}/canonical/{state}/{file_type}", state, file_type, month, schema, chosen, before["input_fingerprint"] if before else None, self._at())
        return {"status": got.status, "input_fingerprint": got.fingerprint, "canonical_schema_id": schema.schema_id}

    def tick(self) -> dict[str, int]:
        """All jobs once, in order; what a trigger of a few seconds runs."""
        return {"inbox": len(self.sweep()), "parse": len(self.parse_due()), "validate": len(self.validate_due()), "merge": len(self.merge_due()), "rebuild": len(self.rebuild_due())}

    def views(self, prefix: str = "serving_") -> dict[str, DataFrame]:
        """The serving views over the stored tables, as temporary views of the session."""
        names = ("submission", "layout_registry", "parse_run", "parse_file_metrics", "parse_column_metrics", "validation_run", "validation_rule", "validation_rule_set_rule", "validation_finding", "submitter_gold_build", "submitter_month_pointer", "canonical_month_build", "canonical_rebuild_queue", "canonical_schema")
        tables = {n: self.meta.read(n) for n in names}
        tables["submission"] = tables["submission"].drop("layout_version")  # the registry's counts
        return serving.register(tables, prefix)


def every(spark: SparkSession, jobs: Jobs, checkpoint: str, seconds: int = 30):
    """A streaming query whose trigger runs all jobs; each of them may be broken off and started again."""
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return clock.writeStream.foreachBatch(lambda _, __: jobs.tick()).option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()
