from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarry.jobs import drivers
from quarry.operators.rules import Rule
from quarry.sources.layouts import CanonicalColumn, CanonicalSchema
from quarry.sources.metadata import SCHEMAS, Metadata

T0 = datetime(2025, 6, 1, 12)
LAYOUT = {
    "layout_id": "L", "submitter_id": "*", "file_type": "medical", "layout_version": "v1", "schema": {"columns": [{"name": "Id"}, {"name": "START", "type": "date"}, {"name": "CODE", "type": "integer"}], "anchor_date_column": "START"},
    "parser_config": {"delimiter": ",", "header": True, "date_formats": ["%Y-%m-%d"]},
}


@pytest.fixture
def jobs(spark, tmp_path):
    clock = {"t": T0}

    def now():
        clock["t"] += timedelta(seconds=1)
        return clock["t"]

    meta = Metadata(spark, str(tmp_path / "meta"))
    out = drivers.Jobs(spark, meta, str(tmp_path / "lake"), now)
    out.clock = clock
    drivers.sync_layouts(meta, [LAYOUT], T0)
    rules = (Rule("id", "id", "NOT_NULL", params={"column": "Id"}), Rule("code", "code", "RANGE", "SOFT", "COUNT", 0, {"column": "CODE", "min": 1, "max": 9}))
    drivers.seed_rule_set(meta, given=rules)
    schema = CanonicalSchema("S", "medical", "v1", (CanonicalColumn("member", "TEXT", True), CanonicalColumn("code", "BIGINT")))
    drivers.sync_canonical(meta, [schema], [{"mapping_id": "M", "layout_id": "L", "canonical_schema_id": "S", "mapping": {"member": {"source": "Id"}, "code": {"source": "CODE"}}}], T0)
    meta.append("submitter", [{"submitter_id": "u", "state": "TX"}])
    return out


def statuses(jobs):
    return {r["submission_id"]: r["status"] for r in jobs.meta.read("submission").collect()}


def test_from_the_inbox_to_a_canonical_month(jobs, spark):
    jobs.store.put("inbox/u/d/medical_202501_202502.csv", b"Id,START,CODE\na,2025-01-03,5\nb,2025-02-04,50\nc,2025-02-05,x\n")
    jobs.store.put("inbox/u/d/_SUCCESS", b"")
    assert jobs.tick() == {"inbox": 1, "parse": 1, "validate": 1, "merge": 1, "rebuild": 2}
    (first,) = statuses(jobs)
    assert statuses(jobs)[first] == "VALIDATED_WITH_WARNINGS"
    read = jobs.meta.read
    assert read("parse_file_metrics").first()["rows_rejected"] == 1 and read("validation_finding").where("not passed").count() == 1
    out = spark.read.parquet(f"{jobs.root}/canonical/TX/medical")
    assert sorted((r["member"], r["code"], r["atomic_month"]) for r in out.collect()) == [("a", 5, "2025-01"), ("b", 50, "2025-02")]
    # nothing is due again; a queued month whose inputs are as before is skipped
    assert jobs.tick() == {"inbox": 0, "parse": 0, "validate": 0, "merge": 0, "rebuild": 0}
    jobs.meta.replace("canonical_rebuild_queue", drivers.winners.enqueue(read("canonical_rebuild_queue"), read("submitter_month_pointer").limit(1), F.lit(T0), "again"))
    assert [x[3] for x in jobs.rebuild_due()] == ["SKIPPED"] and not jobs.rebuild_due()
    # a later submission of one month takes that month, and the other one stays
    jobs.store.put("inbox/u/e/medical_202502_202502.csv", b"Id,START,CODE\nd,2025-02-09,7\n")
    jobs.store.put("inbox/u/e/_SUCCESS", b"")
    assert jobs.tick()["rebuild"] == 1
    out = spark.read.parquet(f"{jobs.root}/canonical/TX/medical")
    assert sorted((r["member"], r["atomic_month"]) for r in out.collect()) == [("a", "2025-01"), ("d", "2025-02")]
    pointer = read("submitter_month_pointer").where("atomic_month = '2025-02'").first()
    assert pointer["replaced_submission_id"] == first and pointer["winning_validation_run_id"]
    views = jobs.views("t_")
    assert views["submission_overview"].count() == 2
    drivers.serving.drop(spark, "t_")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("t_")]


def test_a_bad_submission_stops_no_other(jobs):
    jobs.store.put("inbox/u/a/medical_202501_202501.csv", b"Id,START,CODE\n,2025-01-03,5\n")
    jobs.store.put("inbox/u/b/medical_202501_202501.csv", b"Id,START,CODE\nz,2025-01-03,5\n")
    for k in "ab":
        jobs.store.put(f"inbox/u/{k}/_SUCCESS", b"")
    jobs.sweep()
    gone = jobs.meta.read("submission").orderBy("inbox_prefix").first()["submission_id"]
    jobs.meta.update("submission", {gone: {"layout_id": "none"}})
    assert len(jobs.parse_due()) == 2 and sorted(statuses(jobs).values()) == ["PARSED", "PARSE_FAILED"]
    assert jobs.meta.read("parse_run").where("status = 'FAILED' AND error IS NOT NULL").count() == 1
    assert len(jobs.validate_due()) == 1


def test_late_objects_with_old_times_are_seen(jobs, tmp_path):
    import os

    jobs.store.put("inbox/u/medical_202501_202501.csv", b"Id\n1\n")
    assert jobs.sweep() == []  # not quiet yet
    jobs.store.put("inbox/u/old.csv", b"x")
    os.utime(tmp_path / "lake/inbox/u/old.csv", (1, 1))
    jobs.clock["t"] += timedelta(seconds=30)
    jobs.sweep()
    assert {r["object_key"] for r in jobs.meta.read("inbox_object").collect()} == {"inbox/u/medical_202501_202501.csv", "inbox/u/old.csv"}


def test_metadata_store(spark, tmp_path):
    meta = Metadata(spark, str(tmp_path))
    assert all(meta.read(t).count() == 0 for t in list(SCHEMAS)[:3])
    meta.seed("validation_rule", [{"rule_id": "1", "name": "a"}])
    meta.seed("validation_rule", [{"rule_id": "2", "name": "a"}, {"rule_id": "3", "name": "b"}])
    assert sorted(r["rule_id"] for r in meta.read("validation_rule").collect()) == ["1", "3"]
    drivers.sync_file_config(meta, [{"rule_id": 1, "submitter_id": "u", "file_type": "medical", "layout_id": "L"}])
    drivers.sync_file_config(meta, [{"rule_id": 9, "submitter_id": "u", "file_type": "medical", "layout_id": "L", "priority": 5}])
    assert [(r["rule_id"], r["priority"]) for r in meta.read("submitter_file_config").collect()] == [(1, 5)]
    drivers.heartbeat(meta, now=lambda: T0)
    assert meta.read("heartbeat").count() == 1 and meta.store.get("health/engine.txt") == b"hello"


@pytest.mark.parametrize(("what", "table", "nth"), [("append", "submission", 1), ("move", None, 2), ("update", "submission", 1), ("update", "submission", 2)])
def test_broken_off_and_started_again(jobs, monkeypatch, what, table, nth):
    """Whatever write fails, the next run of the jobs ends what was begun, once."""
    for k in ("1", "2"):
        jobs.store.put(f"inbox/u/d/medical_202501_20250{k}.csv", b"Id,START,CODE\na%s,2025-01-03,5\n" % k.encode())
    jobs.store.put("inbox/u/d/_SUCCESS", b"")
    owner = jobs.store if what == "move" else jobs.meta
    real, calls = getattr(owner, what), []

    def failing(*args):
        if table is None or args[0] == table:
            calls.append(args)
            if len(calls) == nth:
                raise RuntimeError("power cut")
        return real(*args)

    monkeypatch.setattr(owner, what, failing)
    with pytest.raises(RuntimeError, match="power cut"):
        jobs.sweep()
        jobs.parse_due()
    monkeypatch.setattr(owner, what, real)
    jobs.sweep()
    jobs.parse_due()
    assert list(statuses(jobs).values()) == ["PARSED"]
    assert len(jobs.meta.read("submission_file").collect()) == 2 and not [o for o in jobs.store.list("inbox") if o["object_key"].endswith(".csv")]
    assert {r["status"] for r in jobs.meta.read("inbox_object").where("object_key LIKE '%.csv'").collect()} == {"MOVED"}
    (folder,) = {r["silver_prefix"] for r in jobs.meta.read("parse_run").where("status = 'SUCCEEDED'").collect()}
    assert sorted(r["Id"] for r in jobs.spark.read.parquet(folder).collect()) == ["a1", "a2"]


def test_failures_keep_nothing_waiting(jobs):
    """With a batch of two and no rule set for their type, the third submission is tried on the second tick."""
    rows = [{"submission_id": f"s{i}", "submitter_id": "u", "file_type": "other", "status": "PARSED", "received_at": T0 + timedelta(minutes=i)} for i in range(3)]
    jobs.meta.append("submission", rows)
    assert jobs.validate_due(2) == ["s0", "s1"]
    assert "s2" in jobs.validate_due(2)
    assert {r["submission_id"] for r in jobs.meta.read("validation_run").where("status = 'FAILED'").collect()} == {"s0", "s1", "s2"}
