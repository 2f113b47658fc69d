import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarry.operators import canonical, winners
from quarry.operators.latest import latest_per_key, natural_version
from quarry.sources import files
from quarry.sources.layouts import CanonicalColumn, CanonicalSchema

KEYS = ["state", "file_type", "submitter_id", "atomic_month"]
T0 = datetime(2025, 1, 1)
OFFER = "state string, file_type string, submitter_id string, atomic_month string, seq int, submission_id string, winner_timestamp timestamp"
POINTER = "state string, file_type string, submitter_id string, atomic_month string, winning_submission_id string, replaced_submission_id string, winner_timestamp timestamp"


def fold(pointers, offers):
    now, changed = dict(pointers), set()
    for o in sorted(offers, key=lambda o: o[4]):
        k = o[:4]
        if o[6] is not None and (k not in now or o[6] > now[k][2]):
            now[k] = (o[5], now[k][0] if k in now else None, o[6])
            changed.add(k)
    return now, changed


@pytest.mark.parametrize("seed", range(4))
def test_merge_equals_updates_in_turn(spark, seed):
    rng = random.Random(seed)
    offers = [("TX", "medical", f"u{rng.randrange(3)}", f"2025-0{rng.randrange(1, 4)}", i, f"s{i}", rng.choice([None, *(T0 + timedelta(days=d) for d in range(5))])) for i in range(60)]
    stored = {("TX", "medical", "u0", "2025-01"): ("old", "older", T0 + timedelta(days=2)), ("TX", "medical", "u9", "2025-01"): ("kept", None, T0)}
    pointers = spark.createDataFrame([(*k, *v) for k, v in stored.items()], POINTER)
    new, changed = winners.merge(pointers, spark.createDataFrame(offers, OFFER), KEYS, ["seq"])
    want, dirty = fold(stored, offers)
    assert {tuple(r)[:4]: tuple(r)[4:] for r in new.collect()} == want
    assert {tuple(r) for r in changed.collect()} == dirty


@pytest.mark.parametrize("chunks", [1, 3, 40])
def test_records_of_one_key_in_ranges(spark, chunks):
    """The same records however the order is cut, with ties, nulls and equal places in the order's first column."""
    rng = random.Random(chunks)
    offers = [("TX", None, "u", "2025-01", i // 3, f"s{i:03d}", rng.choice([None, *(T0 + timedelta(days=d) for d in range(30))])) for i in range(200)]
    df = spark.createDataFrame(offers, OFFER)
    want, best = [], None
    for o in offers:
        if o[6] is not None and (best is None or o[6] > best):
            want.append(o[5])
            best = o[6]
    got = winners.record_breakers(df, KEYS, ["seq", "submission_id"], "winner_timestamp", chunks=chunks)
    assert sorted(r["submission_id"] for r in got.collect()) == want and got.columns == df.columns
    last = winners._last_two(df, KEYS, ["seq", "submission_id"], "winner_timestamp", "submission_id", chunks=chunks).first()
    assert (last["submission_id"], last["_previous"]) == (want[-1], want[-2])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert chunks == 1 or "_chunk" in next(line for line in plan.splitlines() if "Window" in line and "seq" in line)  # a key is dealt out by its ranges
    assert winners.record_breakers(df.limit(0), KEYS, ["seq"], "winner_timestamp").count() == 0


def test_older_submission_changes_nothing(spark):
    pointers = spark.createDataFrame([("TX", "m", "u", "2025-01", "new", None, T0)], POINTER)
    offers = spark.createDataFrame([("TX", "m", "u", "2025-01", 1, "old", T0 - timedelta(days=1)), ("TX", "m", "u", "2025-01", 2, "tie", T0)], OFFER)
    new, changed = winners.merge(pointers, offers, KEYS, ["seq"])
    assert changed.count() == 0 and new.first()["winning_submission_id"] == "new"


def test_queue(spark):
    queue = spark.createDataFrame([(1, "TX", "m", "2025-01", T0, "x", T0), (2, "TX", "m", "2025-02", T0, "x", None), (3, "TX", "m", "2025-02", T0, "x", None)], "queue_id int, state string, file_type string, atomic_month string, enqueued_at timestamp, reason string, processed_at timestamp")
    changed = spark.createDataFrame([("TX", "m", "2025-03")], "state string, file_type string, atomic_month string")
    longer = winners.enqueue(queue, changed, F.lit(T0), "pointer")
    assert sorted(r[0] for r in longer.select("queue_id").collect()) == [1, 2, 3, 4]
    assert {(r["atomic_month"], r["high_water"], r["events"]) for r in winners.drain(longer).collect()} == {("2025-02", 3, 2), ("2025-03", 4, 1)}
    assert winners.drain(winners.mark_processed(longer, changed, F.lit(T0))).count() == 1


def test_gold_overwrite_replaces_one_month(spark, tmp_path):
    out = str(tmp_path / "gold")
    rows = lambda *x: spark.createDataFrame(x, "Id string, STATE string, atomic_month string")
    winners.overwrite_months(rows(("a", "TX", "2025-01"), ("b", "TX", "2025-02")), out, None, "u", "TX", "medical", F.lit(T0))
    winners.overwrite_months(rows(("c", "TX", "2025-02"), ("d", "TX", "2025-03")), out, ["2025-02"], "u", "TX", "medical", F.lit(T0))
    df = spark.read.parquet(out)
    assert {(r["Id"], r["atomic_month"]) for r in df.collect()} == {("a", "2025-01"), ("c", "2025-02")}
    assert [c.lower() for c in df.columns].count("state") == 1
    with pytest.raises(ValueError, match="2024-01"):
        winners.overwrite_months(rows(("e", "TX", "2025-02")), out, ["2024-01", "2025-02"], "u", "TX", "medical", F.lit(T0))
    assert {r["Id"] for r in spark.read.parquet(out).collect()} == {"a", "c"}
    winners.overwrite_months(rows(("f", "TX", "")).drop("atomic_month"), str(tmp_path / "whole"), None, "u", "TX", "medical", F.lit(T0))
    assert spark.read.parquet(str(tmp_path / "whole")).first()["atomic_month"] == "__all__"


def test_months_change_places(spark, tmp_path, monkeypatch):
    """Whole months are renamed; what an interrupted call set aside is put back by the next one."""
    out = str(tmp_path / "t")
    of = lambda *rows: spark.createDataFrame(rows, "v string, atomic_month string")
    seen = lambda: {(r["v"], r["atomic_month"]) for r in spark.read.parquet(out).collect()}
    assert files.replace_months(of(("a", "2025-01"), ("b", "2025-02"), ("c", "a b/c")), out) == {"2025-01", "2025-02", "a b/c"}
    files.replace_months(of(("d", "2025-02")), out, ["2025-01", "2025-02"])
    assert seen() == {("d", "2025-02"), ("c", "a b/c")}
    move = files.ObjectStore.move

    def fails(self, key, to):
        if key.startswith("_staged"):
            raise OSError("power cut")
        move(self, key, to)

    monkeypatch.setattr(files.ObjectStore, "move", fails)
    with pytest.raises(OSError, match="power cut"):
        files.replace_months(of(("e", "2025-02")), out)
    assert seen() == {("c", "a b/c")}  # between the two renames
    monkeypatch.undo()
    files.replace_months(of(("f", "2025-03")), out)
    assert seen() == {("d", "2025-02"), ("c", "a b/c"), ("f", "2025-03")}
    with pytest.raises(ValueError, match="2025-09"):
        files.replace_months(of(("g", "2025-03")), out, ["2025-03", "2025-09"], required=True)
    assert ("f", "2025-03") in seen()


SCHEMA = CanonicalSchema("medical/v1", "medical", "v1", (CanonicalColumn("member_id", "TEXT", True), CanonicalColumn("provider_id"), CanonicalColumn("start", "DATE", True)))


def silver(spark, tmp_path, name, rows):
    path = str(tmp_path / name)
    spark.createDataFrame(rows, "PATIENT string, PROVIDER string, ORGANIZATION string, START string, atomic_month string").write.mode("overwrite").parquet(path)
    return path


def test_build_skip_and_correction(spark, tmp_path):
    one = {"member_id": {"source": "PATIENT"}, "provider_id": {"coalesce": ["PROVIDER", "ORGANIZATION"]}, "start": {"source": "START", "cast": "DATE"}}
    two = {"member_id": {"expr": "'x' || PATIENT"}, "provider_id": {"const": "CONSTPROV"}, "start": {"source": "start"}}
    a = silver(spark, tmp_path, "a", [("p1", None, "prov1", "2025-01-02", "2025-01"), ("p9", None, None, "2025-02-02", "2025-02")])
    b = silver(spark, tmp_path, "b", [("p2", None, None, "2025-01-03", "2025-01")])
    ws = [canonical.Winner("u1", "s1", "L1", "M1", "v1", one, a), canonical.Winner("u2", "s2", "L2", "M2", "v1", two, b)]
    out = str(tmp_path / "canonical")
    first = canonical.build_month(spark, out, "TX", "medical", "2025-01", SCHEMA, ws, None, F.lit(T0))
    assert (first.status, first.rows) == ("SUCCEEDED", 2)
    df = spark.read.parquet(out)
    assert {r["provider_id"] for r in df.collect()} == {"prov1", "CONSTPROV"} and {"source_submission_id", "canonical_built_at", "source_layout_id"} <= set(df.columns)
    assert canonical.build_month(spark, out, "TX", "medical", "2025-01", SCHEMA, ws[::-1], first.fingerprint, F.lit(T0)).status == "SKIPPED"
    newer = [canonical.Winner("u1", "s3", "L1", "M1", "v1", one, a), ws[1]]
    assert canonical.input_fingerprint(SCHEMA, newer) != first.fingerprint


def test_build_by_mapping_class(spark, tmp_path, monkeypatch):
    """The plan has a scan for each class, whatever the submitters; rows keep their submitters; a month without rows is emptied."""
    one = {"member_id": {"source": "PATIENT"}, "start": {"source": "START", "cast": "DATE"}}
    ws = []
    for i in range(12):
        path = str(tmp_path / f"u {i}")  # a name that paths write with signs
        rows = spark.createDataFrame([(f"p{i}", None, None, "2025-01-02", m) for m in (["2025-01"] if i % 3 else ["2025-02"])], "PATIENT string, PROVIDER string, ORGANIZATION string, START string, atomic_month string")
        rows.write.partitionBy("atomic_month").parquet(path)
        ws.append(canonical.Winner(f"u{i}", f"s{i}", f"L{i % 2}", "M", "v1", one if i % 2 else one | {"provider_id": {"const": "C"}}, path))
    plans, frame = [], canonical._class_frame
    monkeypatch.setattr(canonical, "_class_frame", lambda *a: plans.append(frame(*a)) or plans[-1])
    out = str(tmp_path / "canonical")
    got = canonical.build_month(spark, out, "TX", "medical", "2025-01", SCHEMA, ws, None, F.lit(T0))
    assert got.rows == 8 and len(plans) == 2
    assert all(p._jdf.queryExecution().optimizedPlan().toString().count("Relation ") == 1 for p in plans)
    df = spark.read.parquet(out)
    assert {(r["submitter_id"], r["source_submission_id"], r["member_id"], r["source_layout_id"]) for r in df.collect()} == {(f"u{i}", f"s{i}", f"p{i}", f"L{i % 2}") for i in range(12) if i % 3}
    canonical.build_month(spark, out, "TX", "medical", "2025-02", SCHEMA, ws, None, F.lit(T0))
    emptied = canonical.build_month(spark, out, "TX", "medical", "2025-01", SCHEMA, [ws[0]], got.fingerprint, F.lit(T0))
    assert (emptied.status, emptied.rows) == ("SUCCEEDED", 0)
    assert {r["atomic_month"] for r in spark.read.parquet(out).collect()} == {"2025-02"}
    none = canonical.build_month(spark, out, "TX", "medical", "2025-02", SCHEMA, [canonical.Winner("u", "s", "L", "M", "v1", one, silver(spark, tmp_path, "other", [("p", None, None, "2025-01-01", "2025-01")]))], None, F.lit(T0))
    assert none.rows == 0


def test_mapping_errors(spark):
    df = spark.createDataFrame([("1",)], "A string")
    for spec in ({"source": "B"}, {"coalesce": []}, {"source": "A", "const": 1}, {}):
        with pytest.raises(canonical.MappingError):
            canonical.compile_mapping(spec, df.columns)
    with pytest.raises(canonical.MappingError):
        canonical.map_to_canonical(df, SCHEMA, {}, {})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        canonical.map_to_canonical(df.withColumn("A", F.lit("no date")), SCHEMA, {"member_id": {"const": 1}, "start": {"source": "a"}}, {}).collect()


def test_latest(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, "x"), ("a", 2, "y"), ("b", None, "z")], "k string, t int, v string")
    assert {(r["k"], r["v"]) for r in latest_per_key(df, ["k"], ["t", "v"]).collect()} == {("a", "y"), ("b", "z")}
    s = spark.createDataFrame([("m", "v2", "ACTIVE"), ("m", "v10", "ACTIVE"), ("m", "v11", "OLD")], "file_type string, schema_version string, status string")
    assert canonical.latest_schema(s, "m").first()["schema_version"] == "v10"
    assert canonical.latest_schema(s, "m", lexical=True).first()["schema_version"] == "v2"
    assert s.orderBy(natural_version(F.col("schema_version"))).first()["schema_version"] == "v2"
