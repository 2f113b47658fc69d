from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarry.operators import intake
from quarry.sources.files import ObjectStore
from quarry.streaming import inbox

T0 = datetime(2025, 1, 1, 12)
STATE = "object_key string, submitter_id string, first_seen_at timestamp, last_seen_at timestamp, last_changed_at timestamp, bytes bigint, etag string, status string"


def test_change_detection(spark):
    old = T0 - timedelta(hours=1)
    state = spark.createDataFrame([("inbox/a/1", "a", old, old, old, 5, "x", "SEEN"), ("inbox/a/2", "a", old, old, old, 5, "x", "MOVED"), ("inbox/a/3", "a", old, old, old, 5, "x", "SEEN")], STATE)
    listing = spark.createDataFrame([("inbox/a/1", 5, "x"), ("inbox/a/2", 6, "x"), ("inbox/b/9", 1, None)], "object_key string, bytes bigint, etag string")
    got = {r["object_key"]: r for r in intake.detect_changes(state, listing, F.lit(T0)).collect()}
    assert {k: r["changed"] for k, r in got.items()} == {"inbox/a/1": False, "inbox/a/2": True, "inbox/a/3": False, "inbox/b/9": True}
    assert got["inbox/a/2"]["status"] == "MOVED" and got["inbox/b/9"]["submitter_id"] == "b" and got["inbox/a/1"]["last_changed_at"] == old


def objects(spark, *rows):
    return spark.createDataFrame([(k, k.split("/")[1], T0, T0 - timedelta(minutes=m), 1, "e", "SEEN") for k, m in rows], "object_key string, submitter_id string, last_seen_at timestamp, last_changed_at timestamp, bytes bigint, etag string, status string")


def test_groups(spark):
    df = objects(spark, ("inbox/a/d/_SUCCESS", 0), ("inbox/a/d/1.csv", 0), ("inbox/a/d/e/_SUCCESS", 0), ("inbox/a/d/e/2.csv", 0), ("inbox/b/3.csv", 11), ("inbox/b/4.csv", 9))
    got = {r["object_key"]: (r["inbox_prefix"], r["grouping_method"]) for r in intake.closed_groups(df, F.lit(T0)).collect()}
    assert got == {"inbox/a/d/1.csv": ("inbox/a/d", "MARKER"), "inbox/a/d/e/2.csv": ("inbox/a/d/e", "MARKER"), "inbox/b/3.csv": ("inbox/b", "QUIESCENCE")}
    marks = intake.group_fingerprint(intake.closed_groups(df, F.lit(T0)), df)
    assert marks.count() == 3
    done = spark.createDataFrame([(marks.first()["fingerprint"],)], "group_fingerprint string")
    assert intake.new_groups(marks, done).count() == 2


def test_conventions(spark):
    reg = intake.default_conventions()
    assert reg.parse("Medical_202501_202503.CSV") == intake.Parsed("medical", "202501", "202503", "v1", 1.0)
    assert reg.parse("notes.csv").file_type == "unknown"

    class Acme(intake.Convention):
        def parse(self, filename):
            return intake.Parsed("medical", filename[4:10], None, "v1", 2.0) if filename.startswith("ACME") else None

    reg.register(Acme())
    assert reg.parse("ACME202401.txt").start == "202401"
    row = spark.range(1).select(intake.filename_columns(F.lit("members_202501_202502.gz")).alias("x")).first()["x"]
    assert (row["file_type"], row["end"]) == ("members", "202502")


RULES = "rule_id int, submitter_id string, file_type string, pattern string, extension string, layout_id string, priority int, status string"
LAYOUTS = "layout_id string, submitter_id string, file_type string, layout_version string, status string"
ANY = (1, "*", "medical", r"^medical_\d{6}_\d{6}\.(txt|csv|gz)$", None, "W", 100, "ACTIVE")


@pytest.mark.parametrize(
    ("name", "rules", "layouts", "want"),
    [
        ("medical_202501_202502.csv", [ANY], [], ("medical", "W", "submitter_file_config")),
        ("medical_202501_202502.csv", [ANY, (2, "u", "medical", None, "CSV", "OWN", 10, "ACTIVE")], [], ("medical", "OWN", "submitter_file_config")),
        ("medical_202501_202502.csv", [(2, "u", "medical", None, None, "A", 5, "ACTIVE"), (3, "u", "medical", None, None, "B", 5, "ACTIVE")], [], ("medical", None, "ambiguous_layout_routing")),
        ("medical_202501_202502.csv", [ANY, (4, "*", "pharmacy", None, None, "P", 1, "ACTIVE")], [], ("unknown", None, "ambiguous_file_type_routing")),
        ("odd.csv", [ANY], [], ("unknown", None, "no_submitter_signal")),
        ("medical_202501_202502.csv", [], [("L", "u", "medical", "v1", "ACTIVE"), ("W", "*", "medical", "v1", "ACTIVE")], ("medical", "L", "submitter_single_active_layout")),
        ("medical_202501_202502.csv", [], [("L", "u", "medical", "v1", "ACTIVE"), ("M", "u", "medical", "v1", "ACTIVE")], ("medical", None, "ambiguous_submitter_layout")),
        ("medical_202501_202502.csv", [], [("W", "*", "medical", "v1", "ACTIVE")], ("medical", "W", "wildcard_single_active_layout")),
        ("medical_202501_202502.csv", [], [("W", "*", "medical", "v1", "ACTIVE"), ("X", "*", "medical", "v1", "ACTIVE")], ("medical", None, "ambiguous_wildcard_layout")),
        ("enrollment_202501_202502.csv", [], [], ("enrollment", None, "no_active_layout")),
    ],
)
def test_routing(spark, name, rules, layouts, want):
    files = spark.createDataFrame([("g", "u", name)], "group_id string, submitter_id string, filename string")
    got = intake.route(files, spark.createDataFrame(rules, RULES), spark.createDataFrame(layouts, LAYOUTS)).first()
    assert (got["file_type"], got["layout_id"], got["reason"]) == want


def test_names_of_two_types_are_ambiguous(spark):
    files = spark.createDataFrame([("g", "u", "medical_202501_202502.csv"), ("g", "u", "members_202501_202502.csv")], "group_id string, submitter_id string, filename string")
    got = intake.route(files, spark.createDataFrame([], RULES), spark.createDataFrame([], LAYOUTS)).first()
    assert got["reason"] == "ambiguous_legacy_file_type"


def test_upsert(spark):
    kind = "id string, a string, b string, v int"
    now = spark.createDataFrame([("1", "x", None, 1), ("2", "y", "", 2)], kind)
    out = intake.upsert(now, spark.createDataFrame([("9", "x", "", 7), ("8", "z", None, 8)], kind), ["a", "b"], "id")
    assert {(r["id"], r["v"]) for r in out.collect()} == {("1", 7), ("2", 2), ("8", 8)}
    with pytest.raises(ValueError):
        intake.upsert(now, spark.createDataFrame([("9", "x", "", 7), ("8", "x", None, 8)], kind), ["a", "b"], "id")


def test_claims(spark):
    df = objects(spark, ("inbox/a/1", 1), ("inbox/a/2", 1))
    keys = df.where("object_key = 'inbox/a/1'")
    moved = intake.claim(intake.claim(df, keys, "CLAIMED"), keys, "MOVED")
    assert {r["object_key"]: r["status"] for r in intake.claim(moved, df, "SEEN").collect()} == {"inbox/a/1": "MOVED", "inbox/a/2": "SEEN"}


def test_process_moves_to_raw(spark, tmp_path):
    store = ObjectStore(spark, str(tmp_path))
    for k in ("x/medical_202501_202502.csv", "y/medical_202501_202502.csv"):
        store.put(f"inbox/u/{k}", b"Id\n1\n")
    keys = [o["object_key"] for o in store.list("inbox/u")]
    got = intake.Inbox(store, lambda: "S").process("u", "inbox/u", keys, "medical", "fp", "now")
    assert len(store.list("raw/u/medical/S/data")) == 2 and not store.list("inbox/u")
    assert (got["coverage_start_month"], got["coverage_end_month"]) == ("202501", "202502") and b"fp" in store.get("raw/u/medical/S/manifest.generated.json")
    store.copy("raw/u/medical/S/manifest.generated.json", "copy.json")
    store.delete("raw")
    assert [o["object_key"] for o in store.list()] == ["copy.json"]


def test_due_and_run_keys(spark):
    s = spark.createDataFrame([(f"s{i}", "VALIDATED", i) for i in range(30)], "submission_id string, status string, received_at int")
    done = s.where("received_at < 25").select("submission_id")
    assert inbox.due(s, ("VALIDATED",), done).count() == 5 and inbox.due(s, ("VALIDATED",)).count() == 25
    assert inbox.run_key("c", ["TX"], 1) != inbox.run_key("c", ["TX"], 2) == inbox.run_key("c", ["TX"], 2)


PATTERNS = [None, "medical_", "^med", "med(ical)?_.*", "x?medical", "medical*", "(?i)MEDICAL", "pharmacy|medical", "[mp]", "medical_2025.*csv$", "members_[0-9]+", "", "claims 2025-", "a{2}b"]
NAMES = ["medical_202501.csv", "Medical_1.CSV", "pharmacy.csv.gz", "members_7.txt", "noext", "medica", "claims 2025-01.csv", "aab.csv", "trailing.", ".csv", "x.Y.csv"]


def test_index_of_rules_equals_all_pairs(spark):
    import random
    import re

    rng = random.Random(8)
    rules = [(i, rng.choice(["*", "u", "v"]), "t", rng.choice(PATTERNS), rng.choice([None, "csv", "CSV", "gz", "csv.gz", "txt", ""]), f"L{i}", 1, rng.choice(["ACTIVE", "ACTIVE", "OLD"])) for i in range(120)]
    files = [(f"g{i}", u, n) for i, (u, n) in enumerate((u, n) for u in ("u", "v", "w", "*") for n in NAMES)]
    active = spark.createDataFrame(rules, RULES).where("status = 'ACTIVE'").select("rule_id", F.col("submitter_id").alias("rs"), F.col("file_type").alias("rt"), "pattern", "extension", F.col("layout_id").alias("rl"), "priority")
    got = intake._matching(spark.createDataFrame(files, "group_id string, submitter_id string, filename string"), active)
    want = sorted(
        (g, i) for g, u, n in files for i, s, _, p, e, _, _, status in rules
        if status == "ACTIVE" and s in (u, "*") and (e is None or n.lower().endswith("." + e.lower())) and (p is None or re.match(f"(?:{p})" if not p.startswith("(?i)") else p, n))
    )
    assert sorted((r["group_id"], r["rule_id"]) for r in got.collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_beginnings_of_patterns(spark):
    rows = spark.createDataFrame([(p,) for p in PATTERNS], "p string").select("p", intake.literal_prefix(F.col("p")).alias("l")).collect()
    want = {"medical_": "medical_", "^med": "med", "med(ical)?_.*": "med", "x?medical": "", "medical*": "medica", "medical_2025.*csv$": "medical_", "members_[0-9]+": "members_", "claims 2025-": "claims 2", "a{2}b": ""}
    assert {r["p"]: r["l"] for r in rows} == {p: want.get(p, "") for p in PATTERNS}
