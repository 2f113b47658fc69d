import pytest

from quarry.operators import rules
from quarry.operators.rules import DEFAULT_RULES, Rule, guard


def one(df, rule):
    return rules.evaluate(df, [rule]).first()


@pytest.fixture
def silver(spark):
    rows = [("e1", "a", "10", "x@y"), ("e1", "a", "200000", None), ("e2", None, "abc", "zzz"), (None, None, None, "q@r"), (None, None, "5", "x@y")]
    return spark.createDataFrame(rows, "Id string, PATIENT string, CODE string, MAIL string")


@pytest.mark.parametrize(
    ("rule", "violations"),
    [
        (Rule("1", "n", "NOT_NULL", params={"column": "PATIENT"}), 3), (Rule("2", "n", "RANGE", params={"column": "CODE", "min": 0, "max": 100}), 1),
        (Rule("3", "n", "ALLOWED_VALUES", params={"column": "CODE", "values": [10, 5]}), 2), (Rule("4", "n", "REGEX", params={"column": "MAIL", "pattern": "@"}), 1),
        (Rule("5", "n", "UNIQUE_KEY", params={"columns": ["Id", "PATIENT"]}), 4), (Rule("6", "n", "CUSTOM_SQL", sql="SELECT * FROM silver WHERE CODE = 'abc'"), 1),
    ],
)
def test_kinds(silver, rule, violations):
    got = one(silver, rule)
    assert (got["violations_count"], got["denominator_count"], got["passed"]) == (violations, 5, False)
    assert rules.violating_rows(silver, rule).count() == violations


def test_all_in_one_pass(silver):
    rs = [Rule("a", "a", "NOT_NULL", params={"column": "Id"}), Rule("b", "b", "RANGE", "SOFT", "RATE", 0.5, {"column": "CODE", "min": 0, "max": 9}), Rule("c", "c", "UNIQUE_KEY", params={"columns": ["Id"]}), Rule("d", "d", "NOT_NULL", params={"column": "Id"}, enabled=False)]
    found = rules.evaluate(silver, rs)
    assert {r["rule_id"]: r["violations_count"] for r in found.collect()} == {"a": 2, "b": 2, "c": 4}
    assert rules.outcome(found).first().asDict() == {"outcome": "FAIL_HARD", "submission_status": "VALIDATION_FAILED"}


def test_outcomes(spark):
    f = spark.createDataFrame([("HARD", True), ("SOFT", False)], "severity string, passed boolean")
    assert rules.outcome(f).first()["submission_status"] == "VALIDATED_WITH_WARNINGS"
    assert rules.outcome(f.limit(0)).first()["outcome"] == "PASS"


def test_no_rows_pass(silver):
    got = one(silver.limit(0), Rule("a", "a", "NOT_NULL", "HARD", "RATE", 0.0, {"column": "Id"}))
    assert (got["violations_count"], got["violations_rate"], got["passed"]) == (0, 0.0, True)


def test_samples(silver, spark, tmp_path):
    rs = [Rule("a", "a", "NOT_NULL", params={"column": "PATIENT"}), Rule("c", "c", "UNIQUE_KEY", params={"columns": ["Id"]})]
    got = rules.samples(silver, rs, ["CODE"], most=2).groupBy("rule_id").count().collect()
    assert {r["rule_id"]: r["count"] for r in got} == {"a": 2, "c": 2}
    out = rules.validate(spark, silver, rs, str(tmp_path / "samples"), ["CODE"])
    assert out["outcome"] == "FAIL_HARD" and spark.read.parquet(str(tmp_path / "samples")).count() == 7


@pytest.mark.parametrize("sql", ["DELETE FROM silver", "WITH a AS (SELECT 1) SELECT * FROM a", "SELECT 1; drop table x", "/* c */ update silver set a = 1"])
def test_guard_refuses(sql):
    with pytest.raises(ValueError):
        guard(sql)


def test_guard_strips_comments():
    assert guard("-- drop\nSELECT 1 /* insert */ FROM silver") == "SELECT 1  FROM silver"


def test_overrides():
    r = DEFAULT_RULES[1].override("HARD", None, 0.5, '{"max": 5}')
    assert (r.severity, r.threshold_type, r.threshold, r.params) == ("HARD", "RATE", 0.5, {"column": "CODE", "min": 1, "max": 5})
    assert DEFAULT_RULES[1].override(threshold=0.0).threshold == 0.0


def test_unportable_patterns():
    for p in ("(?<=a)b", r"(a)\1", "a++"):
        with pytest.raises(ValueError):
            Rule("1", "n", "REGEX", params={"column": "MAIL", "pattern": p})


def test_rule_set_tiers(spark):
    s = spark.createDataFrame([("1", "medical", "v1", "202501", "202503"), ("2", "medical", "v2", "202501", None), ("3", "pharmacy", "v1", None, None), ("4", "members", "v1", "202501", None)], "submission_id string, file_type string, layout_version string, coverage_start_month string, coverage_end_month string")
    sets = spark.createDataFrame(
        [("default", "medical", None, None, None, "ACTIVE"), ("versioned", "medical", "v1", None, None, "ACTIVE"), ("b", "pharmacy", None, "2025-01-01", None, "ACTIVE"), ("x", "members", None, None, None, "ACTIVE"), ("y", "members", None, None, None, "ACTIVE")],
        "rule_set_id string, file_type string, layout_version string, effective_start string, effective_end string, status string",
    ).selectExpr("rule_set_id", "file_type", "layout_version", "cast(effective_start as date) effective_start", "cast(effective_end as date) effective_end", "status")
    got = {r["submission_id"]: (r["rule_set_id"], r["candidates"]) for r in rules.resolve_rule_set(s, sets).collect()}
    assert got == {"1": ("versioned", 1), "2": ("default", 1), "3": (None, 0), "4": (None, 2)}


def test_a_range_looks_at_numbers_only(spark):
    """A text is a number as SQL's casts have it: suffixes make none, spaces around it do no harm."""
    df = spark.createDataFrame([("5d",), ("5f",), ("5",), (" 7 ",), ("1e3",), ("inf",), ("x",), (None,)], "v string")
    assert sorted(r["v"] for r in rules.violating_rows(df, Rule("r", "r", "RANGE", params={"column": "v", "min": 6, "max": 99})).collect()) == ["1e3", "5", "inf"]


def test_custom_queries_name_silver_where_they_please(spark):
    df = spark.createDataFrame([(1, "silver", "a"), (2, "gold", "silver"), (3, "silver", "{x}")], "id int, status string, silver string")
    found = lambda sql: sorted(r["id"] for r in rules.violating_rows(df, Rule("c", "c", "CUSTOM_SQL", sql=sql)).collect())
    assert found("SELECT * FROM silver WHERE status = 'silver'") == [1, 3]
    assert found("SELECT s.* FROM Silver s WHERE s.silver IN ('silver', '{x}');") == [2, 3]
    assert found("SELECT a.* FROM silver a JOIN silver b ON a.status = b.silver") == [1, 3]


@pytest.mark.parametrize(("pattern", "fine"), [("[*+]", True), (r"\++", True), ("[]+]+x", True), ("a++", False), ("a*+", False), (r"(a)\1", False), ("(?=a)", False)])
def test_patterns_that_other_engines_lack(pattern, fine):
    made = lambda: Rule("1", "n", "REGEX", params={"column": "MAIL", "pattern": "x"}).override(params={"pattern": pattern})
    if fine:
        assert made().params["pattern"] == pattern
    else:
        with pytest.raises(ValueError):
            made()


def test_report_and_samples_of_broken_rules_only(spark, silver, tmp_path):
    import json

    from quarry.sources.files import ObjectStore

    store = ObjectStore(spark, str(tmp_path))
    rs = [Rule("a", "a", "NOT_NULL", params={"column": "PATIENT"}), Rule("q", "q", "CUSTOM_SQL", sql="SELECT * FROM silver WHERE CODE = 'no such'")]
    rules.validate(spark, silver, rs, str(tmp_path / "samples"), ["CODE"], (store, "report.json"))
    told = json.loads(store.get("report.json"))
    assert told["outcome"] == "FAIL_HARD" and [f["rule_id"] for f in told["findings"]] == ["a", "q"]
    assert sorted(p.name for p in (tmp_path / "samples").glob("rule_id=*")) == ["rule_id=a"]


def test_rule_set_of_a_submission_with_its_last_month_alone(spark):
    s = spark.createDataFrame([("s", "medical", "v1", None, "2024-05")], "submission_id string, file_type string, layout_version string, coverage_start_month string, coverage_end_month string")
    r = spark.sql("SELECT 'R' AS rule_set_id, 'medical' AS file_type, 'v1' AS layout_version, DATE '2024-04-01' AS effective_start, DATE '2024-06-30' AS effective_end, 'ACTIVE' AS status")
    assert rules.resolve_rule_set(s, r).first()["rule_set_id"] == "R"


def test_rule_sets_equal_an_all_pairs_join(spark):
    """Bins of months find what a join of all submissions and rule sets finds, tiers included."""
    import random
    from datetime import date

    rng = random.Random(4)
    month = lambda: f"20{rng.randrange(23, 26)}{rng.randrange(1, 13):02d}"
    subs = []
    for i in range(80):
        a, b = sorted((month(), month()))
        subs.append((f"s{i}", rng.choice(["medical", "pharmacy"]), rng.choice(["v1", "v2", None]), *rng.choice([(a, b), (b, a), (a, None), (None, b), (None, None), ("bad", b), (a, "bad")])))
    day = lambda: date(rng.randrange(2022, 2027), rng.randrange(1, 13), rng.randrange(1, 29))
    sets = []
    for i in range(30):
        a, b = sorted((day(), day()))
        sets.append((f"r{i}", rng.choice(["medical", "pharmacy", "members"]), rng.choice([None, "v1", "v2"]), *rng.choice([(a, b), (a, None), (None, b), (None, None), (b, a)]), rng.choice(["ACTIVE", "ACTIVE", "OLD"])))
    s = spark.createDataFrame(subs, "submission_id string, file_type string, layout_version string, coverage_start_month string, coverage_end_month string")
    r = spark.createDataFrame(sets, "rule_set_id string, file_type string, layout_version string, effective_start date, effective_end date, status string")

    def want(strict):
        out = set()
        for sid, kind, version, c0, c1 in subs:
            first = lambda m: date(int(m[:4]), int(m[4:]), 1) if m and m.isdigit() else None
            s0, s1 = first(c0 if c0 is not None else c1), first(c1 if c1 is not None else c0)
            if s1:
                s1 = date(s1.year + s1.month // 12, s1.month % 12 + 1, 1)  # exclusive
            tiers = {}
            for rid, rt, rv, e0, e1, status in sets:
                if status != "ACTIVE" or rt != kind or (rv is not None and rv != version):
                    continue
                bounded = e0 is not None or e1 is not None
                over = s0 is not None and s1 is not None and (e1 is None or s0 <= e1) and (e0 is None or s1 > e0)
                if bounded and not over:
                    continue
                inside = (bounded and over) if strict else True
                tiers.setdefault((1 if inside else 2) if rv is not None else (3 if inside else 4), []).append(rid)
            best = min(tiers, default=None)
            out.add((sid, tiers[best][0] if best and len(tiers[best]) == 1 else None, best, len(tiers[best]) if best else 0))
        return out

    for strict in (False, True):
        assert {tuple(x) for x in rules.resolve_rule_set(s, r, strict).collect()} == want(strict)
    none = r.limit(0)
    assert {x["tier"] for x in rules.resolve_rule_set(s, none).collect()} == {None} and rules.resolve_rule_set(s.limit(0), r).count() == 0
