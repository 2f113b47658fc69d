"""Each query on the smallest tables against its SQL in DuckDB."""

import duckdb
import pandas as pd
import pytest

from quarry.plans import serving, standins, testqueries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(df):
    def text(v):
        if v is None or v is pd.NaT or v is pd.NA or v != v:
            return ""
        if isinstance(v, (bool, str)):
            return str(v)
        try:
            return f"{float(v):.9g}"
        except (TypeError, ValueError):
            return str(pd.Timestamp(v))

    return sorted(tuple(text(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(testqueries.QUERIES))
def test_equals_sql(spark, db, name):
    got = testqueries.QUERIES[name](spark, SF).toPandas()
    if name in testqueries.ORACLE:
        want = db.sql(testqueries.ORACLE[name]).df()
        assert sorted(want.columns) == sorted(got.columns)
        assert rows(got) == rows(want)


def test_roundtrip_keeps_other_months(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").selectExpr("date_format(o_orderdate, 'yyyy-MM') m", "o_orderkey")
    want = {"1996-03": orders.where("m = '1996-03' AND o_orderkey % 2 = 0").count(), "1996-04": orders.where("m = '1996-04'").count()}
    assert {r["atomic_month"]: r["n"] for r in testqueries.partition_roundtrip(spark, SF).collect()} == {k: v for k, v in want.items() if v}


GRAIN = {
    "submission_overview": ["submission_id"], "validation_findings": ["validation_finding_id"], "submitter_month_status": ["state", "file_type", "submitter_id", "atomic_month"], "canonical_month_status": ["state", "file_type", "atomic_month"],
    "dashboard_kpis_daily": ["day"], "parse_column_health": ["parse_run_id", "column_name"], "validation_summary": ["validation_run_id"],
}


def test_grain_of_views(spark):
    views = serving.register(standins.load(spark, SF))
    for name, keys in GRAIN.items():
        assert views[name].groupBy(*keys).count().where("count > 1").count() == 0, name


def test_unused_joins_are_removed(spark):
    plan = serving.submission_overview(standins.load(spark, SF)).groupBy("submission_status").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_submissions_move_once_for_what_lies_by_submission(spark):
    """One exchange of the submissions and one of each kind of run, before its latest is found."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = serving.submission_overview(standins.load(spark, SF))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(submission_id#") == 4
    assert plan.count("REPARTITION_BY_COL") == 3
