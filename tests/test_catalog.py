"""The stored serving layer against the views over frames."""

import pytest
from pyspark.sql import functions as F

from quarry.plans import catalog, serving, standins

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark):
    tables = dict(standins.load(spark, SF).items())
    catalog.save(spark, tables, "quarry_serving", buckets=4)
    yield tables
    spark.sql("DROP DATABASE quarry_serving CASCADE")


def rows(df, columns):
    return sorted(str(tuple(r)) for r in df.select(*columns).collect())


@pytest.mark.parametrize("name", sorted(catalog.VIEWS))
def test_views_equal_those_over_frames(spark, stored, name):
    want = serving.VIEWS[name](stored)
    other = spark.newSession()  # another session sees them
    other.conf.set("spark.sql.session.timeZone", "UTC")
    got = catalog.view(other, name, "quarry_serving")
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got, sorted(want.columns)) == rows(want, sorted(want.columns))


@pytest.mark.parametrize("name", ["submission_overview", "validation_findings", "validation_summary", "submission_timeline", "parse_column_health"])
def test_joins_need_no_exchange(spark, stored, name):
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    plan = catalog.view(session, name, "quarry_serving")._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Exchange" not in plan


def test_new_rows_are_seen_at_once(spark, stored):
    less = stored | {"submission": stored["submission"].where(F.col("submission_id") < "s5")}
    catalog.save(spark, less, "quarry_serving", buckets=4)
    assert catalog.view(spark, "submission_overview", "quarry_serving").count() == less["submission"].count()
    catalog.save(spark, stored, "quarry_serving", buckets=4)
