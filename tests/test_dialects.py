"""Date formats and patterns of another engine, compared with it on tables of formats, patterns and texts."""

import duckdb
import pytest
from pyspark.sql import functions as F

from quarry.functions import re2, strptime

FORMATS = ["%Y%m%d", "%Y%j", "%Y%m", "%y", "%f", "%g", "%H:%M:%S.%f", "%I:%M %p", "%H:%M %p", "%d-%b-%Y", "%d %B %Y", "%a %d/%m/%y", "%Y-%m-%d  %H", "%S", "%H", "%Y-%m-%d", "%-d/%-m/%Y", "%Y-%m-%dT%H:%M:%SZ", "%Y%%", "%j", "%d/%m", "%p %I", "%y%m%d", "%c", "%x", "%X",
           "%d.%m.%Y %H.%M", "%b", "%B", "%Y%m%d%H%M%S", "%y %Y", "%Y %y", "%m/%d/%y", "%b %d, %Y", "x%Y", "[%d]", " %Y", "%Y ", "%B%m", "%A %Y", "%H%I", "%I%H %p", "lit"]
DATES = ["2024115", "2024060", "69", "68", "1234567", "01:02:03.5", "12:30 am", "12:30 PM", "0:30 PM", "12:30 AM", "13:30 PM", "05-JAN-2024", "5 january 2024", "Mon 01/02/70", " 2024-01-05    07 ", "60", "24", "02024-1-1", "24-1-1", "5/1/2024", "2024-01-01T00:00:00Z", "5", "2024%", "366", "0", "2024-13", "2023-02-29",
         "2024-02-29", "2024-01-01x", "29/02", "pm 5", "13", "12", "990102", "01:02:03", "1.2.2024 3.4", "Sept", "Sep", "２０２４-01-01", "20240102030405", "99 2024", "2024 99", "", "   ", "abc", "01/02/99", "Jan 05, 2024", "x2024", "[5]", "\t2024\n", "may03", "Sunday 2024", "0512 pm", "2024-01-01 01:02:03", "2024366", "2023366", "2024000", "lit", "\x012024", "2024-1-1\n"]

PATTERNS = [r"^[[:digit:]]+$", r"^[a-z]+$", r"(?P<x>a.)b", r"a.b", r"(?s)a.b", r"(?m)^b$", r"^b$", r"(?i)straSSe", r"\bfoo\b", r"\Bo", r"\d{3}-\d{4}", r"^\w+@\w+\.com$", r"[^[:alpha:]]", r"[[:^alpha:]x]", r"\pL+\pN", r"\p{Greek}", r"\P{L}", r"\p{^Lu}", r"[\d\-x]", r"[a-]", r"[]a]", r"[^]a]", r"[a&&b]", r"[a[b]", r"x{2,3}", r"x{,3}", r"x{",
            r"a*?b", r"(?U)a+b", r"\Qa.b\E+", r"\z", r"\x41\x{42}", r"\101", r"\012", r"\v", r"\s", r"[\s]", r"\S+", r"a|b|", r"()", r"(?i)[k]", r"(?i:K)a", r"a(?i)b|C", r"(?-s).", r"[^a]", r"\_", r"\-", r"#x", r"a b", r"[é-ü]", r"^*a", r"(?m)^$", r"a{2}", r"(?:a|b)+c", r"[.]", r"\$", r"a$b", r"(?i)ſ", r"(?i)[^k]", r"(?is)A.B", r"[\n]", r"\.\*", r"[a-c-e]",
            r"\D", r"\W", r"[\D]", r"[^\D]", r"[^\W\d]", r"\07", r"\a", r"(?i)\w", r"[[:space:]]", r"(?i)é"]
REFUSED = [r"(?<x>a.)b", r"a**", r"a*+", r"\Z", r"\1", r"(a)\1", r"(", r")", r"[a", r"a{1001}", r"(?=a)", r"(?!a)", r"(?<=a)b", r"(?>a)", r"[[:foo:]]", r"[z-a]", r"[a-\d]", r"\p{Foo}", r"a{2}{3}", r"(?x)a", r"*a", r"\y"]
TEXTS = ["", "a", "b", "ab", "abc", "abc\n", "123", "12a", "a\nb", "a\rb", "a b", "axb", "straße", "STRASSE", "foo", "xfoo", "foo bar", "555-1234", "me@ex.com", "me@ex.com\n", "é", "É", "Ü", "αβ1", "A1", "x", "xx", "xxx", "x{", "x{,3}", "a.b", "a.bb", "aab", "B", "AB", "K", "K", "k", "ſ", "s", " ", "\t", "\x0b", "\n", "b\na", "a\nb\nc", "\n\n", "]", "[", "&", "-", "_", "#x", "a b", "$", "^",
         ".", ".*", "\x07", "0", "٣", "\x85", "aC", "\\", "z", "aaaaaa", " ", "A\nB", "😀", "a😀b"]


def test_formats_equal_duckdb(spark):
    df = spark.createDataFrame([(v,) for v in DATES], "v string")
    got = df.select("v", *(strptime.parse(F.col("v"), f).cast("string").alias(f"f{i}") for i, f in enumerate(FORMATS))).collect()
    con = duckdb.connect()
    for r in got:
        for i, f in enumerate(FORMATS):
            assert (r["v"], f, r[f"f{i}"]) == (r["v"], f, con.execute("SELECT CAST(try_strptime(?, ?) AS VARCHAR)", [r["v"], f]).fetchone()[0])


@pytest.mark.parametrize("given", ["%Q", "%", "%Y-%", "%z", "%j %m", "%-b"])
def test_formats_that_are_refused(given):
    with pytest.raises(ValueError):
        strptime.compile_format(given)


def test_null_dates(spark):
    assert spark.sql("SELECT CAST(NULL AS STRING) AS v").select(strptime.parse(F.col("v"), "%Y")).first()[0] is None


@pytest.mark.parametrize("given", ["%Y%m%d", "%Y-%m-%d %I:%M %p", "%H:%M:%S.%f"])
def test_a_text_is_made_and_matched_once(spark, given):
    """Whatever number of parts refers to the groups."""
    plan = spark.range(1).select(strptime.parse(F.reverse(F.col("id").cast("string")), given).alias("at"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1 and plan.count("reverse(") == 1


def test_patterns_equal_duckdb(spark):
    df = spark.createDataFrame([(v,) for v in TEXTS], "v string")
    got = df.select("v", *(F.col("v").rlike(re2.translate(p)).alias(f"p{i}") for i, p in enumerate(PATTERNS))).collect()
    con = duckdb.connect()
    for r in got:
        for i, p in enumerate(PATTERNS):
            assert (p, r["v"], r[f"p{i}"]) == (p, r["v"], con.execute("SELECT regexp_matches(?, ?)", [r["v"], p]).fetchone()[0])


@pytest.mark.parametrize("pattern", REFUSED)
def test_refused_patterns(pattern):
    with pytest.raises(ValueError):
        re2.translate(pattern)
    with pytest.raises(duckdb.Error):
        duckdb.execute("SELECT regexp_matches('a', ?)", [pattern])


def test_pattern_without_a_counterpart():
    with pytest.raises(ValueError):
        re2.translate(r"\C")
