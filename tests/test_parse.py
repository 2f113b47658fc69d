import gzip
import json
from datetime import datetime

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions import exprs
from quarry.operators.parse import parse_to_silver
from quarry.sources import records
from quarry.sources.files import ObjectStore, discover_months, scan_csv, scan_months
from quarry.sources.layouts import Layout, LayoutColumn, layout_from, load_layouts

MEDICAL = Layout(
    "L1", "medical", "v1",
    (LayoutColumn("Id", "string", True), LayoutColumn("START", "datetime", True), LayoutColumn("STOP", "datetime"), LayoutColumn("PATIENT", "string", True), LayoutColumn("CODE"), LayoutColumn("COST", "decimal"), LayoutColumn("N", "integer")),
    anchor="START", date_formats=("%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%d"),
)
NOW = datetime(2025, 3, 1)


def parse(spark, tmp_path, *files, layout=MEDICAL):
    paths = []
    for i, text in enumerate(files):
        paths.append(str(tmp_path / f"in{i}.csv"))
        (tmp_path / f"in{i}.csv").write_text(text)
    out = str(tmp_path / "silver")
    return parse_to_silver(spark, paths, layout, out, "S1", NOW, rejected=str(tmp_path / "rejected")), spark.read.parquet(out)


def test_one_valid_row(spark, tmp_path):
    r, df = parse(spark, tmp_path, "Id,START,STOP,PATIENT,CODE\ne1,2025-01-02T03:04:05Z,,p1,99\n")
    assert (r.rows_read, r.rows_written, r.rows_rejected, r.partitions) == (1, 1, 0, {"2025-01": 1})
    row = df.first()
    assert row["START"] == datetime(2025, 1, 2, 3, 4, 5) and row["submission_id"] == "S1" and row["COST"] is None
    assert dict(df.dtypes)["COST"] == "double" and dict(df.dtypes)["atomic_month"] == "string"


def test_bad_date_rejects_its_row_only(spark, tmp_path):
    r, df = parse(spark, tmp_path, "Id,START,STOP,PATIENT,CODE\na,2025-01-01,,p,1\nb,not a date,,p,1\nc,2025-02-01,,p,1\n")
    assert (r.rows_read, r.rows_rejected, r.rows_written) == (3, 1, 2)
    assert df.count() == 2
    assert spark.read.parquet(str(tmp_path / "rejected")).first()["_invalid"] == ["START"]


def test_null_counts_are_of_kept_rows_and_invalid_counts_of_all(spark, tmp_path):
    r, _ = parse(spark, tmp_path, "Id,START,STOP,PATIENT,CODE\na,2025-01-01,2025-01-02,p,1\nb,2025-01-01, ,p,1\nc,2025-01-01,soon,p,1\n")
    stop = next(c for c in r.columns if c["column_name"] == "STOP")
    assert (stop["null_count"], stop["invalid_count"]) == (1, 1)


def test_malformed_rows_are_counted_apart(spark, tmp_path):
    r, _ = parse(spark, tmp_path, "Id,START,STOP,PATIENT,CODE\na,2025-01-01,,p,1\nb,2025-01-01\nc,2025-01-01,,p,1,extra,more\n")
    assert (r.rows_read, r.rows_written, r.rows_malformed) == (1, 1, 2)


def test_files_with_headers_of_their_own(spark, tmp_path):
    r, df = parse(spark, tmp_path, "Id,START,PATIENT,N\na,2025-01-01,p,12.7\n", "PATIENT,id,unused,START\nq,b,x,2025-02-01\n")
    assert r.rows_written == 2 and len(r.files) == 2
    assert {(x["Id"], x["PATIENT"], x["N"]) for x in df.collect()} == {("a", "p", 13), ("b", "q", None)}


def test_gzip_and_unknown_month(spark, tmp_path):
    path = tmp_path / "m.csv.gz"
    path.write_bytes(gzip.compress(b"Id,PATIENT\n1,x\n"))
    layout = Layout("L2", "members", "v1", (LayoutColumn("Id"), LayoutColumn("PATIENT")))
    r = parse_to_silver(spark, [str(path)], layout, str(tmp_path / "s"), "S", NOW, report=(ObjectStore(spark, str(tmp_path)), "r/parse_report.json"))
    assert r.partitions == {"__unknown__": 1} and r.warnings
    assert json.loads((tmp_path / "r/parse_report.json").read_text())["rows_written"] == 1


def test_empty_file_list_and_empty_file(spark, tmp_path):
    (tmp_path / "e.csv").write_text("Id,START\n")
    r = parse_to_silver(spark, [str(tmp_path / "e.csv")], MEDICAL, str(tmp_path / "s"), "S", NOW)
    assert (r.rows_read, r.partitions) == (0, {})
    assert scan_csv(spark, [], MEDICAL).count() == 0


def test_file_without_a_byte(spark, tmp_path):
    r, _ = parse(spark, tmp_path, "", "Id,START,PATIENT\na,2025-01-01,p\n")
    assert (r.rows_read, r.rows_malformed, len(r.files)) == (1, 0, 1)


THREE = Layout("L3", "notes", "v1", (LayoutColumn("A"), LayoutColumn("B"), LayoutColumn("C")))


def some_csv(rng, n):
    """Rows, and their text with quotes, delimiters and line feeds in fields, and quotes that mean nothing."""

    def one():
        return rng.choice(["", "x y", "line\nfeed", 'q"uote', "a,b", "\n\n" + "z" * rng.randrange(30), '",\n"', "w" * rng.randrange(1, 12)])

    def written(v):
        if any(c in v for c in '",\n') or rng.random() < 0.2:
            return '"' + v.replace('"', '""') + '"'
        return v

    rows = [[one() for _ in range(3)] for _ in range(n)]
    rows += [['5" pipe', 'b"', "c"], ["end", "\n", ""]]
    text = "A,B,C\n" + "".join(",".join(v if '" ' in v or v == 'b"' else written(v) for v in r) + "\n" for r in rows)
    return rows, text


@pytest.mark.parametrize("split", [16, 64, 1 << 20])
@pytest.mark.parametrize("feed", ["\n", "\r\n"])
def test_line_feeds_in_quotes(spark, tmp_path, split, feed):
    """Records equal DuckDB's wherever the file is split, at feeds and between the two quotes of a pair too."""
    import random

    rows, text = some_csv(random.Random(split), 25)
    path = tmp_path / "with space.csv"
    path.write_text(text.replace("\n", feed), newline="")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        got = scan_csv(spark, [str(path)], THREE).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    columns = "{'A': 'VARCHAR', 'B': 'VARCHAR', 'C': 'VARCHAR'}"
    want = duckdb.sql(f"SELECT * FROM read_csv('{path}', delim=',', header=true, quote='\"', escape='\"', auto_detect=false, columns={columns}, ignore_errors=true, strict_mode=false)").fetchall()
    text_of = lambda r: tuple(v or "" for v in r)
    assert sorted(text_of((r["A"], r["B"], r["C"])) for r in got) == sorted(map(text_of, want)) == sorted(tuple(v.replace("\n", feed) for v in r) for r in rows)
    assert all(r["_corrupt"] is None for r in got) and len({r["_source_file"] for r in got}) == 1


def test_malformed_and_blank_beside_line_feeds(spark, tmp_path):
    r, df = parse(spark, tmp_path, 'Id,START,STOP,PATIENT,CODE\n\na,2025-01-01,,"p\nq",1\nb,2025-01-01\n \nc,2025-01-01,,p,1,"ex\ntra"\n', "Id,START,PATIENT\nd,2025-02-01,p\n")
    assert (r.rows_read, r.rows_written, r.rows_malformed) == (2, 2, 2)
    assert {x["PATIENT"] for x in df.collect()} == {"p\nq", "p"}


def test_header_over_two_lines(spark, tmp_path):
    (tmp_path / "h.csv").write_text('"A\nlong",B\n1,"x\ny"\n')
    layout = Layout("L4", "notes", "v1", (LayoutColumn("A\nlong"), LayoutColumn("B")))
    assert [tuple(r)[:2] for r in scan_csv(spark, [str(tmp_path / "h.csv")], layout).collect()] == [("1", "x\ny")]


def test_unclosed_quote(spark, tmp_path):
    (tmp_path / "u.csv").write_text('A,B,C\n1,2,"open\n' + "x\n" * 50)
    got = scan_csv(spark, [str(tmp_path / "u.csv")], THREE).collect()
    assert len(got) == 1 and got[0]["A"] == "1"
    with pytest.raises(Exception, match="a quote isn't closed"):
        records.read_records(spark, [str(tmp_path / "u.csv")], ",", True, most=50).collect()


def test_months(spark, tmp_path):
    _, df = parse(spark, tmp_path, "Id,START,PATIENT\na,2025-01-01,p\nb,2025-02-01,p\n")
    assert discover_months(df) == ["2025-01", "2025-02"] and discover_months(df.drop("atomic_month")) == ["__all__"]
    one = scan_months(spark, str(tmp_path / "silver"), "2025-01")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(atomic_month" in one._jdf.queryExecution().toString()


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [("12.7", "integer", 13), ("-2.5", "integer", -3), ("1e3", "integer", 1000), ("5d", "decimal", None), ("1_000", "decimal", None), (" 7 ", "integer", 7), ("", "integer", None), ("x", "string", "x"), ("  ", "string", None), ("99999999999999999999", "integer", None), ("2025-01", "date", None), ("\t5 ", "integer", 5), ("\t5.5", "decimal", 5.5)],
)
def test_typed_values(spark, text, kind, value):
    assert spark.range(1).select(exprs.typed(F.lit(text), kind, ("%Y-%m-%d",)).alias("v")).first()["v"] == value


def test_dates_without_leading_zeros(spark):
    row = spark.range(1).select(exprs.typed(F.lit("2025-1-5"), "date", ("%Y-%m-%d",)).alias("a"), exprs.month_end(F.lit("202402")).alias("b"), exprs.month_start(F.lit("2024-xx")).alias("c")).first()
    assert (str(row["a"]), str(row["b"]), row["c"]) == ("2025-01-05", "2024-02-29", None)


@given(st.integers(-(10**12), 10**12))
def test_rounding_is_half_away_from_zero(n):
    import decimal

    text = f"{n}.5"
    want = int(decimal.Decimal(text).to_integral_value(decimal.ROUND_HALF_UP))
    assert want == (n + 1 if n >= 0 and not text.startswith("-") else n - 1)


def test_layout_files(tmp_path):
    (tmp_path / "medical").mkdir()
    obj = {"file_type": "medical", "layout_version": "v1", "schema": {"columns": [{"name": "A", "type": "date"}], "anchor_date_column": "A"}, "parser_config": {"delimiter": "|", "header": True, "date_formats": ["%Y%m%d"]}}
    (tmp_path / "medical/v1.json").write_text(json.dumps(obj))
    (tmp_path / "medical/other.json").write_text("{}")
    (got,) = load_layouts(tmp_path)
    assert got.anchor == "A" and got.delimiter == "|" and layout_from(obj) == got
    (tmp_path / "medical/v1b.json").write_text(json.dumps(obj))
    with pytest.raises(ValueError):
        load_layouts(tmp_path)
