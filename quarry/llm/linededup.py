"""Line dedup by site-relative frequency.

For each host, the pages that contain a line are divided by the host's pages; lines above a ratio are boilerplate
and are dropped from all pages of that host. Only DataFrame functions are used.

A line is what stands between line feeds, without spaces, tabs and carriage returns at its ends; blank lines are
kept as they are and never counted. A line counts once for each page, a row is a page (repeated rows are pages of
their own), and a null host is a host of its own, written as the empty string. Hosts with fewer than `min_pages`
pages lose nothing. Null text stays null; a page all of whose lines are dropped keeps its row with an empty text.
A line is compared by 96 bits of hashes. A share equal to the ratio is kept.

The shuffle carries a host and hashes for each line, counted before it is sent. A host's dropped lines are at most
its mean lines a page divided by the ratio, so the list that joins back is short however large the host is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import common

EDGES = " \t\r"
#: Dropped lines that may be broadcast, all hosts together; more are joined by host.
BROADCAST_LINES = 500_000

INLINE = "a|abbr|b|bdi|bdo|big|cite|code|data|del|dfn|em|font|i|ins|kbd|mark|q|s|samp|small|span|strong|sub|sup|time|tt|u|var|wbr"
HIDDEN = r"(?is)<!--.*?-->|<(?:script|style|noscript|template|head)\b.*?</(?:script|style|noscript|template|head)\s*>"


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without user and port; null where there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)), F.lit(""))


def html_lines(html: Column) -> Column:
    """Text of a page with a line feed at each block; comments, scripts and styles are left out."""
    shown = F.regexp_replace(html, HIDDEN, "\n")
    shown = F.regexp_replace(shown, rf"(?is)</?(?:{INLINE})(?:\s[^>]*)?>", "")
    shown = F.regexp_replace(shown, r"(?s)<[^>]*>", "\n")
    return F.btrim(F.regexp_replace(shown, r"[ \t\r]*\n[ \t\r\n]*", "\n"), F.lit(EDGES + "\n"))


def _hash(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"))


def boilerplate(pages: DataFrame, host: Column, text: Column, ratio: float, min_pages: int = 5) -> DataFrame:
    """(host, dropped: array of line hashes) for hosts that have boilerplate."""
    host = F.coalesce(host, F.lit("")).alias("host")
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(EDGES))), lambda x: x != "")
    counted = pages.select(host, F.explode_outer(F.array_distinct(F.transform(lines, _hash))).alias("line")).where(F.col("line").isNotNull()).groupBy("host", "line").agg(F.count("*").alias("n"))
    totals = pages.select(host).groupBy("host").agg(F.count("*").alias("total")).where(F.col("total") >= min_pages)
    frequent = counted.where(F.col("n") >= max(2, int(ratio * min_pages)))
    return frequent.join(totals, "host").where(F.col("n") > F.lit(ratio) * F.col("total")).groupBy("host").agg(F.collect_list("line").alias("dropped"))


def drop_lines(pages: DataFrame, host: Column, text: str, ratio: float = 0.08, min_pages: int = 5, kept: str | None = None, dropped: str | None = None) -> DataFrame:
    """`pages` with the text, or column `kept`, free of its host's boilerplate; `dropped` counts the lines it lost."""
    spark = pages.sparkSession
    lists = common.materialise(boilerplate(pages, host, F.col(text), ratio, min_pages).select(F.col("host").alias("__host"), F.col("dropped").alias("__dropped")), "boilerplate")
    size = lists.agg(F.coalesce(F.sum(F.size("__dropped")), F.lit(0)).alias("n")).first()["n"]
    lists = F.broadcast(lists) if size <= BROADCAST_LINES else lists
    out = pages.withColumn("__at", F.coalesce(host, F.lit(""))).join(lists, F.col("__at") == F.col("__host"), "left")
    hit = lambda x: F.array_contains(F.col("__dropped"), _hash(F.btrim(x, F.lit(EDGES))))
    split = F.split(F.col(text), "\n")
    has = F.col("__dropped").isNotNull()
    columns = list(pages.columns)
    if dropped:
        out = out.withColumn("__lost", F.when(has & F.col(text).isNotNull(), F.size(F.filter(split, hit))).otherwise(0))
    out = out.withColumn("__kept", F.when(has, F.array_join(F.filter(split, lambda x: ~hit(x)), "\n")).otherwise(F.col(text)))
    name = kept or text
    chosen = [F.col("__kept").alias(c) if c == name else F.col(c) for c in columns]
    if name not in columns:
        chosen.append(F.col("__kept").alias(name))
    if dropped:
        chosen.append(F.col("__lost").cast("long").alias(dropped))
    return out.select(*chosen)


def op9_line_dedup(spark: SparkSession, sf_dir: str, ratio: float = 0.08, min_pages: int = 5) -> DataFrame:
    """`pages`, whose hosts are in their URLs: the text of each page without its host's boilerplate lines."""
    pages = common.table(spark, sf_dir, "pages").select("page_id", host_of(F.col("url")).alias("host"), html_lines(F.col("html")).alias("text"))
    pages = common.materialise(pages, "page-lines")  # read twice
    out = drop_lines(pages, F.col("host"), "text", ratio, min_pages, dropped="n_dropped")
    return out.select("page_id", "host", "text", "n_dropped")


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str, ratio: float = 0.08, min_pages: int = 5) -> DataFrame:
    """Documents, whose host is their source, without boilerplate lines; n_chars follows the text.

    No row goes: a text of nothing but boilerplate is empty, a null text stays null. A null source is a host like others,
    equal rows count as pages of their own, and an empty table stays empty.
    """
    out = drop_lines(docs, F.col("source"), "text", ratio, min_pages)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


_LINES = r"list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> '')"


def _sql(source: str, key: str, out: str, ratio: float, min_pages: int) -> str:
    """`source` has key, host (not null) and text."""
    return f"""
    WITH pages_ AS ({source}),
    totals AS (SELECT host, count(*) AS total FROM pages_ GROUP BY host),
    counted AS (
      SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct({_LINES})) AS line FROM pages_) GROUP BY host, line),
    dropped AS (
      SELECT c.host, list(c.line) AS lines FROM counted c JOIN totals t ON c.host = t.host
      WHERE t.total >= {min_pages} AND c.n >= 2 AND c.n > CAST({ratio} AS DOUBLE) * t.total GROUP BY c.host)
    SELECT {out} FROM (
      SELECT p.*, string_split(p.text, chr(10)) AS all_lines,
        CASE WHEN d.lines IS NULL THEN string_split(p.text, chr(10))
             ELSE list_filter(string_split(p.text, chr(10)), lambda x: NOT list_contains(d.lines, trim(x, ' ' || chr(9) || chr(13)))) END AS kept_lines
      FROM pages_ p LEFT JOIN dropped d ON p.host = d.host)
    """


def sql_pages(ratio: float = 0.08, min_pages: int = 5) -> str:
    hidden = HIDDEN.removeprefix("(?is)")
    text = f"regexp_replace(html, '{hidden}', chr(10), 'gis')"
    text = rf"regexp_replace({text}, '</?(?:{INLINE})(?:\s[^>]*)?>', '', 'gis')"
    text = rf"regexp_replace({text}, '<[^>]*>', chr(10), 'gs')"
    text = rf"trim(regexp_replace({text}, '[ \t\r]*\n[ \t\r\n]*', chr(10), 'g'), ' ' || chr(9) || chr(13) || chr(10))"
    host = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1))"
    source = f"SELECT page_id, coalesce({host}, '') AS host, {text} AS text FROM pages"
    out = "page_id, nullif(host, '') AS host, array_to_string(kept_lines, chr(10)) AS text, CAST(coalesce(len(all_lines) - len(kept_lines), 0) AS BIGINT) AS n_dropped"
    return _sql(source, "page_id", out, ratio, min_pages)
