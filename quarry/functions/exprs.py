"""Typed-cast and calendar expressions, all of built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions import strptime

UNKNOWN_MONTH = "__unknown__"

LAYOUT_TYPES = {"string": "string", "integer": "bigint", "decimal": "double", "date": "date", "datetime": "timestamp_ntz"}

NUMERIC = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def clean(raw: Column) -> Column:
    """Trimmed text; blank is null."""
    return F.nullif(F.trim(raw.cast("string")), F.lit(""))


def _bare(text: Column) -> Column:
    """Without white space of any kind around it, which casts to numbers skip."""
    return F.btrim(text, F.lit(" \t\n\x0b\f\r"))


def to_bigint(text: Column) -> Column:
    """Whole number, rounding half away from zero where the text has a fraction or an exponent."""
    text = _bare(text)
    numeric = text.rlike(NUMERIC)
    exact = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))
    rounded = F.when(numeric, F.round(text.try_cast("double").try_cast("decimal(38,10)")).try_cast("bigint"))
    plain = F.when(numeric, F.round(text.try_cast("decimal(38,10)")).try_cast("bigint"))
    return F.coalesce(exact, plain, rounded)


def to_double(text: Column) -> Column:
    """Floating point; suffixes such as `5d` are invalid."""
    text = _bare(text)
    return F.when(text.rlike(NUMERIC) | F.lower(text).rlike(r"^[+-]?(nan|inf|infinity)$"), text.try_cast("double"))


def to_timestamp(text: Column, formats: list[str] | tuple[str, ...] = ()) -> Column:
    """First format that fits, then ISO text with a full date; wall-clock time, offsets are not applied."""
    tries = [strptime.parse(text, f) for f in formats]
    iso = F.when(text.rlike(r"^\d{4,}-\d{1,2}-\d{1,2}"), text.try_cast("timestamp_ntz"))
    return F.coalesce(*tries, iso)


def typed(raw: Column, kind: str, formats: list[str] | tuple[str, ...] = ()) -> Column:
    """A raw text column as a layout type; unknown types are text."""
    text = clean(raw)
    if kind == "integer":
        return to_bigint(text)
    if kind == "decimal":
        return to_double(text)
    if kind == "date":
        return to_timestamp(text, formats).cast("date")
    if kind == "datetime":
        return to_timestamp(text, formats)
    return text


def invalid(raw: Column, kind: str, formats: list[str] | tuple[str, ...] = ()) -> Column:
    """Text is there, but has no value of the type."""
    return clean(raw).isNotNull() & typed(raw, kind, formats).isNull()


def atomic_month(ts: Column | None) -> Column:
    return F.lit(UNKNOWN_MONTH) if ts is None else F.coalesce(F.date_format(ts, "yyyy-MM"), F.lit(UNKNOWN_MONTH))


def month_start(month: Column) -> Column:
    """First day of a month written YYYYMM or YYYY-MM; null for other text."""
    digits = F.replace(month, F.lit("-"), F.lit(""))
    return F.when(digits.rlike(r"^\d{6}$"), F.try_to_timestamp(F.concat(digits, F.lit("01")), F.lit("yyyyMMdd")).cast("date"))


def month_end(month: Column) -> Column:
    return F.last_day(month_start(month))


def safe_ratio(n: Column, d: Column) -> Column:
    """n / d as a double; null unless d is positive."""
    return F.when(F.coalesce(d, F.lit(0)) > 0, n.cast("double") / d)


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 2)


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def fingerprint(parts: Column) -> Column:
    """sha256 over sorted lines of an array of strings."""
    return F.sha2(F.concat_ws("\n", F.array_sort(parts)).cast("binary"), 256)
