"""Latest row of a key, as an aggregate: partial maxima before the shuffle, and a join on the result can be removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The row with the largest `order` of each key. Null order values are below all others."""
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    rest = [c for c in df.columns if c not in keys]
    top = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*(c.alias(f"o{i}") for i, c in enumerate(columns)))).alias("_top"))
    return top.select(*(F.col(c) if c in keys else F.col(f"_top.{c}").alias(c) for c in df.columns))


def natural_version(version: Column) -> Column:
    """Order of versions by number (v2 before v10); text order decides among equal numbers."""
    return F.struct(F.coalesce(F.regexp_extract(version, r"(\d+)", 1).try_cast("bigint"), F.lit(-1)).alias("n"), version.alias("t"))
