"""Delimited files to typed, month-partitioned Parquet, with an exact account of what was lost.

One scan of the files: typed rows are kept on the executors' disks while rows, rejects and counters are taken from them,
and computed again where an executor is lost. Months are written by tasks of bounded size. `read = written + rejected`; rows of the
wrong shape are counted apart and belong to neither. Null counts are over kept rows, invalid counts over all.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import exprs
from quarry.sources.files import ObjectStore, scan_csv
from quarry.sources.layouts import CORRUPT, Layout

LINEAGE = ("submission_id", "source_object_key", "ingested_at", "layout_id", "layout_version")


@dataclass
class ParseReport:
    submission_id: str
    layout_id: str
    rows_read: int = 0
    rows_written: int = 0
    rows_rejected: int = 0
    rows_malformed: int = 0
    files: list[dict] = field(default_factory=list)
    columns: list[dict] = field(default_factory=list)
    partitions: dict[str, int] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)


def type_columns(raw: DataFrame, layout: Layout) -> DataFrame:
    """Typed columns, `_invalid` (names of columns whose text has no value of the type), month and reject flag.

    A column of the layout that the input lacks is a typed null. `raw` may hold more columns; they pass through.
    """
    have = {c.lower(): c for c in raw.columns}
    new, bad = {}, []
    for c in layout.columns:
        source = F.col(f"`{have[c.name.lower()]}`") if c.name.lower() in have else F.lit(None).cast("string")
        new[c.name] = exprs.typed(source, c.type, layout.date_formats)
        if c.type in ("integer", "decimal", "date", "datetime"):
            bad.append(F.when(exprs.invalid(source, c.type, layout.date_formats), F.lit(c.name)))
    names = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    passed = [F.col(f"`{c}`") for c in raw.columns if c.lower() not in {x.name.lower() for x in layout.columns}]
    out = raw.select(*(v.alias(k) for k, v in new.items()), names.alias("_invalid"), *passed)
    anchor = next((c for c in layout.columns if layout.anchor and c.name.lower() == layout.anchor.lower()), None)
    month = exprs.atomic_month(None if anchor is None else (F.col(f"`{anchor.name}`") if anchor.type in ("date", "datetime") else exprs.to_timestamp(F.col(f"`{anchor.name}`").cast("string"), layout.date_formats)))
    return out.withColumns({"atomic_month": month, "_row_rejected": F.size("_invalid") > 0})


def _counters(layout: Layout, malformed: Column) -> list[Column]:
    fine = ~malformed
    kept = fine & ~F.col("_row_rejected")
    out = [F.count_if(fine).alias("read"), F.count_if(kept).alias("written"), F.count_if(fine & F.col("_row_rejected")).alias("rejected"), F.count_if(malformed).alias("malformed")]
    for i, c in enumerate(layout.columns):
        out.append(F.count_if(kept & F.col(f"`{c.name}`").isNull()).alias(f"null_{i}"))
        out.append(F.count_if(fine & F.array_contains("_invalid", c.name)).alias(f"invalid_{i}"))
    return out


def metrics(typed: DataFrame, layout: Layout, by: list[str] | None = None) -> DataFrame:
    """All counters in one aggregate, partial sums first; with `by`, for each group."""
    malformed = F.col(CORRUPT).isNotNull() if CORRUPT in typed.columns else F.lit(False)
    return typed.groupBy(*(by or [])).agg(*_counters(layout, malformed))


def parse_to_silver(
    spark: SparkSession, paths: list[str], layout: Layout, out: str, submission_id: str, now: datetime, rejected: str | None = None, report: tuple[ObjectStore, str] | None = None
) -> ParseReport:
    """Parse files to `out` (replaced as a whole), and rejected rows with their reasons to `rejected` if given."""
    raw = scan_csv(spark, paths, layout)
    typed = type_columns(raw, layout)
    lineage = {
        "submission_id": F.lit(submission_id), "source_object_key": F.col("_source_file"), "ingested_at": F.lit(now.replace(tzinfo=None)).cast("timestamp_ntz"),
        "layout_id": F.lit(layout.layout_id), "layout_version": F.lit(layout.version),
    }
    typed = typed.withColumns(lineage).persist(StorageLevel.DISK_ONLY)
    good = typed.where(F.col(CORRUPT).isNull() & ~F.col("_row_rejected")).drop(CORRUPT, "_row_rejected", "_invalid", "_source_file")
    good.hint("rebalance", "atomic_month").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("atomic_month").parquet(out)
    if rejected:
        typed.where(F.col(CORRUPT).isNotNull() | F.col("_row_rejected")).drop("_row_rejected").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(rejected)
    found = metrics(typed, layout, ["_source_file", "atomic_month"]).collect()  # files x months rows
    typed.unpersist()
    r = ParseReport(submission_id, layout.layout_id)
    files: dict[str, dict] = {}
    for row in found:
        f = files.setdefault(row["_source_file"], {"raw_object_key": row["_source_file"], "rows_read": 0, "rows_written": 0, "rows_rejected": 0, "rows_malformed": 0})
        for k, n in (("rows_read", "read"), ("rows_written", "written"), ("rows_rejected", "rejected"), ("rows_malformed", "malformed")):
            f[k] += row[n]
            setattr(r, k, getattr(r, k) + row[n])
        if row["written"]:
            r.partitions[row["atomic_month"]] = r.partitions.get(row["atomic_month"], 0) + row["written"]
    r.files = sorted(files.values(), key=lambda f: f["raw_object_key"])
    r.columns = [{"column_name": c.name, "null_count": sum(x[f"null_{i}"] for x in found), "invalid_count": sum(x[f"invalid_{i}"] for x in found)} for i, c in enumerate(layout.columns)]
    if n := r.partitions.get(exprs.UNKNOWN_MONTH):
        r.warnings.append(f"{n} rows without a month")
    if report:
        report[0].put(report[1], json.dumps(asdict(r), sort_keys=True).encode())
    return r
