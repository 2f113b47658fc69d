"""Layouts of all submitters onto one schema: mapping compiler, union with lineage, fingerprints to skip work."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.latest import latest_per_key, natural_version
from quarry.sources.files import ObjectStore, replace_months
from quarry.sources.layouts import CanonicalSchema

#: Canonical type names and what they are in Spark.
TYPES = {"TEXT": "string", "VARCHAR": "string", "DATE": "date", "BIGINT": "bigint", "DOUBLE": "double", "TIMESTAMP": "timestamp", "BOOLEAN": "boolean"}
FORMS = ("source", "expr", "const", "coalesce")


class MappingError(ValueError):
    """A mapping that can't be compiled against the data."""


def compile_mapping(spec: dict, columns: list[str], name: str = "") -> Column:
    """One of: source (with an optional cast that gives null for bad text), SQL expression, constant, coalesce."""
    have = {c.lower(): c for c in columns}
    given = [f for f in FORMS if f in spec]
    if len(given) != 1:
        raise MappingError(f"{name}: exactly one of {', '.join(FORMS)} is needed, not {given}")
    form = given[0]
    if form == "source":
        if spec["source"].lower() not in have:
            raise MappingError(f"{name}: column {spec['source']} is missing")
        c = F.col(f"`{have[spec['source'].lower()]}`")
        return c.try_cast(TYPES.get(spec["cast"].upper(), spec["cast"])) if spec.get("cast") else c
    if form == "expr":
        return F.expr(f"({spec['expr']})")
    if form == "const":
        return F.lit(str(spec["const"]))
    there = [F.col(f"`{have[c.lower()]}`") for c in spec["coalesce"] if c.lower() in have]
    if not there:
        raise MappingError(f"{name}: none of {spec['coalesce']} is there")
    return F.coalesce(*there)


def map_to_canonical(df: DataFrame, schema: CanonicalSchema, mapping: dict[str, dict], lineage: dict[str, Column]) -> DataFrame:
    """The schema's columns, cast so that a bad value fails the build, and lineage."""
    out = []
    for c in schema.columns:
        kind = TYPES.get(c.type.upper(), c.type)
        if c.name in mapping:
            out.append(compile_mapping(mapping[c.name], df.columns, c.name).cast(kind).alias(c.name))
        elif c.required:
            raise MappingError(f"{c.name} is required and has no mapping")
        else:
            out.append(F.lit(None).cast(kind).alias(c.name))
    return df.select(*out, *(v.alias(k) for k, v in lineage.items()))


@dataclass(frozen=True)
class Winner:
    submitter_id: str
    submission_id: str
    layout_id: str
    mapping_id: str
    mapping_version: str
    mapping: dict
    path: str

    def line(self) -> str:
        return "|".join((self.submitter_id, self.submission_id, self.layout_id, self.mapping_id, self.mapping_version))


def input_fingerprint(schema: CanonicalSchema, winners: list[Winner]) -> str:
    """Names all that goes into a build, whatever the order of the winners."""
    lines = [f"schema:{schema.schema_id}:{schema.version}", *(w.line() for w in sorted(winners, key=lambda w: (w.submitter_id, w.submission_id, w.layout_id, w.mapping_id, w.mapping_version)))]
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def latest_schema(schemas: DataFrame, file_type: str, lexical: bool = False) -> DataFrame:
    """Newest active schema of a type; versions by number, or as text with `lexical`."""
    active = schemas.where((F.col("file_type") == file_type) & (F.col("status") == "ACTIVE"))
    return active.orderBy(F.desc(F.col("schema_version") if lexical else natural_version(F.col("schema_version")))).limit(1)


def winners_with_mappings(pointers: DataFrame, submissions: DataFrame, mappings: DataFrame, lexical: bool = False) -> DataFrame:
    """Pointers of a month with their submission's layout and the newest active mapping of it."""
    version = F.col("mapping_version") if lexical else natural_version(F.col("mapping_version"))
    newest = latest_per_key(mappings.where("status = 'ACTIVE'"), ["layout_id", "canonical_schema_id"], [version, "created_at"])
    s = submissions.select(F.col("submission_id").alias("winning_submission_id"), "layout_id")
    return pointers.join(s, "winning_submission_id").join(newest.select("layout_id", "canonical_schema_id", "mapping_id", "mapping_version", "mapping_json"), "layout_id")


@dataclass(frozen=True)
class BuildResult:
    status: str
    fingerprint: str
    rows: int | None = None


def _place(spark: SparkSession, path: str, month: str) -> tuple[str, str] | None:
    """What to read for a month of a winner's table and the name of the table's folder in its files' paths; None: no such month."""
    path = path.rstrip("/")
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    fs = jvm(path).getFileSystem(spark._jsc.hadoopConfiguration())
    root = re.sub("^file:/+", "file:/", fs.makeQualified(jvm(path)).toUri().toString())
    part = f"{path}/atomic_month={month}"
    if fs.exists(jvm(part)):
        return part, root
    parted = fs.exists(jvm(path)) and any(s.isDirectory() and s.getPath().getName().startswith("atomic_month=") for s in fs.listStatus(jvm(path)))
    return None if parted else (path, root)


def _class_frame(spark: SparkSession, places: list[tuple[str, str]], winners: list[Winner], state: str, file_type: str, month: str, schema: CanonicalSchema, now: Column) -> DataFrame:
    """Winners of one mapping and layout: one scan of all their folders; whose a row is follows from its file's path."""
    names = spark.createDataFrame([(root, w.submitter_id, w.submission_id) for (_, root), w in zip(places, winners, strict=True)], "_root string, _submitter string, _submission string")
    df = spark.read.option("mergeSchema", "true").parquet(*(path for path, _ in places))
    if "atomic_month" in df.columns:  # a column of the files
        df = df.where(F.col("atomic_month") == month)
    file = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/")
    df = df.select("*", F.regexp_extract(file, "^(.*?)(/atomic_month=[^/]*)?/[^/]*$", 1).alias("_root")).join(names, "_root")
    lineage = {
        "state": F.lit(state), "file_type": F.lit(file_type), "atomic_month": F.lit(month), "submitter_id": F.col("_submitter"), "source_submission_id": F.col("_submission"),
        "source_layout_id": F.lit(winners[0].layout_id), "canonical_schema_version": F.lit(schema.version), "canonical_built_at": now,
    }
    return map_to_canonical(df, schema, winners[0].mapping, lineage)


def build_month(spark: SparkSession, out: str, state: str, file_type: str, month: str, schema: CanonicalSchema, winners: list[Winner], previous: str | None, now: Column) -> BuildResult:
    """Replace a month of the canonical table with the union of its winners; SKIPPED if the inputs are unchanged.

    Winners of one layout and mapping are a class, and one scan of many folders: the plan has a branch for each class, however
    many submitters there are. The write is rebalanced and observes its number of rows. A month that has no rows
    any more is emptied.
    """
    from pyspark.sql import Observation

    if not winners:
        raise ValueError(f"{state}/{file_type}/{month}: no winner")
    mark = input_fingerprint(schema, winners)
    if mark == previous:
        return BuildResult("SKIPPED", mark)
    classes: dict[tuple, list[tuple[tuple[str, str], Winner]]] = {}
    for w in sorted(winners, key=lambda w: (w.submitter_id, w.submission_id)):
        if place := _place(spark, w.path, month):
            classes.setdefault((w.layout_id, json.dumps(w.mapping, sort_keys=True)), []).append((place, w))
    rows = 0
    if classes:
        frames = [_class_frame(spark, [p for p, _ in members], [w for _, w in members], state, file_type, month, schema, now) for members in classes.values()]
        seen = Observation()
        union = reduce(DataFrame.unionByName, frames).observe(seen, F.count("*").alias("rows"))
        replace_months(union.hint("rebalance"), out, [month])
        rows = seen.get["rows"]
    else:
        ObjectStore(spark, out).delete(f"atomic_month={month}")
    return BuildResult("SUCCEEDED", mark, rows)
