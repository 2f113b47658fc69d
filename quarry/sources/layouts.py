"""Declarative layouts, routing rules, canonical schemas and mappings from JSON files."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import types as T

from quarry.functions.exprs import LAYOUT_TYPES
from quarry.functions.strptime import compile_format

CORRUPT = "_corrupt"


@dataclass(frozen=True)
class LayoutColumn:
    name: str
    type: str = "string"
    required: bool = False


@dataclass(frozen=True)
class Layout:
    layout_id: str
    file_type: str
    version: str
    columns: tuple[LayoutColumn, ...]
    submitter_id: str = "*"
    key: str = "default"
    anchor: str | None = None
    delimiter: str = ","
    header: bool = True
    date_formats: tuple[str, ...] = ()
    status: str = "ACTIVE"

    def __post_init__(self) -> None:
        for f in self.date_formats:
            compile_format(f)
        names = [c.name.lower() for c in self.columns]
        if len(set(names)) != len(names):
            raise ValueError(f"{self.layout_id}: column names differ in case only")
        if self.anchor and self.anchor.lower() not in names:
            raise ValueError(f"{self.layout_id}: anchor {self.anchor} is not a column")

    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, T.StringType()) for c in self.columns] + [T.StructField(CORRUPT, T.StringType())])

    def kind(self, name: str) -> str:
        return next(c.type for c in self.columns if c.name == name)

    def typed_ddl(self) -> str:
        return ", ".join(f"`{c.name}` {LAYOUT_TYPES.get(c.type, 'string')}" for c in self.columns)


def _pick(obj: dict, *names: str, default=None):
    return next((obj[n] for n in names if n in obj), default)


def layout_from(obj: dict, origin: str = "") -> Layout:
    schema, parser = obj["schema"], obj["parser_config"]
    columns = schema["columns"] if isinstance(schema, dict) else schema
    anchor = _pick(schema, "anchor_date_column", "anchor") if isinstance(schema, dict) else None
    anchor = anchor or _pick(parser, "anchor_date_column", "anchor", "atomic_month_column") or _pick(obj, "anchor_date_column", "anchor")
    file_type, version, submitter = obj["file_type"], _pick(obj, "layout_version", "version", default="v1"), _pick(obj, "submitter_id", default="*")
    return Layout(
        layout_id=_pick(obj, "layout_id", default=f"{submitter}/{file_type}/{version}"), file_type=file_type, version=version, submitter_id=submitter,
        key=_pick(obj, "layout_key", default="default"), anchor=anchor, delimiter=_pick(parser, "delimiter", default=","), header=bool(_pick(parser, "header", "has_header", default=True)),
        date_formats=tuple(_pick(parser, "date_formats", default=())), status=_pick(obj, "status", default="ACTIVE"),
        columns=tuple(LayoutColumn(c["name"], c.get("type", "string"), bool(c.get("required"))) for c in columns),
    )


def load_layouts(folder: str | Path) -> list[Layout]:
    """Files of `folder/*/*.json` that have a schema and a parser configuration; `routing/` is left out."""
    out = []
    for path in sorted(Path(folder).glob("*/*.json")):
        obj = json.loads(path.read_text())
        if path.parent.name != "routing" and "schema" in obj and "parser_config" in obj:
            out.append(layout_from(obj, str(path)))
    seen: set[tuple] = set()
    for x in out:
        identity = (x.submitter_id, x.file_type, x.key, x.version)
        if identity in seen:
            raise ValueError(f"two layouts are {identity}")
        seen.add(identity)
    return out


@dataclass(frozen=True)
class RoutingRule:
    rule_id: int
    submitter_id: str
    file_type: str
    layout_id: str
    pattern: str | None = None
    extension: str | None = None
    priority: int = 100
    status: str = "ACTIVE"


def load_routing(folder: str | Path) -> list[dict]:
    return [c for path in sorted(Path(folder).glob("routing/*.json")) for c in json.loads(path.read_text()).get("configs", [])]


@dataclass(frozen=True)
class CanonicalColumn:
    name: str
    type: str = "TEXT"
    required: bool = False


@dataclass(frozen=True)
class CanonicalSchema:
    schema_id: str
    file_type: str
    version: str
    columns: tuple[CanonicalColumn, ...] = field(default=())


def load_canonical(folder: str | Path) -> list[CanonicalSchema]:
    out = []
    for path in sorted(Path(folder).glob("*/*.json")):
        obj = json.loads(path.read_text())
        columns = tuple(CanonicalColumn(c["name"], c.get("type", "TEXT"), bool(c.get("required"))) for c in obj["columns"])
        version = _pick(obj, "schema_version", "version", default=path.stem)
        out.append(CanonicalSchema(_pick(obj, "canonical_schema_id", default=f"{obj['file_type']}/{version}"), obj["file_type"], version, columns))
    return out


def load_mappings(folder: str | Path) -> list[dict]:
    return [json.loads(path.read_text()) | {"_path": str(path)} for path in sorted(Path(folder).glob("*/*/*.json"))]
