"""From inbox objects to routed submissions: change detection, closing of groups, filename conventions, routing."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKER = "_SUCCESS"
QUIET_MINUTES = 10


def detect_changes(state: DataFrame, listing: DataFrame, now: Column) -> DataFrame:
    """The inbox state after a listing, with `changed` for new objects and those whose size or etag differs.

    State: object_key, submitter_id, first_seen_at, last_seen_at, last_changed_at, bytes, etag, status. Objects that
    the listing lacks stay as they are; moved ones stay moved.
    """
    new = listing.select("object_key", F.col("bytes").alias("nb"), F.col("etag").alias("ne")).withColumn("seen", F.lit(True))
    j = state.join(new, "object_key", "full_outer")
    fresh = F.col("status").isNull()
    differs = F.coalesce(F.col("seen"), F.lit(False)) & (fresh | ~F.col("bytes").eqNullSafe(F.col("nb")) | ~F.col("etag").eqNullSafe(F.col("ne")))
    seen = F.coalesce(F.col("seen"), F.lit(False))
    return j.select(
        "object_key", F.coalesce("submitter_id", F.get(F.split("object_key", "/"), F.lit(1))).alias("submitter_id"), F.coalesce("first_seen_at", now).alias("first_seen_at"),
        F.when(seen, now).otherwise(F.col("last_seen_at")).alias("last_seen_at"), F.when(differs, now).otherwise(F.col("last_changed_at")).alias("last_changed_at"),
        F.when(seen, F.col("nb")).otherwise(F.col("bytes")).alias("bytes"), F.when(seen, F.col("ne")).otherwise(F.col("etag")).alias("etag"),
        F.when(F.col("status") == "MOVED", "MOVED").when(seen, "SEEN").otherwise(F.col("status")).alias("status"), differs.alias("changed"),
    )


def closed_groups(objects: DataFrame, as_of: Column, quiet_minutes: int = QUIET_MINUTES) -> DataFrame:
    """(object_key, submitter_id, inbox_prefix, grouping_method) of seen objects whose group is closed.

    A marker closes everything else below its folder; of nested markers the deepest takes an object. An object no marker
    claims is closed if it hasn't changed for `quiet_minutes`, whatever its siblings do.
    """
    seen = objects.where("status = 'SEEN'")
    base = F.element_at(F.split("object_key", "/"), -1)
    data = seen.where(base != MARKER)
    markers = seen.where(base == MARKER).select(F.regexp_replace("object_key", f"{MARKER}$", "").alias("prefix"))
    # every folder above an object, as keys of an equi-join: no object is compared with all markers
    parts = F.split("object_key", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.concat(F.array_join(F.slice(parts, 1, n), "/"), F.lit("/")))
    claimed = data.where(F.col("object_key").contains("/")).select("object_key", "submitter_id", F.explode(above).alias("prefix")).join(markers, "prefix")
    claimed = claimed.groupBy("object_key", "submitter_id").agg(F.max_by("prefix", F.length("prefix")).alias("prefix"))
    by_marker = claimed.select("object_key", F.get(F.split("prefix", "/"), F.lit(1)).alias("submitter_id"), F.regexp_replace("prefix", "/$", "").alias("inbox_prefix"), F.lit("MARKER").alias("grouping_method"))
    quiet = F.coalesce("last_changed_at", "last_seen_at") <= as_of - F.expr(f"INTERVAL {int(quiet_minutes)} MINUTES")
    by_time = data.where(quiet).join(by_marker.select("object_key"), "object_key", "left_anti")
    by_time = by_time.select("object_key", "submitter_id", F.concat(F.lit("inbox/"), F.col("submitter_id")).alias("inbox_prefix"), F.lit("QUIESCENCE").alias("grouping_method"))
    return by_marker.unionByName(by_time)


def group_fingerprint(groups: DataFrame, objects: DataFrame) -> DataFrame:
    """(inbox_prefix, grouping_method, object_keys, fingerprint): names a group's files, sizes and etags."""
    j = groups.join(objects.select("object_key", "bytes", "etag"), "object_key")
    one = F.concat_ws(":", "object_key", F.col("bytes").cast("string"), F.coalesce("etag", F.lit("")))
    files = F.array_sort(F.collect_list(F.struct(F.col("object_key").alias("k"), one.alias("p"))))
    out = j.groupBy("submitter_id", "inbox_prefix", "grouping_method").agg(files.alias("f"))
    text = F.concat(F.col("inbox_prefix"), F.lit("|"), F.array_join(F.transform("f", lambda x: x["p"]), "|"))
    return out.select("submitter_id", "inbox_prefix", "grouping_method", F.transform("f", lambda x: x["k"]).alias("object_keys"), F.sha2(text.cast("binary"), 256).alias("fingerprint"))


def new_groups(groups: DataFrame, submissions: DataFrame) -> DataFrame:
    """Groups whose fingerprint no submission has."""
    return groups.join(submissions.select(F.col("group_fingerprint").alias("fingerprint")).where("fingerprint IS NOT NULL").distinct(), "fingerprint", "left_anti")


@dataclass(frozen=True)
class Parsed:
    file_type: str = "unknown"
    start: str | None = None
    end: str | None = None
    layout_version: str | None = None
    confidence: float = 0.0


class Convention:
    """A way to read file names. Subclasses say which they match and what those mean."""

    name = "convention"

    def parse(self, filename: str) -> Parsed | None:
        raise NotImplementedError


class CoverageConvention(Convention):
    """`type_YYYYMM_YYYYMM.txt|csv|gz`, in either case."""

    def __init__(self, file_type: str):
        self.file_type, self.name = file_type, f"{file_type}_coverage"
        self.pattern = f"(?i)^{re.escape(file_type)}_([0-9]{{6}})_([0-9]{{6}})\\.(txt|csv|gz)$"

    def parse(self, filename: str) -> Parsed | None:
        m = re.match(self.pattern, filename)
        return Parsed(self.file_type, m[1], m[2], "v1", 1.0) if m else None

    def columns(self, filename: Column) -> Column:
        """The same as a struct column; null where the name doesn't match."""
        part = lambda n: F.regexp_extract(filename, self.pattern, n)
        return F.when(filename.rlike(self.pattern), F.struct(F.lit(self.file_type).alias("file_type"), part(1).alias("start"), part(2).alias("end"), F.lit("v1").alias("layout_version")))


class Conventions:
    """Registered conventions; of several that match a name, the most confident one counts, then the first."""

    def __init__(self, known: list[Convention] | None = None):
        self.known = list(known or [])

    def register(self, convention: Convention) -> None:
        self.known.append(convention)

    def parse(self, filename: str) -> Parsed:
        return max((p for c in self.known if (p := c.parse(filename))), key=lambda p: p.confidence, default=Parsed())


#: File types with a convention from the start (fixed values).
DEFAULT_TYPES = ("medical", "pharmacy", "members", "enrollment")


def default_conventions() -> Conventions:
    return Conventions([CoverageConvention(t) for t in DEFAULT_TYPES])


def filename_columns(filename: Column) -> Column:
    """Struct of the default conventions' reading; file_type `unknown` where none matches."""
    unknown = F.struct(F.lit("unknown").alias("file_type"), F.lit(None).cast("string").alias("start"), F.lit(None).cast("string").alias("end"), F.lit(None).cast("string").alias("layout_version"))
    return F.coalesce(*(CoverageConvention(t).columns(filename) for t in DEFAULT_TYPES), unknown)


#: Copies of a rule, so that one which very many files ask for is not one task's work; most characters of an indexed beginning.
RULE_COPIES, LITERAL = 16, 8


def literal_prefix(pattern: Column) -> Column:
    """Characters that every match of an anchored pattern begins with; empty where the pattern doesn't tell."""
    bare = F.regexp_replace(F.coalesce(pattern, F.lit("")), r"^\^", "")
    letters = F.regexp_extract(bare, "^([A-Za-z0-9_ -]*)", 1)
    last_may_lack = F.substr(bare, F.length(letters) + 1, F.lit(1)).isin("*", "?", "{")
    letters = F.when(last_may_lack, F.substr(letters, F.lit(1), F.greatest(F.length(letters) - 1, F.lit(0)))).otherwise(letters)
    return F.when(bare.contains("|") | bare.startswith("(?"), "").otherwise(F.substr(letters, F.lit(1), F.lit(LITERAL)))


def _matching(files: DataFrame, active: DataFrame) -> DataFrame:
    """Files with the rules that match them, from an index of the rules by submitter, extension and literal beginning.

    A file asks for its own submitter and `*`, each of its endings and none, and its beginnings of the lengths that occur: an
    equi-join, whose few hits are then held against ending and pattern. Rules are there `RULE_COPIES` times and a
    file asks for one copy, whichever side is large.
    """
    index = active.withColumn("_ext", F.coalesce(F.lower("extension"), F.lit(""))).withColumn("_begins", literal_prefix(F.col("pattern")))
    lengths = sorted(r[0] for r in index.select(F.length("_begins")).distinct().collect())  # at most LITERAL + 1
    index = index.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(RULE_COPIES - 1))))
    parts = F.split(F.lower("filename"), r"\.")
    endings = F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(2), F.greatest(F.size(parts), F.lit(2))), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))).otherwise(F.array().cast("array<string>"))
    asked = files.withColumn("_copy", F.pmod(F.xxhash64("group_id", "filename"), F.lit(RULE_COPIES)).cast("int"))
    asked = asked.withColumn("rs", F.explode(F.array_distinct(F.array("submitter_id", F.lit("*"))))).withColumn("_ext", F.explode(F.array_distinct(F.concat(F.array(F.lit("")), endings))))
    asked = asked.withColumn("_begins", F.explode(F.array_distinct(F.array(*(F.substr(F.col("filename"), F.lit(1), F.lit(n)) for n in lengths or [0])))))
    match = (
        (F.col("extension").isNull() | F.lower("filename").endswith(F.concat(F.lit("."), F.lower("extension"))))
        & (F.col("pattern").isNull() | F.expr("filename RLIKE concat('^(?:', pattern, ')')"))
    )
    return asked.join(index, ["rs", "_ext", "_begins", "_copy"]).where(match).drop("_ext", "_begins", "_copy")


def route(files: DataFrame, rules: DataFrame, layouts: DataFrame) -> DataFrame:
    """(group_id, file_type, layout_id, reason) for each group of files.

    Files: group_id, submitter_id, filename. Rules: rule_id, submitter_id, file_type, pattern?, extension?, layout_id,
    priority, status. Layouts: layout_id, submitter_id, file_type, layout_version, status. Active rules of the
    submitter and of `*` that match a file decide; own rules come before those of `*`, then priority. Without a rule
    the file names do, and the only active layout of the type is taken, own before `*`.
    """
    hit = _matching(files, rules.where("status = 'ACTIVE'").select("rule_id", F.col("submitter_id").alias("rs"), F.col("file_type").alias("rt"), "pattern", "extension", F.col("layout_id").alias("rl"), "priority"))
    own = F.when(F.col("rs") == F.col("submitter_id"), 0).otherwise(1)
    scored = hit.withColumn("score", F.struct(own.alias("own"), F.col("priority").alias("p")))
    types = scored.groupBy("group_id").agg(F.count_distinct("rt").alias("types"), F.min("rt").alias("rule_type"), F.min("score").alias("top"))
    tied = scored.join(types, "group_id").where(F.col("score") == F.col("top")).groupBy("group_id").agg(F.count_distinct("rl").alias("layouts"), F.min("rl").alias("rule_layout"))
    by_name = files.withColumn("parsed", filename_columns(F.col("filename"))).groupBy("group_id").agg(
        F.min("submitter_id").alias("submitter_id"), F.count_distinct(F.when(F.col("parsed.file_type") != "unknown", F.col("parsed.file_type"))).alias("named"),
        F.min(F.when(F.col("parsed.file_type") != "unknown", F.col("parsed.file_type"))).alias("name_type"), F.min("parsed.layout_version").alias("name_version"),
    )
    known = layouts.where("status = 'ACTIVE'").select("layout_id", F.col("submitter_id").alias("ls"), F.col("file_type").alias("lt"), "layout_version")
    cond = (F.col("lt") == F.col("name_type")) & (F.col("name_version").isNull() | (F.col("name_version") == F.col("layout_version"))) & ((F.col("ls") == F.col("submitter_id")) | (F.col("ls") == "*"))
    fall = by_name.join(known, cond, "left").groupBy("group_id", "submitter_id", "named", "name_type").agg(
        F.count_if(F.col("ls") == F.col("submitter_id")).alias("own_n"), F.min(F.when(F.col("ls") == F.col("submitter_id"), F.col("layout_id"))).alias("own_id"),
        F.count_if(F.col("ls") == "*").alias("any_n"), F.min(F.when(F.col("ls") == "*", F.col("layout_id"))).alias("any_id"),
    )
    j = fall.join(types, "group_id", "left").join(tied, "group_id", "left")
    n = F.coalesce("types", F.lit(0))
    reason = (
        F.when(n > 1, "ambiguous_file_type_routing").when((n == 1) & (F.col("layouts") == 1), "submitter_file_config").when(n == 1, "ambiguous_layout_routing")
        .when(F.col("named") > 1, "ambiguous_legacy_file_type").when(F.col("named") == 0, "no_submitter_signal")
        .when(F.col("own_n") == 1, "submitter_single_active_layout").when(F.col("own_n") > 1, "ambiguous_submitter_layout")
        .when(F.col("any_n") == 1, "wildcard_single_active_layout").when(F.col("any_n") > 1, "ambiguous_wildcard_layout").otherwise("no_active_layout")
    )
    j = j.withColumn("reason", reason)
    layout = F.when(F.col("reason") == "submitter_file_config", F.col("rule_layout")).when(F.col("reason") == "submitter_single_active_layout", F.col("own_id")).when(F.col("reason") == "wildcard_single_active_layout", F.col("any_id"))
    kind = F.when((n > 1) | (n == 0) & (F.col("named") != 1), "unknown").when(n == 1, F.col("rule_type")).otherwise(F.col("name_type"))
    return j.select("group_id", kind.alias("file_type"), layout.alias("layout_id"), "reason")


def submission_status(layout_id: Column) -> Column:
    return F.when(layout_id.isNotNull(), "READY_FOR_PARSE").otherwise("NEEDS_REVIEW")


def claim(objects: DataFrame, keys: DataFrame, status: str) -> DataFrame:
    """Objects with the given keys in a new state: SEEN, CLAIMED, MOVED in turn; a moved object stays moved."""
    hit = keys.select("object_key").distinct().withColumn("_hit", F.lit(True))
    out = objects.join(hit, "object_key", "left")
    return out.withColumn("status", F.when(F.col("_hit") & (F.col("status") != "MOVED"), status).otherwise(F.col("status"))).select(*objects.columns)


def upsert(current: DataFrame, given: DataFrame, identity: list[str], key: str) -> DataFrame:
    """Rows of `given` replace those of equal identity and keep their key; others are added or left alone.

    Blank and null are equal in an identity; the same identity twice in `given` is an error.
    """
    norm = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_i{n}") for n, c in enumerate(identity)]
    ids = [f"_i{n}" for n in range(len(identity))]
    twice = given.select(*norm).groupBy(*ids).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"definitions repeat {tuple(twice[0][:-1])}")
    a, b = current.select("*", *norm), given.select("*", *norm)
    j = a.alias("a").join(b.alias("b"), ids, "full_outer")
    columns = [F.coalesce(f"a.{c}", f"b.{c}").alias(c) if c == key else F.when(F.col(f"b.{key}").isNotNull(), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in current.columns]
    return j.select(*columns)


@dataclass
class Inbox:
    """Moves a closed group's objects to `raw/`, by a manifest that is written first, and says what submission it is.

    What is half done is done by calling `move` again: an object is in its old place or in its new one.
    """

    store: object
    new_id: Callable[[], str]
    conventions: Conventions = field(default_factory=default_conventions)

    def plan(self, submitter_id: str, prefix: str, keys: list[str], file_type: str, fingerprint: str, received_at: str) -> dict:
        """Writes the manifest, and nothing else."""
        sid = self.new_id()
        raw = f"raw/{submitter_id}/{file_type}/{sid}"
        parsed = [self.conventions.parse(k.rsplit("/", 1)[-1]) for k in keys]
        # the path below the prefix: equal names don't collide
        files = [{"object_key": f"{raw}/data/{k[len(prefix) :].lstrip('/')}", "from": k} for k in keys]
        starts, ends = [p.start for p in parsed if p.start], [p.end for p in parsed if p.end]
        manifest = {"submission_id": sid, "submitter_id": submitter_id, "file_type": file_type, "files": files, "group_fingerprint": fingerprint, "received_at": received_at}
        body = json.dumps(manifest, sort_keys=True).encode()
        self.store.put(f"{raw}/manifest.generated.json", body)
        return manifest | {"manifest_sha256": hashlib.sha256(body).hexdigest(), "raw_prefix": raw, "coverage_start_month": min(starts, default=None), "coverage_end_month": max(ends, default=None)}

    def move(self, raw: str) -> list[str]:
        """Moves what the manifest names and is not moved yet; the objects' old keys."""
        files = json.loads(self.store.get(f"{raw}/manifest.generated.json"))["files"]
        for f in files:
            if self.store.exists(f["from"]):
                if self.store.exists(f["object_key"]):
                    self.store.delete(f["object_key"])
                self.store.move(f["from"], f["object_key"])
            elif not self.store.exists(f["object_key"]):
                raise FileNotFoundError(f["from"])
        return [f["from"] for f in files]

    def process(self, submitter_id: str, prefix: str, keys: list[str], file_type: str, fingerprint: str, received_at: str) -> dict:
        out = self.plan(submitter_id, prefix, keys, file_type, fingerprint, received_at)
        self.move(out["raw_prefix"])
        return out
