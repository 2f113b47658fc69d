"""File scans and object-store operations through Hadoop's file systems, so that any store Spark reads will do."""

from __future__ import annotations

import csv
import io
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources import records
from quarry.sources.layouts import CORRUPT, Layout


def first_lines(spark: SparkSession, paths: list[str], delimiter: str = ",") -> DataFrame:
    """(file, first, opens) of every file with a line: the first one that isn't blank, and whether some line ends inside quotes.

    One job for all files, over their text; nothing is shuffled but a row for each file and task.
    """
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    place = F.when(F.trim("value") != "", F.struct("block", F.monotonically_increasing_id().alias("at")))
    lines = lines.select("value", "file", place.alias("place"), records.opens(F.col("value"), delimiter).alias("open"))
    return lines.groupBy("file").agg(F.min_by("value", "place").alias("first"), F.max("open").alias("opens"))


def _names(spark: SparkSession, file: str, first: str, layout: Layout) -> list[str]:
    """Column names of a file, from its first record, which may go on behind the first line."""
    if first.count('"') % 2:
        text = "\n".join(r["value"] for r in spark.read.option("lineSep", "\n").text(file).limit(1000).collect())
        return [v.strip() for v in next((r for r in csv.reader(io.StringIO(text), delimiter=layout.delimiter) if r), [])]
    return [v.strip() for v in next(csv.reader([first], delimiter=layout.delimiter), [])]


def scan_csv(spark: SparkSession, paths: list[str], layout: Layout) -> DataFrame:
    """The layout's columns as text, `_corrupt` for rows of another shape, and `_source_file`.

    Files may have headers of their own: columns are matched by name whatever the case, those a file lacks are null and
    those the layout lacks are dropped. Files with equal headers are one scan. Quoted fields may hold line feeds:
    files in which some line ends inside quotes are cut into records first, others are read by lines. Compressed files
    are read as they are. An empty file has no rows.
    """
    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for r in first_lines(spark, paths, layout.delimiter).collect() if paths else []:  # a row a file
        file = unquote(r["file"])
        if r["first"] is not None:
            names = _names(spark, file, r["first"], layout) if layout.header else [c.name for c in layout.columns]
            groups.setdefault((tuple(names), bool(r["opens"])), []).append(file)
    out = None
    for (names, spans), files in sorted(groups.items()):
        schema = ", ".join(f"`c{i}` string" for i in range(len(names))) + (", " if names else "") + f"`{CORRUPT}` string"
        options = {"sep": layout.delimiter, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "quote": '"', "escape": '"'}
        if spans:
            df = records.read_records(spark, files, layout.delimiter, layout.header)
            df = df.select(F.from_csv("value", F.lit(schema), options).alias("r"), "_source_file").select("r.*", "_source_file")
        else:
            df = spark.read.schema(schema).options(header=layout.header, enforceSchema="true", **options).csv(files).withColumn("_source_file", F.col("_metadata.file_path"))
        at = {}
        for i, n in enumerate(names):
            at.setdefault(n.lower(), i)
        columns = [(F.col(f"c{at[c.name.lower()]}") if c.name.lower() in at else F.lit(None).cast("string")).alias(c.name) for c in layout.columns]
        df = df.select(*columns, F.col(CORRUPT), "_source_file")
        out = df if out is None else out.unionByName(df)
    if out is None:
        out = spark.createDataFrame([], f"{', '.join(f'`{c.name}` string' for c in layout.columns)}, `{CORRUPT}` string, _source_file string")
    return out


def scan_months(spark: SparkSession, prefix: str, month: str | None = None) -> DataFrame:
    """A month-partitioned Parquet tree; with `month`, only that partition is read."""
    df = spark.read.parquet(prefix)
    return df if month in (None, "__all__") else df.where(F.col("atomic_month") == month)


def discover_months(df: DataFrame) -> list[str]:
    """Sorted distinct months, or `__all__` where the data isn't partitioned by month."""
    if "atomic_month" not in df.columns:
        return ["__all__"]
    return sorted(r[0] for r in df.select("atomic_month").distinct().collect())


def replace_months(df: DataFrame, out: str, months: list[str] | None = None, required: bool = False) -> set[str]:
    """Months of a month-partitioned table get the rows of `df`, others stay; the months that were written.

    Rows are written to a hidden folder below `out`, and then whole months change places by renaming: a reader sees the old
    month or the new one, never parts of either. A named month without rows is emptied, or with `required` an error that
    changes nothing. What an interrupted call had set aside is put back first.
    """
    store, mark = ObjectStore(df.sparkSession, out), uuid.uuid4().hex
    stage, old = f"_staged-{mark}", f"_replaced-{mark}"
    for kept in (f for f in store.folders() if f.startswith("_replaced-")):
        for part in store.folders(kept):
            if not store.exists(part):
                store.move(f"{kept}/{part}", part)
        store.delete(kept)
    df.write.partitionBy("atomic_month").parquet(f"{out}/{stage}")
    new = {unquote(f.partition("=")[2]): f for f in store.folders(stage) if f.startswith("atomic_month=")}
    if required and (missing := sorted(set(months or []) - set(new))):
        store.delete(stage)
        raise ValueError(f"no rows for {', '.join(missing)}")
    gone = {f"atomic_month={m}" for m in set(months or []) - set(new)}
    for part in sorted({*new.values(), *gone}):
        if store.exists(part):
            store.move(part, f"{old}/{part}")
        if part not in gone:
            store.move(f"{stage}/{part}", part)
    store.delete(old)
    store.delete(stage)
    return set(new)


class ObjectStore:
    """List, stat, copy, move, delete, put and get of objects under a root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, key: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{key}" if key else self.root)

    def list(self, prefix: str = "") -> list[dict]:
        """Objects under a prefix in order of their keys; the etag is made of time and size where the store has none."""
        base = self._path(prefix)
        if not self._fs.exists(base):
            return []
        found, top = [], self._fs.makeQualified(self._path("")).toString().rstrip("/")
        it = self._fs.listFiles(base, True)
        while it.hasNext():
            s = it.next()
            key = s.getPath().toString()[len(top) + 1 :]
            if not key.rsplit("/", 1)[-1].endswith(".crc"):
                found.append({"object_key": key, "bytes": s.getLen(), "etag": f"{s.getModificationTime():x}-{s.getLen():x}", "last_modified_ms": s.getModificationTime()})
        return sorted(found, key=lambda x: x["object_key"])

    def folders(self, prefix: str = "") -> list[str]:
        """Names of the folders right below a prefix."""
        base = self._path(prefix)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(base) if s.isDirectory()) if self._fs.exists(base) else []

    def exists(self, key: str) -> bool:
        return self._fs.exists(self._path(key))

    def put(self, key: str, body: bytes) -> None:
        out = self._fs.create(self._path(key), True)
        try:
            out.write(bytearray(body))
        finally:
            out.close()

    def get(self, key: str) -> bytes:
        stream = self._fs.open(self._path(key))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def copy(self, key: str, to: str) -> None:
        conf = self.spark._jsc.hadoopConfiguration()
        self._fs.mkdirs(self._path(to).getParent())
        self._jvm.org.apache.hadoop.fs.FileUtil.copy(self._fs, self._path(key), self._fs, self._path(to), False, conf)

    def move(self, key: str, to: str) -> None:
        self._fs.mkdirs(self._path(to).getParent())
        if not self._fs.rename(self._path(key), self._path(to)):
            raise OSError(f"can't move {key} to {to}")

    def delete(self, key: str) -> None:
        self._fs.delete(self._path(key), True)
