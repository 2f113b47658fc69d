"""Incremental intake: a streaming source whose offsets are looks at an object store, and the micro-batch step.

Spark's own file source never looks at a file again, and passes over those with old times. This one takes a snapshot of the
listing (key, size, etag) at each look, and reports every object that is new or differs from the snapshot before.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from quarry.sources.stores import filesystem

SCHEMA = "object_key string, submitter_id string, bytes bigint, etag string, last_modified timestamp, seen_at timestamp"
_SNAPSHOT = pa.schema([("object_key", pa.string()), ("bytes", pa.int64()), ("etag", pa.string()), ("modified_us", pa.int64())])


class Listing(DataSource):
    """`spark.readStream.format("inbox_listing").options(root=..., state=...)`: objects below `root`/inbox, on any store.

    Options: `state`, the folder of the snapshots, which all executors reach (`root`/_looks); `depth`, the folders below
    inbox that are a partition of their own (1: one for each submitter); `looks`, whether a row without an object is
    given for each partition and look, so that time goes on where nothing changes.
    """

    @classmethod
    def name(cls) -> str:
        return "inbox_listing"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> ListingReader:  # noqa: N802
        root = self.options["root"].rstrip("/")
        return ListingReader(root, self.options.get("state", f"{root}/_looks"), int(self.options.get("depth", 1)), self.options.get("looks", "false").lower() == "true")


class Span(InputPartition):
    """A folder between two looks; `deep`: with all that is below it."""

    def __init__(self, folder: str, deep: bool, start: int, end: int):
        super().__init__((folder, deep, start, end))


class ListingReader(DataSourceStreamReader):
    """An offset is the number of a look. Its snapshot is one file for each partition, written by the task that lists it
    before it reports anything: a batch that is run again finds the snapshot and reports the same."""

    def __init__(self, root: str, state: str, depth: int, looks: bool):
        self.root, self.state, self.depth, self.looks = root, state, depth, looks

    def _looks(self) -> list[int]:
        fs, path = filesystem(self.state)
        found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
        return sorted(int(f.base_name[5:]) for f in found if f.base_name.startswith("look="))

    def _at(self, look: int, folder: str | None = None) -> str:
        return f"{filesystem(self.state)[1]}/look={look:012d}" + ("" if folder is None else f"/{quote(folder, safe='')}.parquet")

    def initialOffset(self) -> dict:  # noqa: N802
        return {"look": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"look": max(self._looks(), default=0) + 1}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        filesystem(self.state)[0].create_dir(self._at(end["look"]), recursive=True)  # the look has begun, whatever it finds
        fs, path = filesystem(self.root)
        level, out = ["inbox"], []
        for d in range(self.depth + 1):
            deep = d == self.depth
            out += [Span(folder, deep, start["look"], end["look"]) for folder in level]
            if not deep:
                infos = [(f, i) for f in level for i in fs.get_file_info(pafs.FileSelector(f"{path}/{f}", allow_not_found=True))]
                level = sorted(f"{f}/{i.base_name}" for f, i in infos if i.type == pafs.FileType.Directory)
        return out

    def _listed(self, folder: str, deep: bool, look: int) -> tuple[pa.Table, int]:
        """The snapshot of a folder at a look, and its time: as it was written, or of now."""
        store, at = filesystem(self.state)[0], self._at(look, folder)
        if store.get_file_info(at).type == pafs.FileType.NotFound:
            fs, path = filesystem(self.root)
            now = time.time_ns() // 1000
            infos = [i for i in fs.get_file_info(pafs.FileSelector(f"{path}/{folder}", recursive=deep, allow_not_found=True)) if i.type == pafs.FileType.File]
            rows = [{"object_key": i.path[len(path) :].lstrip("/"), "bytes": i.size, "etag": f"{i.mtime_ns or 0:x}-{i.size:x}", "modified_us": (i.mtime_ns or 0) // 1000} for i in infos]
            part = f"{at}.{uuid.uuid4().hex}"
            pq.write_table(pa.Table.from_pylist(rows, _SNAPSHOT.with_metadata({"looked_us": str(now)})), part, filesystem=store)
            if store.get_file_info(at).type == pafs.FileType.NotFound:  # not another attempt's
                store.move(part, at)
        table = pq.read_table(at, filesystem=store)
        return table, int(table.schema.metadata[b"looked_us"])

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        folder, deep, start, end = partition.value
        store, before = filesystem(self.state)[0], {}
        if start and store.get_file_info(self._at(start, folder)).type != pafs.FileType.NotFound:
            before = {r["object_key"]: (r["bytes"], r["etag"]) for r in pq.read_table(self._at(start, folder), filesystem=store).to_pylist()}
        table, looked = self._listed(folder, deep, end)
        when = lambda us: datetime.fromtimestamp(us / 1e6, timezone.utc)
        for r in table.to_pylist():
            if before.get(r["object_key"]) != (r["bytes"], r["etag"]):
                yield r["object_key"], r["object_key"].split("/")[1], r["bytes"], r["etag"], when(r["modified_us"]), when(looked)
        if self.looks:
            yield None, folder.partition("/")[2].partition("/")[0] or None, None, None, None, when(looked)

    def commit(self, end: dict) -> None:
        store = filesystem(self.state)[0]
        for look in self._looks():
            if look < end["look"]:
                store.delete_dir(self._at(look))


def changes(spark: SparkSession, root: str, **options: str) -> DataFrame:
    """Objects below `root`/inbox that are new or have changed, as a stream; `options` are those of `Listing`."""
    spark.dataSource.register(Listing)
    return spark.readStream.format("inbox_listing").options(root=root, **options).load()


def run_available(stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None], seconds: int | None = None):
    """Run `step` on each micro-batch; without `seconds`, on what there is now, and then stop.

    Batches are numbered and may be repeated after a failure: a step must give the same result again.
    """
    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)
    return writer.start()


def run_key(prefix: str, parts: list[str], high_water: int | None = None) -> str:
    """Name of a run that is to happen once; a high-water mark tells later changes of the same parts apart."""
    import hashlib

    text = json.dumps([*parts, *([] if high_water is None else [str(high_water)])])
    return f"{prefix}:{hashlib.sha256(text.encode()).hexdigest()[:12]}"


def due(submissions: DataFrame, status: tuple[str, ...], done: DataFrame | None = None, batch: int = 25, failed: DataFrame | None = None) -> DataFrame:
    """The oldest submissions in a state that no run in `done` has dealt with.

    Those with failed runs (`failed`: a submission_id for each) come behind all that have fewer, so that what fails again and
    again keeps nothing newer waiting.
    """
    out = submissions.where(F.col("status").isin(*status))
    if done is not None:
        out = out.join(done.select("submission_id").distinct(), "submission_id", "left_anti")
    order = ["received_at", "submission_id"]
    if failed is not None:
        out = out.join(failed.groupBy("submission_id").agg(F.count("*").alias("_tries")), "submission_id", "left")
        order = [F.coalesce("_tries", F.lit(0)), *order]
    return out.orderBy(*order).limit(batch).drop("_tries")
