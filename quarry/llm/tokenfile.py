"""Token ids of documents as flat binary files in document order, with 64-bit offsets, memory-mapped on reading.

Documents are sorted by key over all partitions (a range shuffle), encoded, and each partition is written as three files:

* `<part>.ids`: unsigned little-endian integers end to end, 2 bytes each where the vocabulary fits, otherwise 4;
* `<part>.offsets`: unsigned 64-bit starts of its documents in the part's ids, and the end of the last one;
* `<part>.keys`: the documents' keys, as an Arrow file.

Partitions don't know how many ids stand before theirs. So offsets are counted from the part's first id, and
`manifest`, a table with a row for each part, has the bases: prefix sums over the parts' numbers of documents and ids.
A document's place in the whole corpus is the base of its part plus its offset.

Files have a name of their own in each attempt of a task, and the manifest lists those of the attempts that Spark
committed: what a lost executor or a second attempt left behind is never read. Everything is written as it comes,
a batch at a time. Files lie in a folder that all executors reach, on any file system that pyarrow opens.

Null and empty texts are the end id alone. Repeated keys are documents of their own, in the order of a hash of
their texts; null keys come first. A key with very many rows is dealt over parts like any others. An empty table has an
empty manifest. Other columns are not read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import ExitStack
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm import common
from quarry.llm.packing import default_tokenizer, tokenizer

WRITTEN = "part int, name string, docs long, tokens long, width int"
#: Bytes of ids that one batch of a reading task holds, about.
READ_BYTES = 1 << 22


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme, as Spark's own readers take it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the path in it; local files are mapped into memory when they are opened."""
    uri = urlsplit(folder)
    if uri.scheme in ("", "file"):
        return pafs.LocalFileSystem(use_mmap=True), uri.path
    return pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", folder))


def write(docs: DataFrame, folder: str, path: str | None = None, key: str = "doc_id", text: str = "text", end_id: int = 2, part_bytes: int = 32 << 20) -> DataFrame:
    """Writes the token files of all documents below `folder` and returns the manifest.

    (part, name, docs, tokens, width, first_doc, first_token, key_type); `path` is a file of the tokenizers library.
    """
    spark, path = docs.sparkSession, path or default_tokenizer()
    common.bound_batches(spark, 1000, "4m")
    folder = qualified(spark, folder)
    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    size = given.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-size // part_bytes))
    order = ["key", "_hash", "_row"]  # of repeated keys and texts: by their place in the input
    given = given.withColumn("_hash", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
    given = given.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = tokenizer(path), TaskContext.get().partitionId()
        width = 2 if max(coder.given.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        name, (fs, root) = f"part-{part:06d}-{uuid.uuid4().hex}", filesystem(folder)
        end, n_docs, n_tokens = np.array([end_id], "<u4").tobytes(), 0, 0
        with ExitStack() as opened:
            ids = offsets = keys = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                if ids is None:
                    fs.create_dir(root, recursive=True)
                    ids, offsets, keys = (opened.enter_context(fs.open_output_stream(f"{root}/{name}.{x}")) for x in ("ids", "offsets", "keys"))
                    keys = opened.enter_context(pa.ipc.new_file(keys, pa.schema([pa.field("key", batch.column(0).type)])))
                    offsets.write(np.zeros(1, "<u8").tobytes())
                coded = [x + end for x in coder.encode([t or "" for t in batch.column(1).to_pylist()])]
                ids.write(np.frombuffer(b"".join(coded), "<u4").astype(f"<u{width}").tobytes())
                ends = n_tokens + np.cumsum([len(x) // 4 for x in coded], dtype="<u8")
                offsets.write(ends.tobytes())
                keys.write_batch(pa.RecordBatch.from_arrays([batch.column(0)], names=["key"]))
                n_docs, n_tokens = n_docs + len(coded), int(ends[-1])
        if n_docs:
            yield pa.RecordBatch.from_pylist([{"part": part, "name": name, "docs": n_docs, "tokens": n_tokens, "width": width}], pa.schema([("part", pa.int32()), ("name", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64()), ("width", pa.int32())]))
        common.release()

    given.mapInArrow(run, WRITTEN).write.parquet(f"{folder}/written")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    bases = {f"first_{x}": F.coalesce(F.sum(f"{x}s").over(before), F.lit(0)) for x in ("doc", "token")}
    written = spark.read.schema(WRITTEN).parquet(f"{folder}/written")
    written.withColumns(bases).withColumn("key_type", F.lit(docs.schema[key].dataType.simpleString())).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{WRITTEN}, first_doc long, first_token long, key_type string").parquet(f"{qualified(spark, folder)}/manifest")


def read(spark: SparkSession, folder: str, key_type: str | None = None, slice_docs: int = 20_000) -> DataFrame:
    """(position, key, start, n_tokens, ids) of all documents in the files below `folder`, from mapped memory.

    `position` and `start` count documents and ids over all parts; `ids` are little-endian unsigned 32-bit, whatever the file's
    width. A task reads ranges of at most `slice_docs` documents, and maps only the pages that hold them. The key's type
    is that of the manifest, unless it is given.
    """
    folder = qualified(spark, folder)
    key_type = key_type or (manifest(spark, folder).select("key_type").first() or ["bigint"])[0]
    schema = f"position long, key {key_type}, start long, n_tokens long, ids binary"
    ranges = manifest(spark, folder).withColumn("low", F.explode(F.sequence(F.lit(0).cast("long"), F.col("docs") - 1, F.lit(slice_docs).cast("long"))))
    ranges = ranges.select("name", "width", "first_doc", "first_token", "low", F.least("docs", F.col("low") + slice_docs).alias("high"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for r in (r for batch in batches for r in batch.to_pylist()):
            low, high, width = r["low"], r["high"], r["width"]
            with fs.open_input_file(f"{root}/{r['name']}.offsets") as f:
                f.seek(8 * low)
                at = np.frombuffer(f.read_buffer(8 * (high - low + 1)), "<u8").astype(np.int64)
            with fs.open_input_file(f"{root}/{r['name']}.keys") as f:
                keys = pa.ipc.open_file(f).read_all().column("key").slice(low, high - low).combine_chunks()
            with fs.open_input_file(f"{root}/{r['name']}.ids") as f:
                for a, b in common.chunks(at, READ_BYTES // 4):
                    f.seek(width * int(at[a]))
                    flat = np.frombuffer(f.read_buffer(width * int(at[b] - at[a])), f"<u{width}").astype("<u4")
                    ends = (4 * (at[a : b + 1] - at[a])).astype(np.int64)
                    ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(ends), pa.py_buffer(flat)]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(r["first_doc"] + low + np.arange(a, b)), keys.slice(a, b - a), pa.array(r["first_token"] + at[a:b]), pa.array(np.diff(at[a : b + 1])), ids],
                        names=["position", "key", "start", "n_tokens", "ids"],
                    )

    return ranges.repartition(F.col("name"), F.col("low")).mapInArrow(common.releasing(run), schema)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = common.table(spark, sf_dir, "documents"), f"{common.shared_dir(spark)}/quarry/tokens-{uuid.uuid4().hex}"
    write(docs, folder)
    out = read(spark, folder, docs.schema["doc_id"].dataType.simpleString())
    return out.select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
