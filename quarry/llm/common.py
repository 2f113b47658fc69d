"""Helpers shared by the corpus operators: storage, splits, vectorised text hashing."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import uuid
from collections.abc import Iterator

os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")  # tasks are the parallelism; threads inside one only get in the way

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
import pyarrow.compute as pc  # noqa: E402
from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

WHITESPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: Bytes of text that one vectorised step takes; temporaries are a few dozen times as large.
CHUNK_BYTES = 1 << 20

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_space = np.zeros(256, dtype=bool)
_space[list(WHITESPACE)] = True
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see. Where the cluster names none (tests), one under the warehouse."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        where = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return where.rstrip("/")


def materialise(df: DataFrame, label: str = "step") -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage ends in replicated files, not in executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quarry/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    # the driver's garbage holds the shuffle files of what is now written; Spark deletes them when it is collected
    del df
    gc.collect()
    spark._jvm.System.gc()
    return out


def discard(df: DataFrame) -> None:
    """Delete what `materialise` wrote for a frame that is no longer needed."""
    spark = df.sparkSession
    jvm, marker = spark._jvm, "/quarry/"
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles() if marker in f}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bound_batches(spark: SparkSession, rows: int = 2000, size: str = "8m") -> None:
    """Bound what one Arrow batch holds, in rows and in bytes: documents differ in length by five orders."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def release() -> None:
    """Give freed memory back to the system: a worker that waits for its next task keeps it otherwise, beside other stages' needs."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not the GNU C library
        ctypes.CDLL(None).malloc_trim(0)


def releasing(run):
    """`run` over a task's batches, with memory given back behind the last one."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return whole


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo `modulus`."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(modulus)


def bounded_sample(df: DataFrame, key: str, limit: int, total: int | None = None) -> DataFrame:
    """About `limit` rows at most, chosen by a hash of the key, the same ones on every run."""
    total = df.count() if total is None else total
    if total <= limit:
        return df
    share = int(limit / total * (1 << 30))
    return df.where(F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30)) < share)


def commonest(df: DataFrame, most: int, n: str = "n", rows: Column | None = None) -> DataFrame:
    """The rows with the largest `n` (at least 1), as many as stay within `most` together; ties are all in or all out.

    `rows` says for how many each row counts. The cut is found on a histogram of a few hundred bins: unlike a
    sort with a large limit, nothing but that reaches the driver.
    """
    level = F.floor(F.log2(n) * 16)
    counted = df.groupBy(level.alias("level")).agg(F.sum(F.lit(1) if rows is None else rows).alias("rows")).collect()
    total, cut = 0, None
    for r in sorted(counted, key=lambda r: -r["level"]):
        total += r["rows"]
        if total > most:
            break
        cut = r["level"]
    if total <= most:
        return df
    return df.where(level >= cut) if cut is not None else df.limit(0)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column end to end and the n+1 offsets; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(bounds: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents with about `most` bytes each; a longer document is a range of its own."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + most, side="right")) - 1)
        yield first, min(last, n)
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        n = max(n, CHUNK_BYTES + 1)
        for which, base in (("_powers", _BASE), ("_inverses", _BASE_INV)):
            out = np.full(n, base, dtype=np.uint64)
            out[0] = 1
            globals()[which] = np.multiply.accumulate(out)


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of concatenated documents: 64-bit hash (A-Z lower-cased), document index, start and end byte.

    A word is a longest run of bytes other than the six ASCII white-space ones, within one document.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    _grow(len(data) + 1)
    inside = ~_space[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[bounds[:-1]] = True
    first = first[:-1]
    before = np.empty(len(data), dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (first | ~before))
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:] & ~first[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_lower[data].astype(np.uint64) + np.uint64(1)) * _powers[: len(data)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * _inverses[starts]
    value = mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return value, np.searchsorted(bounds, starts, side="right") - 1, starts, ends


_ODD = np.array([0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], dtype=np.uint64)


def shingles(value: np.ndarray, doc: np.ndarray, n_docs: int, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of `width` words and their documents; a shorter document's words are one run."""
    count = np.bincount(doc, minlength=n_docs)
    odd = np.resize(_ODD, width) + (np.arange(width, dtype=np.uint64) // np.uint64(len(_ODD))) * np.uint64(2)
    hashes, docs = [], []
    if len(value) >= width:
        m = len(value) - width + 1
        ok = doc[:m] == doc[width - 1 :]
        out = np.zeros(m, np.uint64)
        for k in range(width):
            out += value[k : k + m] * odd[k]
        hashes.append(mix(out[ok]))
        docs.append(doc[:m][ok])
    begin = np.concatenate([[0], np.cumsum(count)])[:-1]
    for n in range(1, width):
        which = np.flatnonzero(count == n)
        if len(which):
            out = np.full(len(which), n, np.uint64) * np.uint64(0x589965CC75374CC3)
            for k in range(n):
                out += value[begin[which] + k] * odd[k]
            hashes.append(mix(out ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
            docs.append(which)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes, docs = np.concatenate(hashes), np.concatenate(docs)
    order = np.argsort(docs, kind="stable")
    return hashes[order], docs[order]


def labelled(spark: SparkSession, sf_dir: str, column: str, limit: int) -> DataFrame:
    """doc_id, text and label of rows that may be learnt from: crc32(doc_id) mod 5 is not 0.

    One row for each document; where labels repeat a document, the largest label counts. The bound is on rows.
    """
    labels = table(spark, sf_dir, "labels").where(F.col(column).isNotNull() & F.col("doc_id").isNotNull())
    labels = labels.where(remainder(F.col("doc_id"), 5) != 0).groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
    labels = bounded_sample(labels, "doc_id", limit)
    return table(spark, sf_dir, "documents").select("doc_id", "text").join(labels, "doc_id")
