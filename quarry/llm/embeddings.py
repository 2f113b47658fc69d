"""Near-dedup of embeddings: random-hyperplane sign hashing, exact cosine, connected components.

Vectors of equal label meet if their signs agree on all planes of a table. Within a bucket all pairs are compared in
double precision, block against block; a pair that met in an earlier table is left to that table. Only counts and a
spanning forest of each block pair leave a task, never the pairs.

Equal vectors of a label are one class from the start. Vectors that are null, empty, all zero, or hold a null or
non-finite component, and those without a label, link with nothing: they are components of their own. Vectors of
unequal length never link. Repeated ids: each row counts as a vector, and the result has a row for each.

A bucket of any size is dealt out as blocks of `block` classes, and each pair of blocks is a group of its own, so no
task holds more than two blocks at a time. Every pair in a bucket is compared; the recall of the tables is that of the planes:
at cosine c a pair meets in a table with probability (1 - acos(c) / pi) ** planes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import common
from quarry.llm.graph import components

#: Tables and planes up to `MANY` vectors; a plane more for each doubling beyond keeps buckets small.
TABLES, PLANES, MANY = 30, 18, 1 << 20


def sized(n: int, least: float) -> tuple[int, int]:
    """Tables and planes for n vectors: with more planes a pair meets in a table less often, so there are more tables.

    A pair at cosine `least` is missed with a probability of about 2e-5, whatever n.
    """
    bits = PLANES + max(0, int(np.ceil(np.log2(max(1, n) / MANY))))
    meets = lambda b: (1 - np.arccos(least) / np.pi) ** b
    miss = (1 - meets(PLANES)) ** TABLES
    return (TABLES if bits == PLANES else int(np.ceil(np.log(miss) / np.log1p(-meets(bits))))), bits


def planes(dimension: int, tables: int, bits: int, seed: int = 20240607) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dimension, tables * bits))


def signatures(x: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """An integer for each vector and table."""
    sign = (x @ planes(x.shape[1], tables, bits) > 0).reshape(len(x), tables, bits)
    value = (sign * (1 << np.arange(bits, dtype=np.int64))).sum(2)
    return (value if bits < 32 else (value ^ (value >> 31)) & 0x7FFFFFFF).astype(np.int32)  # two buckets in one do no harm


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows by the power of two that brings their largest component near 1: squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges with the components of edges (i, j) between nodes 0..n-1: each node and its component's smallest."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            break
        root = low
    at = np.flatnonzero(root != np.arange(n))
    return at, root[at]


def _group(least: float, table: int, side: np.ndarray, ids: np.ndarray, members: np.ndarray, x: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Links within a block (side 1) or between two (0 and 2) of one bucket: forest edges (a, b) and counts (a, -1, n)."""
    same = bool(side[0] == 1)
    left, right = (np.arange(len(ids)),) * 2 if same else (np.flatnonzero(side == 0), np.flatnonzero(side == 2))
    if not len(left) or not len(right) or len(ids) < 2:
        return None
    y = x[right]
    found_i, found_j = [], []
    for p in range(0, len(left), 256):
        i, j = np.nonzero(x[left[p : p + 256]] @ y.T >= least - 1e-9)
        i, j = left[i + p], right[j]
        if same:
            i, j = i[i < j], j[i < j]
        exact = np.einsum("ij,ij->i", x[i], x[j]) >= least
        i, j = i[exact], j[exact]
        if table and len(i):  # a pair that met in an earlier table belongs there
            first = (signs[i, :table] != signs[j, :table]).all(1)
            i, j = i[first], j[first]
        found_i.append(i)
        found_j.append(j)
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    if not len(i):
        return None
    n = np.bincount(i, weights=members[j], minlength=len(ids)) + np.bincount(j, weights=members[i], minlength=len(ids))
    child, root = _forest(len(ids), i, j)
    some = np.flatnonzero(n)
    return np.concatenate([ids[child], ids[some]]), np.concatenate([ids[root], np.full(len(some), -1)]), np.concatenate([np.zeros(len(child)), n[some]])


def _compare(least: float, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Buckets' blocks one after another, in a stream that is sorted by their keys; the last may go on in the next batch."""
        held: pa.Table | None = None

        def compared(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            column = lambda c: rows[c].chunk(0)
            ends = pc.run_end_encode(column("key")).run_ends.to_numpy()
            table, side, ids, members = (column(c).to_numpy() for c in ("tbl", "side", "id", "n"))
            vector, signs = column("v"), column("signs").flatten().to_numpy().reshape(len(rows), tables)
            at, flat = vector.offsets.to_numpy() - vector.offsets[0].as_py(), vector.flatten().to_numpy().astype(np.float64)
            out = []
            for s, e in zip([0, *ends[:-1]], ends, strict=True):
                x = scaled(flat[at[s] : at[e]].reshape(e - s, -1))
                x = x / np.sqrt((x * x).sum(1, keepdims=True))
                if (got := _group(least, int(table[s]), side[s:e], ids[s:e], members[s:e], x, signs[s:e])) is not None:
                    out.append(got)
            a, b, n = (np.concatenate(z).astype(np.int64) for z in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n)], names=["a", "b", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            keys = rows["key"].combine_chunks()
            keys = keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys
            ends = pc.run_end_encode(keys).run_ends.to_numpy()
            cut = int(ends[-2]) if len(ends) > 1 else 0
            if cut:
                yield compared(rows.slice(0, cut))
            held = rows.slice(cut)
        if held is not None and held.num_rows:
            yield compared(held)

    return run


def link(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.98,
         tables: int | None = None, bits: int | None = None, block: int = 1000) -> DataFrame:
    """(key, n_links, component_id, kept) for every row; `kept` marks the smallest id of a component.

    Tables and planes are those of `sized` for the number of distinct vectors, unless given.
    """
    spark = vectors.sparkSession
    common.bound_batches(spark)
    given = vectors.select(F.col(key).alias("id"), F.col(vector).alias("v"), F.col(label).alias("label"))
    element = given.schema["v"].dataType.elementType
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    fit = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    given = given.withColumn("fit", F.coalesce(fit, F.lit(False)))
    # -0.0 and 0.0 are one number
    usable = given.where("fit").select("id", "label", F.transform("v", lambda x: F.when(x == 0, F.lit(0).cast(element)).otherwise(x)).alias("v"))
    classes = usable.groupBy("label", "v").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    classes = common.materialise(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    if tables is None or bits is None:
        many = sized(classes.count(), least)
        tables, bits = tables or many[0], bits or many[1]

    def sign(batches):
        for part in batches:
            signs = [None] * len(part)
            lengths = part["v"].map(len).to_numpy()
            for d in np.unique(lengths):
                at = np.flatnonzero(lengths == d)
                x = scaled(np.array(part["v"].iloc[at].tolist(), dtype=np.float64))
                for i, row in zip(at, signatures(x, tables, bits)):
                    signs[i] = row
            yield part.assign(signs=signs)

    signed = classes.mapInPandas(sign, ", ".join(f"{c} {t}" for c, t in classes.dtypes) + ", signs array<int>")
    signed = common.materialise(signed, "signed")
    size = F.size("v").alias("d")
    places = signed.select("id", "label", size, F.posexplode("signs").alias("tbl", "sig"))
    buckets = places.groupBy("label", "d", "tbl", "sig").agg(F.count("*").alias("m")).where("m > 1")
    placed = places.join(buckets, ["label", "d", "tbl", "sig"])
    parts = F.ceil(F.col("m") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    placed = placed.withColumn("parts", parts).withColumn("own", own)
    # block pairs (low, high) that this row is in: side 0 as low, 2 as high, 1 alone with its own block
    pair = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least("own", o).alias("low"), F.greatest("own", o).alias("high"), F.when(o == F.col("own"), 1).when(F.col("own") < o, 0).otherwise(2).alias("side")))
    placed = placed.select("id", "label", "d", "tbl", "sig", F.inline(pair))
    bucket = F.concat_ws("|", F.col("label").cast("string"), "d", "tbl", "sig", "low", "high")
    placed = placed.select("id", "label", "tbl", F.col("side").cast("int").alias("side"), bucket.alias("key"))
    rows = placed.join(signed.select("id", "label", "v", "signs", "n"), ["id", "label"])
    rows = rows.select("key", "tbl", "side", "id", "n", "v", "signs").repartition("key").sortWithinPartitions("key")
    found = common.materialise(rows.mapInArrow(_compare(least, tables), "a long, b long, n long"), "links")
    linked = components(found.where("b >= 0 and a <> b").select("a", "b"))
    counts = found.where("b < 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
    per_class = classes.join(counts.withColumnRenamed("rep", "id"), "id", "left").join(linked.withColumnRenamed("node", "id"), "id", "left")
    per_class = per_class.select("label", "v", "rep", "n", "links", F.coalesce("component", "id").alias("component"))
    smallest = per_class.groupBy("component").agg(F.min("rep").alias("component_id"))
    per_class = per_class.join(smallest, "component")
    whole = usable.join(per_class, ["label", "v"]).select(F.col("id").alias(key), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    rest = given.where(~F.col("fit")).select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = whole.unionByName(rest)
    return out.select(key, "n_links", "component_id", (F.col(key) == F.col("component_id")).alias("kept"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(common.table(spark, sf_dir, "embeddings"))
