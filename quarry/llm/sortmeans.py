"""Centroid clustering of integer vectors by Sort-means.

Each round orders, for every centroid, the others by their distance from it. A vector scans that list from its previous
centroid, and stops at the first one strictly farther from that centroid than twice the vector's own distance: by the
triangle inequality no later one can be nearer, or as near with a smaller number. All arithmetic is in integers
(distances are squared, so twice is four times), and ties go to the smaller number.

A round is one pass over the vectors, which are written with their assignment for the next one. Behind its vectors each task
writes a row of sums for each centroid, so that what is aggregated is a few numbers a task, and what reaches the driver
are `k` centroids. Nothing is shuffled by cluster; one that holds most vectors is nobody's burden.

Kept are vectors of `dimension` components that are neither null nor non-finite; component x becomes floor(scale * x). Where
one is beyond +-2**27 then, squares leave the range of a long: such a vector is not kept either. The first centroids are the
kept vectors with the smallest SHA-256 of `<seed>:<id>` (null id: empty; ties by vector), fewer if there are fewer; equal ones are
distinct centroids, and the smaller number takes their vectors. Repeated ids are vectors of their own. A centroid without
vectors stays. No kept vector gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import common

LARGEST = 1 << 27


def kept(vectors: DataFrame, key: str, vector: str, dimension: int, scale: int) -> DataFrame:
    """(id, v array<int>) of the vectors that are clustered."""
    given = vectors.select(F.col(key).alias("id"), F.col(vector).alias("x"))
    finite = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double") * scale) < float(LARGEST)))
    # the test comes before the cast in one expression, whatever the order in which filters are evaluated
    fit = (F.size("x") == dimension) & finite
    return given.select("id", F.when(fit, F.transform("x", lambda e: F.floor(e.cast("double") * scale).cast("int"))).alias("v")).where("v IS NOT NULL")


def nearest(x: np.ndarray, previous: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector and its squared distance, scanning from the previous one."""
    apart = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(2)
    best, least = previous.copy(), ((x - centroids[previous]) ** 2).sum(1)
    for c in np.unique(previous):
        at = np.flatnonzero(previous == c)
        own = least[at].copy()
        order = np.lexsort((np.arange(len(centroids)), apart[c]))
        for j in order[order != c]:
            going = apart[c, j] <= 4 * own  # strictly beyond twice the distance: this vector's scan has ended
            at, own = at[going], own[going]
            if not len(at):
                break
            d = ((x[at] - centroids[j]) ** 2).sum(1)
            nearer = (d < least[at]) | ((d == least[at]) & (j < best[at]))
            best[at[nearer]], least[at[nearer]] = j, d[nearer]
    return best, least


def _assign(centroids: np.ndarray):
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, inertia = np.zeros((k, width), np.int64), np.zeros(k, np.int64), np.zeros(k, object)
        kind = None
        for batch in batches:
            kind = batch.column(0).type
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy().astype(np.int64).reshape(-1, width)
            best, least = nearest(x, batch.column(2).to_numpy().astype(np.int64), centroids)
            np.add.at(total, best, x)
            n += np.bincount(best, minlength=k)
            for c in np.unique(best):
                inertia[c] += int(least[best == c].astype(object).sum()) if len(best) * float(least.max()) > 2**62 else int(least[best == c].sum())
            none = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(best.astype(np.int32)), pa.array(least), none, pa.nulls(batch.num_rows, pa.list_(pa.int64())), pa.nulls(batch.num_rows, pa.string())], names=["id", "v", "cluster", "distance", "n", "total", "inertia"])
        at = np.flatnonzero(n)
        if len(at):
            sums = pa.array([total[c].tolist() for c in at], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(at), kind), pa.nulls(len(at), pa.list_(pa.int32())), pa.array(at.astype(np.int32)), pa.nulls(len(at), pa.int64()), pa.array(n[at]), sums, pa.array([str(inertia[c]) for c in at])],
                names=["id", "v", "cluster", "distance", "n", "total", "inertia"],
            )
        common.release()

    return run


def _summed(assigned: DataFrame) -> dict[int, tuple[int, list[int], int]]:
    """Of each centroid with vectors: their number, componentwise sum and inertia. At most `k` rows reach the driver."""
    sums = assigned.where("n IS NOT NULL").select("cluster", "n", "inertia", F.posexplode("total").alias("i", "x"))
    wide = "decimal(38,0)"  # sums of any number of tasks' longs
    each = sums.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast(wide)).alias("x"), F.sum(F.col("inertia").cast(wide)).alias("inertia"))
    found: dict[int, tuple[int, list[int], int]] = {}
    for r in each.orderBy("cluster", "i").collect():
        found.setdefault(r["cluster"], (r["n"], [], int(r["inertia"])))[1].append(int(r["x"]))
    return found


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", dimension: int = 64, scale: int = 64, k: int = 16, rounds: int = 3, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """(key, cluster, distance) of all kept vectors after `rounds` rounds, and (cluster, n, inertia, centroid) of the centroids.

    Distances are squared. Inertia is a decimal.
    """
    spark = vectors.sparkSession
    common.bound_batches(spark, 4000, "4m")
    given = common.materialise(kept(vectors, key, vector, dimension, scale), "vectors")
    order = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    centroids = np.array([r["v"] for r in given.orderBy(order, "v").limit(k).collect()], dtype=np.int64).reshape(-1, dimension)
    state = given.withColumn("cluster", F.lit(0))
    schema = f"id {given.schema['id'].dataType.simpleString()}, v array<int>, cluster int, distance long, n long, total array<long>, inertia string"
    for round_ in range(rounds + 1):
        if not len(centroids):  # no vector is kept
            break
        before, state = state, common.materialise(state.select("id", "v", "cluster").mapInArrow(_assign(centroids), schema), "assigned")
        common.discard(before)
        sums = _summed(state)
        state = state.where("n IS NULL")
        if round_ < rounds:
            centroids = np.array([[x // sums[c][0] for x in sums[c][1]] if c in sums else row.tolist() for c, row in enumerate(centroids)], dtype=np.int64)
    rows = [(c, sums[c][0] if c in sums else 0, sums[c][2] if c in sums else 0, row.tolist()) for c, row in enumerate(centroids)]
    rows = [(c, n, str(i), row) for c, n, i, row in rows]
    found = spark.createDataFrame(rows, "cluster int, n long, inertia string, centroid array<long>").withColumn("inertia", F.col("inertia").cast("decimal(38,0)"))
    if not rows:
        return given.select(F.col("id").alias(key), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), found
    return state.select(F.col("id").alias(key), "cluster", "distance"), found


def op13_sort_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, found = cluster(common.table(spark, sf_dir, "embeddings"))
    rows, most = found.collect(), (1 << 63) - 1  # k rows; a long holds no more
    whole = sum(int(r["inertia"]) for r in rows)
    text = [(r["cluster"], min(int(r["inertia"]), most), min(whole, most), hashlib.sha256(",".join(map(str, r["centroid"])).encode()).hexdigest()) for r in rows]
    each = spark.createDataFrame(text, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(each), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def sql(dimension: int = 64, scale: int = 64, k: int = 16, rounds: int = 3, seed: int = 1) -> str:
    """The same rows: components as rows, all distances computed, a step for each round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
    d{r} AS (
      SELECT x.r, c.c, sum((x.e - c.e) * (x.e - c.e)) AS d FROM x JOIN c{r} c ON x.i = c.i GROUP BY x.r, c.c),
    a{r} AS (SELECT r, c, d FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, c) AS best FROM d{r}) WHERE best = 1)""")
        if r < rounds:
            steps.append(f"""
    s{r} AS (SELECT a.c, x.i, sum(x.e) AS s, count(*) AS n FROM a{r} a JOIN x ON a.r = x.r GROUP BY a.c, x.i),
    c{r + 1} AS (
      SELECT o.c, o.i, CASE WHEN s.n IS NULL THEN o.e ELSE CAST((s.s - ((s.s % s.n) + s.n) % s.n) / s.n AS BIGINT) END AS e
      FROM c{r} o LEFT JOIN s{r} s ON o.c = s.c AND o.i = s.i)""")
    return f"""
    WITH given AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings WHERE len(embedding) = {dimension}),
    parts AS (SELECT r, vec_id, unnest(embedding) AS f, unnest(range(1, {dimension} + 1)) AS i FROM given),
    bad AS (SELECT DISTINCT r FROM parts WHERE f IS NULL OR isnan(f) OR abs(CAST(f AS DOUBLE)) * {scale} >= {LARGEST}),
    x AS MATERIALIZED (
      SELECT r, vec_id, i, CAST(floor(CAST(f AS DOUBLE) * {scale}) AS BIGINT) AS e FROM parts WHERE r NOT IN (SELECT r FROM bad)),
    seeds AS (
      SELECT r, row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), ''))) - 1 AS c
      FROM (SELECT DISTINCT r, vec_id FROM x) ORDER BY c LIMIT {k}),
    c0 AS (SELECT s.c, x.i, x.e FROM seeds s JOIN x ON s.r = x.r),{",".join(steps)},
    per AS (SELECT c, sum(d) AS cluster_inertia FROM a{rounds} GROUP BY c),
    text AS (SELECT c, sha256(string_agg(CAST(e AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
    SELECT g.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(p.cluster_inertia AS BIGINT) AS cluster_inertia,
      CAST((SELECT sum(d) FROM a{rounds}) AS BIGINT) AS inertia, t.centroid_sha256
    FROM a{rounds} a JOIN given g ON a.r = g.r JOIN per p ON a.c = p.c JOIN text t ON a.c = t.c
    """
