"""Prefix trie of conversations, by an external mergesort that knows common prefixes (LCPs).

1. A turn becomes a 16-byte key of its role and text and the size of its text; a conversation is the sequence of its keys.
2. Tasks sort conversations into runs, which are written with each one's LCP, the number of turns shared with the one before it.
3. Bounds from a bounded sample deal the sorted order out as parts. A part's share of every run goes to one task, whose
   loser tree merges them: the player with the longer LCP with the last winner wins without a look at turns, equal ones are
   compared from there on, and the loser keeps what they share. So no shared turn is compared again, and the merged stream
   has its LCPs for nothing.
4. The stream drives a stack of the nodes on the open path. What lies deeper than the next LCP is finished: its sums go to its
   parent, and it is emitted once its parent is finished too.

Conversations are ordered by keys, then by id, so bounds also fall inside a very frequent first turn and inside any
number of equal conversations. A node on the border of parts comes out in pieces. Each piece counts only what starts in its
part (a node's first, a leaf's last), which two LCPs with the neighbours tell, so pieces are added up; there
are at most a path's length of them for each part. Ids of conversations that end in such a node are hashed from its
pieces in order, as a stream.

A task holds its part, `part_bytes` of sequences (24 bytes a turn), and one conversation is never divided. Turns with a null
conversation belong to none and count nowhere. Null roles and texts are empty; turns are ordered with null first, ties by
key. An empty table has no root and gives no row. Other columns are not read. Texts are compared by 128 bits of MD5.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import common

KEY = 16
EMPTY = hashlib.sha256(b"").hexdigest()
RUN = "run long, conv_id long, keys binary, sizes binary, lcp int"
PIECE_IDS = 50_000
NODE = pa.schema([
    ("path", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("border", pa.bool_()), ("part", pa.int32()), ("piece", pa.int32()), ("ids", pa.string()),
])
NODE_DDL = "path binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, border boolean, part int, piece int, ids string"


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns array<struct<turn, key, size>>) in the order of turns; a turn's text goes no further than its key."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turns = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn"), key.alias("key"), F.octet_length(text).cast("long").alias("size")).alias("t"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(given: DataFrame, group: int = 5, heads: int = 9) -> DataFrame:
    """Conversations that begin like the first of their group: h of its turns, then their own after the first h."""
    first = given.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("_base"), F.slice("turns", 1, heads - 1).alias("_head"))
    h = common.remainder(F.col("conv_id"), heads).cast("int")
    out = given.withColumn("_base", F.col("conv_id") - F.col("conv_id") % group).join(first, "_base", "left").withColumn("_h", h)
    head = F.when(F.col("_head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("_head", F.lit(1), F.col("_h")))
    return out.select("conv_id", F.concat(head, F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


def shared(x: bytes, y: bytes, n: int = 0) -> int:
    """The number of turns that two sequences share, of which `n` are known."""
    most = min(len(x), len(y))
    at = n * KEY
    while at < most and x[at : at + KEY] == y[at : at + KEY]:
        at += KEY
    return at // KEY


def _sort_runs(run_bytes: int):
    names = [c.split()[0] for c in RUN.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[bytes, int, bytes]] = []
        held, number = 0, TaskContext.get().partitionId() << 24

        def flush() -> Iterator[pa.RecordBatch]:
            rows.sort()
            for p in range(0, len(rows), 2000):
                keys, convs, sizes = zip(*rows[p : p + 2000], strict=True)
                lcp = [shared(rows[i - 1][0], rows[i][0]) if i else 0 for i in range(p, p + len(keys))]
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(keys)), pa.array(convs, pa.int64()), pa.array(keys, pa.binary()), pa.array(sizes, pa.binary()), pa.array(lcp, pa.int32())], names=names)
            rows.clear()

        for batch in batches:
            turns = batch.column(1)
            at, flat = (turns.offsets.to_numpy() - turns.offsets[0].as_py()).tolist(), turns.flatten()
            keys, sizes = b"".join(flat.field("key").to_pylist()), flat.field("size").to_numpy().astype("<i8").tobytes()
            for i, conv in enumerate(batch.column(0).to_pylist()):
                rows.append((keys[KEY * at[i] : KEY * at[i + 1]], conv, sizes[8 * at[i] : 8 * at[i + 1]]))
            held += len(keys) + len(sizes)
            if held >= run_bytes:
                yield from flush()
                held, number = 0, number + 1
        yield from flush()
        common.release()

    return run


def merged(runs: list[list[tuple[bytes, int, bytes, int]]]) -> Iterator[tuple[int, tuple[bytes, int, bytes, int]]]:
    """Rows (keys, conv, sizes, lcp) of sorted runs in order, each behind its LCP with the row before it, by a loser tree."""
    k = len(runs)
    rest = [iter(r) for r in runs]
    head = [next(r, None) for r in rest]
    same = [0] * k  # turns that a head shares with the last winner that it met
    losers, winners = [0] * k, [0] * k + list(range(k))

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = head[a], head[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if same[a] != same[b]:
            return (a, b) if same[a] > same[b] else (b, a)
        n = shared(x[0], y[0], same[a])
        p, q = x[0][n * KEY : n * KEY + KEY], y[0][n * KEY : n * KEY + KEY]
        won, lost = (a, b) if (p, x[1]) < (q, y[1]) else (b, a)
        same[lost] = n
        return won, lost

    for node in range(k - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    best = winners[1] if k > 1 else 0
    while k and head[best] is not None:
        yield same[best], head[best]
        head[best] = next(rest[best], None)
        if head[best] is not None:
            same[best] = head[best][3]
        node = (k + best) // 2
        while node:
            best, losers[node] = play(best, losers[node])
            node //= 2


class Node:
    """A node on the open path, with the sums of what has been finished below it."""

    __slots__ = ("begun", "children", "conv", "ends", "extended", "leaves", "n", "path", "pending", "saved", "size")

    def __init__(self, size: int, path: bytes | None, begun: bool):
        self.size, self.path, self.begun = size, path, begun  # begun: in an earlier part
        self.conv, self.n, self.children, self.leaves, self.saved, self.extended = None, 0, 0, 0, 0, False
        self.ends: list[int] = []
        self.pending: list[list] = []


def nodes(part: int, runs: list[list[tuple[bytes, int, bytes, int]]], before: int, behind: int) -> Iterator[list]:
    """Rows of NODE for a part, which shares `before` turns with the one before it and `behind` with the next (-1: there is none)."""
    border = max(before, behind)
    stack: list[Node] = []

    def close(last: bool) -> Iterator[list]:
        """Finish the deepest open node; `last`: the next part begins with what follows."""
        node, depth = stack.pop(), len(stack)
        goes_on = last and depth <= behind
        node.n += len(node.ends)
        node.conv = min([*node.ends[:1], *([] if node.conv is None else [node.conv])])
        node.leaves += not node.extended and not goes_on
        node.saved += node.n * node.size - (0 if node.begun else node.size)
        parent = stack[-1] if stack else None
        if parent:
            parent.n, parent.leaves, parent.saved = parent.n + node.n, parent.leaves + node.leaves, parent.saved + node.saved
            parent.children += not node.begun
            parent.conv = node.conv if parent.conv is None else min(parent.conv, node.conv)
        out = node.begun or goes_on
        for row in node.pending:
            if not out:
                row[4] = node.conv
            yield row
        sha = None if out else hashlib.sha256(",".join(map(str, node.ends)).encode()).hexdigest() if node.ends else EMPTY
        row = [node.path, parent.path if parent else None, depth, node.conv, None, node.n, node.children, node.leaves, node.saved, sha, out, part, None, None]
        if parent and not out:
            parent.pending.append(row)
        else:
            yield row
        for p in range(0, len(node.ends) if out else 0, PIECE_IDS):
            yield [node.path, None, depth, None, None, None, None, None, None, None, True, part, p // PIECE_IDS, ",".join(map(str, node.ends[p : p + PIECE_IDS]))]

    for i, (lcp, (keys, conv, sizes, _)) in enumerate(merged(runs)):
        while len(stack) > lcp + 1:
            yield from close(False)
        size = np.frombuffer(sizes, "<i8")
        for d in range(len(stack), len(keys) // KEY + 1):
            if stack:
                stack[-1].extended = True
            path = hashlib.md5(keys[: KEY * d]).digest() if d <= border + 1 else None
            stack.append(Node(int(size[d - 1]) if d else 0, path, not i and d <= before))
        stack[-1].ends.append(conv)
    while stack:
        yield from close(True)


def _merge(neighbours: dict[int, tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        part, rows = None, []

        def done() -> Iterator[pa.RecordBatch]:
            for row in nodes(part, list(held.values()), *neighbours[part]):
                rows.append(row)
                if len(rows) == 4000:
                    yield batch_of()
            held.clear()

        def batch_of() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), NODE, strict=True)], schema=NODE)
            rows.clear()
            return out

        for batch in batches:
            for p, run_, conv, keys, sizes, lcp in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if p != part:
                    if held:
                        yield from done()
                    part = p
                mine = held.setdefault(run_, [])
                mine.append((keys, conv, sizes, lcp if mine else 0))
        if held:
            yield from done()
        if rows:
            yield batch_of()
        common.release()

    return run


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the ids of each path, whose pieces come one after another."""
    path, sha = None, None
    row = lambda: pa.RecordBatch.from_arrays([pa.array([path], pa.binary()), pa.array([sha.hexdigest()])], names=["path", "sha"])
    for batch in batches:
        for p, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if p != path:
                if sha:
                    yield row()
                path, sha = p, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
    if sha:
        yield row()


def trie(given: DataFrame, part_bytes: int = 16 << 20, run_bytes: int = 16 << 20, parts: int | None = None) -> DataFrame:
    """The nodes of the trie of (conv_id, turns) as `sequences` makes them.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).
    """
    spark = given.sparkSession
    common.bound_batches(spark, 2000, "8m")
    runs = common.materialise(given.select("conv_id", F.transform("turns", lambda t: F.struct(t["key"].alias("key"), t["size"].alias("size"))).alias("turns")).mapInArrow(_sort_runs(run_bytes), RUN), "runs")
    count, size = runs.agg(F.count("*"), F.coalesce(F.sum(F.length("keys") + F.length("sizes")), F.lit(0))).first()
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // part_bytes))
    sample = sorted((bytes(r["keys"]), r["conv_id"]) for r in common.bounded_sample(runs.select("keys", "conv_id"), "conv_id", 16 * parts, count).collect())
    bounds = sorted({sample[len(sample) * i // parts] for i in range(1, parts)}) if sample else []

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = [bisect_right(bounds, x) for x in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), *batch.columns], names=["part", *batch.schema.names])

    dealt = runs.mapInArrow(deal, f"part int, {RUN}")
    edge = F.struct("keys", "conv_id")
    neighbours: dict[int, list[int]] = {}
    last = None
    for r in dealt.groupBy("part").agg(F.min(edge).alias("low"), F.max(edge).alias("high")).orderBy("part").toLocalIterator():
        neighbours[r["part"]] = [-1, -1]
        if last:
            n = shared(bytes(last["high"]["keys"]), bytes(r["low"]["keys"]))
            neighbours[last["part"]][1] = neighbours[r["part"]][0] = n
        last = r
    ordered = dealt.repartition(parts, "part").sortWithinPartitions("part", "run", "keys", "conv_id")
    found = common.materialise(ordered.mapInArrow(_merge({p: (a, b) for p, (a, b) in neighbours.items()}), NODE_DDL), "nodes")
    common.discard(runs)
    ids = found.where("ids IS NOT NULL").select("path", "ids", "part", "piece").repartition("path").sortWithinPartitions("path", "part", "piece").select("path", "ids")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    border = found.where("border AND ids IS NULL").groupBy("path").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent").alias("parent"), *sums)
    border = border.join(ids.mapInArrow(_hash_pieces, "path binary, sha string"), "path", "left").withColumn("ends_sha256", F.coalesce("sha", F.lit(EMPTY)))
    border = common.materialise(border.drop("sha"), "border")
    names = border.select(F.col("path").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = found.where("NOT border")
    under = inner.where("parent_conv_id IS NULL").drop("parent_conv_id").join(names, "parent", "left")
    return inner.where("parent_conv_id IS NOT NULL").select(columns).unionByName(under.select(columns)).unionByName(border.join(names, "parent", "left").select(columns))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(rebuilt(sequences(common.table(spark, sf_dir, "conversations"))))


def sql() -> str:
    """The same rows: a path is the text of its turns' hashes, and subtrees are found by their beginnings."""
    turn = "md5(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))"
    return f"""
    WITH RECURSIVE bits(b, v, k) AS (
      SELECT CAST(i AS UBIGINT), CAST(i AS UBIGINT), 0 FROM range(256) t(i)
      UNION ALL SELECT b, CASE WHEN v % 2 = 1 THEN xor(v >> 1, CAST(3988292384 AS UBIGINT)) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
    crc_table AS (SELECT b, v FROM bits WHERE k = 8),
    ids AS (SELECT DISTINCT conv_id AS c, CAST(conv_id AS VARCHAR) AS s FROM conversations WHERE conv_id IS NOT NULL),
    crc(c, s, k, v) AS (
      SELECT c, s, 0, CAST(4294967295 AS UBIGINT) FROM ids
      UNION ALL SELECT crc.c, crc.s, k + 1, xor(crc.v >> 8, t.v)
      FROM crc JOIN crc_table t ON t.b = xor(crc.v & 255, CAST(ascii(substr(crc.s, k + 1, 1)) AS UBIGINT)) WHERE k < length(crc.s)),
    heads AS (SELECT c, CAST(xor(v, CAST(4294967295 AS UBIGINT)) % 9 AS BIGINT) AS h, c - c % 5 AS base FROM crc WHERE k = length(s)),
    turns AS (
      SELECT conv_id AS c, key, size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS p
      FROM (SELECT conv_id, turn, {turn} AS key, strlen(coalesce(text, '')) AS size FROM conversations WHERE conv_id IS NOT NULL)),
    whole AS (
      SELECT h.c, 0 AS own, t.p, t.key, t.size FROM heads h JOIN turns t ON t.c = h.base AND t.p <= h.h
      UNION ALL SELECT h.c, 1, t.p, t.key, t.size FROM heads h JOIN turns t ON t.c = h.c AND t.p > h.h),
    seq AS (SELECT c, size, row_number() OVER w AS d, string_agg(key, '') OVER w AS path FROM whole WINDOW w AS (PARTITION BY c ORDER BY own, p ROWS UNBOUNDED PRECEDING)),
    member AS (SELECT c, 0 AS d, '' AS path, 0 AS size FROM heads UNION ALL SELECT c, d, path, size FROM seq),
    lengths AS (SELECT c, max(d) AS n FROM member GROUP BY c),
    node AS (
      SELECT path, max(m.d) AS depth, min(m.c) AS conv_id, count(*) AS n_convs, max(size) AS size,
        sha256(coalesce(string_agg(CAST(m.c AS VARCHAR), ',' ORDER BY m.c) FILTER (WHERE m.d = l.n), '')) AS ends_sha256
      FROM member m JOIN lengths l ON m.c = l.c GROUP BY path),
    child AS (SELECT left(path, length(path) - 32) AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
    full_ AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM node n LEFT JOIN child k ON n.path = k.path),
    below AS (
      SELECT a.path, sum(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((b.n_convs - 1) * b.size) AS saved_tokens
      FROM full_ b CROSS JOIN range(1000) g(k) JOIN full_ a ON a.path = left(b.path, 32 * g.k) WHERE g.k <= b.depth GROUP BY a.path)
    SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(w.n_leaves AS BIGINT) AS n_leaves,
      CAST(w.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
    FROM full_ n JOIN below w ON n.path = w.path LEFT JOIN full_ p ON n.depth > 0 AND p.path = left(n.path, length(n.path) - 32)
    """
