"""N-gram Jaccard join in metric space: pivots, Voronoi regions, triangle-inequality windows, recursive exact joins.

Jaccard distance (1 - share) is a metric; two documents link within `radius` = 1 - percent / 100.

  0. Meeting. Documents of a corpus are nearly all at distance 1 from each other, where distances to document pivots tell
     nothing apart. The first pivots are therefore the shingles themselves, as sets of one: rare before frequent, by
     exact document counts, those that only one document has left out. A document within the radius shares one of the
     first `floor(radius * size) + 1` (it can lack no more than `floor(radius * size)` of them). Documents that
     meet at a pivot so are tied to one cluster; links never leave a cluster, and a document that meets none has no link.
  1. Regions. A cluster of more than `block` shingles takes documents as pivots and is dealt out by its Voronoi regions:
     a document's region is that of its nearest pivot, and a boundary document, no farther from another pivot than from
     its own by more than two radii, is replicated in that pivot's window. Those at distance 1 from all pivots have a
     region of their own, with all that are at `1 - radius` or more from their nearest one in its window. Documents within the
     radius of a pivot are linked to it, and regions whose documents are all of one component need no further look.
     The regions are dealt out again by new pivots, `LEVELS` times; what is still large then is compared as pairs of blocks.
     Among near copies of one text nearly all are in all windows. A region whose windows make more than they part
     (`GAIN`, `COPIES`) is left as it was, with the links found, and compared as pairs of blocks at once.
     A document counts for `LEAST` shingles there if it has fewer, so that a block is bounded in pairs too.
  2. Within `block` shingles the same recursion runs in memory, down to exact intersections of the pairs that no
     window excludes. A pair of one component is not looked at again, nor one of documents that have too few shingles
     in common with all others there together.

A large region is dealt over as many tasks as it has blocks, each with the region's pivots. Frequent shingles, found on a
bounded sample, are kept out of the count's shuffle and stand last in the order of pivots; any order is exact.

Words are runs of bytes other than ASCII white space, A-Z lower-cased; a set is all runs of `width` words, or the
whole sequence where there are fewer. Null, empty and blank texts have no set and link with nothing. Sets are
compared by 64-bit hashes of shingles and known by 64-bit keys; documents of equal sets are one class from the start.
Rows with a null id are components of their own; rows of equal id are one document with several texts. An empty table
gives no row; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm import common
from quarry.llm.graph import components

#: Rows that may be broadcast (about 40 bytes each); beyond them the same joins shuffle.
BROADCAST_SPOTS = 1_000_000
#: Rows sampled to find frequent shingles, and how many of those there may be.
SAMPLE_ROWS, MOST_FREQUENT = 4_000, 500_000
#: Rounds by document pivots over the cluster, and the pivots of a region in each.
LEVELS, PIVOTS = 3, 16
#: A region is dealt out if its parts have at most this share of its pairs, and this many times its shingles, together.
GAIN, COPIES = 0.5, 1.5
#: Shingles counted in one task, and documents' rows in one group.
BUCKET, GROUP_ROWS = 8_000_000, 50_000
#: A document weighs as many shingles at least where a block is filled, which so bounds its pairs too.
LEAST = 64


def sets(data: np.ndarray, bounds: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document."""
    for a, b in common.chunks(bounds):
        value, doc, _, _ = common.words(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
        hashes, of = common.shingles(value, doc, b - a, width)
        edge = np.searchsorted(of, np.arange(b - a + 1))
        for i in range(b - a):
            yield np.unique(hashes[edge[i] : edge[i + 1]])


def set_key(s: np.ndarray) -> int:
    """A 64-bit key of a set."""
    if not len(s):
        return 0
    with np.errstate(over="ignore"):
        total = common.mix(s).sum(dtype=np.uint64) + np.uint64(len(s)) * np.uint64(0x9E3779B97F4A7C15)
    return int(common.mix(np.array([total], np.uint64)).view(np.int64)[0])


def _flat(every: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(every) if every else np.zeros(0, np.uint64)


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values, kind))


# --- exact joins in memory


class Joined:
    """Links of documents in memory, as labels of components; pairs of one label are not compared."""

    def __init__(self, members: list[np.ndarray], label: np.ndarray, percent: int):
        self.percent, self.radius = percent, 1 - percent / 100
        self.size = np.array([len(s) for s in members], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        unique, self.column = np.unique(_flat(members), return_inverse=True)
        self.mark = np.zeros(len(unique), bool)
        several = np.bincount(self.column, minlength=len(unique)) > 1
        held = np.concatenate([[0], np.cumsum(several[self.column])])
        #: a document's shingles that others here have
        self.held = held[self.start[1:]] - held[self.start[:-1]]
        self.label = np.unique(label, return_inverse=True)[1]

    def shared(self, x: int, among: np.ndarray) -> np.ndarray:
        """Intersection sizes of x with others."""
        own = self.column[self.start[x] : self.start[x + 1]]
        self.mark[own] = True
        n = self.size[among]
        ends = np.cumsum(n)
        at = np.repeat(self.start[among] - (ends - n), n) + np.arange(n.sum())
        out = np.add.reduceat(self.mark[self.column[at]].astype(np.int64), ends - n)
        self.mark[own] = False
        return out

    def against(self, x: int, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances of x to others, and which of them link with it."""
        both = self.shared(x, among)
        union = self.size[x] + self.size[among] - both
        return 1 - both / union, 100 * both >= self.percent * union

    def measure(self, x: int, among: np.ndarray) -> np.ndarray:
        """Distances of x to others; those that link with it become one component."""
        if not len(among):
            return np.zeros(0)
        distance, linked = self.against(x, among)
        old = np.unique(self.label[among[linked]])
        if len(old) and (len(old) > 1 or old[0] != self.label[x]):
            self.label[np.isin(self.label, np.append(old, self.label[x]))] = min(old[0], self.label[x])
        return distance

    def visit(self, at: np.ndarray, depth: int = 0) -> None:
        """Finds all links among `at`."""
        if len(at) < 2 or (self.label[at] == self.label[at[0]]).all():
            return
        if len(at) <= 24 or depth > 6:
            return self.pairs(at, np.zeros((0, len(at))))
        pivot, rows = 0, []
        for _ in range(8):
            rows.append(self.measure(at[pivot], at))
            nearest = np.min(rows, axis=0)
            pivot = int(nearest.argmax())
            if nearest[pivot] <= self.radius:
                break
        d = np.array(rows)
        home, windows = voronoi(d, self.radius)
        parts = [(home == j) | windows[j + 1] for j in range(-1, len(d)) if (home == j).any()]
        if sum(int(here.sum()) ** 2 for here in parts) > GAIN * len(at) ** 2:
            return self.pairs(at, d)
        for here in parts:
            self.visit(at[here], depth + 1)

    def pairs(self, at: np.ndarray, d: np.ndarray) -> None:
        """Compares all pairs that sizes and distances to pivots (a row for each) leave."""
        for i in range(len(at) - 1):
            x, rest = at[i], slice(i + 1, None)
            ok = self.label[at[rest]] != self.label[x]
            low, high = np.minimum(self.size[at[rest]], self.size[x]), np.maximum(self.size[at[rest]], self.size[x])
            ok &= 100 * low >= self.percent * high
            ok &= (100 + self.percent) * np.minimum(self.held[at[rest]], self.held[x]) >= self.percent * (low + high)
            if len(d) and ok.any():
                ok &= (np.abs(d[:, rest] - d[:, i : i + 1]) <= self.radius + 1e-9).all(0)
            self.measure(x, at[rest][ok])


def voronoi(d: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """The region of each column of distances (a row for each pivot), -1 if all are 1; and whose windows it is in.

    A pair within the radius, in two regions, meets in the one of the smaller number: the windows' rows are the
    regions from -1 on, and hold the documents of larger ones only.
    """
    nearest, slack = d.min(0), 1e-9
    home = np.where(nearest >= 1, -1, d.argmin(0))
    windows = np.zeros((len(d) + 1, d.shape[1]), bool)
    windows[0] = (home >= 0) & (nearest >= 1 - radius - slack)
    for j in range(len(d)):
        windows[j + 1] = (home > j) & (d[j] <= nearest + 2 * radius + slack)
    return home, windows


def _members(group: pa.Table, *names: str) -> Iterator[tuple[int, list[np.ndarray], list[np.ndarray]]]:
    """For each region in a group: its number, its sets, and the columns `names`; a node counts once in each slot."""
    group = group.combine_chunks()
    column = {c: group[c].to_numpy() for c in ("region", "node", "slot", *names)}
    order = np.lexsort((column["node"], column["slot"], column["region"]))
    key = np.stack([column[c][order] for c in ("region", "slot", "node")])
    order = order[np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(0)])] if len(order) else order
    raw = group["set"]
    region = column["region"][order]
    for first, last in zip(*_runs(region), strict=True):
        at = order[first:last]
        yield int(region[first]), [np.frombuffer(raw[int(i)].as_buffer(), np.uint64) for i in at], [column[c][at] for c in names]


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of runs of equal values."""
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    return first, np.append(first[1:], len(x))


def _table(**columns: np.ndarray) -> pa.Table:
    return pa.table({c: pa.array(v, pa.int64()) for c, v in columns.items()})


def _joined(percent: int):
    """Edges of a spanning forest of the links within each region of a group."""

    def run(group: pa.Table) -> pa.Table:
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for _, members, (node, label) in _members(group, "node", "component"):
            found = Joined(members, label, percent)
            found.visit(np.arange(len(members)))
            _, first, of = np.unique(found.label, return_index=True, return_inverse=True)
            far = np.flatnonzero(first[of] != np.arange(len(node)))
            a.append(node[far])
            b.append(node[first[of]][far])
        return _table(a=np.concatenate(a), b=np.concatenate(b))

    return run


def _dealt(percent: int):
    """For each region of a group, whose rows with a slot are its pivots: the others' new regions, and links to pivots."""

    def run(group: pa.Table) -> pa.Table:
        out = [np.zeros((5, 0), np.int64)]

        def add(a, b, region: int, slot: int, node) -> None:
            n = max(np.size(a), np.size(node))
            out.append(np.array([np.full(n, x, np.int64) for x in (a, b, region, slot, node)]))

        for region, members, (node, slot) in _members(group, "node", "slot"):
            pivots, others = np.flatnonzero(slot >= 0), np.flatnonzero(slot < 0)
            if not len(others):
                continue
            found = Joined(members, np.arange(len(members)), percent)
            rows = []
            for p in pivots:
                distance, linked = found.against(p, others)
                rows.append(distance)
                if linked.any():
                    add(node[others[linked]], node[p], region, -2, -1)
            home, windows = voronoi(np.array(rows), found.radius)
            for j in range(-1, len(pivots)):
                here = others[(home == j) | windows[j + 1]]
                if len(here):
                    add(-1, -1, region, j, node[here])
        return _table(**dict(zip(("a", "b", "region", "slot", "node"), np.concatenate(out, axis=1), strict=True)))

    return run


# --- document counts of shingles


def frequent(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Frequent shingles by a bounded sample of rows (sorted hashes, counts), the shingles of all rows by the mean size there, and the rows."""
    total = docs.count()
    sample = docs if total <= SAMPLE_ROWS else docs.sample(SAMPLE_ROWS / total, seed=7)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = [*sets(*common.utf8(batch.column(0)), width)]
            hashes, n = np.unique(_flat(every), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([None, None], pa.int64()), pa.array([int(n.sum()), len(every) << 40], pa.int64())], names=["h", "n"])

    counted = sample.select("text").mapInArrow(common.releasing(run), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    counted = common.materialise(counted.where("n >= 16 or h is null"), "jaccard-sample")
    both = (counted.where("h is null").first() or {"n": 0})["n"]
    rows, shingles = both >> 40, both & ((1 << 40) - 1)
    got = counted.where(F.col("h").isNotNull() & (F.col("n") >= max(16, rows // 250, shingles // MOST_FREQUENT))).toPandas()
    common.discard(counted)
    h, n = got["h"].to_numpy(dtype=np.int64).view(np.uint64), got["n"].to_numpy(dtype=np.int64)
    order = np.argsort(h)
    return h[order], n[order], shingles / max(1, rows) * total, total


_PLACED = ["bucket", "id", "text_key", "n", "rest", "node", "frequent", "nodes", "counts", "low", "lowest"]


def _place(width: int, percent: int, bits: int, shift: int, groups: int, heavy):
    """Of each text a row (bucket < 0), and of each batch its classes' shingles by buckets, five bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, rank = heavy.value
        none = pa.nulls
        for batch in batches:
            every = [*sets(*common.utf8(batch.column(2)), width)]
            n = np.array([len(s) for s in every], np.int64)
            node = np.array([set_key(s) for s in every], np.int64)
            pivot = _flat(every) >> np.uint64(shift)
            at = np.minimum(np.searchsorted(often, pivot), max(0, len(often) - 1))
            is_often = often[at] == pivot if len(often) else np.zeros(len(pivot), bool)
            owner = np.repeat(np.arange(len(every)), n)
            rest = n - np.bincount(owner[is_often], minlength=len(every))
            window = n * (100 - percent) // 100 + 1
            # frequent pivots of documents whose other ones may not fill the window
            spot = np.flatnonzero(is_often & (rest < window)[owner])
            spot = spot[np.lexsort((rank[at[spot]], owner[spot]))]
            of = owner[spot]
            first = np.searchsorted(of, of) if len(of) else of
            spot = spot[np.arange(len(of)) - first < (window - rest)[of] + rest[of]]
            lists = _lists(pivot[spot].view(np.int64), np.bincount(owner[spot], minlength=len(every)), pa.int64())
            m = len(every)
            where = -1 - (np.arange(m) + (batch.column(1)[0].as_py() or 0) % groups) % groups if m else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(where.astype(np.int32)), batch.column(0), batch.column(1), pa.array(n), pa.array(rest), pa.array(node), lists, *(none(m, pa.binary()) for _ in range(4))], names=_PLACED)
            valid = np.zeros(m, bool)
            valid[np.unique(node, return_index=True)[1]] = True
            valid &= n > 0
            some = valid[owner] & ~is_often
            pivot, owner = pivot[some], owner[some]
            bucket = (pivot & np.uint64((1 << bits) - 1)).astype(np.uint32)
            order = np.argsort(bucket.astype(np.uint16) if bits <= 16 else bucket, kind="stable")
            pivot, owner, bucket = pivot[order] >> np.uint64(bits), owner[order], bucket[order]
            firsts, lasts = _runs(bucket)
            if not len(firsts):
                continue
            begin, end = _runs(bucket.astype(np.int64) * m + owner)
            nodes, counts = node[owner[begin]], (end - begin).astype(np.uint32)
            low, lowest = (pivot >> np.uint64(8)).astype(np.uint32), pivot.astype(np.uint8)
            a, b = np.searchsorted(begin, firsts), np.searchsorted(begin, lasts)
            packed = [[nodes[i:j].tobytes() for i, j in zip(a, b, strict=True)], [counts[i:j].tobytes() for i, j in zip(a, b, strict=True)], [low[i:j].tobytes() for i, j in zip(firsts, lasts, strict=True)], [lowest[i:j].tobytes() for i, j in zip(firsts, lasts, strict=True)]]
            k = len(firsts)
            yield pa.RecordBatch.from_arrays([pa.array(bucket[firsts].astype(np.int32)), none(k, batch.column(0).type), *(none(k, pa.int64()) for _ in range(4)), none(k, pa.list_(pa.int64())), *(pa.array(x, pa.binary()) for x in packed)], names=_PLACED)

    return run


def _counted(bits: int):
    """Documents' rows as they are; of a bucket (node, pivot, df) for the pivots that several classes have."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        size = len(group)
        if size and group["bucket"][0].as_py() < 0:
            return group.select(_PLACED[1:7]).append_column("pivot", pa.nulls(size, pa.int64())).append_column("df", pa.nulls(size, pa.int32()))
        joined = lambda c, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in group[c]])
        nodes, counts = joined("nodes", np.int64), joined("counts", np.uint32)
        pivot = (joined("low", np.uint32).astype(np.uint64) << np.uint64(8)) | joined("lowest", np.uint8)
        once = np.zeros(len(nodes), bool)  # a class counts once, however many batches it is in
        once[np.unique(nodes, return_index=True)[1]] = True
        if not once.all():
            pivot = pivot[np.repeat(once, counts)]
            nodes, counts = nodes[once], counts[once]
        owner = np.repeat(np.arange(len(nodes), dtype=np.int32), counts)
        order = np.argsort(pivot)
        pivot, owner = pivot[order], owner[order]
        first, last = _runs(pivot)
        df = np.repeat((last - first).astype(np.int32), last - first)
        some = df > 1
        pivot = (pivot[some] << np.uint64(bits)) | np.uint64(group["bucket"][0].as_py())
        m = int(some.sum())
        common.release()
        out = {"id": pa.nulls(m, group.schema.field("id").type), **{c: pa.nulls(m, pa.int64()) for c in ("text_key", "n", "rest")}, "node": pa.array(nodes[owner[some]]), "frequent": pa.nulls(m, pa.list_(pa.int64())), "pivot": pa.array(pivot.view(np.int64)), "df": pa.array(df[some])}
        return pa.table(out)

    return run


def grouped(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 75, block: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """Rows (id, text_key, n, node) of `docs`, and the classes (node, rep, component) whose sets they hold.

    `text_key` is a hash of the text; `component` the smallest node reachable by links, `rep` the smallest id of a class.
    """
    spark = docs.sparkSession
    common.bound_batches(spark)
    given = docs.select(F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    kind = given.dtypes[0][1]
    often, counts, shingles, total = frequent(given, width)
    bits = max(6, int(np.ceil(np.log2(max(1.0, shingles / BUCKET)))))
    shift = max(0, 24 - bits)
    rank = np.empty(len(often), np.int64)
    rank[np.lexsort((often, counts))] = np.arange(len(often))
    heavy = spark.sparkContext.broadcast((often >> np.uint64(shift), rank))

    schema = f"bucket int, id {kind}, text_key long, n long, rest long, node long, frequent array<bigint>, nodes binary, counts binary, low binary, lowest binary"
    spread = given.mapInArrow(common.releasing(_place(width, percent, bits, shift, max(64, -(-total // GROUP_ROWS)), heavy)), schema)
    found = spread.groupBy("bucket").applyInArrow(_counted(bits), f"id {kind}, text_key long, n long, rest long, node long, frequent array<bigint>, pivot long, df int")
    found = common.materialise(found, "jaccard-counts")
    placed = found.where("pivot is null").select("id", "text_key", "n", "rest", "node", "frequent")
    rows = common.materialise(placed.select("id", "text_key", "n", "node"), "jaccard-rows")
    shared = found.where("pivot is not null").select("node", "pivot", "df")
    classes = placed.where("n > 0 and id is not null").groupBy("node").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("rest").alias("rest"), F.first("frequent").alias("frequent"))
    classes = common.materialise(classes, "jaccard-classes")

    # documents that others can meet: those whose window reaches beyond the pivots that only they have
    window = F.floor(F.col("n") * (100 - percent) / 100) + 1
    several = shared.groupBy("node").agg(F.count("*").alias("several"))
    open_ = classes.join(several, "node", "left").withColumn("several", F.coalesce("several", F.lit(0)))
    open_ = open_.withColumn("need", window - F.col("rest") + F.col("several")).where((F.col("need") > 0) & ((F.col("several") > 0) | (F.size("frequent") > 0)))
    open_ = common.materialise(open_.select("node", "several", "need", "frequent"), "jaccard-open")
    few = open_.count() <= BROADCAST_SPOTS
    own = shared.join(F.broadcast(open_.select("node", "need")) if few else open_.select("node", "need"), "node")
    own = own.withColumn("place", F.row_number().over(Window.partitionBy("node").orderBy("df", "pivot"))).where("place <= need").select("node", "pivot")
    late = open_.where(F.col("need") > F.col("several")).select("node", F.explode(F.slice("frequent", 1, (F.col("need") - F.col("several")).cast("int"))).alias("pivot"))
    meet = common.materialise(own.unionByName(late), "jaccard-meet")
    common.discard(open_)
    common.discard(found)
    star = meet.groupBy("pivot").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z").select("pivot", "a")
    edges = common.materialise(meet.join(star, "pivot").where("a <> node").select("a", F.col("node").alias("b")).distinct(), "jaccard-meetings")
    common.discard(meet)
    clusters = common.materialise(components(edges, "jaccard-components").select("node", F.col("component").alias("region")), "jaccard-clusters")
    common.discard(edges)

    spent = [classes, clusters]
    links = _links(given, classes, clusters, width, percent, block, spent)
    label = components(links, "jaccard-components")
    out = classes.select("node", "rep").join(label, "node", "left").select("node", "rep", F.coalesce("component", "node").alias("component"))
    out = common.materialise(out, "jaccard-labels")
    for frame in spent:
        common.discard(frame)
    return rows, out


def _links(given: DataFrame, classes: DataFrame, clusters: DataFrame, width: int, percent: int, block: int, spent: list[DataFrame]) -> DataFrame:
    """Edges (a, b) with the components of all links within the regions of `clusters` (node, region).

    Adds to `spent` what is no longer needed once the edges are."""
    spark = given.sparkSession
    size = classes.select("node", F.greatest("n", F.lit(LEAST).cast("long")).alias("n"))
    columns = ["part", "region", "slot", "component", "node"]
    edges = spark.createDataFrame([], "a long, b long")

    def compared(rows: DataFrame, what, schema: str) -> DataFrame:
        """`what` over the groups `part` of rows (part, region, slot, component, node). Texts are read again for the sets
        of these nodes only."""
        spots = rows.join(classes.select("node", F.col("rep").alias("id")), "node").groupBy("id", "node").agg(F.collect_list(F.struct(*columns[:4])).alias("at"))
        spots = common.materialise(spots, "jaccard-spots")
        n = spots.agg(F.coalesce(F.sum(F.size("at") + 1), F.lit(0)).alias("n")).first()["n"]
        texts = given.join(F.broadcast(spots) if n <= BROADCAST_SPOTS else spots, "id").select("text", "node", "at")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out: dict[str, list] = {c: [] for c in [*columns, "set"]}
                held = 0
                for s, node, at in zip(sets(*common.utf8(batch.column(0)), width), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    if set_key(s) != node:  # another text of the same id
                        continue
                    raw = s.tobytes()
                    for spot in at:
                        for c in columns[:4]:
                            out[c].append(spot[c])
                        out["node"].append(node)
                        out["set"].append(raw)
                        held += len(raw)
                        if held > 8 << 20:
                            yield _sets_batch(out)
                            out, held = {c: [] for c in out}, 0
                yield _sets_batch(out)

        placed = texts.mapInArrow(common.releasing(run), ", ".join(f"{c} long" for c in columns) + ", set binary")
        found = common.materialise(placed.groupBy("part").applyInArrow(what, schema), "jaccard-found")
        common.discard(spots)
        spent.append(found)
        return found

    def whole(rows: DataFrame, total: int) -> DataFrame:
        """Regions of a block at most, several in a group."""
        groups = F.lit(max(1, total // block))
        return compared(rows.withColumn("part", F.pmod(F.xxhash64("region"), groups)).withColumn("slot", F.lit(-1).cast("long")).select(*columns), _joined(percent), "a long, b long")

    def in_pairs(rows: DataFrame) -> DataFrame:
        return compared(_pairs(rows, block).select(*columns), _joined(percent), "a long, b long")

    members = clusters.select("node", "region", F.col("node").alias("component"))
    for level in range(LEVELS + 1):
        members = common.materialise(members.join(size, "node"), "jaccard-members")
        spent.append(members)
        regions = common.materialise(members.groupBy("region").agg(F.sum("n").alias("total"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("region", "total"), "jaccard-regions")
        spent.append(regions)
        small = regions.where(F.col("total") <= block)
        amount = small.agg(F.sum("total")).first()[0]
        if amount:
            edges = edges.unionByName(whole(members.join(small.select("region"), "region"), amount))
        large = regions.where(F.col("total") > block).withColumn("parts", F.ceil(F.col("total") / block))
        if not large.limit(1).count():
            break
        rest = members.join(large, "region")
        if level == LEVELS:
            edges = edges.unionByName(in_pairs(rest))
            break
        slot = F.pmod(F.xxhash64("node", F.lit(level)), F.lit(PIVOTS))
        pivots = rest.groupBy("region", "parts", slot.alias("slot")).agg(F.min_by("node", F.xxhash64("node", F.lit(-1 - level))).alias("node"))
        pivots = pivots.withColumn("p", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("component", F.lit(-1).cast("long"))
        dealt = rest.withColumn("p", F.pmod(F.xxhash64("node", F.lit(level)), F.col("parts"))).withColumn("slot", F.lit(-1).cast("long"))
        both = dealt.unionByName(pivots, allowMissingColumns=True).withColumn("part", F.xxhash64("region", "p"))
        found = compared(both.select(*columns), _dealt(percent), "a long, b long, region long, slot long, node long")
        edges = edges.unionByName(found.where("slot = -2").select("a", "b"))
        label = common.materialise(components(edges, "jaccard-components"), "jaccard-linked")
        spent.append(label)
        own = F.coalesce("component", "node").alias("component")
        fresh = found.where("slot > -2").select("node", "region", F.xxhash64("region", "slot", F.lit(level)).alias("part")).distinct().join(label, "node", "left").select("node", "region", "part", own)
        parts = fresh.join(size, "node").groupBy("region", "part").agg(F.sum("n").alias("k"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
        worth = parts.groupBy("region").agg(F.sum("k").alias("k"), F.sum(F.pow("k", F.lit(2))).alias("pairs")).join(large, "region")
        pays = (F.col("k") <= COPIES * F.col("total")) & (F.col("pairs") <= GAIN * F.pow("total", F.lit(2)))
        worth = common.materialise(worth.select("region", pays.alias("pays")), "jaccard-dealt")
        spent.append(worth)
        if worth.where("not pays").limit(1).count():
            kept = rest.select("node", "region", "n").join(worth.where("not pays").select("region"), "region").join(label, "node", "left").select("node", "region", "n", own)
            edges = edges.unionByName(in_pairs(kept))
        members = fresh.join(worth.where("pays").select("region"), "region").select("node", F.col("part").alias("region"), "component")
    return edges


def _pairs(rest: DataFrame, block: int) -> DataFrame:
    """All pairs of half blocks of large regions (node, region, component, n), but for those within its main component."""
    half = F.lit(block // 2)
    per = rest.groupBy("region", "component").agg(F.sum("n").alias("k"))
    main = per.groupBy("region").agg(F.max_by(F.struct("component", "k"), "k").alias("main"), F.sum("k").alias("m")).select("region", "m", F.col("main.component").alias("main"), F.col("main.k").alias("k"))
    dealt = rest.select("node", "region", "component").join(main, "region").withColumn("is_main", (F.col("component") == F.col("main")) & (F.col("k") > half))
    others = F.when(F.col("k") > half, F.col("m") - F.col("k")).otherwise(F.col("m"))
    h = F.xxhash64("node", F.lit("pairs"))
    dealt = dealt.withColumn("half", F.when(F.col("is_main"), -1 - F.pmod(h, F.ceil(F.col("k") / half))).otherwise(F.pmod(h, F.greatest(F.lit(1), F.ceil(others / half)))))
    halves = dealt.select("region", "half").distinct()
    pairs = halves.join(halves.where("half >= 0").select("region", F.col("half").alias("other")), "region").where("half <= other")
    twice = pairs.select("region", "other", F.col("half").alias("low"), F.explode(F.array_distinct(F.array("half", "other"))).alias("half"))
    group = F.xxhash64("region", "low", "other")
    return dealt.join(twice, ["region", "half"]).select(group.alias("part"), group.alias("region"), F.lit(-1).cast("long").alias("slot"), "component", "node")


def _sets_batch(out: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, pa.binary() if c == "set" else pa.int64()) for c, v in out.items()], names=[*out])


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 75, block: int = 1 << 20) -> DataFrame:
    """(key, n_shingles, component_id) for every row: sets link if 100 * intersection >= percent * union.

    The component is the smallest id reachable by links, the document's own included. `block` bounds the shingles of
    the documents that one task compares, but for a single longer one.
    """
    rows, classes = grouped(docs, key, text, width, percent, block)
    smallest = classes.groupBy("component").agg(F.min("rep").alias("component_id"))
    ids = classes.join(smallest, "component").select("node", "component_id")
    linkable = rows.where("n > 0 and id is not null")
    if linkable.select("id", "node").distinct().groupBy("id").count().where("count > 1").limit(1).count():  # one id with several texts ties their components
        ids = _tie(linkable, ids)
    alone = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component_id")).otherwise(F.col("id"))
    return rows.select("id", "n", "node").join(ids, "node", "left").select(F.col("id").alias(key), F.col("n").alias("n_shingles"), alone.alias("component_id"))


def _tie(linkable: DataFrame, ids: DataFrame) -> DataFrame:
    """Components that share a document id are one."""
    rows = linkable.select("id", "node").join(ids, "node")
    first = rows.groupBy("id").agg(F.min("component_id").alias("c"))
    tied = components(rows.join(first, "id").select(F.col("component_id").cast("long").alias("a"), F.col("c").cast("long").alias("b")).distinct())
    return ids.join(tied.withColumnRenamed("node", "component_id"), "component_id", "left").select("node", F.coalesce("component", "component_id").alias("component_id"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(common.table(spark, sf_dir, "documents"))


def stage_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate texts one row stays: the smallest id, or of equal ones a row of it.

    Texts without words and rows with a null id all stay, as do different texts of one id. An empty table stays empty;
    other columns are carried along, whatever their names.
    """
    rows, classes = grouped(docs)
    linkable = rows.where("n > 0 and id is not null").select("id", "text_key", "node").join(classes.select("node", "component"), "node")
    first = linkable.groupBy("component").agg(F.min(F.struct("id", "text_key")).alias("first"), F.count("*").alias("rows"))
    first = common.materialise(first.where("rows > 1").select("component", "first.*", "rows"), "jaccard-first")
    several = linkable.join(first.select("component"), "component").select("id", "text_key").distinct()
    gone = common.materialise(several.join(first.select("id", "text_key"), ["id", "text_key"], "left_anti"), "jaccard-gone")
    names = {"id": "_jaccard_id", "text_key": "_jaccard_text_key"}
    own = [F.col("doc_id").alias(names["id"]), F.xxhash64("text").alias(names["text_key"])]
    gone = gone.withColumnsRenamed(names)
    kept = docs.select("*", *own).join(F.broadcast(gone) if gone.count() <= BROADCAST_SPOTS else gone, [*names.values()], "left_anti")
    # equal rows of a text that stays
    twice = linkable.join(first.select("id", "text_key"), ["id", "text_key"]).groupBy("id", "text_key").agg(F.count("*").alias("rows")).where("rows > 1").select("id", "text_key")
    twice = common.materialise(twice, "jaccard-twice").withColumnsRenamed(names)
    if twice.limit(1).count():
        equal = kept.join(twice, [*names.values()], "left_semi")
        kept = kept.join(twice, [*names.values()], "left_anti").unionByName(equal.dropDuplicates([*names.values()]))
    return kept.select(*docs.columns)
