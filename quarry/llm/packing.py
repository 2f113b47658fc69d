"""Best-fit packing of tokenised documents into sequences, by linear grouping.

1. Documents longer than a sequence are cut; the first piece takes the remainder and may be shorter, all others fill
   a sequence each. What is left to pack is at most one piece for each document.
2. Pieces longer than a share of the capacity are sorted by length and cut into groups of equal cardinality; lengths
   are rounded up to the largest of their group. The few rounded lengths make a cutting-stock problem, whose linear
   programme is solved by column generation (a knapsack finds the next configuration). Rounded-down multiples of
   its configurations become sequences.
3. Actual lengths take the places of rounded ones, longest first. What found no place, and all small pieces, go by
   decreasing length to the sequence with the least room that suffices (best fit), or to a new one.

The plan needs only the number of pieces of each length, so the driver holds `capacity` counts and the runs of the
plan, whatever the corpus. Pieces are ranked within their length, in slices, and looked up in the runs of it.

Null and empty texts are one token (the end). No row is dropped, ties in length are broken by document id, and
repeated document ids are packed like others (each row by itself).
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm import common


class PairEncoder:
    """Byte-level BPE from a file of the `tokenizers` library, with the ids of its `encode(add_special_tokens=False)`.

    The file's merges are in the order of its ids, which is all that the faster encoder of `tiktoken` needs to give the
    same ids; loading fails if they differ on a probe. Texts that hold the content of an added token go to `tokenizers`.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in the file
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        special = {x["content"] for x in spec.get("added_tokens", [])}
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.fast = tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.given, self.added = Tokenizer.from_file(path), sorted(special)
        probe = "It's  the 3rd\n\n caf\u00e9 \u4e2d\u6587 \u0440\u0443\u0441 <|text|> x\u00a0\t_=+ 12345 don't"
        if self.given.encode(probe, add_special_tokens=False).ids != self.fast.encode_ordinary(probe):
            raise ValueError(f"{path}: not a byte-level BPE in the order of its ids")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        return [array("I", self._ids(t)).tobytes() for t in texts]

    def _ids(self, text: str) -> list[int]:
        if any(a in text for a in self.added):
            return self.given.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


@cache
def tokenizer(path: str) -> PairEncoder:
    return PairEncoder(path)


def pieces(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """(key, piece, start, length, ids_crc32) of all documents, cut where they are longer than a sequence."""
    schema = df.select(F.col(key).alias("doc_id")).schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long")
    end = np.array([end_id], dtype="<u4").tobytes()
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(path)
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(coder.encode([t or "" for t in batch.column(1).to_pylist()])):
                ids += end
                at, k = 0, 0
                while at < len(ids):
                    to = min(len(ids), at + (len(ids) % width if at == 0 and len(ids) % width else width))
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append((to - at) // 4)
                    crc.append(zlib.crc32(ids[at:to]))
                    at, k = to, k + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=schema.names,
            )

    return df.select(F.col(key).alias("doc_id"), text).mapInArrow(run, schema)


def configurations(sizes: list[int], demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """The cutting-stock linear programme over few sizes: configurations and how often each is taken."""
    m = len(sizes)
    size = np.array(sizes)
    fit = np.maximum(1, capacity // size).astype(float)
    basis, inverse, level = np.diag(fit), np.diag(1 / fit), demand / fit
    for _ in range(30 * m):
        price = inverse.sum(0)
        best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for c in range(1, capacity + 1):  # unbounded knapsack: the most valuable configuration at these prices
            n = np.searchsorted(size, c, side="right")
            best[c] = best[c - 1]
            if n:
                value = best[c - size[:n]] + price[:n]
                i = int(value.argmax())
                if value[i] > best[c] + 1e-12:
                    best[c], last[c] = value[i], i
        if best[capacity] <= 1 + 1e-6:
            break
        column, c = np.zeros(m), capacity
        while c > 0:
            if last[c] < 0:
                c -= 1
            else:
                column[last[c]] += 1
                c -= sizes[last[c]]
        move = (inverse * column).sum(1)
        ratio = np.where(move > 1e-9, level / np.where(move > 1e-9, move, 1), np.inf)
        j = int(ratio.argmin())
        if not np.isfinite(ratio[j]):
            break
        basis[:, j] = column
        pivot = inverse[j] / move[j]
        inverse = inverse - move[:, None] * pivot
        inverse[j] = pivot
        level = np.maximum(level - move * ratio[j], 0)
        level[j] = ratio[j]
    return [(basis[:, j].astype(int), float(level[j])) for j in range(m)]


def plan_groups(counts: dict[int, int], capacity: int, groups: int, small: float) -> tuple[int, dict[int, list[tuple[int, int, int, int]]]]:
    """The plan for one number of groups; pieces of at most `small` of the capacity are not grouped."""
    left = {s: n for s, n in counts.items() if n}
    rank: dict[int, int] = defaultdict(int)
    runs: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    room: dict[int, list[list[int]]] = defaultdict(list)  # free tokens -> [first sequence, number]
    sequences = 0

    def put(size: int, number: int, first: int, offset: int) -> None:
        runs[size].append((rank[size], number, first, offset))
        rank[size] += number
        left[size] -= number
        if not left[size]:
            del left[size]

    if n := left.get(capacity, 0):
        put(capacity, n, 0, 0)
        sequences += n
    large = sorted((s for s in left if s > small * capacity), reverse=True)
    total = sum(left[s] for s in large)
    if total:
        share = -(-total // groups)
        members: list[list[list[int]]] = []  # of each group: [length, number], longest first
        taken = share
        for s in large:
            n = left[s]
            while n:
                if taken == share:
                    members.append([])
                    taken = 0
                k = min(n, share - taken)
                members[-1].append([s, k])
                taken += k
                n -= k
        rounded: dict[int, list[list[int]]] = {}
        for g in members:  # groups that round to the same length are one
            rounded.setdefault(g[0][0], []).extend(g)
        sizes = sorted(rounded)
        demand = np.array([sum(k for _, k in rounded[s]) for s in sizes], dtype=float)
        queue = {s: [list(x) for x in rounded[s]] for s in sizes}
        for column, level in sorted(configurations(sizes, demand, capacity), key=lambda x: -x[1]):
            todo = int(level + 1e-7)
            slots = [sizes[i] for i in np.repeat(np.arange(len(sizes)), column)][::-1]
            # all places of a group are filled from its longest; a column is split where an actual length runs out
            while todo and all(queue[s] for s in slots):
                need = {s: slots.count(s) for s in slots}
                n = todo
                for s, k in need.items():
                    have = sum(x[1] for x in queue[s])
                    n = min(n, have // k)
                if not n:
                    break
                picks, used = [], defaultdict(int)
                for s in slots:  # the j-th place of a group takes what stands j * n further on
                    at = used[s]
                    used[s] += 1
                    skip, i = at * n, 0
                    while skip >= queue[s][i][1]:
                        skip -= queue[s][i][1]
                        i += 1
                    picks.append((s, i, skip))
                n_run = min([n, *(queue[s][i][1] - skip for s, i, skip in picks)])
                offset = 0
                chosen = [queue[s][i][0] for s, i, _ in picks]
                for size in chosen:
                    put(size, n_run, sequences, offset)
                    offset += size
                for (s, i, _), _size in zip(picks, chosen, strict=True):
                    queue[s][i][1] -= n_run
                for s in need:
                    queue[s] = [x for x in queue[s] if x[1]]
                if capacity - offset:
                    room[capacity - offset].append([sequences, n_run])
                sequences += n_run
                todo -= n_run
    while left:
        size = max(left)
        while left.get(size):
            fits = [r for r in room if r >= size]
            if not fits:
                per = max(1, capacity // size)
                n = left[size] // per
                if not n:
                    per, n = left[size], 1
                for j in range(per):
                    put(size, n, sequences, j * size)
                if capacity - per * size:
                    room[capacity - per * size].append([sequences, n])
                sequences += n
                continue
            free = min(fits)
            first, number = room[free].pop()
            if not room[free]:
                del room[free]
            k = min(number, left[size])
            put(size, k, first, capacity - free)
            if free - size:
                room[free - size].append([first, k])
            if number > k:
                room[free].append([first + k, number - k])
    return sequences, dict(runs)


def plan(counts: dict[int, int], capacity: int = 1024, groups: tuple[int, ...] = (64, 128), small: float = 0.2) -> dict[int, list[tuple[int, int, int, int]]]:
    """For each length, runs (first rank, number, first sequence, offset): rank r of a run goes to sequence
    `first sequence + r - first rank`, at the offset. Of the numbers of groups, the one with the fewest sequences.
    """
    return min((plan_groups(counts, capacity, g, small) for g in groups), key=lambda x: x[0])[1]


def pack(cut: DataFrame, capacity: int = 1024, slice_rows: int = 50_000) -> DataFrame:
    """Adds sequence_id and offset to pieces. `cut` is read more than once: write it first.

    A length's pieces are ranked in slices by a hash of the document, each of about `slice_rows` rows of all lengths
    or fewer, so that a very frequent length is no single task's work.
    """
    spark = cut.sparkSession
    slices = F.lit(max(1, -(-cut.count() // slice_rows)))
    cut = cut.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), slices))
    each = cut.groupBy("length", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = each.select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = {r["length"]: r["n"] for r in each.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = [(int(s), [(int(a), int(b), int(c), int(d)) for a, b, c, d in runs]) for s, runs in plan(counts, capacity).items()]
    runs = spark.createDataFrame(rows, "length long, runs array<struct<first: long, number: long, sequence: long, offset: long>>")
    order = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = cut.withColumn("_rank", F.row_number().over(order) - 1).join(bases, ["length", "slice"]).withColumn("_rank", F.col("_rank") + F.col("base"))
    ranked = ranked.join(F.broadcast(runs), "length")
    run = F.element_at(F.filter("runs", lambda r: (r["first"] <= F.col("_rank")) & (F.col("_rank") < r["first"] + r["number"])), 1)
    ranked = ranked.withColumn("_run", run)
    return ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("_run.sequence") + F.col("_rank") - F.col("_run.first")).alias("sequence_id"), F.col("_run.offset").alias("offset"),
    )


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = 1024) -> DataFrame:
    common.bound_batches(docs.sparkSession, 1000, "4m")
    return pack(common.materialise(pieces(docs, path or default_tokenizer(), capacity=capacity), "pieces"), capacity)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(common.table(spark, sf_dir, "documents"))


def stage_best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: where each piece of the kept documents goes.

    Null and empty texts are one token, the end. Repeated ids and equal rows are packed as rows of their own, null ids too.
    An empty table packs to no piece.
    """
    return pack_documents(docs)
