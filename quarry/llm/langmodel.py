"""Language-model scoring: context-tree weighting over bytes, decomposed into binary decisions.

A text is its lower-cased words with single spaces between them and an end symbol. Each byte is eight binary
decisions; a decision is made in the contexts of the 0 to `depth` bytes before it, of which each holds a
Krichevsky-Trofimov estimate from its counts in all training texts. Context-tree weighting mixes the estimates of
all depths: a context's weight is the share of its own block probability in its weighted probability, computed
bottom-up from the counts in closed form. Every context that was counted is a node, so the tree grows with the input.

Counting sends (context, byte) counts, summed in each task first. The tree is split below contexts of `SPLIT` - 1 bytes:
the driver holds the top, whose size the alphabet bounds, and executors the subtrees, a group of them at a time. They
send the weights of their roots up, get what the top leaves for them, and score each distinct gram of the documents.
The `most` commonest grams are broadcast with their scores; the others are joined with theirs by shuffle. So are
the tokens of the base score, which needs exact counts of all, beyond the `most_words` commonest.

Null text counts as empty, which is the end symbol and one token. Whole texts are scored. Repeated rows score alike.
Tokens are compared by 64-bit hashes. Without training rows, counts are zero and the model is uniform.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import common

END = 0xFF  # never a byte of UTF-8: pads the first contexts and ends a text
SPACE = 0x20
END_TOKEN = 1  # stands for the hash of the end token
SPLIT = 3  # context bytes of a subtree's root
CHUNK = 1 << 20  # bytes of text that one vectorised step takes
HELD = 1_000_000  # distinct grams or tokens that a task sums before it sends them

def _lgamma(x: np.ndarray) -> np.ndarray:
    """By recurrence up to 8, then Stirling's series."""
    x = np.asarray(x, dtype=np.float64)
    shift, low = np.zeros_like(x), x.copy()
    for _ in range(8):
        small = low < 8
        shift[small] += np.log(low[small])
        low[small] += 1
    z = 1 / (low * low)
    return (low - 0.5) * np.log(low) - low + 0.9189385332046727 + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / low - shift


_HALVES, _WHOLES = _lgamma(np.arange(1 << 12) + 0.5), _lgamma(np.arange(1 << 12) + 1.0)


def _looked_up(counts: np.ndarray, table: np.ndarray, more: float) -> np.ndarray:
    """lgamma(counts + more) of whole counts; nearly all are small, and stand in the table."""
    at = counts.astype(np.int64)
    out = table[np.minimum(at, len(table) - 1)]
    large = np.flatnonzero(at >= len(table))
    out[large] = _lgamma(counts[large] + more)
    return out


def _kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov block probability of a zeros and b ones."""
    return _looked_up(a, _HALVES, 0.5) + _looked_up(b, _HALVES, 0.5) - _looked_up(a + b, _WHOLES, 1.0) - np.log(np.pi)


def normal_bytes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the normal form, each text with the end symbol behind it, and the bounds."""
    n = len(bounds) - 1
    _, doc, start, end = common.words(data, bounds)
    length = end - start
    total = np.bincount(doc, weights=length + 1, minlength=n).astype(np.int64)
    total = np.maximum(total, 1)  # a space or the end behind each word; no word: the end alone
    out_bounds = np.concatenate([[0], np.cumsum(total)])
    out = np.full(out_bounds[-1], SPACE, np.uint8)
    offset = np.cumsum(length + 1) - (length + 1)  # where words begin, if every text had words
    empty_before = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n) == 0)])[:-1]
    at = offset + empty_before[doc] if len(doc) else offset
    inside = np.repeat(start - (np.cumsum(length) - length), length) + np.arange(length.sum()) if len(doc) else np.zeros(0, np.int64)
    to = np.repeat(at - (np.cumsum(length) - length), length) + np.arange(length.sum()) if len(doc) else np.zeros(0, np.int64)
    out[to] = common._lower[data[inside]]
    out[out_bounds[1:] - 1] = END
    return out, out_bounds


def gram_codes(text: np.ndarray, bounds: np.ndarray, depth: int) -> np.ndarray:
    """For each byte, the code of it and the `depth` bytes before it (END before the text's first byte)."""
    code = text.astype(np.uint64)
    shifted = code.copy()
    for k in range(1, depth + 1):
        np.left_shift(shifted, np.uint64(8), out=shifted)
        code[k:] |= shifted[:-k] if len(text) > k else shifted[:0]
    full = (1 << (8 * (depth + 1))) - 1
    for k in range(depth):  # the first bytes of a text have END before them
        at = bounds[:-1][np.diff(bounds) > k] + k
        own = (1 << (8 * (k + 1))) - 1
        code[at] = (code[at] & np.uint64(own)) | np.uint64(full ^ own)
    return code


@dataclass(frozen=True)
class TreeModel:
    """Sorted node keys of each depth and the mixture's probability of a one, as `_small`, where a node is the deepest on the path."""

    depth: int
    keys: tuple[np.ndarray, ...]
    ones: tuple[np.ndarray, ...]
    known: np.ndarray  # codes whose scores are at hand
    known_log: np.ndarray

    def log10_of(self, codes: np.ndarray) -> np.ndarray:
        """log10 probability of each code's last byte in its context."""
        if not len(codes):
            return np.zeros(0)
        out = np.zeros(len(codes))
        todo = np.arange(len(codes))
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, codes), len(self.known) - 1)
            hit = self.known[at] == codes
            out[hit] = self.known_log[at[hit]]
            todo = np.flatnonzero(~hit)
        for part in np.array_split(todo, max(1, len(todo) // 100_000)):
            out[part] = self._slow(codes[part])
        return out

    def _slow(self, codes: np.ndarray) -> np.ndarray:
        symbol = (codes & np.uint64(255)).astype(np.int64)
        context = codes >> np.uint64(8)
        total = np.zeros(len(codes))
        for level in range(8):
            node = (1 << level) | (symbol >> (8 - level))
            bit = (symbol >> (7 - level)) & 1
            one, todo = np.full(len(codes), 0.5), np.arange(len(codes))
            for d in range(self.depth, -1, -1):  # the deepest node on the path counts
                keys = self.keys[d]
                if len(keys) and len(todo):
                    key = node_key(context[todo], d, node[todo])
                    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    hit = keys[at] == key
                    one[todo[hit]] = self.ones[d][at[hit]]
                    todo = todo[~hit]
            total += np.log10(np.where((bit == 1) == (one > 0), np.abs(one), 1 - np.abs(one)))
        return total


def node_key(context: np.ndarray, depth: int, node: np.ndarray) -> np.ndarray:
    """Key of a decision node (1..255) in the context of the last `depth` bytes."""
    mask = np.uint64((1 << (8 * depth)) - 1)
    return ((context & mask) << np.uint64(8)) | node.astype(np.uint64)


def _nodes(codes: np.ndarray, counts: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys of the decision nodes in contexts of d bytes, and their counts of zeros and ones; codes are sorted.

    A level's keys rise with the codes, so its nodes are runs, and eight sorted levels are merged at the end.
    """
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)
    symbol, context = (codes & np.uint64(255)).astype(np.int64), codes >> np.uint64(8)
    parts, a, b = [], [], []
    for level in range(8):
        key = node_key(context, d, (1 << level) | (symbol >> (8 - level)))
        bit = (symbol >> (7 - level)) & 1
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        whole, ones = np.add.reduceat(counts, first), np.add.reduceat(counts * bit, first)
        parts.append(key[first])
        b.append(ones)
        a.append(whole - ones)
    key = np.concatenate(parts)
    order = np.argsort(key, kind="stable")
    return key[order], np.concatenate(a)[order], np.concatenate(b)[order]


def _small(one: np.ndarray) -> np.ndarray:
    """Probabilities of a one in 32 bits: those above a half less 1, since 1 - 1e-8 would be stored as 1, and a zero scored minus infinity."""
    return np.where(one > 0.5, one - 1, one).astype(np.float32)


def _parents(keys: np.ndarray, d: int) -> np.ndarray:
    """Keys of the nodes in contexts a byte shorter than those of depth d."""
    return node_key(keys >> np.uint64(8), d - 1, keys & np.uint64(255))


@dataclass(frozen=True)
class Part:
    """Depths `first` to `first + len(keys) - 1` of the tree: node keys, counts, weights and shares of own estimates."""

    first: int
    keys: list[np.ndarray]
    zeros: list[np.ndarray]
    ones: list[np.ndarray]
    weighted: list[np.ndarray]
    share: list[np.ndarray]
    up: list[np.ndarray]  # places of the parents, a depth higher

    def mixed(self, gathered: np.ndarray, left: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Top-down: probabilities of a one at each depth, and what the last depth has gathered and leaves.

        `gathered` and `left` are what the path down to each node of the first depth has.
        """
        final, g, m = [], gathered, left
        for d, keys in enumerate(self.keys):
            if d:
                g, m = g[self.up[d]], m[self.up[d]]
            estimate = (self.ones[d] + 0.5) / (self.zeros[d] + self.ones[d] + 1.0)
            final.append(_small(g + m * estimate))
            g, m = g + m * self.share[d] * estimate, m * (1 - self.share[d])
        return final, g, m


def part(codes: np.ndarray, counts: np.ndarray, first: int, last: int, below: np.ndarray | None = None) -> Part:
    """Depths `first` to `last` of the tree from counts of grams with `last` context bytes, bottom-up.

    `below` has the children's weights for each node of depth `last`, in the order of keys; None: the tree ends there.
    """
    n = last - first + 1
    keys, zeros, ones, weighted, share, up = ([None] * n for _ in range(6))
    for d in range(last, first - 1, -1):
        codes, inverse = np.unique(codes & np.uint64((1 << (8 * (d + 1))) - 1), return_inverse=True)
        counts = np.bincount(inverse, weights=counts, minlength=len(codes))
        at = d - first
        keys[at], zeros[at], ones[at] = _nodes(codes, counts, d)
        own = _kt(zeros[at], ones[at])
        if d < last:
            up[at + 1] = np.searchsorted(keys[at], _parents(keys[at + 1], d + 1))
            below = np.bincount(up[at + 1], weights=weighted[at + 1], minlength=len(own))
        if below is None:
            weighted[at], share[at] = own, np.ones(len(own))
        else:
            weighted[at] = np.logaddexp(own, below) - np.log(2)
            share[at] = np.exp(np.log(0.5) + own - weighted[at])
    return Part(first, keys, zeros, ones, weighted, share, up)


def build(levels: list[tuple[np.ndarray, np.ndarray]], known: int) -> TreeModel:
    """The whole tree from (codes, counts) of each depth 0..D: codes are d context bytes and the byte itself."""
    depth = len(levels) - 1
    codes, counts = levels[depth]
    whole = part(codes, counts, 0, depth)
    final, _, _ = whole.mixed(np.zeros(len(whole.keys[0])), np.ones(len(whole.keys[0])))
    model = TreeModel(depth, tuple(whole.keys), tuple(final), np.zeros(0, np.uint64), np.zeros(0))
    top = np.sort(codes[np.argsort(-counts, kind="stable")[:known]])
    return TreeModel(depth, model.keys, model.ones, top, model.log10_of(top))


def _runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)


def _sum_codes(codes: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct codes and the sums of their weights. Sorting is several times faster than a table of hashes."""
    order = np.argsort(codes)
    codes = codes[order]
    first = _runs(codes)
    return codes[first], *(np.add.reduceat(w[order], first) if len(first) else np.zeros(0, np.int64) for w in weights)


def _count_codes(codes: np.ndarray, learn: np.ndarray, ask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`_sum_codes` where weights are 0 or 1, which are sorted with codes of at most 62 bits in one word."""
    if len(codes) and int(codes.max()) >> 62:
        return _sum_codes(codes, learn, ask)
    word = np.sort((codes << np.uint64(2)) | (learn + 2 * ask).astype(np.uint64))
    first = _runs(word)
    n, word = np.diff(np.append(first, len(word))), word[first]
    codes, kind = word >> np.uint64(2), (word & np.uint64(3)).astype(np.int64)
    first = _runs(codes)
    if not len(first):
        return codes, n, n
    return codes[first], np.add.reduceat(n * (kind & 1), first), np.add.reduceat(n * (kind >> 1), first)


def count(texts: DataFrame, depth: int) -> DataFrame:
    """(kind, code, n, m) over the columns `text`, `learn` and `ask`: kind 0 for grams of depth + 1 bytes, 1 for tokens.

    n counts rows to learn from (learn = 1), m rows to score (ask = 1); tokens are counted in the former only. Each
    task sums what it has read, and sends it packed by ranges of a hash; a range is summed in one task.
    """
    buckets = max(16, 4 * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    names = ["kind", "bucket", "codes", "n", "m"]

    def packed(kind: int, codes: np.ndarray, n: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
        bucket = (common.mix(codes) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
        ends = np.flatnonzero(np.diff(bucket[order])) + 1
        first = np.concatenate([[0], ends]) if len(codes) else np.zeros(0, np.int64)
        last = np.append(ends, len(codes)) if len(codes) else first
        columns = [pa.array([x[i:j].tobytes() for i, j in zip(first, last, strict=True)], pa.binary()) for x in (codes[order], n[order].astype(np.uint32), m[order].astype(np.uint32))]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(first), kind, np.int32)), pa.array(bucket[order][first]), *columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple[np.ndarray, ...]]] = [[], []]

        def merged(kind: int) -> tuple[np.ndarray, ...]:
            return _sum_codes(*(np.concatenate(x) for x in zip(*held[kind], strict=True)))

        for batch in batches:
            data, bounds = common.utf8(batch.column(0))
            learn, ask = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (1, 2))
            for a, b in common.chunks(bounds, CHUNK):
                piece, edge = data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
                normal, at = normal_bytes(piece, edge)
                of = np.repeat(np.arange(a, b), np.diff(at))
                held[0].append(_count_codes(gram_codes(normal, at, depth), learn[of], ask[of]))
                value, doc, _, _ = common.words(piece, edge)
                value = value[learn[doc + a] > 0]
                held[1].append(_sum_codes(np.where(value <= END_TOKEN, value + np.uint64(2), value), np.ones(len(value), np.int64), np.zeros(len(value), np.int64)))
            if learn.any():
                held[1].append((np.array([END_TOKEN], np.uint64), np.array([learn.sum()]), np.array([0])))
            for kind in (0, 1):
                if sum(len(x[0]) for x in held[kind]) > HELD:
                    held[kind] = [merged(kind)]
                    if len(held[kind][0][0]) > HELD // 2:
                        yield packed(kind, *held[kind][0])
                        held[kind] = []
        for kind in (0, 1):
            if held[kind]:
                yield packed(kind, *merged(kind))

    def summed(group: pa.Table) -> pa.Table:
        joined = lambda c, kind: np.concatenate([np.frombuffer(x, kind) for x in group[c].to_pylist()])
        codes, n, m = _sum_codes(joined("codes", np.uint64), joined("n", np.uint32).astype(np.int64), joined("m", np.uint32).astype(np.int64))
        return pa.table({"kind": pa.array(np.full(len(codes), group["kind"][0].as_py(), np.int32)), "code": codes.view(np.int64), "n": n, "m": m})

    counted = texts.select("text", "learn", "ask").mapInArrow(common.releasing(run), "kind int, bucket int, codes binary, n binary, m binary")
    return counted.groupBy("kind", "bucket").applyInArrow(summed, "kind int, code long, n long, m long")


def _collect(df: DataFrame, value: str = "n") -> tuple[np.ndarray, np.ndarray]:
    got = df.select("code", F.col(value).cast("double").alias("v")).toArrow()
    return got["code"].to_numpy().view(np.uint64), got["v"].to_numpy()


def _arrays(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return group["code"].to_numpy(dtype=np.int64).view(np.uint64), group["n"].to_numpy(dtype=np.float64), group["m"].to_numpy() > 0


def gram_scores(grams: DataFrame, depth: int, group: int = 100_000) -> DataFrame:
    """(code, m, log10) for the grams (code, n, m) with m > 0: all contexts that were counted take part.

    Subtrees go together in groups of about `group` grams.
    """
    spark = grams.sparkSession
    split = min(SPLIT, depth)
    suffix = F.shiftrightunsigned("code", 8).bitwiseAND(F.lit((1 << (8 * split)) - 1))
    groups = max(1, -(-grams.count() // group))
    dealt = grams.select("code", "n", "m", F.pmod(F.xxhash64(suffix), F.lit(groups)).alias("part"))

    def lift(found: pd.DataFrame) -> pd.DataFrame:
        codes, n, _ = _arrays(found)
        sub = part(codes, n, split, depth)
        keys, inverse = np.unique(_parents(sub.keys[0], split), return_inverse=True)
        return pd.DataFrame({"code": keys.view(np.int64), "w": np.bincount(inverse, weights=sub.weighted[0], minlength=len(keys))})

    top_keys, final, gathered, left = [], [], None, None
    if split:
        roots = dealt.where("n > 0").groupBy("part").applyInPandas(lift, "code long, w double").groupBy("code").agg(F.sum("w").alias("w"))
        keys, below = _collect(roots, "w")
        short = grams.where("n > 0").groupBy(F.col("code").bitwiseAND(F.lit((1 << (8 * split)) - 1)).alias("code")).agg(F.sum("n").alias("n"))
        codes, n = _collect(short)
        top = part(codes, n, 0, split - 1, below[np.argsort(keys)])
        final, gathered, left = top.mixed(np.zeros(len(top.keys[0])), np.ones(len(top.keys[0])))
        top_keys = top.keys
    above = spark.sparkContext.broadcast((top_keys, final, gathered, left))

    def give(found: pd.DataFrame) -> pd.DataFrame:
        top_keys, final, gathered, left = above.value
        codes, n, asked = _arrays(found)
        sub = part(codes[n > 0], n[n > 0], split, depth)
        if split:
            at = np.searchsorted(top_keys[-1], _parents(sub.keys[0], split))
            below, _, _ = sub.mixed(gathered[at], left[at])
        else:
            below, _, _ = sub.mixed(np.zeros(len(sub.keys[0])), np.ones(len(sub.keys[0])))
        model = TreeModel(depth, (*top_keys, *sub.keys), (*final, *below), np.zeros(0, np.uint64), np.zeros(0))
        order = np.argsort(codes[asked])
        wanted = codes[asked][order]
        return pd.DataFrame({"code": wanted.view(np.int64), "m": found["m"].to_numpy()[asked][order], "log10": model.log10_of(wanted)})

    scored = dealt.groupBy("part").applyInPandas(give, "code long, m long, log10 double")
    return common.materialise(scored, "lm-grams")


@dataclass(frozen=True)
class WordCounts:
    keys: np.ndarray
    counts: np.ndarray


def score(docs: DataFrame, training: DataFrame | Column, key: str = "doc_id", text: str = "text", depth: int = 5, most: int = 2_000_000, most_words: int = 1_000_000) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for each row of `docs`.

    `score` is the log10 probability of the text, and `bits_per_byte` its code length over the bytes of its normal form.

    `training` has the texts to learn from, or is a condition on `docs`. `most` bounds the grams that are broadcast
    with their scores, `most_words` the tokens; the others are joined by shuffle, so neither bounds what is counted.
    """
    spark = docs.sparkSession
    common.bound_batches(spark)
    if isinstance(training, DataFrame):
        texts = training.select(F.col(text).alias("text"), F.lit(1).alias("learn"), F.lit(0).alias("ask")).unionByName(docs.select(F.col(text).alias("text"), F.lit(0).alias("learn"), F.lit(1).alias("ask")))
    else:
        texts = docs.select(F.col(text).alias("text"), F.coalesce(training, F.lit(False)).cast("int").alias("learn"), F.lit(1).alias("ask"))
    counted = common.materialise(count(texts, depth), "lm-counts")
    words = common.materialise(counted.where("kind = 1").select("code", "n"), "lm-words")
    scores = gram_scores(counted.where("kind = 0").select("code", "n", "m"), depth)
    common.discard(counted)
    grams_whole = scores.count() <= most
    codes, log10 = _collect(common.commonest(scores, most, "m"), "log10")
    order = np.argsort(codes)
    common_grams = spark.sparkContext.broadcast((codes[order], log10[order]))
    size = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, distinct = int(size["n"]), int(size["v"])
    codes, n = _collect(common.commonest(words, most_words))
    order = np.argsort(codes)
    common_words = spark.sparkContext.broadcast(WordCounts(codes[order], n[order]))
    floor = float(np.log10(total + distinct + 1)) if total + distinct + 1 > 0 else 0.0
    whole = distinct <= most_words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (grams, scored_grams), table = common_grams.value, common_words.value
        for batch in batches:
            data, bounds = common.utf8(batch.column(1))
            rows = batch.num_rows
            n_tokens, n_known, n_bytes = (np.zeros(rows, np.int64) for _ in range(3))
            base, log10 = np.zeros(rows), np.zeros(rows)
            rare_doc, rare_code, rare_gram_doc, rare_gram = [], [], [], []
            for a, b in common.chunks(bounds, CHUNK):
                part, edge = data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
                normal, at = normal_bytes(part, edge)
                codes = gram_codes(normal, at, depth)
                order = np.argsort(codes)
                rising = codes[order]
                first = _runs(rising)
                unique, times = rising[first], np.diff(np.append(first, len(rising)))
                place = np.minimum(np.searchsorted(grams, unique), max(0, len(grams) - 1))
                hit = grams[place] == unique if len(grams) else np.zeros(len(unique), bool)
                value, each = np.zeros(len(unique)), np.zeros(len(codes))
                value[hit] = scored_grams[place[hit]]
                each[order] = np.repeat(value, times)
                log10[a:b] = np.add.reduceat(each, at[:-1])
                n_bytes[a:b] = np.diff(at)
                far = np.sort(order[np.repeat(~hit, times)])
                rare_gram_doc.append(np.searchsorted(at, far, side="right") - 1 + a)
                rare_gram.append(codes[far])
                value, doc, _, _ = common.words(part, edge)
                value = np.concatenate([np.where(value <= END_TOKEN, value + np.uint64(2), value), np.full(b - a, END_TOKEN, np.uint64)])
                doc = np.concatenate([doc, np.arange(b - a)])
                n_tokens[a:b] = np.bincount(doc, minlength=b - a)
                if len(table.keys):
                    which, unique = pd.factorize(value)
                    place = np.minimum(np.searchsorted(table.keys, unique), len(table.keys) - 1)
                    hit = (table.keys[place] == unique)[which]
                    c = np.where(table.keys[place] == unique, table.counts[place], 0)[which]
                else:
                    hit, c = np.zeros(len(value), bool), np.zeros(len(value))
                if whole:
                    hit_or_new = np.ones(len(value), bool)
                else:
                    hit_or_new = hit
                base[a:b] = np.bincount(doc[hit_or_new], weights=np.log10(c[hit_or_new] + 1) - floor, minlength=b - a)
                n_known[a:b] = np.bincount(doc[hit & (c > 0)], minlength=b - a)
                rest = ~hit_or_new
                rare_doc.append(doc[rest] + a)
                rare_code.append(value[rest])
            rare, rare_grams = listed(rare_doc, rare_code, rows), listed(rare_gram_doc, rare_gram, rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_tokens), pa.array(n_known), pa.array(n_bytes), pa.array(base), pa.array(log10), rare, rare_grams], names=names)

    def listed(of: list[np.ndarray], codes: list[np.ndarray], rows: int) -> pa.Array:
        of = np.concatenate(of) if of else np.zeros(0, np.int64)
        codes = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        order = np.argsort(of, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=rows))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(codes[order].view(np.int64)))

    names = ["id", "n_tokens", "n_known", "n_bytes", "base", "score", "rare", "grams"]
    kind = docs.select(F.col(key).alias("id")).dtypes[0][1]
    given = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    scored = given.mapInArrow(common.releasing(run), f"id {kind}, n_tokens long, n_known long, n_bytes long, base double, score double, rare array<bigint>, grams array<bigint>")
    result = [F.col("id").alias(key), "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens")]
    if not (whole and grams_whole):
        scored = common.materialise(scored.withColumn("row", F.monotonically_increasing_id()), "lm-scores")
    if whole:
        out = scored.withColumn("more", F.lit(0).cast("long")).withColumn("extra", F.lit(0.0))
    else:
        tail = scored.select("row", F.explode("rare").alias("code")).groupBy("row", "code").agg(F.count("*").alias("k"))
        found = tail.join(words, "code", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        sums = found.groupBy("row").agg(F.sum(F.col("k") * (F.log10(F.col("n") + 1) - F.lit(floor))).alias("extra"), F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("more"))
        out = scored.join(sums, "row", "left")
    if not grams_whole:  # each gram of the documents has a score
        tail = scored.select("row", F.explode("grams").alias("code")).join(scores.select("code", "log10"), "code")
        out = out.join(tail.groupBy("row").agg(F.sum("log10").alias("rest")), "row", "left").withColumn("score", F.col("score") + F.coalesce("rest", F.lit(0.0)))
    length = (F.col("score") * F.lit(-np.log2(10)) / F.col("n_bytes")).alias("bits_per_byte")
    return out.select(*result, (F.col("base") + F.coalesce("extra", F.lit(0.0))).alias("base_score"), "score", length)


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, common.remainder(F.col("doc_id"), 7) != 2)
    held = (common.remainder(F.col("doc_id"), 7) == 2).alias("held_out")
    return out.select("doc_id", held, "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
