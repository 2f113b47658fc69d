"""Benchmark decontamination by spaced seeds that no accepted overlap can avoid.

An item counts as contained if `length` words in a row (or the whole item, if shorter) agree with a stretch of the
document to `share` at least. A seed hashes the words under a fixed mask, which ignores the positions between them. Of
the n words k = n - ceil(share * n) may differ, and a differing word spoils at most as many seeds as the mask has
words: of the n - span + 1 seeds at least n - span + 1 - weight * k are met. An item takes the heaviest mask for which
that is positive; single words always do. Seed hashes of items and of documents are joined; each hit gives a
diagonal (document position less item position), and diagonals with that many hits are compared word by word. So
nothing that is accepted is missed. Only DataFrame functions are used.

Words are runs of letters and digits in lower case. Null and empty texts have no words and never match. Repeated documents and items are reported each under
its own id; rows with equal ids count as one. Among several diagonals the one with the most agreeing words is
reported, then the smallest. Words are compared by 64-bit hashes. Whole texts are searched.

The item side of the seed join is broadcast only if it has at most `broadcast_seeds` rows; beyond that, the join
shuffles seed hashes. Document texts are never shuffled for seeds, and are read a second time only for documents
with a hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import common

#: Positions that count, by number of words. Those between them are ignored.
MASKS = {1: (0,), 2: (0, 2), 3: (0, 1, 3), 4: (0, 1, 3, 5), 6: (0, 1, 3, 4, 7, 8)}


def word_hashes(text: Column) -> Column:
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _windows(words: Column, weights: list[int]) -> Column:
    """For each mask, the position (from 0) and hash of its words wherever it fits."""

    def of(weight: int) -> Column:
        mask = MASKS[weight]
        hashed = lambda i: F.struct(i.alias("pos"), F.lit(weight).alias("weight"), F.xxhash64(*[F.get(words, i + k) for k in mask], F.lit(weight)).alias("seed"))
        return F.when(F.size(words) > mask[-1], F.transform(F.sequence(F.lit(0), F.size(words) - mask[-1] - 1), hashed)).otherwise(F.array().cast("array<struct<pos: int, weight: int, seed: bigint>>"))

    return of(weights[0]) if len(weights) == 1 else F.concat(*map(of, weights))


def seeds(df: DataFrame, key: str, words: str, weights: list[int], *others: str) -> DataFrame:
    """(key, others, pos, weight, seed) for all masks; the masks' hashes differ, so one join serves all.

    The outer generator keeps the optimizer from adding a filter on the array's size below it, which would compute
    the words anew inside the windows' lambda.
    """
    return df.select(key, *others, F.inline_outer(_windows(F.col(words), weights))).where(F.col("pos").isNotNull())


def find(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
         length: int = 20, share: float = 0.75, broadcast_seeds: int = 500_000, broadcast_hits: int = 500_000) -> DataFrame:
    """(doc_id, item_id, matched, compared, doc_pos, item_pos): a row for each document and item it contains.

    `matched` of `compared` words agree in the best stretch, which starts at `doc_pos` and `item_pos` (from 0).
    """
    items = items.where(F.col(item_key).isNotNull() & F.col(item_text).isNotNull()).groupBy(F.col(item_key).alias("item_id")).agg(F.min(item_text).alias("t"))
    items = common.materialise(items.select("item_id", word_hashes(F.col("t")).alias("item_words")).where(F.size("item_words") > 0), "items")
    compared = F.least(F.lit(length), F.size("item_words"))
    differ = compared - F.ceil(F.lit(share) * compared).cast("int")
    met = {w: compared - mask[-1] - w * differ for w, mask in MASKS.items()}
    sized = items.select("*", F.array_max(F.array(*[F.when((n > 0) | F.lit(w == 1), F.struct(F.lit(w).alias("own"), F.greatest(F.lit(1), n).alias("need"))) for w, n in met.items()])).alias("x")).select("*", "x.own", "x.need")
    weights = sorted(r["own"] for r in sized.select("own").distinct().collect()) or [1]
    wanted = seeds(sized, "item_id", "item_words", weights, "own", "need").where("weight = own")
    wanted = common.materialise(wanted.select("item_id", F.col("pos").alias("item_pos"), "need", "seed"), "item-seeds")
    few = wanted.count() <= broadcast_seeds
    given = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("doc_id"), F.col(text).alias("t"))
    split = given.select("doc_id", word_hashes(F.col("t")).alias("words"))
    hits = seeds(split, "doc_id", "words", weights).join(F.broadcast(wanted) if few else wanted, "seed")
    hits = hits.groupBy("doc_id", "item_id", (F.col("pos") - F.col("item_pos")).alias("diagonal")).agg(F.count("*").alias("n"), F.first("need").alias("need"))
    hits = hits.where("n >= need").select("doc_id", "item_id", "diagonal")
    hits = common.materialise(hits, "seed-hits")
    by_doc = hits.groupBy("doc_id").agg(F.count("*").alias("n")).select("doc_id")
    small = hits.count() <= broadcast_hits
    again = given.join(F.broadcast(by_doc) if small else by_doc, "doc_id", "left_semi")
    texts = common.materialise(again.select("doc_id", word_hashes(F.col("t")).alias("words")).dropDuplicates(["doc_id", "words"]), "hit-texts")
    pairs = hits.join(texts, "doc_id").join(F.broadcast(items) if few else items, "item_id")
    # the stretch of the item that lies inside the document on this diagonal
    first, last = F.greatest(F.lit(0), -F.col("diagonal")), F.least(F.size("item_words"), F.size("words") - F.col("diagonal"))
    agree = F.transform(F.sequence(F.col("first"), F.col("last") - 1), lambda i: (F.get("item_words", i) == F.get("words", i + F.col("diagonal"))).cast("int"))
    compared = F.least(F.lit(length), F.size("item_words"))
    pairs = pairs.withColumns({"first": first, "last": last, "compared": compared}).where(F.col("last") - F.col("first") >= F.col("compared"))
    pairs = pairs.select("doc_id", "item_id", "diagonal", "first", "compared", agree.alias("agree"))
    sums = F.transform(
        F.sequence(F.lit(0), F.size("agree") - F.col("compared")),
        lambda i: F.struct(F.aggregate(F.slice("agree", i + 1, F.col("compared")), F.lit(0), lambda a, x: a + x).alias("m"), (-i).alias("i")),
    )
    best = pairs.withColumn("best", F.array_max(sums)).where(F.col("best.m") >= F.lit(share) * F.col("compared"))
    found = best.select("doc_id", "item_id", F.col("best.m").alias("matched"), "compared", (F.col("first") - F.col("best.i")).alias("item_pos"), (F.col("first") - F.col("best.i") + F.col("diagonal")).alias("doc_pos"))
    order = F.struct(F.col("matched"), -F.col("doc_pos"), -F.col("item_pos"), F.col("compared"))
    top = found.groupBy("doc_id", "item_id").agg(F.max(order).alias("x"))
    return top.select("doc_id", "item_id", F.col("x.matched").alias("matched"), F.col("x.compared").alias("compared"), (-F.col("x.col2")).alias("doc_pos"), (-F.col("x.col3")).alias("item_pos"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document of `documents` and item of `benchmark` that it contains."""
    return find(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of `benchmark`.

    Null, empty and blank texts contain none and stay, as do rows with a null id; equal rows share their fate, and rows of
    one id go together if one of their texts contains an item. An empty table stays empty, and an empty benchmark takes nothing away.
    """
    found = common.materialise(find(docs, common.table(spark, sf_dir, "benchmark")).select("doc_id").distinct(), "contaminated")
    return docs.join(F.broadcast(found) if found.count() <= 1_000_000 else found, "doc_id", "left_anti").select(*docs.columns)
