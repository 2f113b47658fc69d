"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text, normalised by length.

Folding lower-cases, maps homoglyphs (other scripts, accents, full-width forms) and digit substitutions to plain
letters and all that is no letter to white space. Lexicon terms are whole words or beginnings of words; weights are
smoothed log-odds of toxic against other labelled documents. Exception phrases (given, or learnt as neighbours with
which a term stands in clean documents only) cancel the matches inside them. A logistic calibration turns the
total weight, raw and per length, into a score.

Null text counts as empty, and an empty text gets the score of a text without a match. Whole texts are matched.
Ties between terms at one word go to the larger weight. Repeated rows score alike; columns other than the text are
never read. Without toxic labels the lexicon is the given seed list.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, cached_property
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import common

#: Weight that a seed word has before labels speak.
SEED_WEIGHT = 2.0
SEEDS = ("idiot", "moron", "stupid", "scum", "loser", "pathetic", "worthless", "disgusting")
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "pond scum")
PREFIX_LENGTHS = (4, 5, 6, 7)

_LOOKALIKES = dict(zip("аеорсухіјѕԁһԛԝкмтвнαβεικνορτυχγ", "aeopcyxijsdhqwkmtbhabeiknoptuxy", strict=True))
_DIGITS = dict(zip("013457", "oieast", strict=True))


@cache
def _table() -> dict[int, str]:
    """For code points below 0x20000: what they fold to."""
    out = {}
    for i in range(0x20000):
        c = chr(i)
        plain = unicodedata.normalize("NFKD", c)
        base = "".join(x for x in plain if not unicodedata.combining(x)).lower()
        base = "".join(_LOOKALIKES.get(x, _DIGITS.get(x, x)) for x in base)
        out[i] = "".join(x if x.isalpha() else " " for x in base) or ("" if unicodedata.combining(c) else " ")
    return {i: x for i, x in out.items() if x != chr(i)}


_inner = re.compile(r"(?<=[^\W_])[@$](?=[^\W_])")


def fold(text: str) -> str:
    """Folded words, each behind one or more spaces, with a space at either end."""
    if "@" in text or "$" in text:
        text = _inner.sub(lambda m: "a" if m[0] == "@" else "s", text)
    return f" {text.translate(_table())} "


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float]  # " term " for a word, " term" for a beginning of words
    exceptions: tuple[str, ...]
    beta: tuple[float, ...] = field(default=(-3.0, 1.0, 0.5, 1.0))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "automaton"}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton | None:
        out = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            out.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            out.add_word(f" {phrase} ", (len(phrase) + 2, None))
        if not len(out):
            return None
        out.make_automaton()
        return out

    def features(self, text: str) -> tuple[float, float, float]:
        """Total weight, weight per thousand words (both as logarithms), and whether anything matched."""
        folded = fold(text)
        best: dict[int, float] = {}
        free: list[tuple[int, int]] = []
        if self.automaton:
            for end, (length, weight) in self.automaton.iter(folded):
                start = end - length + 1
                if weight is None:
                    free.append((start, end))
                elif weight > best.get(start, 0.0):
                    best[start] = weight
        if free:
            starts = sorted(a for a, _ in free)
            reach = list(accumulate((b for _, b in sorted(free)), max))
            best = {k: w for k, w in best.items() if not (i := bisect_right(starts, k)) or reach[i - 1] <= k}
        total = sum(best.values())
        return float(np.log1p(total)), float(np.log1p(1000 * total / (10 + folded.count(" ")))), float(bool(best))


def _terms(folded: str) -> set[str]:
    out = set()
    for w in set(folded.split()):
        if 3 <= len(w) <= 40:
            out.add(f" {w} ")
        out.update(f" {w[:k]}" for k in PREFIX_LENGTHS if len(w) >= k)
    return out


def _counts(df: DataFrame, wanted: frozenset[str] | None) -> DataFrame:
    """(term, n documents) over the texts of `df`; with `wanted`, of these terms only, and of their neighbours."""
    held = df.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter[str] = Counter()
            for text in batch.column(0).to_pylist():
                folded = fold(text or "")
                terms = _terms(folded)
                seen.update(terms if held.value is None else terms & held.value)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["term", "n"])

    return df.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def _phrases(df: DataFrame, terms: frozenset[str]) -> DataFrame:
    """(phrase, label, n documents) of two words of which one has a lexicon term."""
    held = df.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter[tuple[str, int]] = Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                w = fold(text or "").split()
                hit = {x for x in set(w) if f" {x} " in held.value or any(f" {x[:k]}" in held.value for k in PREFIX_LENGTHS)}
                seen.update({(f"{a} {b}", label) for a, b in zip(w, w[1:], strict=False) if a in hit or b in hit})
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.int64()), pa.array(list(seen.values()), pa.int64())],
                names=["phrase", "label", "n"],
            )

    return df.select("text", "label").mapInArrow(run, "phrase string, label long, n long").groupBy("phrase", "label").agg(F.sum("n").alias("n"))


def choose(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int, least: float) -> dict[str, float]:
    """Terms by smoothed log-odds; a longer term that a chosen beginning covers as well is left out."""
    odds = {t: float(np.log((n + 0.5) / (n_toxic + 1)) - np.log((clean.get(t, 0) + 0.5) / (n_clean + 1))) for t, n in toxic.items()}
    out: dict[str, float] = {}
    for term in sorted((t for t, w in odds.items() if w >= least), key=lambda t: (len(t), t)):
        if not any(out.get(term[:k], -1e9) >= odds[term] - 0.7 for k in range(len(term) - 1, 3, -1)):
            out[term] = odds[term]
    return out


def fit(df: DataFrame, min_documents: int = 5, least_odds: float = 2.5, seeds: tuple[str, ...] = SEEDS, exceptions: tuple[str, ...] = EXCEPTIONS) -> ToxicityModel:
    """Learn from `text` and `label` of rows whose number the caller bounds.

    The driver gets the terms that are in `min_documents` toxic documents at least, the exception phrases, and four
    numbers for each labelled row; all of them are bounded by the labelled rows, and none is cut.
    """
    rows = common.materialise(df.where(F.col("label").isin(0, 1)).select("text", "label"), "toxic")
    size = {int(r["label"]): r["count"] for r in rows.groupBy("label").count().collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    frequent = _counts(rows.where("label = 1"), None).where(F.col("n") >= min_documents)
    toxic = {r["term"]: r["n"] for r in frequent.collect()}
    clean = {r["term"]: r["n"] for r in _counts(rows.where("label = 0"), frozenset(toxic)).collect()} if toxic else {}
    weights = choose(toxic, clean, n1, n0, least_odds)
    for w in seeds:
        if not any(f" {w} "[: k + 1] in weights for k in range(4, len(w) + 2)):
            known = clean.get(f" {w} ", 0)
            weights[f" {w} "] = max(0.1, SEED_WEIGHT - np.log1p(known))
    learnt = ()
    if n0 and weights:
        counted = _phrases(rows, frozenset(weights)).groupBy("phrase").agg(F.coalesce(F.sum(F.expr("n * int(label = 0)")), F.lit(0)).alias("clean"), F.coalesce(F.sum(F.expr("n * int(label = 1)")), F.lit(0)).alias("toxic"))
        learnt = tuple(r["phrase"] for r in counted.where("clean >= 3 and toxic = 0").orderBy("phrase").collect())
    model = ToxicityModel(weights, tuple(dict.fromkeys([*exceptions, *learnt])))
    if not n1 or not n0:
        return model
    held = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [held.value.features(t or "") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(pa.array([r[k] for r in x], pa.float64()) for k in range(3)), batch.column(1).cast(pa.int64())], names=["a", "b", "c", "label"])

    got = rows.mapInArrow(run, "a double, b double, c double, label long").toPandas().sort_values(["a", "b", "c", "label"])
    x = np.column_stack([np.ones(len(got)), got[["a", "b", "c"]].to_numpy()])
    y = got["label"].to_numpy(dtype=float)
    beta = np.array([-2.0, 0.1, 0.1, 0.1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip((x * beta).sum(1), -30, 30)))
        ridge = np.diag([1e-3, 0.3, 0.3, 0.3])
        step = np.linalg.solve(np.einsum("ni,nj,n->ij", x, x, p * (1 - p) + 1e-9) + ridge, (x * (y - p)[:, None]).sum(0) - np.diag(ridge) * beta)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return ToxicityModel(model.weights, model.exceptions, tuple(map(float, beta)))


def score_toxicity(df: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score") -> DataFrame:
    """Adds the score to all columns but the text, which isn't returned; replaces a column of that name."""
    spark = df.sparkSession
    common.bound_batches(spark)
    held = spark.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c != text and c.lower() != score.lower()]
    schema = df.select(*kept).schema.add(score, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        b = m.beta
        for batch in batches:
            x = np.array([m.features(t or "") for t in batch.column(0).to_pylist()]).reshape(-1, 3)
            p = 1 / (1 + np.exp(-np.clip(b[0] + (x * np.array(b[1:])).sum(1), -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(p)], names=[*kept, score])

    return df.select(F.col(text).alias("__text"), *kept).mapInArrow(run, schema)


def op1_toxicity(spark: SparkSession, sf_dir: str, max_labelled: int = 30_000) -> DataFrame:
    common.bound_batches(spark)
    model = fit(common.labelled(spark, sf_dir, "toxic", max_labelled))
    out = score_toxicity(common.table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    return out.select("doc_id", (common.remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
