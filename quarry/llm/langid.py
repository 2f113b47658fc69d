"""Language identification: multinomial naive Bayes over hashed character n-grams.

Fitting counts 1- to 3-grams of letters by language in one pass with partial sums; the model is a matrix of
log-probabilities with `buckets` rows and a column for each learnt language, so its size does not depend on the
corpus. Scoring gathers matrix rows for all n-grams of a batch and adds them up by document.

Null text, and text without a letter, is `und` with score 0. Ties go to the language first in alphabetical order.
Whole texts are scored, however long; repeated rows are scored alike; other input columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import common

UNKNOWN = "und"
ORDERS = 3


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    log_prior: np.ndarray
    log_prob: np.ndarray  # buckets x languages, float32

    @property
    def buckets(self) -> int:
        return len(self.log_prob)


@cache
def _folding() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: its lower case, white space for all that is no letter; and whether it is a letter."""
    every = [chr(i) for i in range(0x110000)]
    letter = np.fromiter((c.isalpha() for c in every), bool, len(every))
    lower = np.full(len(every), 32, np.uint32)
    for i in np.flatnonzero(letter):
        low = every[i].lower()
        lower[i] = ord(low) if len(low) == 1 else i
    return lower, letter


def grams(data: np.ndarray, bounds: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the documents, the documents they are from, and the number of letters of each."""
    n = len(bounds) - 1
    lower, letter = _folding()
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[bounds]
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    if len(points) != starts[-1]:  # only for malformed UTF-8: keep to the document's bounds
        points = np.concatenate([np.resize(np.frombuffer(data[a:b].tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32), c) if c else np.zeros(0, np.uint32) for a, b, c in zip(bounds[:-1], bounds[1:], np.diff(starts))])
    doc = np.repeat(np.arange(n), np.diff(starts))
    letters = np.bincount(doc[letter[points]], minlength=n)
    low = lower[points]
    found, docs = [], []
    code = np.zeros(len(low), np.uint32)
    for k in range(ORDERS):
        m = len(low) - k
        if m <= 0:
            break
        code = (code[:m] * np.uint32(0x01000193)) ^ (low[k:] * np.uint32(0x9E3779B1) + np.uint32(k + 1))
        keep = (doc[:m] == doc[k:]) & (low[:m] != 32) if k == 0 else (doc[:m] == doc[k:]) & ((low[:m] != 32) | (low[k:] != 32))
        h = code[keep]
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        found.append((h >> np.uint32(7)) % np.uint32(buckets))
        docs.append(doc[:m][keep])
    if not found:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), letters
    return np.concatenate(found), np.concatenate(docs), letters


def fit(df: DataFrame, text: str = "text", lang: str = "lang", buckets: int = 1 << 15, max_rows: int = 40_000, key: str = "doc_id", smoothing: float = 0.5) -> LanguageModel:
    """Learn from rows with a language. At most about `max_rows` are read, chosen by a hash of the key.

    The driver gets languages x buckets counts. Without a row to learn from, the model has no language and
    predicts `und` everywhere.
    """
    known = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    known = common.bounded_sample(known, "key", max_rows, known.select("key").count())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, which = np.unique(np.array(batch.column(1).to_pylist(), dtype=object).astype(str), return_inverse=True)
            data, bounds = common.utf8(batch.column(0))
            total = np.zeros(len(names) * buckets, np.int64)
            for a, b in common.chunks(bounds):
                bucket, doc, _ = grams(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], buckets)
                total += np.bincount(which[a:b][doc] * buckets + bucket, minlength=len(total))
            rows = np.bincount(which, minlength=len(names))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array(np.concatenate([names[at // buckets], names]).tolist(), pa.string()),
                "bucket": pa.array(np.concatenate([at % buckets, np.full(len(names), -1)]).astype(np.int64)),
                "n": pa.array(np.concatenate([total[at], rows]).astype(np.int64)),
            })

    counted = known.select("text", "lang").mapInArrow(common.releasing(count), "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(counted["lang"].unique()))
    place = {x: i for i, x in enumerate(languages)}
    prior, matrix = np.ones(len(languages)), np.full((buckets, len(languages)), smoothing)
    at = counted["lang"].map(place).to_numpy(dtype=np.int64)
    bucket, n = counted["bucket"].to_numpy(np.int64), counted["n"].to_numpy(np.float64)
    prior[at[bucket < 0]] += n[bucket < 0]
    np.add.at(matrix, (bucket[bucket >= 0], at[bucket >= 0]), n[bucket >= 0])
    log_prob = np.log(matrix) - np.log(matrix.sum(0, keepdims=True))
    return LanguageModel(languages, np.log(prior / prior.sum()), log_prob.astype(np.float32))


def score_batch(model: LanguageModel, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the likeliest language (-1: unknown) and its posterior probability."""
    n, k = len(bounds) - 1, len(model.languages)
    best, score = np.full(n, -1), np.zeros(n)
    if not k:
        return best, score
    for a, b in common.chunks(bounds, max(1 << 16, 4 * common.CHUNK_BYTES // max(4, k))):
        bucket, doc, letters = grams(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], model.buckets)
        total = np.stack([np.bincount(doc, weights=model.log_prob[bucket, j], minlength=b - a) for j in range(k)], 1) + model.log_prior
        total -= total.max(1, keepdims=True)
        p = np.exp(total)
        p /= p.sum(1, keepdims=True)
        best[a:b] = np.where(letters > 0, p.argmax(1), -1)
        score[a:b] = np.where(letters > 0, p.max(1), 0.0)
    return best, score


def identify(df: DataFrame, model: LanguageModel, text: str = "text", prediction: str = "lang_pred", score: str = "score") -> DataFrame:
    """Adds the predicted language and its probability; replaces columns of these names."""
    spark = df.sparkSession
    common.bound_batches(spark)
    held = spark.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c.lower() not in (prediction.lower(), score.lower())]
    if text not in kept:
        raise ValueError(f"{text} can't be both input and output")
    schema = df.select(*kept).schema.add(prediction, "string").add(score, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        names = [*m.languages, UNKNOWN]
        for batch in batches:
            best, p = score_batch(m, *common.utf8(batch.column(kept.index(text))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([names[i] for i in best], pa.string()), pa.array(p)], names=[*kept, prediction, score])

    return df.select(*kept).mapInArrow(common.releasing(run), schema)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    common.bound_batches(spark)
    model = fit(docs.where(common.remainder(F.col("doc_id"), 3) != 1).select("doc_id", "text", "lang"))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (common.remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


def stage_language_id(spark: SparkSession, docs: DataFrame, sf_dir: str, least: float = 0.5) -> DataFrame:
    """Keeps documents with a recognised language: not `und`, and with a posterior of at least `least`.

    Null texts and those without a letter go; equal rows go or stay together; null languages are not learnt from, and
    without any to learn from no document is recognised. An empty table stays empty.
    """
    common.bound_batches(spark)
    model = fit(docs.select("doc_id", "text", "lang"))
    columns = docs.columns
    marked = identify(docs, model, prediction="_lang_pred", score="_lang_score")
    return marked.where((F.col("_lang_pred") != UNKNOWN) & (F.col("_lang_score") >= least)).select(*columns)
