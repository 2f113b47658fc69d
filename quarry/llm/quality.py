"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class has a mean and a covariance shrunk towards the pooled one and towards its own scaled identity. The score
is a calibrated difference of the classes' log-densities; the model caches the inverse of each Cholesky factor, so
that a density takes one small product for each document.

Null text counts as empty; an empty text has the statistics of no words, and a score like any other. Whole texts
count. With labels of one class only, that class's share (smoothed) is every document's score. Repeated rows score
alike, and columns other than the text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import common

FEATURES = (
    "bytes", "words", "word_length", "word_spread", "longest_word", "upper", "digits", "symbols", "marks", "stops",
    "newlines", "other", "short_words", "distinct_words", "distinct_runs", "commonest_word",
)

_kinds = np.zeros(256, np.uint8)  # 0: other ASCII
_kinds[97:123] = 1
_kinds[65:91] = 2
_kinds[48:58] = 3
_kinds[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 4
_kinds[[ord(c) for c in "!?"]] = 5
_kinds[[ord(c) for c in ".,;:"]] = 6
_kinds[10] = 7
_kinds[128:] = 8


@dataclass(frozen=True)
class QualityModel:
    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray  # class x feature
    factors: np.ndarray  # class x feature x feature, inverses of the lower Cholesky factors
    log_dets: np.ndarray
    slope: float
    intercept: float


def statistics(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each document: logarithms of sizes, log-odds of shares."""
    n = len(bounds) - 1
    out = np.zeros((n, len(FEATURES)))
    for a, b in common.chunks(bounds):
        part, edge = data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
        size = np.diff(edge).astype(float)
        doc = np.repeat(np.arange(b - a), np.diff(edge))
        kind = np.bincount(doc * 9 + _kinds[part], minlength=9 * (b - a)).reshape(-1, 9).astype(float)
        value, of, start, end = common.words(part, edge)
        length = (end - start).astype(float)
        count = np.bincount(of, minlength=b - a).astype(float)
        some = np.maximum(count, 1)
        mean = np.bincount(of, weights=length, minlength=b - a) / some
        spread = np.sqrt(np.maximum(np.bincount(of, weights=length**2, minlength=b - a) / some - mean**2, 0))
        longest, distinct, runs, common_word = (np.zeros(b - a) for _ in range(4))
        np.maximum.at(longest, of, length)
        first = np.searchsorted(of, np.arange(b - a + 1))
        for i in range(b - a):
            w = value[first[i] : first[i + 1]]
            if len(w):
                _, each = np.unique(w, return_counts=True)
                distinct[i], common_word[i] = len(each), each.max()
                runs[i] = len(np.unique(w[:-2] + w[1:-1] * np.uint64(3) + w[2:] * np.uint64(7))) if len(w) > 2 else 1
        share = lambda x, of: np.log((x + 0.25) / (of - x + 0.75))
        letters = kind[:, 1] + kind[:, 2]
        short = np.bincount(of, weights=length <= 3, minlength=b - a)
        out[a:b] = np.stack([
            np.log1p(size), np.log1p(count), np.log1p(mean), np.log1p(spread), np.log1p(longest),
            share(kind[:, 2], letters), share(kind[:, 3], size), share(kind[:, 4], size), share(kind[:, 5], size), share(kind[:, 6], size),
            share(kind[:, 7], size), share(kind[:, 8], size), share(short, count), share(distinct, count), share(runs, np.maximum(count - 2, 1)), share(common_word, count),
        ], 1)
    return np.nan_to_num(out)


def with_statistics(df: DataFrame, kept: list[str], text: str = "text") -> DataFrame:
    schema = ", ".join(f"`{c}` {t}" for c, t in df.select(*kept).dtypes) + ", features array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(*common.utf8(batch.column(0)))
            features = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], features], names=[*kept, "features"])

    return df.select(F.col(text).alias("__text"), *kept).mapInArrow(run, schema)


def discriminant(model: QualityModel, x: np.ndarray) -> np.ndarray:
    """log-density of class 1 less that of class 0."""
    z = (x - model.centre) / model.scale
    density = []
    for mean, factor, log_det in zip(model.means, model.factors, model.log_dets, strict=True):
        white = np.einsum("ij,nj->ni", factor, z - mean)
        density.append(-0.5 * (white**2).sum(1) - 0.5 * log_det)
    return density[1] - density[0]


def predict(model: QualityModel, x: np.ndarray) -> np.ndarray:
    if not len(x):
        return np.zeros(0)
    d = np.sign(raw := discriminant(model, x)) * np.log1p(np.abs(raw)) if model.slope else np.zeros(len(x))
    return 1 / (1 + np.exp(-np.clip(model.slope * d + model.intercept, -30, 30)))


def learn(x: np.ndarray, y: np.ndarray, to_pooled: float = 0.2, to_identity: float = 0.05) -> QualityModel:
    """Means, shrunk covariances and, by Newton steps, a logistic calibration of the discriminant."""
    k = len(FEATURES)
    centre, scale = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(k), np.ones(k))
    share = (y.sum() + 1) / (len(y) + 2)
    if len(np.unique(y)) < 2:
        eye = np.stack([np.eye(k)] * 2)
        return QualityModel(centre, scale, np.zeros((2, k)), eye, np.zeros(2), 0.0, float(np.log(share / (1 - share))))
    z = (x - centre) / scale
    means = np.stack([z[y == c].mean(0) for c in (0, 1)])
    own = [np.einsum("ni,nj->ij", d := z[y == c] - means[c], d) / len(d) if (y == c).sum() > 1 else np.eye(k) for c in (0, 1)]
    pooled = sum(s * (y == c).mean() for c, s in enumerate(own))
    factors = []
    for s in own:
        s = (1 - to_pooled - to_identity) * s + to_pooled * pooled + to_identity * (np.trace(s) / k + 0.1) * np.eye(k)
        factors.append(np.linalg.cholesky(s))
    log_dets = 2 * np.log(np.diagonal(np.stack(factors), axis1=1, axis2=2)).sum(1)
    factors = np.stack([np.linalg.inv(f) for f in factors])
    bare = QualityModel(centre, scale, means, factors, log_dets, 1.0, 0.0)
    raw = discriminant(bare, x)
    d = np.sign(raw) * np.log1p(np.abs(raw))
    a = np.stack([d, np.ones(len(d))], 1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip((a * beta).sum(1), -30, 30)))
        w = p * (1 - p) + 1e-9
        step = np.linalg.solve(np.einsum("ni,nj,n->ij", a, a, w) + 1e-3 * np.eye(2), (a * (y - p)[:, None]).sum(0) - 1e-3 * beta)
        beta = beta + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return QualityModel(centre, scale, means, factors, log_dets, float(beta[0]), float(beta[1]))


def fit(df: DataFrame, text: str = "text", label: str = "label") -> QualityModel:
    """Learn from labelled rows; the caller bounds their number, since the driver gets a row of statistics for each."""
    rows = with_statistics(df.where(F.col(label).isin(0, 1)), [label], text).toPandas()
    x = np.array(rows["features"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    order = np.lexsort([*x.T, rows[label].to_numpy(dtype=int)])  # sums in a fixed order: the same model on every run
    return learn(x[order], rows[label].to_numpy(dtype=int)[order])


def classify(df: DataFrame, model: QualityModel, text: str = "text", score: str = "score") -> DataFrame:
    """Adds the score of class 1 to all columns but the text, which isn't returned; replaces a column of that name."""
    spark = df.sparkSession
    common.bound_batches(spark)
    held = spark.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c not in (text,) and c.lower() != score.lower()]
    schema = df.select(*kept).schema.add(score, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = predict(held.value, statistics(*common.utf8(batch.column(0))))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(p)], names=[*kept, score])

    return df.select(F.col(text).alias("__text"), *kept).mapInArrow(run, schema)


def op2_quality(spark: SparkSession, sf_dir: str, max_labelled: int = 30_000) -> DataFrame:
    common.bound_batches(spark)
    model = fit(common.labelled(spark, sf_dir, "quality", max_labelled))
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = classify(docs, model)
    return out.select("doc_id", (common.remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
