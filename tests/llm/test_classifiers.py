import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import common, langid, quality, toxicity

SF = "/root/testdata/sf0.01"


def held(i, m, k):
    return zlib.crc32(str(i).encode()) % m == k


def test_remainder(spark):
    got = spark.range(50).select("id", common.remainder(F.col("id"), 5).alias("r")).collect()
    assert all(r["r"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in got)


@pytest.mark.parametrize(("query", "column", "least"), [(toxicity.op1_toxicity, "toxic", 0.9), (quality.op2_quality, "quality", 0.9)])
def test_held_out_accuracy(spark, query, column, least):
    out = query(spark, SF).toPandas()
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert out["score"].between(0, 1).all() and (out["held_out"] == [held(i, 5, 0) for i in out["doc_id"]]).all()
    both = out.merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    both = both[both["held_out"]]
    assert (both["predicted"] == both[column]).mean() >= least


def test_language_accuracy(spark):
    out = langid.op7_language_id(spark, SF).toPandas().merge(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas(), on="doc_id")
    assert (out["held_out"] == [held(i, 3, 1) for i in out["doc_id"]]).all()
    assert (out[out["held_out"]]["lang_pred"] == out[out["held_out"]]["lang"]).mean() > 0.98


def test_language_matches_brute_force(spark, docs):
    df = docs(["der die das", "the and of", "le la les"]).withColumn("lang", F.element_at(F.array(F.lit("de"), F.lit("en"), F.lit("fr")), (F.col("doc_id") + 1).cast("int")))
    model = langid.fit(df, buckets=1 << 10)
    from quarry.llm.common import utf8
    import pyarrow as pa

    data, bounds = utf8(pa.array(["the der", "la"]))
    bucket, doc, _ = langid.grams(data, bounds, 1 << 10)
    for i in range(2):
        total = model.log_prior + model.log_prob[bucket[doc == i]].sum(0)
        p = np.exp(total - total.max())
        best, score = langid.score_batch(model, data, bounds)
        assert best[i] == p.argmax() and score[i] == pytest.approx(p.max() / p.sum(), rel=1e-4)


def plain_statistics(text):
    """The features of a text, counted one by one."""
    import re

    raw = text.encode()
    words = [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    length = [len(w.encode()) for w in words]
    upper, lower = (sum(a <= b <= z for b in raw) for a, z in ((65, 90), (97, 122)))
    of = lambda chars: sum(b in chars for b in raw)
    share = lambda x, n: np.log((x + 0.25) / (n - x + 0.75))
    mean = sum(length) / max(1, len(words))
    spread = max(0.0, sum(n * n for n in length) / max(1, len(words)) - mean**2) ** 0.5
    runs = len({tuple(words[i : i + 3]) for i in range(len(words) - 2)}) if len(words) > 2 else min(1, len(words))
    return [
        np.log1p(len(raw)), np.log1p(len(words)), np.log1p(mean), np.log1p(spread), np.log1p(max(length, default=0)),
        share(upper, upper + lower), share(of(b"0123456789"), len(raw)), share(of(b"#$%&*+/<=>@[\\]^_`{|}~"), len(raw)), share(of(b"!?"), len(raw)), share(of(b".,;:"), len(raw)),
        share(of(b"\n"), len(raw)), share(sum(b > 127 for b in raw), len(raw)), share(sum(n <= 3 for n in length), len(words)), share(len(set(words)), len(words)), share(runs, max(len(words) - 2, 1)),
        share(max((words.count(w) for w in set(words)), default=0), len(words)),
    ]


def test_quality_equals_brute_force(spark, docs, prose):
    """Statistics counted one by one; densities with covariances inverted whole; the calibration's gradient is zero."""
    rng = np.random.default_rng(5)
    texts = ["", None, "One, TWO three!", "é中 a\n\nb 12 <x>", "same same same Same"] + [prose(int(rng.integers(3, 60))) + ("!!! $$$ 123 " * int(rng.integers(0, 9)) if i % 3 == 0 else ".") for i in range(60)]
    labelled = docs(texts).select("text", (F.col("doc_id") % 3 == 0).cast("int").alias("label"))
    model = quality.fit(labelled)
    x = np.array([plain_statistics(t or "") for t in texts])
    y = np.array([int(i % 3 == 0) for i in range(len(texts))])
    z = (x - x.mean(0)) / (x.std(0) + 1e-6)
    k = x.shape[1]
    own = [np.cov(z[y == c].T, bias=True) for c in (0, 1)]
    pooled = sum(own[c] * (y == c).mean() for c in (0, 1))
    raw = np.zeros(len(z))
    for c, sign in ((0, -1), (1, 1)):
        s = 0.75 * own[c] + 0.2 * pooled + 0.05 * (np.trace(own[c]) / k + 0.1) * np.eye(k)
        d = z - z[y == c].mean(0)
        raw += sign * (-0.5 * (d @ np.linalg.inv(s) * d).sum(1) - 0.5 * np.linalg.slogdet(s)[1])
    d = np.sign(raw) * np.log1p(np.abs(raw))
    want = 1 / (1 + np.exp(-(model.slope * d + model.intercept)))
    got = [r["score"] for r in quality.classify(docs(texts), model).orderBy("doc_id").collect()]
    assert got == pytest.approx(want.tolist(), abs=1e-6)
    beta = np.array([model.slope, model.intercept])
    gradient = np.stack([d, np.ones(len(d))], 1).T @ (y - want) - 1e-3 * beta
    assert np.abs(gradient).max() < 1e-3


def test_odd_texts(spark, odd, docs, prose):
    df = docs([prose(30) for _ in range(6)])
    model = langid.fit(df)
    got = langid.identify(odd.withColumn("score", F.lit("clash")), model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in got[:4]] == ["und", "und", "und", "en"] and got[0]["score"] == 0.0 and got[6]["score"] == got[7]["score"]
    assert langid.identify(odd, langid.fit(df.limit(0))).where("lang_pred <> 'und'").count() == 0
    assert langid.identify(df.limit(0), model).count() == 0
    labelled = df.selectExpr("text", "cast(doc_id % 2 as int) label")
    q = quality.fit(labelled)
    scores = quality.classify(odd, q).orderBy("doc_id").collect()
    assert all(0 <= r["score"] <= 1 for r in scores) and scores[0]["score"] == scores[1]["score"] and scores[6]["score"] == scores[7]["score"]
    assert quality.classify(odd, quality.fit(labelled.where("label = 1"))).select("score").distinct().count() == 1
    assert quality.classify(odd, quality.fit(labelled.limit(0))).first()["score"] == pytest.approx(0.5)
    t = toxicity.fit(labelled.limit(0))
    got = toxicity.score_toxicity(odd, t).orderBy("doc_id").collect()
    assert got[0]["score"] == got[1]["score"] and len(got) == 8


def test_folding_and_exceptions():
    model = toxicity.ToxicityModel({" idiot ": 2.0, " vequ": 1.0}, ("trash can", "clown fish", "idiot box"))
    hit = lambda t: model.features(t)[2] == 1.0
    assert hit("an IDIOT") and hit("an 1d10t!") and hit("аn іdiоt") and hit("ｉｄｉｏｔ") and hit("idïot") and hit("vequoir")
    assert not hit("idiotic") and not hit("the idiot box") and not hit("") and not hit("invequ")
    assert model.features("idiot")[1] > model.features("idiot " + "fine " * 500)[1]


def test_matching_equals_brute_force():
    rng = np.random.default_rng(5)
    words = ["ab", "abc", "abcdef", "abcd", "dog", "trash", "can", "pond", "scum"]
    model = toxicity.ToxicityModel({" abc ": 1.0, " abcd": 2.0, " abcdef ": 0.5, " scum ": 3.0, " trash": 1.5}, ("trash can", "pond scum", "scum dog", "can abc"))
    for n in [0, 1, 2, 3, *rng.integers(4, 60, 200)]:
        text = " ".join(rng.choice(words, n))
        folded, best = toxicity.fold(text), {}
        for term, weight in model.weights.items():
            for i in range(len(folded)):
                if folded.startswith(term, i):
                    best[i] = max(weight, best.get(i, 0.0))
        spans = [(i, i + len(e) + 1) for e in model.exceptions for i in range(len(folded)) if folded.startswith(f" {e} ", i)]
        total = sum(w for i, w in best.items() if not any(a <= i < b for a, b in spans))
        assert model.features(text)[0] == pytest.approx(np.log1p(total))


def test_very_many_exceptions_take_linear_time():
    model = toxicity.ToxicityModel({" scum ": 3.0}, ("pond scum",))
    assert model.features("pond scum " * 100_000)[2] == 0.0 and model.features("pond scum " * 100_000 + "scum")[2] == 1.0


def test_classifiers_on_empty_tables_and_clashing_names(spark, odd, docs, prose):
    labelled = docs([prose(30) for _ in range(6)]).selectExpr("text", "cast(doc_id % 2 as int) label")
    t, q = toxicity.fit(labelled, min_documents=1), quality.fit(labelled)
    clash = odd.withColumn("Score", F.lit("clash")).withColumn("label", F.lit(None).cast("int"))
    for run in (lambda df: toxicity.score_toxicity(df, t), lambda df: quality.classify(df, q)):
        assert run(odd.limit(0)).count() == 0
        out = run(clash)
        assert [c.lower() for c in out.columns].count("score") == 1 and dict(out.dtypes)["score"] == "double"
        assert out.count() == odd.count() and out.where("score is null or score < 0 or score > 1").count() == 0


def test_learnt_terms_and_exceptions(spark):
    rows = [("a plain day with grumpf in it", 1)] * 30 + [("a plain day with a grumpf tree in it", 0)] * 5 + [("a plain day with rain in it", 0)] * 60
    model = toxicity.fit(spark.createDataFrame(rows, "text string, label int"), min_documents=3, least_odds=1.0)
    out = toxicity.score_toxicity(spark.createDataFrame([(1, "a day with grumpf"), (2, "a day with a grumpf tree"), (3, "a day with rain")], "doc_id long, text string"), model)
    got = {r["doc_id"]: r["score"] for r in out.collect()}
    assert got[1] > 0.5 > got[2] and got[3] < 0.5


def test_stage_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = langid.stage_language_id(spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() >= 0.99 * docs.count()
