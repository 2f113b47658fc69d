"""Each stage of the pipeline, and the whole, on nulls, repeated rows, very long texts, ties and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import common, packing

KIND = "doc_id long, text string, lang string, source string, n_chars long, extra string, row string"
ITEM = "the quick benchmark passage that nobody should ever see inside of any training document at all costs today or tomorrow morning"


def rows(prose):
    """Texts of two languages that letters tell apart, and everything odd."""
    out = []
    for i in range(90):
        lang = "xx" if i % 2 else "yy"
        text = prose(40) if i % 2 else prose(40).translate(str.maketrans("aeiou", "öäüßé"))
        out.append((i, f"{text}\nsign up now\n{prose(8) if i % 2 else ''}", lang, "hot" if i % 3 else None, 1, "e", "r"))
    same = prose(50)
    out += [(100 + i, same, "xx", "hot", 1, None, None) for i in range(3)] + [(100, same, "xx", "hot", 1, None, None)] * 2  # copies, and equal rows
    out += [(200, None, None, None, None, None, None), (201, "", "xx", "hot", 0, None, None), (202, " \n ", "xx", "hot", 0, None, None), (None, same + " more of it", "xx", "hot", 1, None, None), (203, "12 34 !", "xx", None, 1, None, None)]
    out += [(300, f"{prose(30)} {ITEM} {prose(30)}", "xx", "hot", 1, None, None), (301, prose(30_000), "xx", "hot", 1, None, None)]
    return out


@pytest.fixture
def tables(spark, prose, monkeypatch):
    found = {"documents": spark.createDataFrame(rows(prose), KIND), "benchmark": spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string")}
    monkeypatch.setattr(common, "table", lambda spark, sf_dir, name: found[name])
    return found


def ids(df):
    return sorted((r[0] for r in df.select("doc_id").collect()), key=str)


def test_stages_on_odd_rows(spark, tables):
    stages, docs = dict(corpus_pipeline.STAGES), tables["documents"]
    kept = common.materialise(stages["language_id"](spark, docs, ""))
    assert kept.schema.simpleString() == docs.schema.simpleString()
    gone = set(ids(docs)) - set(ids(kept))
    assert gone == {200, 201, 202, 203} and ids(kept).count(100) == 3
    lines = common.materialise(stages["line_dedup"](spark, docs, ""))  # of all rows: none goes
    assert lines.columns == docs.columns and ids(lines) == ids(docs)
    got = {r["doc_id"]: r for r in lines.collect()}
    assert got[200]["text"] is None and "sign up now" not in got[1]["text"] and got[1]["n_chars"] == len(got[1]["text"]) and got[201]["text"] == ""
    apart = common.materialise(stages["ngram_jaccard_join"](spark, docs, ""))
    assert apart.columns == docs.columns
    left = ids(apart)
    assert left.count(100) == 1 and 101 not in left and 102 not in left and {200, 201, 202, None} <= set(left)
    clean = common.materialise(stages["decontamination"](spark, docs, ""))
    assert set(ids(docs)) - set(ids(clean)) == {300} and len(ids(clean)) == docs.count() - 1 and clean.columns == docs.columns
    packed = common.materialise(stages["best_fit_packing"](spark, docs, "")).collect()
    coder = packing.tokenizer(packing.default_tokenizer())
    want = sorted(len(coder.encode([r["text"] or ""])[0]) // 4 + 1 for r in docs.collect())
    whole, held = {}, {}
    for p in packed:
        whole.setdefault((p["doc_id"], p["piece"]), 0)
        held.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert sum(p["length"] for p in packed) == sum(want) and len(packed) == sum(-(-n // 1024) for n in want)
    for places in held.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024


def test_run_on_odd_rows(spark, tables):
    got = corpus_pipeline.run(spark, "")
    found = set(ids(got))
    assert {200, 201, 202, 203, 300, 101, 102} & found == set() and {100, 301, None} <= found and got.where("doc_id = 100").count() == 1
    assert set(range(90)) <= found


def test_empty_tables(spark, tables):
    empty = tables["documents"].limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, "")
        assert out.count() == 0 and (name == "best_fit_packing" or out.columns == empty.columns)
    tables["benchmark"] = tables["benchmark"].limit(0)
    docs = tables["documents"].where(F.col("doc_id") >= 100)
    assert dict(corpus_pipeline.STAGES)["decontamination"](spark, docs, "").count() == docs.count()
    tables["documents"] = empty
    assert corpus_pipeline.run(spark, "").count() == 0
