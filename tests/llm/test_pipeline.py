import corpus_pipeline
from quarry.llm import common, decontam, jaccard

SF = "/root/testdata/sf0.001"


def test_stages(spark, monkeypatch):
    """Each stage keeps its contract on what the one before it kept."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_jaccard_join", "decontamination", "best_fit_packing"]
    seen, write = [common.table(spark, SF, "documents")], common.materialise

    def spy(df, label="step"):
        out = write(df, label)
        if label.startswith("pipeline-"):
            seen.append(out)
        return out

    monkeypatch.setattr(common, "materialise", spy)
    packed = corpus_pipeline.run(spark, SF)
    assert len(seen) == 6 and packed.count() == seen[5].count()
    for a, b in zip(seen, seen[1:-1], strict=False):
        assert a.schema.simpleString() == b.schema.simpleString()
        assert b.join(a, "doc_id", "left_anti").count() == 0
    components = jaccard.join(seen[2]).toPandas().set_index("doc_id")["component_id"]
    assert sorted(r[0] for r in seen[3].select("doc_id").collect()) == sorted(set(components))
    found = {r[0] for r in decontam.op4_decontamination(spark, SF).select("doc_id").collect()}
    assert found and not found & {r[0] for r in seen[4].select("doc_id").collect()}
    assert {r[0] for r in seen[5].select("doc_id").distinct().collect()} == {r[0] for r in seen[4].select("doc_id").collect()}
