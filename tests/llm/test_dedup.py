import math
import random
import re
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import decontam, embeddings, graph, jaccard, linededup
from quarry.llm.registry import ORACLE_SQL

SF = "/root/testdata/sf0.01"


def union_find(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, i) for i in range(6000, 6100)] + [(9, 9)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == union_find({x for e in edges for x in e}, edges)


def test_no_edges(spark):
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_jaccard(ids, texts):
    s = [shingles(t) for t in texts]
    edges = [(ids[i], ids[j]) for i in range(len(s)) for j in range(i) if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 75 * len(s[i] | s[j])]
    return union_find(ids, edges), [len(x) for x in s]


def test_jaccard_equals_brute_force(spark, docs, prose):
    rng = random.Random(3)
    texts = [None, "", " \n ", "One two", "one TWO", "one two three", "a b c d e"]
    shared = prose(30)
    for _ in range(12):
        base = prose(rng.randrange(5, 60)).split()
        texts.append(" ".join(base))
        for _ in range(rng.randrange(0, 12)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = "x"
            texts.append(" ".join(copy))
    texts += [f"{shared} {prose(5)}" for _ in range(20)] + [f"{shared} {prose(60)}" for _ in range(20)]
    for block in (1 << 20, 400):  # regions of one block, and of many
        out = jaccard.join(docs(texts).withColumn("n_shingles", F.lit("clash")), block=block).orderBy("doc_id").collect()
        want, sizes = brute_jaccard(list(range(len(texts))), texts)
        assert [r["component_id"] for r in out] == [want[i] for i in range(len(texts))]
        assert [r["n_shingles"] for r in out] == sizes


def near_copies(prose, n):
    """Copies of one text of which many differ in 0 to 9 % of their words: few of all pairs link, and one component is large."""
    rng = random.Random(11)
    base = prose(240).split()
    out = []
    for _ in range(n):
        share = rng.choice([0.01, 0.02, 0.03, 0.05, 0.07, 0.09])
        out.append(" ".join(w + str(rng.randrange(3)) if rng.random() < share else w for w in base))
    return out


def test_jaccard_windows_do_not_multiply_near_copies(spark, docs, prose, monkeypatch):
    """Among near copies of one text nearly all are in all windows: they are not sent once for each, round after round."""
    texts = near_copies(prose, 160)
    sent, write = [], jaccard.common.materialise

    def seen(df, label="step"):
        out = write(df, label)
        if label == "jaccard-spots":
            sent.append(out.agg(F.coalesce(F.sum(F.size("at")), F.lit(0))).first()[0])
        return out

    monkeypatch.setattr(jaccard.common, "materialise", seen)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join(docs(texts), block=12_000).collect()}
    want, _ = brute_jaccard(list(range(len(texts))), texts)
    assert got == want
    assert 20 < len(set(want.values())) < 140
    assert sum(sent) < 12 * len(texts)


def test_jaccard_in_memory_leaves_out_what_is_mostly_alone(prose, monkeypatch):
    """Copies of equal length with a fifth of shingles that no other has can't link: only pivots are compared."""
    base = prose(240).split()
    members = [*jaccard.sets(*jaccard.common.utf8(pa.array([" ".join(f"x{i}y{k}" if k % 24 == 12 else w for k, w in enumerate(base)) for i in range(160)])), 5)]
    compared, measure = [], jaccard.Joined.measure
    monkeypatch.setattr(jaccard.Joined, "measure", lambda self, x, among: compared.append(len(among)) or measure(self, x, among))
    found = jaccard.Joined(members, np.arange(len(members)), 75)
    found.visit(np.arange(len(members)))
    assert len(set(found.label.tolist())) == len(members)
    assert sum(compared) <= 8 * len(members)


def test_jaccard_threshold_is_exact(spark, docs):
    texts, want = [], []
    for cut in (12, 13, 14, 15):  # of 96 runs of words, 96 - cut are shared
        w = [f"w{cut}x{i}" for i in range(100)]
        texts += [" ".join(w), " ".join(w[:-cut] + [f"v{cut}x{i}" for i in range(cut)])]
        s, t = map(shingles, texts[-2:])
        want.append(100 * len(s & t) >= 75 * len(s | t))
    got = [r["component_id"] for r in jaccard.join(docs(texts)).orderBy("doc_id").collect()]
    assert [got[2 * k] == got[2 * k + 1] for k in range(4)] == want and True in want and False in want


def test_jaccard_links_sets_whose_short_hashes_collide(spark, docs):
    """Two sets of different first pivots, whose 64-bit keys have equal 32-bit hashes."""
    before, after = (" ".join(f"{c}{i}" for i in range(20)) for c in "ab")
    texts = [f"{before} x{i} {after}" for i in (220929, 230736)]
    keys = [(jaccard.set_key(s),) for s in jaccard.sets(*jaccard.common.utf8(pa.array(texts)), 5)]
    assert len(set(keys)) == 2 and spark.createDataFrame(keys, "k long").select(F.hash("k")).distinct().count() == 1
    assert [r["component_id"] for r in jaccard.join(docs(texts)).collect()] == [0, 0]


def test_jaccard_edge_rows(spark, docs, odd):
    out = {r["doc_id"]: r["component_id"] for r in jaccard.join(odd).collect()}
    assert out == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6}
    assert jaccard.join(docs([]).limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "a b c d e f"), (1, "q r s t u v"), (2, "q r s t u v"), (None, "a b c d e f"), (5, None)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in jaccard.join(twice).collect())
    assert got == [(0, 0), (1, 1), (1, 1), (2, 1), (5, 5)]


def test_jaccard_stage(spark, docs, prose):
    a, b = prose(40), prose(40)
    df = docs([a, b, a, b + " x", "", None])
    kept = jaccard.stage_jaccard_join(spark, df, SF)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 4, 5]
    assert jaccard.stage_jaccard_join(spark, df.limit(0), SF).count() == 0


def test_jaccard_stage_with_repeated_ids(spark, prose):
    """Different texts of one id stay; equal rows, and texts alike, stay once; extra columns and nulls are no trouble."""
    a, b, c = prose(40), prose(40), prose(40)
    rows = [(1, a), (1, a), (1, b), (2, a + " x"), (2, c), (None, a), (None, None), (3, None), (3, None), (4, c), (5, "")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, node string, n long")
    kept = jaccard.stage_jaccard_join(spark, df, SF)
    got = sorted(((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()))
    assert kept.columns == df.columns and got == sorted([(1, a), (1, b), (2, c), (0, a), (0, ""), (3, ""), (3, ""), (5, "")])


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute_cosine(rows, least=0.98):
    x = [np.array(v, float) if v and all(c is not None and np.isfinite(c) for c in v) and any(v) and lab is not None else None for _, v, lab in rows]
    x = [v / np.sqrt((v * v).sum()) if v is not None else None for v in x]
    edges = [(i, j) for i in range(len(x)) for j in range(i) if x[i] is not None and x[j] is not None and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]) and (x[i] * x[j]).sum() >= least]
    n = np.zeros(len(x), int)
    for i, j in edges:
        n[i] += 1
        n[j] += 1
    comp = union_find(list(range(len(rows))), edges)
    low = {}
    for i, c in comp.items():
        low[c] = min(low.get(c, rows[i][0]), rows[i][0])
    return sorted((rows[i][0], int(n[i]), low[comp[i]]) for i in range(len(rows)))


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for c in range(8):
        centre = rng.standard_normal(16)
        for _ in range(12):
            rows.append((len(rows), np.float32(centre + rng.standard_normal(16) * rng.choice([0.02, 0.1, 0.2])).tolist(), c % 3))
    rows += [(200, rows[0][1], 0), (201, rows[0][1], 0), (202, rows[0][1], 1), (203, None, 0), (204, [0.0] * 16, 0), (205, [float("nan")] + [1.0] * 15, 0), (206, rows[0][1], None), (207, [1.0, None] + [1.0] * 14, 0), (208, [], 0), (209, [float("inf")] * 16, 0), (210, [2 * x for x in rows[0][1]], 0), (211, [1.0, 2.0], 0), (212, [1.0, 2.0], 0)]
    for block in (5, 1000):
        out = embeddings.link(vectors(spark, rows).withColumn("n", F.lit("clash")), block=block, tables=40)
        assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in out.collect()) == brute_cosine(rows)
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out.collect())


def test_embeddings_of_very_large_and_small_numbers(spark):
    rows = [(1, [1.0, 2.0], 0), (2, [1e200, 2e200], 0), (3, [1e-200, 2e-200], 0), (4, [1e308, 1.7e308], 0), (5, [2e-200, -1e-200], 0), (6, [5e-324, 0.0], 0), (7, [9.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.link(df).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (0, 5), 6: (1, 6), 7: (1, 6)}


def test_recall_of_the_shipped_tables(spark):
    """1,000 pairs at cosines just above the threshold, among others just below it: what the default settings find."""
    rng, rows, want = np.random.default_rng(11), [], 0
    for i in range(1200):
        a = rng.standard_normal(32)
        b = rng.standard_normal(32)
        a, b = a / np.linalg.norm(a), b - b @ a / (a @ a) * a
        c = rng.uniform(0.9801, 0.985) if i < 1000 else rng.uniform(0.97, 0.9799)
        want += i < 1000
        rows += [(2 * i, a.tolist(), 0), (2 * i + 1, (c * a + math.sqrt(1 - c * c) * b / np.linalg.norm(b)).tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in embeddings.link(df).collect()}
    assert sum(got[2 * i] for i in range(1000)) >= 0.999 * want and not sum(got[2 * i] for i in range(1000, 1200))


def test_embeddings_of_equal_ids_and_none(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [0.0, 1.0], 0)]
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in embeddings.link(vectors(spark, rows)).collect()) == [(1, 0, 1), (1, 1, 1), (2, 1, 1)]
    assert embeddings.link(vectors(spark, rows).limit(0)).count() == 0


def test_recall_of_tables():
    p = (1 - np.arccos(0.98) / np.pi) ** embeddings.PLANES
    assert 1 - (1 - p) ** embeddings.TABLES > 0.9999


def brute_contained(text, item, length=20, share=0.75):
    words = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    d, b = words(text), words(item)
    n = min(length, len(b))
    return n > 0 and any(sum(x == y for x, y in zip(d[i : i + n], b[j : j + n], strict=True)) >= share * n for j in range(len(b) - n + 1) for i in range(len(d) - n + 1))


def test_decontamination(spark, docs, prose):
    item = prose(40).split()
    swapped = [w if i % 9 else "zzz" for i, w in enumerate(item)]
    texts = [
        " ".join(item), f"{prose(50)} {' '.join(item)} {prose(30)}", f"{prose(10)}. {' '.join(swapped).upper()}!", " ".join(item[5:33]), " ".join(item[:12]) + " " + prose(30), prose(200), None, "", " ".join(item[::-1]),
        f"{' '.join(item)} {prose(5)} {' '.join(swapped)}",
    ]
    items = spark.createDataFrame([(1, " ".join(item)), (2, prose(30)), (3, None), (4, "too short"), (1, " ".join(item))], "item_id long, text string")
    for few in (500_000, 0):  # broadcast, and joined by shuffle
        got = {(r["doc_id"], r["item_id"]): r for r in decontam.find(docs(texts).withColumn("seed", F.lit("clash")), items, broadcast_seeds=few, broadcast_hits=few).collect()}
        assert set(got) == {(i, 1) for i, t in enumerate(texts) if brute_contained(t, " ".join(item))} == {(i, 1) for i in (0, 1, 2, 3, 9)}
    assert (got[1, 1]["matched"], got[1, 1]["doc_pos"], got[1, 1]["item_pos"]) == (20, 50, 0)
    assert decontam.find(docs(texts).limit(0), items).count() == 0 and decontam.find(docs(texts), items.limit(0)).count() == 0


def test_decontamination_misses_no_edited_item(spark, docs, prose):
    """Items of 1 to 30 words, with as many words replaced at random as is accepted, and with one more."""
    rng, texts, items = random.Random(3), [], []
    for n in [*range(1, 31), 10, 12, 15, 17, 20, 20, 20]:
        item = [f"w{len(items)}x{i}" for i in range(n)]
        m = min(n, 20)
        for differ in (m - math.ceil(0.75 * m), m - math.ceil(0.75 * m) + 1):
            for _ in range(4):
                edited, first = list(item), rng.randrange(n - m + 1)
                for i in rng.sample(range(first, first + m), differ):
                    edited[i] = "zzz"
                texts.append(f"{prose(7)} {' '.join(edited[first : first + m])} {prose(9)}")
        items.append(" ".join(item))
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = {(d, i) for d, t in enumerate(texts) for i, item in enumerate(items) if d // 8 == i and brute_contained(t, item)}
    assert len(want) >= 4 * len(items)
    for few in (500_000, 0):
        found = decontam.find(docs(texts), table, broadcast_seeds=few, broadcast_hits=few)
        assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want


def test_decontamination_of_real_tables(spark):
    found = {r["doc_id"] for r in decontam.op4_decontamination(spark, SF).select("doc_id").collect()}
    d, b = (spark.read.parquet(f"{SF}/{t}.parquet").toPandas() for t in ("documents", "benchmark"))
    norm = lambda t: " ".join(w for w in re.split(r"[\W_]+", t.lower()) if w)
    items = [norm(t) for t in b["text"]]
    whole = {i for i, t in zip(d["doc_id"], map(norm, d["text"]), strict=True) if any(x in t for x in items)}
    assert whole <= found and len(found) <= len(whole) + 5


def test_line_dedup_equals_sql(spark):
    import duckdb

    duckdb.sql(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = duckdb.sql(ORACLE_SQL["op9_line_dedup"]).df().sort_values("page_id").reset_index(drop=True)
    got = linededup.op9_line_dedup(spark, SF).toPandas().sort_values("page_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got[sorted(got)], want[sorted(want)], check_dtype=False)


def test_line_dedup_rules(spark):
    rows = [(i, "big", f"menu\nline {i}\n footer \t") for i in range(10)] + [(10, "big", "menu\r\nline 1"), (11, None, "menu\nmenu\nx"), (12, "tiny", "menu"), (13, "big", None), (14, "big", ""), (15, "big", "menu")]
    out = {r["id"]: r for r in linededup.drop_lines(spark.createDataFrame(rows, "id long, h string, text string"), F.col("h"), "text", ratio=0.5, dropped="lost").collect()}
    assert out[0]["text"] == "line 0" and out[0]["lost"] == 2 and out[10]["text"] == "line 1"
    assert out[11]["text"] == "menu\nmenu\nx" and out[12]["text"] == "menu" and out[13]["text"] is None and out[15]["text"] == "" and len(out) == 16
    exact = [(i, "h", "half" if i % 2 else f"own {i}") for i in range(10)]
    kept = linededup.drop_lines(spark.createDataFrame(exact, "id long, h string, text string"), F.col("h"), "text", ratio=0.5)
    assert kept.where("text = 'half'").count() == 5  # a share equal to the ratio is kept
    assert linededup.drop_lines(kept.limit(0), F.col("h"), "text").count() == 0


def test_line_dedup_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = linededup.stage_line_dedup(spark, docs, SF)
    assert out.schema.simpleString() == docs.schema.simpleString() and out.count() == docs.count()


def test_hosts(spark):
    df = spark.createDataFrame([("HTTP://u@A.example:80/x",), ("nothing",), (None,)], "u string")
    assert [r[0] for r in df.select(linededup.host_of(F.col("u"))).collect()] == ["a.example", None, None]


def test_materialised_files_are_in_the_shared_folder(spark, tmp_path, monkeypatch):
    from quarry.llm import common

    assert common.shared_dir(spark) == (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    monkeypatch.setattr(common, "shared_dir", lambda _: f"file://{tmp_path}")
    df = common.materialise(spark.range(3).toDF("x"), f"t{uuid.uuid4().hex[:4]}")
    assert df.count() == 3 and list(tmp_path.glob("quarry/*"))
    common.discard(df)
    assert not list(tmp_path.glob("quarry/*"))


def test_planes_grow_with_the_vectors():
    """Buckets stay small, and the chance that a pair is missed stays what it is."""
    miss = lambda t, b: (1 - (1 - math.acos(0.98) / math.pi) ** b) ** t
    assert embeddings.sized(0, 0.98) == embeddings.sized(1 << 20, 0.98) == (30, 18)
    for n in (1 << 21, 10**9, 10**11):
        tables, bits = embeddings.sized(n, 0.98)
        assert n / 2**bits <= 4 and miss(tables, bits) <= miss(30, 18)
