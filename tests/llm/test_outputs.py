"""Prefix trie, token files and Sort-means against brute force and SQL, on odd input too."""

import hashlib
import random
import uuid
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import common, sortmeans, tokenfile, trie
from quarry.llm.packing import default_tokenizer
from quarry.llm.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op13_sort_means"])
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    want = con.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = ", ".join(sorted(got.columns))
    assert sorted(str(tuple(r)) for r in got.select(*sorted(got.columns)).collect()) == sorted(map(str, con.sql(f"SELECT {order} FROM ({ORACLE_SQL[name]})").fetchall()))


def brute_trie(turns):
    """Nodes by the contract, from (conv_id, turn, role, text) without equal turns in a conversation."""
    own = {}
    for c, t, role, text in turns:
        if c is not None:
            own.setdefault(c, []).append(((t is not None, t or 0), (role or "", text or "")))
    own = {c: [x for _, x in sorted(ts, key=lambda x: x[0])] for c, ts in own.items()}
    new = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        new[c] = own.get(c - c % 5, [])[:h] + ts[h:]
    members = {}
    for c, ts in new.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    out = {}
    for path, cs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        ends = ",".join(map(str, sorted(c for c in cs if len(new[c]) == len(path))))
        out[path] = (
            min(cs), len(path), min(members[path[:-1]]) if path else None, len(cs), sum(len(p) == len(path) + 1 for p in below),
            sum(not any(q[: len(p)] == p and len(q) > len(p) for q in below) for p in below), sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p), hashlib.sha256(ends.encode()).hexdigest(),
        )
    return sorted(out.values(), key=str)


def some_turns(rng, n):
    out = []
    for c in range(n):
        kind = rng.randrange(6)
        if kind < 2:  # a very frequent conversation
            turns = [("user", "hello"), ("assistant", "é" * 3), ("user", "bye")]
        elif kind == 2:  # a very frequent beginning
            turns = [("user", "hello")] + [(rng.choice("ab"), rng.choice(["x", "y", ""])) for _ in range(rng.randrange(5))]
        else:
            turns = [(rng.choice(["user", None]), rng.choice(["x", "y", None, "hello"])) for _ in range(rng.randrange(1, 14))]
        out += [(c, None if i == 0 and rng.random() < 0.5 else i, *t) for i, t in enumerate(turns)]
    rng.shuffle(out)
    return out


def nodes(df, **options):
    found = trie.trie(trie.rebuilt(trie.sequences(df)), **options)
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize(("seed", "parts", "run_bytes"), [(1, 1, 1 << 20), (2, 7, 1), (3, 40, 400)])
def test_trie_equals_brute_force(spark, seed, parts, run_bytes, monkeypatch):
    """One part; more parts than groups, so that nodes and hashes span several; runs of a batch and of all."""
    monkeypatch.setattr(trie, "PIECE_IDS", 3)
    turns = some_turns(random.Random(seed), 150)
    assert nodes(spark.createDataFrame(turns, TURNS).repartition(5), parts=parts, run_bytes=run_bytes) == brute_trie(turns)


def test_trie_of_odd_rows(spark):
    long = "wort " * 50_000
    turns = [(None, 0, "user", "nobody's"), (7, 0, "user", long), (7, 1, None, None), (8, 0, "user", long), (-3, 0, "a", "b"), (9, None, "", "x"), (9, 0, "", "y"), (10**18, 3, "u", "v")]
    df = spark.createDataFrame(turns, TURNS).withColumn("turns", F.lit("clash")).withColumn("key", F.lit(1)).withColumn("size", F.lit(2))
    assert nodes(df) == brute_trie(turns)
    repeated = spark.createDataFrame([(1, 0, "u", "a"), (1, 0, "u", "a"), (2, 0, "u", "a")], TURNS)  # two turns in one place
    assert max(r[1] for r in nodes(repeated)) <= 2
    assert nodes(spark.createDataFrame([], TURNS)) == []


def test_merge_shares_turns():
    """The merged stream is sorted and has its LCPs, whatever the runs."""
    rng = random.Random(5)
    rows = [(b"".join(bytes([rng.randrange(2)]) * trie.KEY for _ in range(rng.randrange(5))), i, b"") for i in range(200)]
    for k in (1, 2, 3, 8, 13):
        runs = [sorted(rows[i::k]) for i in range(k)] + [[]]
        runs = [[(*r, trie.shared(run[i - 1][0], r[0]) if i else 0) for i, r in enumerate(run)] for run in runs]
        got = list(trie.merged(runs))
        assert [r[:3] for _, r in got] == sorted(rows)
        assert [n for n, _ in got][1:] == [trie.shared(a[0], b[0]) for a, b in zip(sorted(rows), sorted(rows)[1:], strict=False)]
    assert list(trie.merged([])) == []


def written(spark, df, **options):
    folder = f"{common.shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    return tokenfile.write(df, folder, **options), folder


def test_token_files_round_trip(spark, docs):
    """Every document comes back from the files, in order, with ids of the tokenizers library and the end."""
    from tokenizers import Tokenizer

    rng = random.Random(2)
    texts = [None, "", " \n ", "<|endoftext|> # !", "é中😀 x", "a b c " * 30_000] + [" ".join(rng.choice(["ab", "Cd", "#", "12"]) for _ in range(rng.randrange(40))) for _ in range(300)]
    df = docs(texts).repartition(3).withColumn("key", F.lit("clash")).withColumn("start", F.lit(1))
    parts, folder = written(spark, df, part_bytes=20_000)
    parts = parts.orderBy("part").collect()
    assert len(parts) > 4 and all(r["width"] == 2 for r in parts)
    for a, b in zip(parts, parts[1:], strict=False):
        assert b["first_doc"] == a["first_doc"] + a["docs"] and b["first_token"] == a["first_token"] + a["tokens"]
    coder, start = Tokenizer.from_file(default_tokenizer()), 0
    for slice_docs in (7, 20_000):
        start, got = 0, tokenfile.read(spark, folder, slice_docs=slice_docs).orderBy("position").collect()
        assert len(got) == len(texts)
        for i, r in enumerate(got):
            ids = [*coder.encode(texts[i] or "", add_special_tokens=False).ids, 2]
            assert (r["position"], r["key"], r["start"], r["n_tokens"]) == (i, i, start, len(ids))
            assert np.frombuffer(r["ids"], "<u4").tolist() == ids
            start += len(ids)
    flat = b"".join(open(f"{tokenfile.filesystem(folder)[1]}/{r['name']}.ids", "rb").read() for r in parts)
    assert len(flat) == 2 * start  # nothing but ids


def test_token_files_of_odd_keys(spark, docs):
    same = docs(["one"] * 40 + ["two"] * 3 + ["three"]).withColumn("doc_id", F.when(F.col("doc_id") < 43, 5))
    _, folder = written(spark, same)
    got = tokenfile.read(spark, folder).orderBy("position").collect()
    assert [r["key"] for r in got] == [None, *[5] * 43] and len({bytes(r["ids"]) for r in got}) == 3
    _, folder = written(spark, same.withColumn("doc_id", F.col("doc_id").cast("string")))
    assert tokenfile.read(spark, folder).where("key = '5'").count() == 43
    empty, folder = written(spark, same.limit(0))
    assert empty.count() == 0 and tokenfile.read(spark, folder).count() == 0


def test_token_query(spark):
    got = tokenfile.op12_token_files(spark, SF).orderBy("start").collect()
    docs = {r["doc_id"]: r["text"] or "" for r in common.table(spark, SF, "documents").collect()}
    start, coder = 0, tokenfile.tokenizer(default_tokenizer())
    assert [r["doc_id"] for r in got] == sorted(docs)
    for r in got:
        ids = coder.encode([docs[r["doc_id"]]])[0] + b"\2\0\0\0"
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids) // 4, zlib.crc32(ids))
        start += r["n_tokens"]


def brute_means(rows, dimension, k, rounds):
    kept = [(i, [int(np.floor(float(x) * 64)) for x in v]) for i, v in rows if v is not None and len(v) == dimension and all(x is not None and np.isfinite(x) for x in v)]
    seeds = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [v for _, v in seeds]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        near = [j for _, j in assigned()]
        for j in set(near):
            mine = [v for (_, v), n in zip(kept, near, strict=True) if n == j]
            centroids[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return sorted(((i, j, d) for (i, _), (d, j) in zip(kept, assigned(), strict=True)), key=str), centroids


@pytest.mark.parametrize("seed", range(3))
def test_sort_means_equals_brute_force(spark, seed):
    """Ties, equal seeds, a very frequent vector, and everything that is not kept."""
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 1.5]) for _ in range(3)]) for i in range(120)] + [(200 + i, [0.5, 0.5, 0.5]) for i in range(60)]
    rows += [(None, [0.1, 0.2, 0.3]), (7, [9.0, 9.0, 9.0]), (7, [9.0, 9.0, 9.0]), (300, None), (301, [1.0, None, 1.0]), (302, [1.0, float("nan"), 1.0]), (303, [float("inf")] * 3), (304, [1.0]), (305, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("clash")).repartition(3)
    got, found = sortmeans.cluster(df, dimension=3, k=6)
    want, centroids = brute_means(rows, 3, 6, 3)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    found = found.orderBy("cluster").collect()
    assert [r["centroid"] for r in found] == centroids
    assert [(r["n"], int(r["inertia"])) for r in found] == [(sum(j == c for _, j, _ in want), sum(d for _, j, d in want if j == c)) for c in range(6)]


def test_sort_means_of_few_and_none(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1e30, 0.0])], "vec_id long, embedding array<double>")
    got, found = sortmeans.cluster(df, dimension=2)
    assert sorted(tuple(r) for r in got.collect()) == [(1, 0, 0), (2, 0, 0)] and found.count() == 2  # beyond a long's squares: not kept
    got, found = sortmeans.cluster(df.limit(0), dimension=2)
    assert got.count() == found.count() == 0


def test_scan_ends_early_and_rightly():
    rng = np.random.default_rng(3)
    x, centroids = rng.integers(-50, 50, (500, 4)), rng.integers(-50, 50, (20, 4))
    centroids[7] = centroids[3]
    for previous in (np.zeros(500, np.int64), rng.integers(0, 20, 500)):
        best, least = sortmeans.nearest(x, previous, centroids)
        d = ((x[:, None] - centroids[None]) ** 2).sum(2)
        assert (best == d.argmin(1)).all() and (least == d.min(1)).all()
