import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.llm import common, langmodel, packing, pii

SF = "/root/testdata/sf0.01"
TEXTS = st.lists(st.text(alphabet="aB \n\té中.A1", max_size=30), max_size=8)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@given(TEXTS)
@settings(max_examples=200, deadline=None)
def test_words_and_normal_form(texts):
    data, bounds = common.utf8(pa.array(texts, pa.string()))
    value, doc, start, end = common.words(data, bounds)
    got = [(int(d), bytes(data[a:b]).decode()) for d, a, b in zip(doc, start, end, strict=True)]
    want = [(i, w) for i, t in enumerate(texts) for w in re.findall(r"[^\x20\x09-\x0D]+", t)]
    assert got == want
    by_word = {}
    for h, (_, w) in zip(value, got, strict=True):
        assert by_word.setdefault(int(h), words(w)) == words(w)
    assert len(by_word) == len({tuple(words(w)) for _, w in got})
    normal, at = langmodel.normal_bytes(data, bounds)
    assert [bytes(normal[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)] == [" ".join(words(t)).encode() + b"\xff" for t in texts]


def tokenizers():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_tokenizer())
    t.encode_special_tokens = True
    return t


@given(st.lists(st.text(alphabet="ab 's\n\té中9.<|>\u00a0", max_size=40), max_size=5))
@settings(max_examples=150, deadline=None)
def test_ids_are_those_of_tokenizers(texts):
    want = [e.ids for e in tokenizers_cached().encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in packing.tokenizer(packing.default_tokenizer()).encode(texts)] == want


_known = []


def tokenizers_cached():
    if not _known:
        _known.append(tokenizers())
    return _known[0]


def test_added_tokens_keep_their_ids():
    from tokenizers import Tokenizer

    given = Tokenizer.from_file(packing.default_tokenizer())
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y", "a <|endoftext b"]
    got = [np.frombuffer(x, "<u4").tolist() for x in packing.tokenizer(packing.default_tokenizer()).encode(texts)]
    assert got == [given.encode(t, add_special_tokens=False).ids for t in texts] and got[0] == [64, 220, 50256, 275]


def test_documents_are_tokenized_alike(spark):
    texts = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(150).collect()]
    want = [e.ids for e in tokenizers_cached().encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in packing.tokenizer(packing.default_tokenizer()).encode(texts)] == want


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
@settings(max_examples=100, deadline=None)
def test_plan_places_every_piece_once(counts):
    runs = packing.plan(counts, 64, (3, 8))
    used = Counter()
    for size, n in counts.items():
        rank = 0
        for first, number, sequence, _ in runs[size]:
            assert first == rank
            rank += number
            for k in range(number):
                used[sequence + k] += size
        assert rank == n
    assert all(v <= 64 for v in used.values())
    assert len(used) <= 1 + 1.35 * sum(s * n for s, n in counts.items()) / 64 + sum(n for s, n in counts.items() if s > 32)


def check_packed(rows, texts, capacity=1024):
    coder = tokenizers_cached()
    by_sequence = {}
    for i, t in enumerate(texts):
        ids = coder.encode(t or "", add_special_tokens=False).ids + [2]
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(-(-len(ids) // capacity)))
        at = 0
        for r in mine:
            part = ids[at : at + r["length"]]
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            assert r["length"] == capacity or r["piece"] == 0
            at += r["length"]
            by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert at == len(ids)
    for parts in by_sequence.values():
        to = 0
        for offset, length in sorted(parts):
            assert offset == to
            to += length
        assert to <= capacity
    return len(by_sequence)


def test_packing(spark, docs, odd, prose):
    ODD = [r["text"] for r in odd.orderBy("doc_id").collect()]

    check_packed(packing.pack_documents(odd.withColumn("length", F.lit("clash"))).collect(), ODD)
    texts = [prose(n) for n in (900, 5, 300, 300, 300, 40, 2000, 10, 10, 10, 600, 450)]
    n = check_packed(packing.pack_documents(docs(texts)).collect(), texts)
    assert n <= 1 + sum(len(tokenizers_cached().encode(t).ids) + 1 for t in texts) / 1024 * 1.2
    assert packing.pack_documents(docs([]).limit(0)).count() == 0


def test_packing_of_real_documents(spark):
    rows = packing.op6_best_fit_packing(spark, SF).toPandas()
    total = rows["length"].sum()
    assert rows["sequence_id"].nunique() <= 1.02 * total / 1024 + 5
    assert rows.groupby("sequence_id")["length"].sum().max() <= 1024


# ---- language model ---------------------------------------------------------------------------------------------


def kt(a, b):
    p, x, y = 0.0, 0, 0
    for _ in range(int(a)):
        p += math.log((x + 0.5) / (x + y + 1))
        x += 1
    for _ in range(int(b)):
        p += math.log((y + 0.5) / (x + y + 1))
        y += 1
    return p


def test_krichevsky_trofimov():
    a, b = np.array([0.0, 3, 0, 20, 500]), np.array([0.0, 0, 5, 31, 4])
    assert np.allclose(langmodel._kt(a, b), [kt(x, y) for x, y in zip(a, b, strict=True)])


def test_tree_equals_recursion():
    """Scores against context-tree weighting written as its definition, on a small alphabet and depth 2."""
    texts = ["ab ab ab", "abc", "b a b a", "", "cab cab"]
    depth = 2
    seqs = [[langmodel.END] * depth + list(" ".join(words(t)).encode()) + [langmodel.END] for t in texts]
    counts = {}
    for s in seqs:
        for i in range(depth, len(s)):
            for d in range(depth + 1):
                context, symbol = tuple(s[i - d : i]), s[i]
                for level in range(8):
                    node = (1 << level) | (symbol >> (8 - level))
                    counts.setdefault((context, node), [0, 0])[(symbol >> (7 - level)) & 1] += 1

    def weighted(context, node):
        own = kt(*counts[context, node])
        below = [c for (c, n) in counts if n == node and len(c) == len(context) + 1 and c[1:] == context]
        if not below:
            return own, 1.0
        both = np.logaddexp(own, sum(weighted(c, node)[0] for c in below)) - math.log(2)
        return both, math.exp(math.log(0.5) + own - both)

    def predict(s, i, level):
        symbol, total, left = s[i], 0.0, 1.0
        node, bit = (1 << level) | (symbol >> (8 - level)), (symbol >> (7 - level)) & 1
        path = [tuple(s[i - d : i]) for d in range(depth + 1) if (tuple(s[i - d : i]), node) in counts]
        if not path:
            return 0.5
        for d, c in enumerate(path):
            a, b = counts[c, node]
            p = (b + 0.5) / (a + b + 1)
            share = weighted(c, node)[1] if d < len(path) - 1 else 1.0
            total += left * share * p
            left *= 1 - share
        return total if bit else 1 - total

    data, bounds = common.utf8(pa.array(texts))
    codes = langmodel.gram_codes(*langmodel.normal_bytes(data, bounds), depth)
    levels = []
    for d in range(depth + 1):
        u, n = np.unique(codes & np.uint64((1 << (8 * (d + 1))) - 1), return_counts=True)
        levels.append((u, n.astype(float)))
    model = langmodel.build(levels, 3)
    for probe in ("ab c", "zz", ""):
        data, bounds = common.utf8(pa.array([probe]))
        got = model.log10_of(langmodel.gram_codes(*langmodel.normal_bytes(data, bounds), depth)).sum()
        s = [langmodel.END] * depth + list(" ".join(words(probe)).encode()) + [langmodel.END]
        want = sum(math.log10(predict(s, i, level)) for i in range(depth, len(s)) for level in range(8))
        assert got == pytest.approx(want, rel=1e-4)


@pytest.mark.parametrize("most_words", [300_000, 5])
def test_base_score(spark, docs, most_words):
    texts = ["The cat the", None, "", "the DOG", "a\tb\x0bc é", "the the", "new words here", "cat"] * 2
    df = docs(texts)
    train = [i % 3 != 0 for i in range(len(texts))]
    out = langmodel.score(df.withColumn("n", F.lit("clash")), df.where("doc_id % 3 <> 0"), depth=3, most_words=most_words).orderBy("doc_id").collect()
    seen = Counter()
    for t, ok in zip(texts, train, strict=True):
        if ok:
            seen.update([*words(t), None])
    n, v = sum(seen.values()), len(seen)
    for r, t in zip(out, texts, strict=True):
        tokens = [*words(t), None]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(seen[w] > 0 for w in tokens), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in tokens))
        assert r["score"] < 0


def test_language_model_beats_the_base_on_held_out_texts(spark):
    """The score is a probability that is better than the base's, and the code length is the same thing in bits."""
    out = langmodel.op8_language_model(spark, "/root/testdata/sf0.1").toPandas()
    assert len(out) == 10_000 and (out["score"] < 0).all()
    for part in (out[out["held_out"]], out[~out["held_out"]]):
        assert part["score"].sum() / part["n_tokens"].sum() > part["base_score"].sum() / part["n_tokens"].sum() + 0.1
    assert 1.5 < out["bits_per_byte"].median() < 2.5


@pytest.mark.parametrize("n", [10, 10**8, 10**11])
@pytest.mark.parametrize("symbol", [0, 255])
def test_what_was_never_seen_among_very_many_has_a_finite_score(n, symbol):
    """Even where 32 bits can't tell the probability of the rest from 1."""
    model = langmodel.build([(np.array([symbol], np.uint64), np.array([float(n)]))], 0)
    seen, other = model.log10_of(np.array([symbol, symbol ^ 255], np.uint64))
    assert other == pytest.approx(math.log10(0.5 / (n + 1)) + 7 * math.log10(0.5), rel=1e-6)
    assert seen == pytest.approx(8 * math.log1p(-0.5 / (n + 1)) / math.log(10), rel=1e-3)


def test_language_model_of_nothing(spark, docs, odd):
    out = langmodel.score(odd, odd.limit(0), depth=2).collect()
    assert len(out) == 8 and all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in out)
    assert langmodel.score(docs([]).limit(0), odd, depth=2).count() == 0


@pytest.mark.parametrize("most", [300_000, 40, 0])
@pytest.mark.parametrize("flag", [False, True])
def test_every_counted_context_takes_part(spark, docs, prose, monkeypatch, most, flag):
    """Scores equal those of the whole tree, built at once, whatever is broadcast and however subtrees are grouped."""
    texts = [prose(25) for _ in range(12)] + ["only here: qxz", None, "\u4e2d\u6587 caf\u00e9"]
    df, depth = docs(texts), 5
    data, bounds = common.utf8(pa.array([t for i, t in enumerate(texts) if i % 3]))
    codes = langmodel.gram_codes(*langmodel.normal_bytes(data, bounds), depth)
    levels = [tuple(np.unique(codes & np.uint64((1 << (8 * (d + 1))) - 1), return_counts=True)) for d in range(depth + 1)]
    model = langmodel.build([(u, n.astype(float)) for u, n in levels], 0)
    spread = langmodel.gram_scores
    monkeypatch.setattr(langmodel, "gram_scores", lambda grams, depth: spread(grams, depth, 100))
    taught = F.col("doc_id") % 3 != 0
    got = langmodel.score(df, taught if flag else df.where(taught), depth=depth, most=most).orderBy("doc_id").collect()
    assert len(got) == len(texts)
    for r, t in zip(got, texts, strict=True):
        data, bounds = common.utf8(pa.array([t], pa.string()))
        want = model.log10_of(langmodel.gram_codes(*langmodel.normal_bytes(data, bounds), depth)).sum()
        assert r["score"] == pytest.approx(want, rel=1e-4)


def test_model_prefers_what_it_was_taught(spark, docs, prose):
    df = docs([prose(80) for _ in range(40)])
    out = langmodel.score(df.unionByName(docs(["qxz jjk vvw " * 20])), df, depth=4).toPandas()
    per = out["score"] / out["n_tokens"]
    assert per.iloc[-1] < per.iloc[:-1].min()


# ---- personal data ----------------------------------------------------------------------------------------------

BASE = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in BASE:
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and not (13 <= len(d) <= 19 and luhn(d)) or kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


CASES = [
    None, "", "no data", "mail a.b@c.d.e, x@y and _d@e.f.", "a@b.c@d.e.f a@b.c_d@e.f %%@x.y..z@q.r", "1.2.3.4 256.1.1.1 1.2.3.4.5 001.002.003.0255 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112 79927398713 12345678901234567890123",
    "+1 (988) 555-2485 +12 +1-2-3-4-5-6-7-8-9 ++44 20 7946 0958.", "é😀 a@b.c é 10.0.0.1 中+49 30 123456 7", "4" * 16 + " " + "0" * 13, "9" * 5000 + "@" + "a" * 5000, "a" * 20000, "1 " * 5000, "1-1 2--3 4111  1111", "x@y.z" * 3,
]


def op10(spark, texts, monkeypatch, rows=None):
    df = spark.createDataFrame(rows or list(enumerate(texts)), "doc_id long, text string").withColumn("new", F.lit("clash"))
    monkeypatch.setattr(pii.common, "table", lambda *a: df)
    return pii.op10_pii(spark, "").collect()


def test_base_spans(spark, monkeypatch):
    out = {r["doc_id"]: r for r in op10(spark, CASES, monkeypatch)}
    for i, t in enumerate(CASES):
        want = brute(t)
        assert out[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), t and t[:60]
        assert [out[i][f"n_{k}"] for k, _ in BASE] == [sum(x.startswith(f"{k}:") for x in want) for k, _ in BASE]
        assert set(want) <= set(filter(None, out[i]["spans"].split(",")))


def test_patterns_find_unseen_identifiers(spark, monkeypatch):
    texts = [f"call tel: +1 988 555 24{i}5 now" for i in range(10, 16)] + ["call tel: 0988-555-7777 now", "see page 0988-555-7777 now", "tel: none", "call tel: 0988-555-7777 now"]
    out = {r["doc_id"]: r for r in op10(spark, texts, monkeypatch)}
    assert out[6]["spans"] == "phone:10:23" and out[6]["n_phone"] == 0 and out[9]["spans"] == out[6]["spans"]
    assert out[7]["spans"] == "" and out[8]["spans"] == "" and out[0]["spans"] == "phone:10:26"


def test_discovered_instances_lead_to_new_patterns(spark, monkeypatch):
    texts = [f"call tel: +1 988 555 24{i} now" for i in range(10, 40)]
    texts += [f"{w} 0988-555-77{i} now" for i in range(10, 18) for w in ("tel:", "ring")] + ["ring 0988-555-9901 now", "ring 0988-555-9902 now", "page 0988-555-9903 now"]
    out = [r["spans"] for r in sorted(op10(spark, texts, monkeypatch), key=lambda r: r["doc_id"])]
    assert out[30:46] == ["phone:5:18"] * 16 and out[46:] == ["phone:5:18"] * 2 + [""]


def test_identifiers_like_emails_need_no_digits(spark, monkeypatch):
    texts = [f"mail: {c}@example.com now" for c in "abcdefgh"] + ["mail: john@intranet now", "see john@intranet now", "mail: jane now"]
    out = [r["spans"] for r in sorted(op10(spark, texts, monkeypatch), key=lambda r: r["doc_id"])]
    assert out[8:] == ["email:6:19", "", ""]


def test_repeated_null_and_no_rows(spark, monkeypatch):
    out = op10(spark, None, monkeypatch, [(1, "a@b.c"), (1, "a@b.c"), (1, "x"), (None, "a@b.c"), (2, None)])
    assert sorted((r["doc_id"] or 0, r["spans"]) for r in out) == [(0, "email:0:5"), (1, ""), (1, "email:0:5"), (1, "email:0:5"), (2, "")]
    assert pii.extract(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_real_documents(spark):
    out = {r["doc_id"]: r["base_sha256"] for r in pii.op10_pii(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        assert out[r["doc_id"]] == hashlib.sha256(",".join(brute(r["text"])).encode()).hexdigest()


def test_very_many_matches_in_a_text(spark, docs):
    """Positions and the word before, which may be a match itself; 8,000 pairs take seconds, not minutes."""
    text = " ".join(f"k{i} 12{i:05d}" for i in range(100, 8100))
    row = pii.scan(docs([text, "mail a@b.co c@d.ee", "é1234 x12345"])).orderBy("id").collect()
    want = [(m.start(), m.end(), m[0]) for m in re.finditer(r"\S+", text)]
    assert [(x["s"], x["e"], x["m"]) for x in row[0]["tokens"]] == want[1:]
    assert [x["left"] for x in row[0]["tokens"]] == [w[2] for w in want[:-1]]
    assert [(x["s"], x["e"], x["left"]) for x in row[1]["email"]] == [(5, 11, "mail"), (12, 18, "a@b.co")]
    assert [(x["s"], x["e"], x["left"]) for x in row[2]["tokens"]] == [(6, 12, "é1234")]
