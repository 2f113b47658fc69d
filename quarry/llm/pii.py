"""Personal data: bootstrapped contextual extraction from seed entities.

Seeds are spans of four base kinds, found by pattern and checked (address parts, digit counts, Luhn). The word before a
seed is a lexical pattern of its kind. Patterns and instances (the seeds' texts and those of other tokens that look like
identifiers) are a graph: Spark scores patterns by the mean trust in their distinct instances, and instances by the
patterns they follow, in turns. Trusted instances count for further patterns in the next turn, seeds or not, and carry
their kind on. Identifiers behind a trusted pattern become spans of the kind that most of its trusted instances
have. Only DataFrame functions are used.

Null text counts as empty and has no span. Whole texts are searched. Positions are code points, the end exclusive.
Matches of a kind are leftmost and don't overlap; those that fail their check are dropped without another try.
Discovered spans never overlap a base span. Patterns need `support` distinct trusted instances. Repeated rows get the
same spans; a tie between kinds goes to the first listed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import common

KINDS = ("email", "ip", "card", "phone")

#: Same matches as the plain patterns, with starts and repeats tied down so that none is tried at quadratic cost:
#: a match starts where a run starts or the last match ended, and repeats give nothing back where nothing follows.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"  # shorter ones fail the check of digits in any case
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Tokens that may be identifiers: four characters or more and a digit or @; without @, three digits are asked for later.
TOKEN = r"(?<![^\x20\x09-\x0D\"'(=:\[<])(?=[A-Za-z_./+-]*+[0-9@])[A-Za-z0-9][A-Za-z0-9_@./+-]{3,}(?<=[A-Za-z0-9])(?![A-Za-z0-9_@/+-])"

#: Matches whose positions are summed in one go.
RUN = 64

SPAN = "struct<s: int, e: int, m: string, left: string>"


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once, though lambdas in it use it again and again."""
    return F.element_at(F.transform(F.array(value), body), 1)


def matches(text: Column, pattern: str) -> Column:
    """Spans of all matches in order, with the matched text and the word before it (null: none), another match or not.

    Splitting at the matches gives the text between them, and so the positions: running sums, `RUN` matches at a time,
    so that a text of very many matches does not copy its list of spans for each.
    """
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    joined = F.arrays_zip(between.alias("b"), found.alias("m"))
    joined = F.filter(joined, lambda x: x["m"].isNotNull())

    return let(joined, lambda j: F.when(F.size(j) > 0, _placed(j)).otherwise(F.array().cast(f"array<{SPAN}>")))


def _placed(joined: Column) -> Column:
    def word(x: Column, i: Column) -> Column:
        behind = F.concat(F.coalesce(F.get(joined, i - 1)["m"], F.lit("")), x["b"])
        # read backwards, where the word is the first one: a search for the last one tries every place
        left = F.nullif(F.reverse(F.regexp_extract(F.reverse(behind), r"^\s*+(\S++)", 1)), F.lit(""))
        return F.struct(F.char_length(x["b"]).alias("gap"), F.char_length(x["m"]).alias("n"), x["m"].alias("m"), left.alias("left"))

    def add(acc: Column, total: Column) -> Column:
        return F.struct((acc["pos"] + total).alias("pos"), F.concat(acc["out"], F.array(acc["pos"])).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + x["gap"]
        one = F.struct(start.alias("s"), (start + x["n"]).alias("e"), x["m"].alias("m"), x["left"].alias("left"))
        return F.struct((start + x["n"]).alias("pos"), F.concat(acc["out"], F.array(one)).alias("out"))

    def within(run: Column, first: Column) -> Column:
        return F.aggregate(run, F.struct(first.alias("pos"), F.array().cast(f"array<{SPAN}>").alias("out")), step, lambda acc: acc["out"])

    def spans(runs: Column) -> Column:
        totals = F.transform(runs, lambda run: F.aggregate(run, F.lit(0), lambda n, x: n + x["gap"] + x["n"]))
        firsts = F.aggregate(totals, F.struct(F.lit(0).alias("pos"), F.array().cast("array<int>").alias("out")), add, lambda acc: acc["out"])
        return F.flatten(F.zip_with(runs, firsts, within))

    runs = lambda w: F.transform(F.sequence(F.lit(0), F.floor((F.size(w) - 1) / RUN).cast("int")), lambda k: F.slice(w, k * RUN + 1, RUN))
    return let(F.transform(joined, word), lambda w: let(runs(w), spans))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the checksum holds: every second digit from the right is doubled."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Checked spans of each kind. Texts without a character that the kind needs are not searched."""
    none = F.array().cast(f"array<{SPAN}>")
    digit = text.rlike("[0-9]")
    octets = lambda x: F.forall(F.split(x["m"], r"\."), lambda p: F.char_length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(
        F.split(x["m"], r"\."), lambda p: F.coalesce(F.substring(F.regexp_replace(p, "^0+", ""), 1, 3).try_cast("int"), F.lit(0)) <= 255
    )
    size = lambda x: F.char_length(_digits(x["m"]))
    return {
        "email": F.when(text.contains("@"), matches(text, EMAIL)).otherwise(none),
        "ip": F.when(digit & text.rlike(r"[0-9]\.[0-9]"), F.filter(matches(text, IP), octets)).otherwise(none),
        "card": F.when(digit, F.filter(F.filter(matches(text, CARD), lambda x: size(x).between(13, 19)), lambda x: _luhn(_digits(x["m"])))).otherwise(none),
        "phone": F.when(text.contains("+"), F.filter(matches(text, PHONE), lambda x: size(x).between(9, 15))).otherwise(none),
    }


def _pattern(left: Column) -> Column:
    """Lexical form of the word before an instance: lower case, without what stands around it but for : = and #."""
    return F.nullif(F.regexp_replace(F.lower(left), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}:=#]+$", ""), F.lit(""))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, row, email, ip, card, phone, tokens): the base spans of each row, and other tokens like identifiers."""
    given = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    found = given.select("id", F.xxhash64("t").alias("row"), "t", *(c.alias(k) for k, c in base_spans(F.col("t")).items()))
    tokens = F.when(F.col("t").rlike("[0-9@]"), F.filter(matches(F.col("t"), TOKEN), lambda x: x["m"].contains("@") | (F.char_length(_digits(x["m"])) >= 3)))
    every = F.concat(*KINDS)
    clear = lambda x: ~F.exists("base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
    found = found.select("id", "row", *KINDS, every.alias("base"), F.coalesce(tokens, F.array().cast(f"array<{SPAN}>")).alias("all_tokens"))
    return found.select("id", "row", *KINDS, F.filter("all_tokens", lambda x: x["left"].isNotNull() & clear(x)).alias("tokens"))


def bootstrap(scanned: DataFrame, rounds: int = 3, support: int = 3, trust: float = 0.6) -> DataFrame:
    """(pattern, kind, score) of the trusted patterns.

    A pattern's score is the mean trust in its distinct instances, an instance's the chance that one of its patterns
    is right; seeds are trusted fully. A pattern takes part from the round on in which `support` distinct instances
    are trusted to `trust` at least. A very common word before identifiers is one row a value: values and patterns
    are summed before they are shuffled, and no pattern's instances are ever gathered.
    """
    seeds = reduce(DataFrame.unionByName, (
        scanned.select(F.lit(n).alias("kind"), F.explode(k).alias("x")).select("kind", _pattern(F.col("x.left")).alias("pattern"), F.col("x.m").alias("value")) for n, k in enumerate(KINDS)
    ))
    others = scanned.select(F.explode_outer("tokens").alias("x")).where(F.col("x").isNotNull()).select(F.lit(None).cast("int").alias("kind"), _pattern(F.col("x.left")).alias("pattern"), F.col("x.m").alias("value"))
    edges = seeds.unionByName(others).where(F.col("pattern").isNotNull()).groupBy("pattern", "value").agg(F.min("kind").alias("kind"))
    known = edges.groupBy("pattern").agg(F.count("*").alias("m")).where(F.col("m") >= support).select("pattern")
    edges = common.materialise(edges.join(known, "pattern"), "pii-edges")  # other patterns can never be trusted
    seed, own = F.max(F.col("kind").isNotNull()).alias("seed"), F.min("kind").alias("own")
    instances = edges.groupBy("value").agg(seed, own).select("value", F.col("seed").cast("double").alias("trust"), F.col("own").alias("k"))
    patterns = None
    for _ in range(rounds):
        sure = F.count(F.when(F.col("trust") >= trust, F.col("k"))).alias("sure")
        votes = edges.select("pattern", "value").join(instances, "value").groupBy("pattern", "k").agg(F.sum("trust").alias("t"), F.count("*").alias("n"), sure)
        best = F.max(F.when(F.col("sure") > 0, F.struct("sure", (-F.col("k")).alias("k"))))
        patterns = votes.groupBy("pattern").agg((F.sum("t") / F.sum("n")).alias("score"), F.sum("sure").alias("trusted"), (-best["k"]).alias("k"))
        patterns = common.materialise(patterns.where(F.col("trusted") >= support).select("pattern", "score", "k"), "pii-patterns")
        doubt = F.coalesce(F.sum(F.log1p(-F.least(F.col("score"), F.lit(0.999)))), F.lit(0.0))
        first = F.max(F.when(F.col("k").isNotNull(), F.struct("score", (-F.col("k")).alias("k"))))
        instances = edges.join(patterns, "pattern", "left").groupBy("value").agg(seed, own, (F.lit(1.0) - F.exp(doubt)).alias("p"), (-first["k"]).alias("behind"))
        instances = instances.select("value", F.when(F.col("seed"), 1.0).otherwise(F.col("p")).alias("trust"), F.coalesce("own", "behind").alias("k"))
    return common.materialise(patterns.where(F.col("score") >= trust).select("pattern", F.col("k").alias("kind"), "score"), "pii-trusted")


def _written(spans: Column, kind: str) -> Column:
    return F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")))


def _of_kind(n: int):
    return lambda x: x["k"] == n


def extract(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = 3, support: int = 3, trust: float = 0.6) -> DataFrame:
    """(key, email, ip, card, phone, new): arrays of spans for each row; `new` has the kind's number with each span."""
    scanned = common.materialise(scan(docs, key, text), "pii-scan")
    trusted = bootstrap(scanned, rounds, support, trust)
    tokens = scanned.select("id", "row", F.explode_outer("tokens").alias("x")).where(F.col("x").isNotNull()).withColumn("pattern", _pattern(F.col("x.left")))
    behind = tokens.join(trusted.select("pattern", F.col("kind").alias("k")), "pattern").select("id", "row", F.struct("k", F.col("x.s").alias("s"), F.col("x.e").alias("e")).alias("x"))
    new = behind.groupBy(F.col("id").alias("nid"), F.col("row").alias("nrow")).agg(F.collect_set("x").alias("new"))
    out = scanned.join(new, F.col("id").eqNullSafe(F.col("nid")) & (F.col("row") == F.col("nrow")), "left")
    return out.select(F.col("id").alias(key), *KINDS, F.coalesce("new", F.array().cast("array<struct<k: int, s: int, e: int>>")).alias("new"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(common.table(spark, sf_dir, "documents"))
    base = F.concat(*(_written(F.transform(F.col(k), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))), k) for k in KINDS))
    both = []
    for n, k in enumerate(KINDS):
        plain = F.transform(F.col(k), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
        more = F.transform(F.filter("new", _of_kind(n)), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
        both.append(_written(F.array_distinct(F.concat(plain, more)), k))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"), F.array_join(F.concat(*both), ",").alias("spans"))
