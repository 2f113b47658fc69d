"""Latest validated submission of each month: a set-based merge with the result of one update after another."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.sources.files import replace_months


def winner_time(validation_ended: Column, received: Column, created: Column) -> Column:
    return F.coalesce(validation_ended, received, created)


def _bounds(offers: DataFrame, column: str, chunks: int, most: int = 4000) -> list:
    """Values that cut the offers into `chunks` ranges of about equal size, from a bounded sample: they say nothing about results."""
    some = offers.where(F.col(column).isNotNull()).select(F.col(column).alias("v"))
    total = some.count()
    if chunks < 2 or not total:
        return []
    share = min(1.0, most / total)
    sample = sorted(r["v"] for r in (some if share == 1 else some.sample(share, seed=11)).collect())
    return sorted({sample[len(sample) * i // chunks] for i in range(1, chunks)}) if sample else []


def _records(offers: DataFrame, keys: list[str], seq: list[str], ts: str, held: DataFrame | None, chunks: int | None, submission: str | None) -> DataFrame:
    """The records, with the range (`_chunk`) of each and, for a submission, the record before it in that range (`_previous`)."""
    chunks = chunks or int(offers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = [F.lit(v) for v in _bounds(offers, seq[0], chunks)]
    chunk = F.coalesce(F.size(F.filter(F.array(*cuts), lambda v: v <= F.col(seq[0]))), F.lit(0)) if cuts else F.lit(0)
    placed = offers.where(F.col(ts).isNotNull()).withColumn("_chunk", chunk)
    tops = placed.groupBy(*keys, "_chunk").agg(F.max(ts).alias("_top"))  # partial maxima before the shuffle
    if held is not None:
        tops = tops.unionByName(held.where(F.col(ts).isNotNull()).select(*keys, F.lit(-1).alias("_chunk"), F.col(ts).alias("_top")))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = tops.withColumn("_base", F.max("_top").over(before)).where("_chunk >= 0 AND (_base IS NULL OR _top > _base)").drop("_top")  # other ranges hold no record
    same = [F.col(f"o.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    found = placed.alias("o").join(bases.alias("b"), reduce(and_, same, F.col("o._chunk") == F.col("b._chunk"))).select("o.*", "b._base")
    within = Window.partitionBy(*keys, "_chunk").orderBy(*seq).rowsBetween(Window.unboundedPreceding, -1)
    best = F.greatest("_base", F.max(ts).over(within))
    found = found.withColumn("_best", best).withColumn("_record", F.col("_best").isNull() | (F.col(ts) > F.col("_best")))
    if submission:
        found = found.withColumn("_previous", F.last(F.when(F.col("_record"), F.col(submission)), True).over(within))
    return found.where("_record").drop("_record", "_best", "_base")


def record_breakers(offers: DataFrame, keys: list[str], seq: list[str], ts: str, held: DataFrame | None = None, chunks: int | None = None) -> DataFrame:
    """Offers that would replace the pointer if taken in the order of `seq`: strictly newer than all before them.

    A segmented prefix maximum in two levels, so that a key with very many offers is the work of many tasks: the order is
    cut into ranges of the first of `seq`; each key's maxima in its ranges are scanned, which gives what is best before a
    range, and records are found within it. A tie keeps the incumbent, and an offer without a time never wins. `held`
    (keys, `ts`) are times that stand before all offers.
    """
    return _records(offers, keys, seq, ts, held, chunks, None).drop("_chunk")


def _last_two(offers: DataFrame, keys: list[str], seq: list[str], ts: str, submission: str, held: DataFrame | None = None, chunks: int | None = None) -> DataFrame:
    """(keys, submission, ts, _previous) of each key's last record and the one before it; records of a key rise strictly."""
    records = _records(offers, keys, seq, ts, held, chunks, submission)
    each = records.groupBy(*keys, "_chunk").agg(F.max_by(F.struct(F.col(submission).alias("s"), F.col(ts).alias("t"), F.col("_previous").alias("p")), ts).alias("last"))
    by = Window.partitionBy(*keys).orderBy(F.desc("_chunk"))  # a row for each range
    top = each.withColumn("_earlier", F.lead("last.s").over(by)).withColumn("_rank", F.row_number().over(by)).where("_rank = 1")
    return top.select(*keys, F.col("last.s").alias(submission), F.col("last.t").alias(ts), F.coalesce("last.p", "_earlier").alias("_previous"))


def resolve(offers: DataFrame, keys: list[str], seq: list[str], ts: str, submission: str = "submission_id") -> DataFrame:
    """(keys, winning_submission_id, replaced_submission_id, winner_timestamp): the pointer after all offers."""
    out = _last_two(offers, keys, seq, ts, submission)
    return out.select(*keys, F.col(submission).alias("winning_submission_id"), F.col("_previous").alias("replaced_submission_id"), F.col(ts).alias("winner_timestamp"))


def merge(pointers: DataFrame, offers: DataFrame, keys: list[str], seq: list[str], ts: str = "winner_timestamp", submission: str = "submission_id") -> tuple[DataFrame, DataFrame]:
    """(new pointers, keys whose pointer changed). A stored pointer is an offer before all others of its key."""
    held = pointers.select(*keys, F.col("winner_timestamp").alias(ts))
    won = _last_two(offers, keys, seq, ts, submission, held)
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"w.{k}")) for k in keys]
    stored = pointers.where("winner_timestamp IS NOT NULL")
    j = stored.alias("p").join(won.withColumn("_won", F.lit(True)).alias("w"), reduce(and_, same), "full_outer")
    new = F.col("w._won")
    out = j.select(
        *(F.when(new, F.col(f"w.{k}")).otherwise(F.col(f"p.{k}")).alias(k) for k in keys),
        F.when(new, F.col(f"w.{submission}")).otherwise(F.col("p.winning_submission_id")).alias("winning_submission_id"),
        F.when(new, F.coalesce("w._previous", "p.winning_submission_id")).otherwise(F.col("p.replaced_submission_id")).alias("replaced_submission_id"),
        F.when(new, F.col(f"w.{ts}")).otherwise(F.col("p.winner_timestamp")).alias("winner_timestamp"),
    )
    return out, won.select(*keys)


def enqueue(queue: DataFrame, changed: DataFrame, now: Column, reason: str) -> DataFrame:
    """The rebuild queue with a row for each changed month (state, file_type, atomic_month)."""
    top = queue.agg(F.coalesce(F.max("queue_id"), F.lit(0)).alias("top"))
    number = F.row_number().over(Window.orderBy("state", "file_type", "atomic_month"))  # months, not data
    rows = changed.select("state", "file_type", "atomic_month").distinct().withColumn("n", number).crossJoin(top)
    rows = rows.select((F.col("top") + F.col("n")).cast(queue.schema["queue_id"].dataType).alias("queue_id"), "state", "file_type", "atomic_month", now.alias("enqueued_at"), F.lit(reason).alias("reason"), F.lit(None).cast("timestamp").alias("processed_at"))
    return queue.unionByName(rows, allowMissingColumns=True)


def drain(queue: DataFrame, most: int = 250) -> DataFrame:
    """Months of the oldest pending events, each once, with the highest event seen."""
    oldest = queue.where("processed_at IS NULL").orderBy("enqueued_at", "queue_id").limit(most)
    return oldest.groupBy("state", "file_type", "atomic_month").agg(F.max("queue_id").alias("high_water"), F.count("*").alias("events"))


def mark_processed(queue: DataFrame, months: DataFrame, now: Column) -> DataFrame:
    """Every pending event of the given months is done, whatever the build's result."""
    done = months.select("state", "file_type", "atomic_month").distinct().withColumn("_done", F.lit(True))
    out = queue.join(done, ["state", "file_type", "atomic_month"], "left")
    return out.withColumn("processed_at", F.when(F.col("_done") & F.col("processed_at").isNull(), now).otherwise(F.col("processed_at"))).select(*queue.columns)


def overwrite_months(silver: DataFrame, out: str, months: list[str] | None, submitter_id: str, state: str | None, file_type: str, now: Column) -> None:
    """Replace the named months of a submitter's gold table and no others, in one write.

    Lineage columns are added only where the data has none of that name, in whatever case; data without a month has
    the one named, or `__all__`. A named month without rows is an error: its old rows would stay as if they were new.
    """
    have = {c.lower() for c in silver.columns}
    lineage = {"submitter_id": F.lit(submitter_id), "state": F.lit(state or "__unknown__"), "file_type": F.lit(file_type), "atomic_month": F.lit(months[0] if months and len(months) == 1 else "__all__")}
    df = silver.withColumns({k: v for k, v in lineage.items() if k not in have}).withColumn("gold_built_at", now)
    named = months if months and months != ["__all__"] else None
    if named:
        df = df.where(F.col("atomic_month").isin(named))
    replace_months(df, out, named, required=True)
