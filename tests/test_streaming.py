"""The listing source and the closing of groups, against the batch query on a replayed log."""

import os
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarry.operators import intake
from quarry.sources import stores
from quarry.streaming import closing, inbox


def run(spark, root, ck, seen, **options):
    q = inbox.run_available(inbox.changes(spark, str(root), **options), str(ck), lambda df, n: seen.append(sorted(r[0] for r in df.select("object_key").collect() if r[0])))
    q.awaitTermination(120)
    assert q.exception() is None


def test_each_change_is_reported_once(spark, tmp_path):
    root, seen = tmp_path / "root", []
    (root / "inbox/u/deep/er").mkdir(parents=True)
    (root / "inbox/v").mkdir()
    (root / "inbox/u/a.csv").write_text("1")
    (root / "inbox/v/v.csv").write_text("1")
    (root / "inbox/loose.csv").write_text("1")
    run(spark, root, tmp_path / "ck", seen)
    assert seen == [["inbox/loose.csv", "inbox/u/a.csv", "inbox/v/v.csv"]]
    # after a restart: an object with an old time, one whose size changed, one whose time went back, and a new submitter
    (root / "inbox/u/deep/er/old.csv").write_text("old")
    os.utime(root / "inbox/u/deep/er/old.csv", (1, 1))
    (root / "inbox/u/a.csv").write_text("11")
    os.utime(root / "inbox/v/v.csv", (5, 5))
    (root / "inbox/w").mkdir()
    (root / "inbox/w/w.csv").write_text("")
    run(spark, root, tmp_path / "ck", seen)
    assert seen[1] == ["inbox/u/a.csv", "inbox/u/deep/er/old.csv", "inbox/v/v.csv", "inbox/w/w.csv"]
    (root / "inbox/v/v.csv").unlink()
    run(spark, root, tmp_path / "ck", seen)
    assert not any(seen[2:])
    assert len([x for x in os.listdir(root / "_looks")]) <= 2  # old snapshots go


def test_empty_inbox_and_deeper_partitions(spark, tmp_path):
    root, seen = tmp_path / "root", []
    root.mkdir()
    run(spark, root, tmp_path / "ck", seen, depth="2", state=f"file://{tmp_path}/state")
    for k in ("inbox/u/x/1.csv", "inbox/u/y/z/2.csv", "inbox/u/3.csv"):
        (root / k).parent.mkdir(parents=True, exist_ok=True)
        (root / k).write_text("1")
    run(spark, root, tmp_path / "ck", seen, depth="2", state=f"file://{tmp_path}/state")
    assert [x for x in seen if x] == [["inbox/u/3.csv", "inbox/u/x/1.csv", "inbox/u/y/z/2.csv"]]


def test_a_batch_that_is_run_again_is_the_same(tmp_path):
    (tmp_path / "inbox/u").mkdir(parents=True)
    (tmp_path / "inbox/u/a.csv").write_text("1")
    reader = inbox.ListingReader(str(tmp_path), str(tmp_path / "s"), 1, False)
    rows = lambda a, b: sorted(r for p in reader.partitions({"look": a}, {"look": b}) for r in reader.read(p))
    first = rows(0, 1)
    (tmp_path / "inbox/u/b.csv").write_text("2")
    assert rows(0, 1) == first and [r[0] for r in rows(1, 2)] == ["inbox/u/b.csv"] and reader.latestOffset() == {"look": 3}


T0 = datetime(2025, 6, 1)
LOOK = "object_key string, submitter_id string, bytes long, etag string, last_modified timestamp, seen_at timestamp"


def log(rng, n):
    """Looks some minutes apart, with what each one reports."""
    looks, t = [], T0
    for i in range(n):
        t += timedelta(minutes=rng.choice([1, 3, 6]))
        found = {}
        for _ in range(rng.randrange(4)):
            u = rng.choice("uv")
            folder = rng.choice(["", "d/", "d/e/", "f/"])
            name = intake.MARKER if folder and rng.random() < 0.3 else f"{rng.randrange(6)}.csv"
            found[f"inbox/{u}/{folder}{name}"] = (u, i + 1)
        looks.append((t, [(k, u, b, f"e{b}", T0, t) for k, (u, b) in found.items()]))
    return looks


def batchwise(spark, looks, quiet):
    """What the batch query closes at each look, when what is closed is taken away at once; an object that changes comes back."""
    state, out = {}, []
    for t, rows in looks:
        for k, u, b, e, _, _ in rows:
            state[k] = (u, b, t)
        schema = "object_key string, submitter_id string, last_seen_at timestamp, last_changed_at timestamp, status string"
        objects = spark.createDataFrame([(k, u, at, at, "SEEN") for k, (u, _, at) in state.items()], schema)
        for r in intake.closed_groups(objects, F.lit(t), quiet).collect():
            out.append((r["object_key"], state[r["object_key"]][1], r["inbox_prefix"], r["grouping_method"]))
            del state[r["object_key"]]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_closing_equals_the_batch_query(spark, tmp_path, seed):
    closing.use_state_store(spark)
    looks, quiet = log(random.Random(seed), 10), 10
    end = looks[-1][0] + timedelta(minutes=30)
    looks.append((end, []))
    folder = tmp_path / "looks"
    for i, (t, rows) in enumerate(looks):
        beat = [(None, u, None, None, None, t) for u in "uv"]
        spark.createDataFrame(rows + beat, LOOK).coalesce(1).write.parquet(str(folder / f"look={i:03d}"))
        for f in (folder / f"look={i:03d}").iterdir():
            os.utime(f, (1e9 + i, 1e9 + i))
    stream = spark.readStream.schema(LOOK).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))
    got = []

    def keep(df, n):
        got.extend((r["object_key"], r["bytes"], r["inbox_prefix"], r["grouping_method"]) for r in df.collect())

    q = closing.closed_stream(stream, quiet).writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(240)
    assert q.exception() is None
    assert sorted(got) == batchwise(spark, looks, quiet)


def test_inbox_to_closed_groups(spark, tmp_path):
    """From files to groups: the marker's at once, the quiet one's when its time is over."""
    closing.use_state_store(spark)
    root, got = tmp_path / "root", []
    for k in ("inbox/u/d/1.csv", "inbox/u/d/_SUCCESS", "inbox/u/2.csv"):
        (root / k).parent.mkdir(parents=True, exist_ok=True)
        (root / k).write_text("1")

    def look():
        stream = closing.closed_stream(inbox.changes(spark, str(root), looks="true"), quiet_minutes=1 / 60)
        step = lambda df, n: got.extend((r["object_key"], r["inbox_prefix"], r["grouping_method"]) for r in df.collect())
        q = stream.writeStream.foreachBatch(step).option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert q.exception() is None

    look()
    assert got == [("inbox/u/d/1.csv", "inbox/u/d", "MARKER")]
    time.sleep(1.2)
    look()
    look()
    assert got[1:] == [("inbox/u/2.csv", "inbox/u", "QUIESCENCE")]


def test_s3_settings():
    env = {"S3_ACCESS_KEY_ID": "k", "S3_SECRET_ACCESS_KEY": "s", "S3_ENDPOINT_URL": "http://store:9000"}
    got = stores.s3_settings(env)
    assert (got["fs.s3a.endpoint"], got["fs.s3a.connection.ssl.enabled"], got["fs.s3a.path.style.access"], got["fs.s3a.endpoint.region"]) == ("store:9000", "false", "true", "us-east-1")
    assert got["fs.s3a.aws.credentials.provider"].endswith("SimpleAWSCredentialsProvider")
    assert stores.s3_settings(env | {"S3_SESSION_TOKEN": "t", "S3_URL_STYLE": "vhost"})["fs.s3a.session.token"] == "t"
    bare = stores.s3_settings({})
    assert "fs.s3a.endpoint" not in bare and "fs.s3a.access.key" not in bare and bare["fs.s3a.connection.ssl.enabled"] == "true"
    fs, path = stores.filesystem("s3a://bucket/a/b", env)
    assert path == "bucket/a/b" and fs.type_name == "s3"


def test_configure_s3(spark):
    stores.configure_s3(spark, {"S3_ENDPOINT_URL": "https://e", "S3_REGION": "r"})
    conf = spark._jsc.hadoopConfiguration()
    assert (conf.get("fs.s3a.endpoint"), conf.get("fs.s3a.endpoint.region"), conf.get("fs.s3a.connection.ssl.enabled")) == ("e", "r", "true")
