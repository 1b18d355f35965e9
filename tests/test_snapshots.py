"""Tables that batches change: streams of late and repeated rows, reruns, untouched files."""

from __future__ import annotations

import datetime as dt
import glob
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from scholion.operators import registry as G
from scholion.streaming import snapshot, streams


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def at(day):
    return None if day is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=day)


def row(pmc_id, day=None, success=False, full_text=False, error=None):
    done = day is not None
    return (pmc_id, done, at(day), success, at(day) if success else None, error, at(day) if error else None, "u" if done else None, full_text)


def batches_of(spark, folder, batches):
    """Each list of rows as one file, to be read as one batch, in this order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, G.REGISTRY_SCHEMA).coalesce(1).write.parquet(f"{folder}/in/{i}")
        for file in glob.glob(f"{folder}/in/{i}/*.parquet"):
            os.utime(file, (1_000_000 + i, 1_000_000 + i))
    return (
        spark.readStream.schema(G.REGISTRY_SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{folder}/in")
    )


def plain_stats(batches):
    state = {}
    for rows in batches:
        for r in rows:
            if r[0] is None:
                continue
            stamp = max((t for t in (r[2], r[4], r[6]) if t is not None), default=dt.datetime.min)
            if r[0] not in state or stamp >= state[r[0]][0]:
                state[r[0]] = (stamp, r)
    rows = [r for _, r in state.values()]
    return len(rows), sum(r[1] for r in rows), sum(r[3] for r in rows), sum(r[8] for r in rows), sum(r[5] is not None for r in rows)


def test_counters_of_the_latest_rows(spark, folder):
    batches = [
        [row(1), row(2), row(3), row(None), row(250)],
        [row(1, 5, success=True, full_text=True), row(2, 4, error="x"), row(2, 4, error="x")],
        [row(1, 2, error="late"), row(1, 5, success=True, full_text=True), row(1), row(3, 1, success=True)],
        [row(2, 9, success=True), row(3, 1, success=True), row(250, 3, error="y"), row(-7, 1)],
    ]
    stream = batches_of(spark, folder, batches)
    streams.stream_registry_stats(stream, f"{folder}/out", f"{folder}/state", bucket_size=100).awaitTermination()
    for i in range(4):
        assert tuple(spark.read.parquet(f"{folder}/out/stats/batch_id={i}").first()) == plain_stats(batches[: i + 1])
    assert tuple(streams.latest_stats(spark, f"{folder}/out").first()) == (5, 5, 3, 1, 1)


def test_random_changes_and_a_batch_run_again(spark, folder):
    r = random.Random(4)
    # equal times of an id come with equal rows, as the order of such rows is not known
    draw = lambda: (lambda i, d: row(i, d, success=(i + d) % 2 == 0, full_text=d % 3 == 0, error="e" if d % 5 == 0 else None))(r.randint(0, 40), r.randint(1, 30))
    batches = [[draw() for _ in range(r.randint(1, 40))] for _ in range(5)]
    stream = batches_of(spark, folder, batches)
    streams.stream_registry_stats(stream, f"{folder}/out", f"{folder}/state", bucket_size=7).awaitTermination()
    want = plain_stats(batches)
    assert tuple(streams.latest_stats(spark, f"{folder}/out").first()) == want
    # the last batch again, as after a driver that died before it noted the batch as done
    os.rename(f"{folder}/state/commits/4", f"{folder}/commit-4")
    for crc in glob.glob(f"{folder}/state/commits/.4.crc"):
        os.rename(crc, f"{folder}/crc-4")
    stream = spark.readStream.schema(G.REGISTRY_SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{folder}/in")
    streams.stream_registry_stats(stream, f"{folder}/out", f"{folder}/state", bucket_size=7).awaitTermination()
    assert tuple(streams.latest_stats(spark, f"{folder}/out").first()) == want
    assert G.stored_registry(spark, f"{folder}/out/rows").count() == want[0]


VERSION = "pmc_id int, sections map<string,string>, abstract_text string, arrival long"


def test_best_versions_read_the_current_state_only(spark, folder):
    many = [(i, {"a": "x"}, "abc", i) for i in range(100)]
    merge = lambda old, new: streams.best_version(new if old is None else old.unionByName(new))
    bucket = snapshot.by_hash("pmc_id", 16)
    for batch_id, rows in enumerate([many, [(5, {"a": "x", "b": "y"}, "", 200)], [(5, None, "zzzz", 300), (7, {"a": "x"}, "abcd", 400)], []]):
        snapshot.merge_batch(spark.createDataFrame(rows, VERSION), folder, batch_id, bucket, merge)
    best = streams.current_best(spark, folder)
    got = {r.pmc_id: r.arrival for r in best.collect()}
    assert got == {i: i for i in range(100)} | {5: 200, 7: 400}
    # one folder per bucket, however many batches wrote it
    buckets = {f.split("bucket=")[1].split("/")[0] for f in best.inputFiles()}
    assert len(best.inputFiles()) == len(buckets) == 16
    # what a failed attempt of the next batch left is not read, and running it again replaces it
    left = f"{folder}/data/batch_id=4/bucket=3"
    spark.createDataFrame([(1, None, "bad", 0)], VERSION).write.parquet(left)
    assert {r.pmc_id: r.arrival for r in streams.current_best(spark, folder).collect()} == got
    snapshot.merge_batch(spark.createDataFrame([(1, {"a": "1", "b": "2", "c": "3"}, "", 500)], VERSION), folder, 4, bucket, merge)
    snapshot.merge_batch(spark.createDataFrame([(1, {"a": "1", "b": "2", "c": "3"}, "", 500)], VERSION), folder, 4, bucket, merge)
    assert {r.pmc_id: r.arrival for r in streams.current_best(spark, folder).collect()} == got | {1: 500}


def files(folder):
    return set(glob.glob(f"{folder}/data/**/*.parquet", recursive=True))


def submits(spark, *bundles):
    return spark.createDataFrame(
        list(bundles),
        "user string, submitted_at timestamp_ntz, success_dict map<int,boolean>, error_dict map<int,string>, full_text_ids array<int>",
    )


def test_upsert_leaves_untouched_files_alone(spark, folder):
    registry = G.registry_insert(spark.createDataFrame([], G.REGISTRY_SCHEMA), spark.range(0, 1000).select(F.col("id").cast("int").alias("pmc_id")))
    G.store_registry(registry, folder, 100)
    before = {f.split("/data/")[1] for f in files(folder)}
    assert len(before) == 10
    first = submits(spark, ("a", at(1), {3: True, 7: True}, {120: "bad"}, [3]), ("b", at(2), {}, {7: "later"}, None), ("c", at(3), None, {5000: "new"}, []))
    second = submits(spark, ("a", at(4), {120: True}, None, None))
    plain = G.registry_apply_results(G.registry_apply_results(registry, first), second)
    for batch_id, bundles in ((1, first), (2, second), (2, second)):
        G.registry_upsert(spark, folder, bundles, batch_id, 100)
    stored = G.stored_registry(spark, folder)
    key = lambda r: r[0]
    assert sorted(map(tuple, stored.collect()), key=key) == sorted(map(tuple, plain.select(*stored.columns).collect()), key=key)
    read = {f.split("/data/")[1] for f in stored.inputFiles()}
    # buckets 0, 1 and 50 were written anew, the files of the other eight keep their names
    assert len(read & before) == 8 and all("batch_id=0" in f for f in read & before)
    assert {f.split("/bucket=")[0] + "/" + f.split("bucket=")[1].split("/")[0] for f in read - before} == {"batch_id=1/0", "batch_id=1/50", "batch_id=2/1"}


def test_empty_registry(spark, folder):
    G.store_registry(spark.createDataFrame([], G.REGISTRY_SCHEMA), folder)
    assert G.stored_registry(spark, folder).count() == 0
    G.registry_upsert(spark, folder, submits(spark, ("a", at(1), {3: True}, None, None)), 1)
    assert [r.pmc_id for r in G.stored_registry(spark, folder).collect()] == [3]
