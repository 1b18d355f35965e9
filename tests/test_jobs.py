"""Relational jobs: skewed logs against pandas, keys against a plain loop, and all light
queries against their SQL."""

from __future__ import annotations

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check_queries import TABLES, compare
from scholion.functions.keys import growing_keys, restart_keys
from scholion.operators import fetch_log as L
from scholion.operators import reconcile as R
from scholion.operators import registry as G
from scholion.plans import catalog, oracle

SF = "/root/testdata/sf0.001"
LIGHT = [
    n
    for n in catalog.jobs()
    if not n.startswith(("xml_", "html_", "stream_", "markup_", "src_xml"))
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", LIGHT)
def test_light_query(spark, con, name):
    same, text = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert same, text


def test_every_query_has_sql():
    assert set(catalog.jobs()) == set(oracle.statements())
    assert set(catalog.jobs()) <= set(entry.queries()) and set(oracle.statements()) <= set(entry.oracle_sql())


def hot_log(spark):
    """One worker holds most of the log; many calls share a second."""
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    outcomes = ["Success"] * 6 + ["HttpBan", "Timeout", "HttpError", "HttpError", "EmptyResponse"]
    rows, at = [], 0
    for i in range(900):
        at += rng.choice([0, 10, 200, 900])
        worker = 1 if i % 10 else rng.randint(2, 3)
        outcome = "HttpError" if 300 < i < 340 else rng.choice(outcomes)
        rows.append((worker, i, start + dt.timedelta(milliseconds=at), outcome, 900 + i % 50))
    schema = "worker int, event_id int, ts timestamp_ntz, outcome string, delay_ms int"
    return rows, spark.createDataFrame(rows, schema)


def by_worker(rows):
    for w in {r[0] for r in rows}:
        yield [r for r in sorted(rows, key=lambda r: (r[2], r[1])) if r[0] == w]


def test_chunked_windows_on_a_hot_worker(spark):
    rows, log = hot_log(spark)
    want = {}
    for mine in by_worker(rows):
        streak, pause = 0, None
        for i, (_, event, ts, outcome, _) in enumerate(mine):
            paused = pause is not None and ts < pause
            streak = 0 if outcome == "Success" else streak + 1
            seconds = 60 if outcome == "HttpBan" else 20 if streak >= 5 else None
            if seconds:
                until = ts + dt.timedelta(seconds=seconds)
                pause = until if pause is None else max(pause, until)
            last = [L.PRESSURE[r[3]] for r in mine[max(0, i - 29) : i + 1]]
            want[event] = (streak, pause, paused, sum(last) / (100 * len(last)))
    for seconds in (3600, 5):
        got = {r["event_id"]: r for r in L.pause_windows(log, seconds).collect()}
        paused = {r["event_id"]: r["is_paused"] for r in L.paused_attempts(log, seconds).collect()}
        pressure = {r["event_id"]: r["pressure"] for r in L.rolling_pressure(log, seconds).collect()}
        for event, (streak, until, is_paused, mean) in want.items():
            assert (got[event]["streak"], got[event]["pause_until"]) == (streak, until)
            assert paused[event] == is_paused
            assert abs(pressure[event] - mean) < 1e-12


def test_rate_audit_on_a_hot_worker(spark):
    rows, log = hot_log(spark)
    want = {}
    for mine in by_worker(rows):
        for i, r in enumerate(mine):
            count = sum(1 for s in mine[: i + 1] if s[2] > r[2] - dt.timedelta(seconds=1))
            gap = None if i == 0 else (r[2] - mine[i - 1][2]) // dt.timedelta(milliseconds=1)
            want[r[1]] = (gap, count)
    for seconds in (1, 7, 3600):
        got = L.rate_gap_audit(log, seconds=seconds).collect()
        assert {r["event_id"]: (r["gap_ms"], r["last_second"]) for r in got} == want
    zoned = log.withColumn("ts", F.col("ts").cast("timestamp"))
    got = L.rate_gap_audit(zoned, seconds=7).collect()
    assert {r["event_id"]: (r["gap_ms"], r["last_second"]) for r in got} == want


def test_rate_audit_of_repeated_rows(spark):
    """As many rows come out as go in; each is a dispatch of its own."""
    rows, _ = hot_log(spark)
    rng = random.Random(6)
    rows = rows + rng.choices(rows, k=300) + [rows[5]] * 40
    start = dt.datetime(2024, 1, 1)
    rows += [(9, e, start, "Success", 900) for e in (7, 7, 8)]
    log = spark.createDataFrame(rows, "worker int, event_id int, ts timestamp_ntz, outcome string, delay_ms int").repartition(3)
    want = []
    for mine in by_worker(rows):
        for i, r in enumerate(mine):
            count = sum(1 for s in mine[: i + 1] if s[2] > r[2] - dt.timedelta(seconds=1))
            gap = None if i == 0 else (r[2] - mine[i - 1][2]) // dt.timedelta(milliseconds=1)
            want.append((r[0], r[1], -1 if gap is None else gap, count))
    for seconds in (1, 3600):
        got = L.rate_gap_audit(log, seconds=seconds).collect()
        assert sorted((r.worker, r.event_id, -1 if r.gap_ms is None else r.gap_ms, r.last_second) for r in got) == sorted(want)


@pytest.mark.parametrize("bits", [4, 16])
def test_running_totals_over_far_batches(spark, bits):
    rng = random.Random(bits)
    batches = sorted({rng.randrange(2 ** rng.choice([3, 9, 20, 40, 62])) for _ in range(300)} | {0})
    rows = [(b, rng.randint(0, 9)) for b in batches]
    times = [(b, dt.datetime(2024, 1, 1, 0, i // 60, i % 60), dt.datetime(2024, 1, 1, 1, i // 60, i % 60)) for i, b in enumerate(batches)][5:]
    summaries = spark.createDataFrame(rows, "batch long, unique long")
    timed = spark.createDataFrame(times, "batch long, started_at timestamp_ntz, ended_at timestamp_ntz")
    if bits == 4:
        got = {r.batch: (r.processed, r.total_processed) for r in R.batch_running_totals(summaries, bits=13).collect()}
    else:
        found = {r.batch: r for r in R.batch_running_totals(summaries, timed).collect()}
        got = {b: (r.processed, r.total_processed) for b, r in found.items()}
        assert found[batches[0]].elapsed is None and found[batches[5]].batch_seconds == 3600.0
        assert abs(found[batches[65]].elapsed - 61.0) < 1e-9
    total, want = 0, {}
    for b, n in rows:
        total += n
        want[b] = (n, total)
    assert got == want
    assert R.batch_running_totals(summaries.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_claims_of_uneven_sizes(spark, block):
    registry = G.registry_insert(spark.createDataFrame([], G.REGISTRY_SCHEMA), spark.range(100, 160).select(F.col("id").cast("int").alias("pmc_id")))
    sizes = [("b", 25), ("a", 3), ("a", 3), ("c", 0), ("d", None), ("e", -4), ("f", 1), ("g", 40), ("h", 5), ("i", 2)]
    workers = spark.createDataFrame(sizes, "user string, size int")
    got = {r.pmc_id: r.user for r in G.registry_claim_sizes(registry, workers, block=block).collect()}
    line = [u for u, n in sorted(((u, n) for u, n in sizes if n and n > 0)) for _ in range(n)]
    assert got == dict(zip(range(100, 160), line))
    assert set(got.values()) == {"a", "b", "f", "g"}  # rows ran out
    many = spark.range(500).select(F.format_string("%04d", "id").alias("user"), F.lit(1).alias("size"))
    assert sorted(r.user for r in G.registry_claim_sizes(registry, many, block=block).collect()) == [f"{i:04d}" for i in range(60)]
    assert G.registry_claim_sizes(registry, workers.limit(0)).count() == 0


def loop_keys(titles, grow):
    keys, n = [], 1
    for title in titles:
        if not title:
            title, n = f"section_{n}", n + 1
        key = title
        while key in keys:
            key, n = f"{key if grow else title}_{n}", n + 1
        keys.append(key)
    return keys


def test_keys_against_a_loop(spark):
    rng = random.Random(5)
    pool = ["R", "R", "", "S", "R_1", "R_2", "R_1_2", "section_1", "section_2"]
    lists = [[rng.choice(pool) for _ in range(rng.randint(0, 12))] for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(lists)), "i int, titles array<string>")
    items = F.transform("titles", lambda t: F.struct(t.alias("title"), F.lit(0).alias("scope")))
    rows = df.select("i", restart_keys(F.col("titles")).alias("a"), growing_keys(items).alias("b"))
    for r in rows.collect():
        assert r["a"] == loop_keys(lists[r["i"]], grow=False)
        assert r["b"] == loop_keys(lists[r["i"]], grow=True)


def test_best_version_ties_keep_the_first(spark):
    rows = [(1, {"a": "x"}, "abc", 5), (1, {"a": "x"}, "abc", 3), (1, None, "abcdef", 1), (2, {}, None, 9)]
    df = spark.createDataFrame(
        rows, "pmc_id int, sections map<string,string>, abstract_text string, arrival int"
    )
    assert sorted(r["arrival"] for r in R.best_version(df).collect()) == [3, 9]


def test_registry_round(spark):
    empty = spark.createDataFrame([], G.REGISTRY_SCHEMA)
    ids = spark.createDataFrame([(i,) for i in (5, 3, 3, 9, None)], "pmc_id int")
    registry = G.registry_insert(empty, ids)
    assert G.registry_insert_count(registry, ids).first()["inserted"] == 0
    claimed = G.registry_claim(registry, ["a", "b"], 1)
    assert {(r["pmc_id"], r["user"]) for r in claimed.collect()} == {(3, "a"), (5, "b")}
    noted = G.registry_after_claim(registry, claimed)
    assert [r["pmc_id"] for r in noted.where(G.is_free()).collect()] == [9]
    at = dt.datetime(2024, 1, 2)
    submits = spark.createDataFrame(
        [("a", at, {3: True}, {}, [3]), ("b", at, {}, {5: "bad"}, None)],
        "user string, submitted_at timestamp_ntz, success_dict map<int,boolean>, "
        "error_dict map<int,string>, full_text_ids array<int>",
    )
    stats = G.registry_stats(G.registry_apply_results(noted, submits)).first()
    assert tuple(stats) == (3, 2, 1, 1, 1)
