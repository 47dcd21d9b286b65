"""The session account on a stream against the batch columns of the action log."""

import os
import random
import tempfile
from datetime import datetime, timedelta

import pytest

from kintsugi.operators import actionlog
from kintsugi.sources import fixtures as fx
from kintsugi.streaming import ledger

SCHEMA = "session_id long, event_id long, ts timestamp, action_type string, valid boolean, note string"
START = datetime(2024, 3, 1)


@pytest.fixture
def store(spark):
    before = spark.conf.get(ledger.STATE_STORE, None)
    spark.conf.set(ledger.STATE_STORE, ledger.ROCKSDB)
    yield
    spark.conf.set(ledger.STATE_STORE, before) if before else spark.conf.unset(ledger.STATE_STORE)


def actions(n, seed, sessions=6):
    """Actions in time order; session 0 holds a third of them, ties in time included."""
    rng = random.Random(seed)
    kinds = [*actionlog.KNOWN_ACTIONS, "unlisted", None]
    return [(0 if i % 3 == 0 else rng.choice([None, *range(1, sessions)]), i, START + timedelta(minutes=i // 2, microseconds=i // 2),
             rng.choices(kinds, weights=[5] * 11 + [1, 3, 3])[0], rng.choice([True, True, False, None]), f"n{i}") for i in range(n)]


def streamed(spark, parts, delay, **kw):
    """The ledger over one file per part, one micro-batch each."""
    base = tempfile.mkdtemp(prefix="kintsugi-ledger-")
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/log")
    files = [f for f in os.listdir(f"{base}/log") if f.endswith(".parquet")]
    assert len(files) == len(parts)
    log = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{base}/log")
    accounts = ledger.ledger(log, delay=delay, **kw)
    query = accounts.writeStream.outputMode("append").format("parquet").option("path", f"{base}/out") \
        .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(accounts.schema).parquet(f"{base}/out")


CLOSE = [(-1, -1, START + timedelta(days=400), None, None, None)]


def test_micro_batches_equal_the_batch(spark, store):
    rows = actions(240, 3)
    # neighbouring parts overlap by up to 20 minutes, and each is out of order in itself
    rng = random.Random(5)
    late = sorted(rows, key=lambda r: r[2] + timedelta(minutes=rng.randint(0, 20)))
    parts = [late[i:i + 80] for i in range(0, 240, 80)]
    for part in parts:
        rng.shuffle(part)
    got = streamed(spark, [*parts, CLOSE], "21 minutes", max_steps=9).where("session_id is null or session_id >= 0")
    batch = actionlog.annotate(spark.createDataFrame(rows, SCHEMA), max_steps=9)
    assert sorted(map(str, got.select(batch.columns).collect())) == sorted(map(str, batch.collect()))
    ends = {(r.session_id, r.end_step, r.ended_by) for r in actionlog.session_end(batch, max_steps=9).collect() if r.ended_by != "open"}
    found = ledger.session_ends(got).collect()
    assert {(r.session_id, r.end_step, r.ended_by) for r in found} == ends and len(found) == len(ends)
    assert {r.ended_by for r in found} == {"finish", "max_steps"}


def test_late_actions_are_dropped_and_idle_sessions_forgotten(spark, store):
    at = lambda hours: START + timedelta(hours=hours)
    first = [(1, 1, at(0), "cast_type", True, "a"), (1, 2, at(1), "finish", True, "b"), (2, 3, at(30), "cast_type", True, "c")]
    second = [(2, 5, at(31), "cast_type", True, "e"), (2, 6, at(60), "cast_type", True, "f")]
    third = [(1, 4, at(2), "cast_type", True, "late"), (1, 7, at(70), "cast_type", True, "again"), (3, 8, at(71), "cast_type", True, "g")]
    kept = streamed(spark, [first, second, third, CLOSE], "1 hour").where("session_id >= 0").collect()
    assert sorted((r.event_id, r.step, r.active) for r in kept) == \
        [(1, 1, True), (2, 2, True), (3, 1, True), (5, 2, True), (6, 3, True), (7, 3, False), (8, 1, True)]
    forgot = streamed(spark, [first, second, third, CLOSE], "1 hour", forget=timedelta(hours=20)).where("session_id = 1").collect()
    assert sorted((r.event_id, r.step, r.active) for r in forgot) == [(1, 1, True), (2, 2, True), (7, 1, True)]


def test_replay_of_the_log_equals_the_batch(spark, tables):
    log = fx.action_log(tables)
    got = ledger.replay(log)
    batch = actionlog.annotate(log)
    assert sorted(map(str, got.select(batch.columns).collect())) == sorted(map(str, batch.collect()))
    assert sorted(map(tuple, actionlog.session_end(got).collect())) == sorted(map(tuple, actionlog.session_end(batch).collect()))
    empty = ledger.replay(log.limit(0))
    assert empty.count() == 0 and set(batch.columns) <= set(empty.columns)
    assert got.schema["ts"].dataType == log.schema["ts"].dataType


def test_calls_to_the_state_do_not_grow_with_the_sessions(spark, store):
    rows = [(s, s * 3 + i, START + timedelta(minutes=i), "finish" if i == 2 else "cast_type", True, "n") for s in range(300) for i in range(3)]
    log = spark.createDataFrame(rows, SCHEMA)
    base = tempfile.mkdtemp(prefix="kintsugi-ledger-")
    log.union(spark.createDataFrame(CLOSE, SCHEMA)).write.parquet(f"{base}/log")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{base}/log")
    accounts = ledger.ledger(stream, buckets=16)
    query = accounts.writeStream.outputMode("append").format("parquet").option("path", f"{base}/out") \
        .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sum(p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress) < 300
    got = spark.read.schema(accounts.schema).parquet(f"{base}/out").where("session_id >= 0")
    batch = actionlog.annotate(log)
    assert sorted(map(str, got.select(batch.columns).collect())) == sorted(map(str, batch.collect()))
