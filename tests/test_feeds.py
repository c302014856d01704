"""Signals that arrive on a stream, and the feed that can be replayed."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from trafficlens.session import scratch_path
from trafficlens.streaming import feed as FD
from trafficlens.streaming import stream as ST

SESSIONS = "client_id long, session_id long, _ts timestamp, session_duration_sec long"
SIGNALS = "client_id long, session_id long, edge_score double, mouse_move_events long, _signal_ts timestamp"
T0 = dt.datetime(2024, 1, 1, 12, 0)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_late_signals_and_state_bound(spark):
    """Batch by batch: a signal in time, one too late, one never, two for one session."""
    a, b, out, state = (scratch_path(spark, n) for n in ("t-sess", "t-sig", "t-out", "t-state"))

    def step(sessions, signals):
        spark.createDataFrame(sessions, SESSIONS).coalesce(1).write.mode("append").parquet(a)
        spark.createDataFrame(signals, SIGNALS).coalesce(1).write.mode("append").parquet(b)
        s, g = spark.readStream.schema(SESSIONS).parquet(a), spark.readStream.schema(SIGNALS).parquet(b)
        rows = ST.drain(ST.attach_signals_stream(s, g, "1 hour", "30 minutes"), "t-attach", out, state).collect()
        return sorted((r.session_id, r.edge_score, r.mouse_move_events) for r in rows)

    first = step([(1, i, at(0), 10) for i in (1, 2, 3, 4)], [(1, 1, 0.5, 7, at(59)), (1, 4, 0.25, 1, at(5)), (9, 9, 0.9, 9, at(0))])
    assert first == [(1, 0.5, 7), (4, 0.25, 1)]  # 2 and 3 may still get theirs
    # for session 2 too late, for 4 a second one; the clock passes the wait
    second = step([(1, 5, at(300), 10)], [(1, 2, 0.75, 7, at(61)), (1, 4, 0.9, 2, at(6)), (1, 6, 0.1, 0, at(300))])
    assert second == [(1, 0.5, 7), (2, None, None), (3, None, None), (4, 0.25, 1)]
    # a session behind the watermark is dropped, the open one is still held back
    assert step([(1, 7, at(-600), 10)], [(1, 7, 0.3, 1, at(-600))]) == second


@pytest.fixture()
def feed(spark):
    return scratch_path(spark, "t-feed"), scratch_path(spark, "t-ledger")


SCHEMA = "client_id long, session_id long, value double, revision long, day date"


def rows(spark, data):
    return spark.createDataFrame([(1, i, v, r, d) for i, v, r, d in data], SCHEMA)


def stored(spark, path):
    return sorted((r.session_id, r.value, r.revision, r.day) for r in FD.read_feed(spark, path, rows(spark, []).schema).collect())


D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def test_batches_merge_by_key_and_revision(spark, feed):
    path, ledger = feed
    run = FD.upsert(path, ledger, "f")
    run(rows(spark, [(1, 1.0, 0, D1), (2, 2.0, 0, D2), (3, 3.0, 0, None)]), 0)
    run(rows(spark, [(1, 9.0, 2, D1), (1, 5.0, 1, D1), (3, 4.0, 1, None)]), 1)  # corrections, out of order
    want = [(1, 9.0, 2, D1), (2, 2.0, 0, D2), (3, 4.0, 1, None)]
    assert sorted(stored(spark, path), key=str) == sorted(want, key=str)
    run(rows(spark, [(1, 1.0, 0, D1)]), 2)  # an older revision
    assert sorted(stored(spark, path), key=str) == sorted(want, key=str)
    run(rows(spark, []), 3)
    assert {r.batch_id: r["rows"] for r in FD.read_ledger(spark, ledger).collect()} == {0: 3, 1: 2, 2: 1, 3: 0}


def test_a_repeated_batch_changes_nothing(spark, feed):
    path, ledger = feed
    batch = rows(spark, [(i, float(i), 0, D1) for i in range(50)])
    run = FD.upsert(path, ledger, "f")
    run(batch, 0)
    before, files = stored(spark, path), sorted(os.listdir(f"{path}/day=2024-01-01"))
    run(batch, 0)  # finished: the ledger says so, nothing is written
    assert stored(spark, path) == before and sorted(os.listdir(f"{path}/day=2024-01-01")) == files
    FD.merge(batch, path, ("client_id", "session_id"), "revision", "day")  # it failed before the ledger was written
    assert stored(spark, path) == before


def test_only_touched_days_are_written(spark, feed):
    path, ledger = feed
    run = FD.upsert(path, ledger, "f")
    run(rows(spark, [(1, 1.0, 0, D1), (2, 2.0, 0, D2)]), 0)
    other = sorted(os.listdir(f"{path}/day=2024-01-02"))
    run(rows(spark, [(3, 3.0, 0, D1)]), 1)
    assert sorted(os.listdir(f"{path}/day=2024-01-02")) == other
    assert [r[0] for r in stored(spark, path)] == [1, 2, 3]


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    many = spark.range(20_000).select(F.lit(1).cast("long").alias("client_id"), F.lit(1).cast("long").alias("session_id"),
                                      F.col("id").cast("double").alias("value"), F.col("id").alias("revision"), F.lit(D1).alias("day"))
    out = FD.newest(many, ("client_id", "session_id"), "revision")
    assert [tuple(r) for r in out.collect()] == [(1, 1, 19999.0, 19999, D1)]
    assert "partial_max" in out._jdf.queryExecution().executedPlan().toString()
