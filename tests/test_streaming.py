"""Streaming operators: drained stream equals batch, append holds back open
sessions, rows behind the watermark are dropped."""

import datetime as dt
import os

from conftest import SF01
from pyspark.sql import functions as F

from trafficlens.operators import ordered as O
from trafficlens.functions.expressions import ntz_micros
from trafficlens.streaming import stream as ST

GAP = 30 * 60 * 1_000_000


def _batch(spark):
    raw = spark.read.parquet(f"{SF01}/events.parquet").select("user_id", ntz_micros("ts").alias("us"), "event_id")
    return O.gap_sessions(raw, ["user_id"], "us", GAP, tie="event_id")


def test_append_mode_holds_back_open_sessions(spark):
    s = ST.drain(ST.stream_gap_sessions(ST.read_event_stream(spark, SF01)), "t-append")
    assert s.count() == 9525  # the last 24 sessions are still open at the watermark
    assert s.exceptAll(_batch(spark)).count() == 0


def test_late_rows_are_dropped(spark, tmp_path):
    """Three files, one micro-batch each. Spark filters late input with the
    previous batch's watermark, so a row far behind it in the third batch is
    dropped (append mode; complete mode keeps all state)."""
    import glob
    import shutil

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = tmp_path / "in"
    ev.where("ts < '2024-01-15'").coalesce(1).write.parquet(str(src / "b0"))
    ev.where("ts >= '2024-01-15'").coalesce(1).write.parquet(str(src / "b1"))
    late = spark.createDataFrame([(10**9, dt.datetime(2024, 1, 1, 0, 0, 1), 424242, "click", 1.0, '{"k": 1}')],
                                 ST.EVENTS_SCHEMA)
    late.coalesce(1).write.parquet(str(src / "b2"))
    flat = tmp_path / "flat"
    flat.mkdir()
    for i, part in enumerate(["b0", "b1", "b2"]):
        f = glob.glob(str(src / part / "*.parquet"))[0]
        dst = flat / f"{i}-events.parquet"
        shutil.copy(f, dst)
        os.utime(dst, (1_700_000_000 + 100 * i, 1_700_000_000 + 100 * i))  # file source orders by mtime
    stream = ST.read_event_stream(spark, str(flat), glob="*.parquet", max_files_per_trigger=1)
    out = ST.drain(ST.stream_gap_sessions(stream), "t-late")
    assert out.count() > 0
    assert out.where(F.col("user_id") == 424242).count() == 0


def test_stream_classify_equals_batch(spark):
    from __spark_entry__ import queries

    q = queries()
    s = q["stream_classify"](spark, SF01).select("session_id", "traffic_class")
    b = q["classify_sessions"](spark, SF01).select("session_id", "traffic_class")
    assert s.count() == b.count() == 10000
    assert s.exceptAll(b).count() == 0


def test_bidding_feed_equals_batch_payload(spark, tmp_path):
    from trafficlens.operators import classify as CL
    from trafficlens.operators import clean as CN
    from trafficlens.sources import fixtures as FX

    d = "/root/testdata/sf0.001"
    rows = FX.session_signals_from(ST.read_event_stream(spark, d), FX.nations(spark, d))
    q = ST.start_bidding_feed(rows, str(tmp_path / "feed"), str(tmp_path / "ck"), every=None)
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "feed"))
    want = CN.vbb_upload_payload(CL.classify_sessions(FX.session_signals(spark, d)))
    cols = ["session_id", "traffic_class", "conversion_value", "traffic_type"]
    assert got.count() == want.count() == 1000
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0


def test_split_sessions_spread_a_hot_user(spark, tmp_path):
    """One user with half of the hits: the same sessions as in one piece, the
    open spans of that user in several state partitions; a second drain with
    nothing new adds nothing."""
    hits = ST.read_event_stream(spark, SF01).withColumn(
        "user_id", F.when(F.col("event_id") % 2 == 0, F.lit(7)).otherwise(F.col("user_id")))
    split = lambda: ST.drain_split_sessions(hits, "t-split", folder=str(tmp_path / "split"))
    got = split()
    whole = ST.drain(ST.stream_gap_sessions(hits), "t-whole")
    end = got.agg(F.max("session_end_us")).first()[0]
    assert got.exceptAll(whole).count() == 0
    # those of the last minutes before the watermark are still open in the second half
    assert whole.where(F.col("session_end_us") <= end).exceptAll(got).count() == 0
    assert whole.count() - got.count() < 30
    state = spark.read.format("statestore").load(str(tmp_path / "split" / "spans-state"))
    assert state.where(F.col("key.user_id") == 7).select("partition_id").distinct().count() > 1
    n = got.count()
    assert split().count() == n


def test_split_sessions_edges(spark, tmp_path):
    import pytest

    (tmp_path / "none").mkdir()
    nothing = ST.read_event_stream(spark, str(tmp_path / "none"), glob="*.parquet")
    assert ST.drain_split_sessions(nothing, "t-none").count() == 0
    with pytest.raises(ValueError):
        ST.drain_split_sessions(nothing, "t-long", gap="5 minutes", span="10 minutes")
