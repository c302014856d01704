"""Order-dependent operators stay exact when one key spans many tasks."""

import pytest
from conftest import SF001
from oracle_check import digest
from pyspark.sql import functions as F

from trafficlens.functions.expressions import ntz_micros
from trafficlens.operators import ordered as O

HOT = """WITH r AS (SELECT user_id % 2 AS user_id, epoch_us(ts) AS us, event_id FROM events)"""
SESS = HOT + """,
g AS (SELECT *, us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) AS gap FROM r),
m AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > 1800000000 THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS sn FROM g)
SELECT user_id, min(us) AS session_start_us, max(us) + 1800000000 AS session_end_us, count(*) AS n_events
FROM m GROUP BY user_id, sn"""
STATS = HOT + """,
g AS (SELECT user_id, us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) AS gap FROM r)
SELECT user_id, count(gap) AS n_gaps, round(min(gap)/1000000.0,3) AS min_gap_sec, round(max(gap)/1000000.0,3) AS max_gap_sec,
 round(avg(gap)/1000000.0,3) AS avg_gap_sec, round(stddev_samp(gap)/1000000.0,3) AS stddev_gap_sec FROM g GROUP BY 1"""


def _hot(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    return ev.select((F.col("user_id") % 2).alias("user_id"), ntz_micros("ts").alias("us"), "event_id")


def _same(df, con, sql):
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    drows = res.fetchall()
    return len(rows) == len(drows) and digest(df.columns, rows)[0] == digest([d[0] for d in res.description], drows)[0]


@pytest.mark.parametrize("hours", [1, 7, 100, 10_000])
def test_gap_sessions_hot_keys(spark, duck001, hours):
    df = O.gap_sessions(_hot(spark), ["user_id"], "us", 30 * 60 * 1_000_000, tie="event_id", bucket_us=hours * O.HOUR_US)
    assert _same(df, duck001, SESS)


@pytest.mark.parametrize("hours", [1, 7, 100, 10_000])
def test_gap_stats_hot_keys(spark, duck001, hours):
    df = O.gap_stats(_hot(spark), ["user_id"], "us", tie="event_id", bucket_us=hours * O.HOUR_US)
    assert _same(df, duck001, STATS)


def test_hot_key_is_split_across_tasks(spark):
    rows = O.bucketed(_hot(spark), ["user_id"], "us", "event_id", O.HOUR_US)
    runs = rows.groupBy("user_id").agg(F.countDistinct(O.BUCKET).alias("buckets"), F.count("*").alias("n")).collect()
    assert all(r.buckets > 200 for r in runs)


def test_null_times_are_left_out(spark):
    df = spark.createDataFrame([("u", None, 1), ("u", 1_000_000, 2), ("u", 3_000_000, 3), ("v", None, 4)], "k string, us bigint, id bigint")
    s = O.gap_stats(df, ["k"], "us", tie="id").collect()
    assert [(r.k, r.n_gaps, r.min_gap_sec) for r in s] == [("u", 1, 2.0)]
    g = O.gap_sessions(df, ["k"], "us", 10_000_000, tie="id").collect()
    assert [tuple(r) for r in g] == [("u", 1_000_000, 13_000_000, 2)]


def test_null_keys_group_together(spark, duck001):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    df = ev.select(F.when(F.col("user_id") % 3 == 0, F.lit(None)).otherwise(F.col("user_id") % 3).cast("bigint").alias("user_id"),
                   ntz_micros("ts").alias("us"), "event_id")
    sql_keys = "CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id % 3 END"
    st = O.gap_stats(df, ["user_id"], "us", tie="event_id", bucket_us=5 * O.HOUR_US)
    assert _same(st, duck001, STATS.replace("user_id % 2 AS user_id", sql_keys + " AS user_id"))
    gs = O.gap_sessions(df, ["user_id"], "us", 30 * 60 * 1_000_000, tie="event_id", bucket_us=5 * O.HOUR_US)
    assert _same(gs, duck001, SESS.replace("user_id % 2 AS user_id", sql_keys + " AS user_id"))


def test_a_burst_is_one_row_before_the_shuffle(spark):
    """A client's hits within a gap are folded in the tasks that read them."""
    rows = spark.range(200_000).select(F.lit("bot").alias("k"), (F.lit(7_200_000_000) + F.col("id")).alias("us"))
    rows = rows.unionByName(spark.createDataFrame([("bot", 7_200_000_000 + 30 * 60 * 1_000_000 + 199_999), ("bot", 0), (None, 5)], "k string, us bigint"))
    df = O.gap_sessions(rows, ["k"], "us", 30 * 60 * 1_000_000)
    got = sorted((r.k or "", r.session_start_us, r.n_events) for r in df.collect())
    assert got == [("", 5, 1), ("bot", 0, 1), ("bot", 7_200_000_000, 200_001)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.rindex("HashAggregate") and "SortAggregate" not in plan


@pytest.mark.parametrize("gap", [0, 1, 3])
def test_gaps_of_single_microseconds(spark, gap):
    df = spark.createDataFrame([("a", t) for t in (0, 0, 1, 2, 6, 10, 10, 14)], "k string, us bigint")
    got = sorted((r.session_start_us, r.session_end_us - gap, r.n_events) for r in O.gap_sessions(df, ["k"], "us", gap, bucket_us=5).collect())
    want, run = [], []
    for t in (0, 0, 1, 2, 6, 10, 10, 14):
        if run and t - run[-1] > gap:
            want.append((run[0], run[-1], len(run)))
            run = []
        run.append(t)
    assert got == [*want, (run[0], run[-1], len(run))]
