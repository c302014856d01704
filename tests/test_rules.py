"""Boundary rows for the classifier cascade and the behaviour tiers."""

import math

import pytest

from pyspark.sql import functions as F

from trafficlens.operators.user_map import with_channel_of_table
from trafficlens import config as C
from trafficlens.functions import expressions as X

SCHEMA = "edge_score double, event_velocity_per_sec double, session_duration_sec bigint, mouse_move_events bigint"

CASES = [
    # score, velocity, duration, mouse, class, rule
    (0.19, 20.01, 100, 50, C.FRAUD, 1),
    (0.20, 20.01, 0, 0, C.SCRAPER, 2),        # 0.20 is not < 0.20 -> rule 2
    (0.19, 20.0, 100, 50, C.FRAUD, 6),        # velocity 20 is not > 20
    (0.47, 8.01, 9, 0, C.SCRAPER, 2),
    (0.48, 8.01, 9, 0, C.SCRAPER, 5),         # 0.48 not < 0.48, falls to >= 0.38
    (0.47, 8.0, 9, 0, C.SCRAPER, 5),          # velocity 8 is not > 8
    (0.47, 8.01, 10, 0, C.SCRAPER, 5),        # duration 10 is not < 10
    (0.47, 8.01, 9, 1, C.SCRAPER, 5),         # mouse 1 is not 0
    (0.55, 5.0, 30, 1, C.HUMAN, 3),
    (0.549, 5.0, 30, 1, C.SCRAPER, 5),
    (0.55, 5.01, 30, 1, C.SCRAPER, 5),
    (0.55, 5.0, 29, 1, C.SCRAPER, 5),
    (0.55, 5.0, 30, 0, C.SCRAPER, 5),
    (0.62, 50.0, 0, 0, C.HUMAN, 4),           # high velocity, high score: still Human
    (0.619, 50.0, 0, 0, C.SCRAPER, 5),
    (0.38, 1.0, 100, 0, C.SCRAPER, 5),
    (0.379, 1.0, 100, 0, C.FRAUD, 6),         # slow low-score traffic is fraud
    (None, 1.0, 100, 5, C.FRAUD, 6),          # missing score
    (float("nan"), 1.0, 100, 5, C.FRAUD, 6),  # NaN must not become Human
    (0.9, None, None, None, C.HUMAN, 4),
]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame([c[:4] for c in CASES], SCHEMA)
    out = df.select("*", X.classify().alias("cls"), X.classify_rule().alias("rule")).collect()
    return out


@pytest.mark.parametrize("i", range(len(CASES)))
def test_cascade(rows, i):
    exp_cls, exp_rule = CASES[i][4], CASES[i][5]
    r = rows[i]
    assert (r.cls, r.rule) == (exp_cls, exp_rule), CASES[i]


def test_tiers_and_imputation(spark):
    df = spark.createDataFrame(
        [(30, 5.0, 1, 0, "google / cpc"), (2, 1.0, 0, 0, "programmatic / display"), (100, 15.1, 0, 1, "Bing / CPC"),
         (29, 5.0, 1, 0, None), (3, 15.0, 0, 0, "x"), (1000, 1.0, 0, 1, "y")],
        "session_duration_sec bigint, event_velocity_per_sec double, click_events bigint, scroll_events bigint, source_medium string")
    out = df.select(X.behavior_tier().alias("t"), X.tier_score(X.behavior_tier()).alias("s"),
                    X.imputed_mouse().alias("m")).collect()
    assert [r.t for r in out] == ["engaged", "bursty_display", "bursty", "mixed", "mixed", "mixed"]
    assert [r.s for r in out] == [0.8, 0.111, 0.25, 0.556, 0.556, 0.556]
    # lo = max(5, int(.3d)), hi = max(lo, min(300, int(.8d))), midpoint; 0 without clicks/scrolls
    assert [r.m for r in out] == [(9 + 24) // 2, 0, (30 + 80) // 2, (8 + 23) // 2, 0, (300 + 300) // 2]


def test_channel_and_value_lookups(spark):
    df = spark.createDataFrame([("Google / CPC",), ("google / cpc",), ("google / organic search",), (None,),
                                ("(direct) / (none)",), ("x programmatic / display y",)], "source_medium string")
    out = df.select(X.channel_of("source_medium").alias("c"), X.conversion_value("source_medium").alias("v")).collect()
    # channel: lower-cased substring; value: exact, case-sensitive
    assert [(r.c, r.v) for r in out] == [("Google Ads", 100.0), ("Google Ads", 150.0), ("Organic", 100.0),
                                         ("Other", 100.0), ("Direct", 200.0), ("Display", 100.0)]


def test_insight_on_rounded_percent(spark):
    df = spark.createDataFrame([(40.0,), (39.9,), (20.0,), (19.9,)], "p double")
    out = [r.i for r in df.select(X.insight("p").alias("i")).collect()]
    assert out == [C.INSIGHT_HIGH, C.INSIGHT_MODERATE, C.INSIGHT_MODERATE, C.INSIGHT_LOW]
    assert not math.isnan(0.0)


def test_user_supplied_channel_table_equals_builtin(spark):
    table = spark.createDataFrame([(k, n, i) for i, (k, n) in enumerate(C.CHANNEL_NAMES)],
                                  "key string, name string, priority int")
    df = spark.createDataFrame([("Google / CPC",), ("x",), (None,), ("google / organic search",)], "source_medium string")
    a = [r[0] for r in df.select(X.channel_of("source_medium")).collect()]
    b = {r.source_medium: r.channel for r in with_channel_of_table(df, table).collect()}
    assert a == ["Google Ads", "Other", "Other", "Organic"]
    assert [b[s] for s in ("Google / CPC", "x", None, "google / organic search")] == a


def test_channel_table_ties_nulls_and_repeated_rows(spark):
    table = spark.createDataFrame([("ab", "second", 1), ("AB", "again", 1), (None, "null key", 0), ("a", "late", 2)],
                                  "key string, name string, priority int")
    df = spark.createDataFrame([("xaby", 1), ("xaby", 1), ("a", 2), (None, 3), ("q", 4)], "source_medium string, n int")
    got = sorted((str(r.source_medium), r.n, r.channel) for r in with_channel_of_table(df, table).collect())
    assert got == [("None", 3, "Other"), ("a", 2, "late"), ("q", 4, "Other"), ("xaby", 1, "again"), ("xaby", 1, "again")]


def test_iso_text_in_a_skipped_hour(spark):
    """02:30 UTC on the day New York skips 02:00 to 03:00."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        us = 1_710_037_800_000_000
        assert spark.range(1).select(X.micros_to_iso(F.lit(us))).first()[0] == "2024-03-10T02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
