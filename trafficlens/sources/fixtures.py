"""Test inputs derived from the driver tables (see FIXTURES.md).

The reference ships no data; these views give every operator its input shape
from ``events`` and ``nation``, deterministically and at any scale factor.
Each view is a plain DataFrame transformation of the source tables, so its
work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.expressions import channel_of, ntz_micros
from .tables import table

# Assignments of the fixture (FIXTURES.md), in natural order.
USER_SOURCES = (  # by user_id % 8: (source, medium)
    ("google", "cpc"),
    ("meta", "paid_social"),
    ("bing", "cpc"),
    ("programmatic", "display"),
    ("direct", "(none)"),
    (None, None),
    ("google", "organic"),
    ("newsletter", "email"),
)
USER_DEVICES = ("desktop", "mobile", "tablet", None)  # by user_id % 4
ROW_SOURCES = (  # by event_id % 8
    "google / cpc",
    "meta / paid_social",
    "bing / cpc",
    "programmatic / display",
    "direct / (none)",
    "(direct) / (none)",
    "google / organic",
    "newsletter / email",
)
ROW_DEVICES = ("desktop", "mobile", "tablet")  # by user_id % 3
BOT_UA = "GPTBot/1.0 (+https://openai.com/gptbot)"
HUMAN_UA = "Mozilla/5.0"
REFERRER = "https://example.com/"


def _pick(index, values) -> F.Column:
    """values[index] for a small fixed list, as a CASE expression."""
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v) if v is not None else F.lit(None).cast("string")
        expr = F.when(index == i, lit) if expr is None else expr.when(index == i, lit)
    return expr


def _k() -> F.Column:
    """``k`` of the JSON object ``props``; NULL where it is no whole number."""
    return F.from_json("props", "k string")["k"].try_cast("bigint")


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nations(spark, sf_dir)


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation name by key, one row per key. Being unique on the key, the
    lookup can never multiply events, and Catalyst removes the left join
    entirely from queries that do not use the name. The planner broadcasts
    it from its measured size and would fall back to a sort-merge join if it
    were large."""
    return table(spark, sf_dir, "nation").groupBy(F.col("n_nationkey").cast("bigint").alias("_nk")).agg(
        F.min("n_name").alias("_nation"))


def _events_with_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.join(_nations(spark, sf_dir), F.col("user_id") % 25 == F.col("_nk"), "left")


def ga_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View A: nested hit-level events in the analytics export shape."""
    ev = _events_with_nation(spark, sf_dir)
    k = _k()
    uid = F.col("user_id")
    name = (
        F.when(F.col("event_type") == "view", F.lit("page_view"))
        .when(F.col("event_type") == "signup", F.lit("scroll"))
        .otherwise(F.col("event_type"))
    )
    ev = ev.withColumn("_k", k).withColumn("event_name", name)
    null_s = F.lit(None).cast("string")
    null_i = F.lit(None).cast("bigint")
    sid = F.when(F.col("_k") != 0, uid * 100 + F.dayofmonth("ts")).cast("bigint")
    params = F.array(
        F.struct(F.lit("ga_session_id").alias("key"),
                 F.struct(null_s.alias("string_value"), sid.alias("int_value")).alias("value")),
        F.struct(F.lit("percent_scrolled").alias("key"),
                 F.struct(null_s.alias("string_value"),
                          F.when(F.col("event_name") == "scroll", F.col("_k")).cast("bigint").alias("int_value")).alias("value")),
        F.struct(F.lit("page_location").alias("key"),
                 F.struct(F.when(F.col("event_name") == "page_view",
                                 F.concat(F.lit("/p/"), (F.col("_k") % 10).cast("string"))).alias("string_value"),
                          null_i.alias("int_value")).alias("value")),
    )
    # ga_session_id is always present (possibly NULL); the others only when set.
    params = F.filter(params, lambda p: (p["key"] == "ga_session_id")
                      | p["value"]["int_value"].isNotNull() | p["value"]["string_value"].isNotNull())
    src = uid % 8
    return ev.select(
        uid.cast("string").alias("user_pseudo_id"),
        F.col("event_id"),
        ntz_micros("ts").alias("event_timestamp"),
        F.to_date("ts").alias("event_date"),
        F.col("event_name"),
        params.alias("event_params"),
        F.struct(_pick(src, [s for s, _ in USER_SOURCES]).alias("source"),
                 _pick(src, [m for _, m in USER_SOURCES]).alias("medium")).alias("traffic_source"),
        F.struct(F.when(uid % 11 != 0, F.col("_nation")).alias("country")).alias("geo"),
        F.struct(_pick(uid % 4, USER_DEVICES).alias("category")).alias("device"),
    )


def session_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View B: one enriched session row per event, with a ground-truth label."""
    return session_signals_from(table(spark, sf_dir, "events"), _nations(spark, sf_dir))


def session_signals_from(events: DataFrame, nations: DataFrame) -> DataFrame:
    """View B over any events DataFrame, batch or streaming (the nation
    lookup is a stream-static join)."""
    ev = events.join(nations, F.col("user_id") % 25 == F.col("_nk"), "left")
    k = _k()
    eid, uid, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    return ev.select(
        eid.alias("session_id"),
        uid.alias("client_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("event_timestamp"),
        (k / F.lit(100.0)).alias("edge_score"),
        F.round(F.col("value") / F.lit(5.0), 2).alias("event_velocity_per_sec"),
        ((eid * 7) % 120).alias("session_duration_sec"),
        F.when(et.isin("click", "purchase", "signup"), eid % 231 + 20).otherwise(F.lit(0)).cast("bigint").alias("mouse_move_events"),
        F.when(et == "click", 1).otherwise(0).cast("bigint").alias("click_events"),
        F.when(et == "signup", 1).otherwise(0).cast("bigint").alias("scroll_events"),
        k.alias("page_scroll_depth_pct"),
        (F.lit(1) + eid % 20).cast("bigint").alias("total_events"),
        _pick(eid % 8, ROW_SOURCES).alias("source_medium"),
        F.col("_nation").alias("geo_country"),
        _pick(uid % 3, ROW_DEVICES).alias("device_category"),
        F.concat(F.lit("/p/"), (k % 10).cast("string")).alias("landing_page"),
        F.when(k >= 60, F.lit(C.HUMAN)).when(k >= 25, F.lit(C.SCRAPER)).otherwise(F.lit(C.FRAUD)).alias("raw_traffic_label"),
        F.when(eid % 10 < 4, F.lit(BOT_UA)).otherwise(F.lit(HUMAN_UA)).alias("user_agent"),
        F.when(eid % 3 == 0, F.lit("")).otherwise(F.lit(REFERRER)).alias("referrer"),
        F.col("ts").alias("_ts"),
        F.col("value").alias("_value"),
        *([F.col("revision")] if "revision" in events.columns else []),
    )


def late_signals(events: DataFrame) -> DataFrame:
    """Measured signals of view B for four in five sessions, each with a time 0 to
    89 minutes after the session's (batch or streaming)."""
    eid = F.col("event_id")
    return events.where(eid % 5 != 0).select(
        F.col("user_id").alias("client_id"), eid.alias("session_id"), (_k() / F.lit(100.0)).alias("edge_score"),
        F.when(F.col("event_type").isin("click", "purchase", "signup"), eid % 231 + 20).otherwise(F.lit(0)).cast("bigint").alias("mouse_move_events"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), (eid % 90).cast("int"))).alias("_signal_ts"))


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View C: measured edge score and mouse moves for 4 in 5 sessions of A.

    Same session keys and allow-list as sessionisation of view A; the score is
    max(k) / 100 and the mouse count 10 x clicks of the session."""
    ev = table(spark, sf_dir, "events")
    k = _k()
    name = (
        F.when(F.col("event_type") == "view", F.lit("page_view"))
        .when(F.col("event_type") == "signup", F.lit("scroll"))
        .otherwise(F.col("event_type"))
    )
    sid = F.when(k != 0, F.col("user_id") * 100 + F.dayofmonth("ts")).cast("bigint")
    return (
        ev.select(F.col("user_id").cast("string").alias("client_id"), sid.alias("session_id"),
                  k.alias("_k"), name.alias("_name"))
        .where(F.col("_name").isin(*C.EVENT_ALLOWLIST) & F.col("session_id").isNotNull()
               & (F.col("session_id") % 5 != 0))
        .groupBy("client_id", "session_id")
        .agg((F.max("_k") / F.lit(100.0)).alias("edge_score"),
             (F.count_if(F.col("_name").isin(*C.CLICK_EVENTS)) * 10).cast("bigint").alias("mouse_move_events"))
    )


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed conversion values: one row per purchase of view B."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return ev.select(F.col("event_id").alias("session_id"), F.round("value", 2).alias("conversion_value_usd"))


def roi_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior-style ROI draws per channel, derived from view B."""
    ev = table(spark, sf_dir, "events")
    k = _k()
    eid = F.col("event_id")
    return ev.select(
        channel_of(_pick(eid % 8, ROW_SOURCES)).alias("channel"),
        (eid % 4).cast("int").alias("chain"),
        eid.alias("draw"),
        (F.lit(2.0) + k / F.lit(50.0)).alias("roi"),
    )


def media_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend per country, Monday week and paid channel, independent of value."""
    ev = _events_with_nation(spark, sf_dir)
    ch = channel_of(_pick(F.col("event_id") % 8, ROW_SOURCES))
    return (
        ev.select(
            F.col("_nation").alias("geo"),
            F.to_date(F.date_trunc("week", F.col("ts").cast("timestamp"))).alias("week"),
            ch.alias("channel"),
            F.col("value"),
        )
        .where(F.col("channel").isin(*C.PAID_CHANNELS))
        .groupBy("geo", "week", "channel")
        .agg(F.round(F.sum("value"), 2).alias("spend"))
    )
